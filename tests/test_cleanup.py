"""Clean-up rules on literal cases with invented names."""

import datetime as dt

from pyspark.sql import functions as F

from casegraph.operators import cleanup, media

DAY = dt.date(2031, 3, 10)


def day(n):
    return DAY + dt.timedelta(n)


def one(spark, **values):
    base = {"incident_date": None, "death_date": None, "incident_date_possible": None, "flags": [], "police_status": None, "suspect_status": None, "legal_status": None, "police_investigation_status": None, "suspect_conflicts": [], "sources": []}
    schema = "incident_date date, death_date date, incident_date_possible date, flags array<string>, police_status string, suspect_status string, legal_status string, police_investigation_status string, suspect_conflicts array<string>, sources array<struct<url:string,publisher:string,published:date,roles:array<string>>>"
    return spark.createDataFrame([tuple((base | values).values())], schema)


def test_dates_are_repaired(spark):
    get = lambda **v: tuple(cleanup.repair_dates(one(spark, **v)).select("incident_date", "death_date", "incident_date_possible", "flags").first())
    assert get(incident_date=day(2), death_date=day(0)) == (day(0), day(2), None, ["date_chronology_repaired"])
    assert get(incident_date=day(0), incident_date_possible=day(1)) == (day(1), day(1), day(0), [])
    assert get(incident_date=day(1), incident_date_possible=day(0)) == (day(1), day(1), day(0), [])
    assert get() == (None, None, None, [])


def test_statuses_find_their_axes(spark):
    get = lambda f, **v: tuple(f(one(spark, **v)).select("suspect_status", "legal_status", "police_investigation_status", "suspect_conflicts").first())
    assert get(cleanup.split_status, police_status="Charged") == ("in_custody", "indicted", "completed", [])
    assert get(cleanup.split_status, police_status="trial", legal_status="convicted") == (None, "convicted", None, [])
    assert get(cleanup.split_status, suspect_status="convicted") == ("in_custody", "convicted", None, [])
    assert get(cleanup.collapse_status, suspect_status="in custody", suspect_conflicts=["arrested", "in_custody"]) == ("arrested", None, None, [])
    assert get(cleanup.collapse_status, suspect_status="wanted", suspect_conflicts=["arrested", "convicted", "indicted", "closed"]) == ("wanted", "convicted", "closed", ["arrested", "convicted", "indicted", "closed"])


def test_timeline_and_roles(spark):
    sources = [("u1", "Daily", day(1), ["report"]), ("u2", "Daily", day(1), []), ("u3", None, day(20), ["b"]), ("u4", "X", None, [])]
    out = cleanup.run_all(one(spark, incident_date=day(1), incident_date_possible=day(0), legal_status="indicted", sources=sources)).first()
    assert [(e.date, e.event) for e in out.timeline] == [(day(0), "Incident occurred"), (day(1), "Reported in Daily"), (day(1), "Victim death reported"), (day(20), "Reported in media"), (day(20), "Suspect indicted")]
    assert out.timeline[0].confidence == "medium" and [s.roles for s in out.sources] == [["report"], [], ["b", "indictment_update"], []]
    kept = cleanup.drop_sources(cleanup.add_timeline(one(spark, incident_date=day(1), sources=sources)), lambda s: s["url"] != "u3").first()
    assert kept.dropped_sources == ["u3"] and [e.event for e in kept.timeline] == ["Incident occurred", "Reported in Daily"] and len(kept.sources) == 3


def test_names_and_evidence(spark):
    df = spark.createDataFrame([("lena mor", ["lena ruth mor", "dana katz", "lena"], ["Mor", "x", "dana"])], "n string, c array<string>, a array<string>")
    got = df.select(cleanup.richer_name(F.col("n"), F.col("c")), cleanup.drop_weak_aliases(F.col("a"), F.col("n"))).first()
    assert tuple(got) == ("lena ruth mor", ["Mor"])
    items = spark.createDataFrame([(1, "weapon", "A pistol found", None, 2, "en"), (1, "weapon", "אקדח", "car", 5, "he"), (1, "trace", "shell", None, 1, "en")], "case_id int, type string, description string, location_found string, source_count int, lang string")
    got = sorted(tuple(r) for r in cleanup.merge_evidence(items, "case_id", {"handgun": ["pistol", "אקדח"]}).collect())
    assert got == [(1, "handgun|weapon", "A pistol found", ["אקדח"], 5), (1, "trace", "shell", [], 1)]


def test_strict_filters(spark):
    df = spark.createDataFrame([("Lod", day(0), []), ("Haifa", day(0), []), (None, day(99), []), (None, None, ["x"])], "city string, incident_date date, flags array<string>").withColumn("death_date", F.lit(None).cast("date"))
    assert [r.flags for r in cleanup.strict_place(df, "city", "lod").collect()] == [[], ["city:unverified"], ["x", "city:unverified"]]
    assert [r.flags for r in cleanup.strict_dates(df, "2031-03-01", "2031-04-01").collect()] == [[], [], ["x", "date:unverified"]]


def test_evidence_rules(spark):
    def decide(text="", stock=False, stock_conf=0.0, category="other", conf=0.0, selector="img"):
        df = spark.createDataFrame([(text, stock, stock_conf, category, conf, selector)], "t string, s boolean, sc double, c string, f double, x string")
        row = {"text": F.col("t"), "is_stock": F.col("s"), "stock_confidence": F.col("sc"), "category": F.col("c"), "confidence": F.col("f"), "selector": F.col("x")}
        names = lambda v: F.array(F.lit(v))
        return tuple(df.select(media.evidence_decision(row, names("Lena Mor"), names("Dan Katz"), names("Lod"), ["forensic"]).alias("e")).select("e.*").first())

    assert decide(stock=True, stock_conf=0.95) == (False, "stock_photo:conf=0.95")
    assert decide(category="generic_stock") == (False, "category:generic_stock")
    assert decide("seen: lena mor") == (True, "caption_match:victim:Lena Mor")
    assert decide("dan katz in court") == (True, "caption_match:suspect:Dan Katz")
    assert decide("street in lod", category="cctv") == (True, "category:cctv+city:Lod")
    assert decide("lod", category="victim_portrait", conf=0.6) == (True, "category:victim_portrait+city:Lod")
    assert decide(category="victim_portrait", conf=0.85) == (True, "category:victim_portrait+high_conf")
    assert decide("forensic team", category="weapon") == (True, "category:weapon+evidence_kw:forensic")
    assert decide(selector="meta:og:image") == (True, "og_image_lead")
    assert decide(stock=True, stock_conf=0.3) == (True, "low_confidence_stock:conf=0.30")
    assert decide() == (False, "default:no_evidence_signal")


def test_support_confidence(spark):
    df = spark.createDataFrame([(0, [], 0), (2, [1], 0), (5, [1, 2, 3], 0), (2, [1, 2], 2)], "n int, t array<int>, d int")
    assert [r[0] for r in df.select(cleanup.support_confidence(F.col("n"), F.col("t"), F.col("d"))).collect()] == [0.5, 0.74, 1.0, 0.59]
