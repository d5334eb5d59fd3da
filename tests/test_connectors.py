"""Connectors on recorded answers, scans, exports and settings."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from casegraph.sources import connectors, exports, scans
from casegraph.streaming import ingest


def test_registry_and_walks():
    assert connectors.site("ynet").language == "he"
    with pytest.raises(ValueError, match="known are ynet"):
        connectors.site("nowhere")
    day = lambda n: dt.datetime(2031, 1, n)
    pages = {1: [("https://a/n/9", "t9", day(9)), ("https://a/n/5", "t5", day(5))], 2: [("https://a/sport/4", "t4", day(4)), ("https://a/n/u", "tu", None)], 3: [("https://a/n/1", "t1", day(1))], 4: [("https://a/n/4", "late", day(4))]}
    rows, counts = connectors.page_walk(lambda n: pages.get(n, []), day(3), day(8), blocked=("sport",))
    assert [r[1] for r in rows] == ["t5", "tu"] and counts == {"in_window": 2, "post": 1, "pre": 1}  # the old third page ends the walk
    answers = {None: ([1, 2], "x"), "x": ([3], None)}
    assert connectors.cursor_walk(lambda c: answers[c]) == [1, 2, 3]


def test_retry():
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise ConnectionError("no")
        return "yes"

    assert connectors.retry(flaky, sleep=waits.append) == "yes" and waits == [2.0, 4.0]
    with pytest.raises(ConnectionError):
        connectors.retry(lambda: (_ for _ in ()).throw(ConnectionError("no")), tries=2, sleep=waits.append)
    with pytest.raises(KeyError):
        connectors.retry(lambda: {}["x"], sleep=waits.append)


def test_feeds_and_gates(spark):
    rss = "<rss><channel><item><link>https://a.org/1</link><title>T</title><pubDate>Mon, 03 Feb 2031 10:00:00 GMT</pubDate></item><item><link>https://a.org/2</link><title>U</title><pubDate>soon</pubDate></item></channel></rss>"
    got = connectors.parse_rss(spark.createDataFrame([(rss,)], "xml string")).collect()
    assert [(r.url, r.published is not None) for r in got] == [("https://a.org/1", True), ("https://a.org/2", False)]
    found = spark.createDataFrame([("https://g/1",), ("https://a.org/2",), ("https://g/3",)], "url string")
    moved = spark.createDataFrame([("https://g/1", "https://a.org/x"), ("https://g/3", "https://b.org/y")], "url string, target string")
    assert sorted(r.url for r in connectors.resolve(found, moved, ["https://a.org/"]).collect()) == ["https://a.org/2", "https://a.org/x"]
    first = connectors.discover([found.limit(1)], lambda: [found])
    assert first.count() == 3 and connectors.discover([found], lambda: [moved.select("target")]).count() == 3
    assert connectors.or_else(found.where("false"), lambda: found).count() == 3
    robots = spark.createDataFrame([("a.org", "User-agent: *\nDisallow: /2")], "host string, body string")
    assert sorted(r.url for r in connectors.can_fetch(found, robots).collect()) == ["https://g/1", "https://g/3"]

    def fetch(url):
        if url.endswith("2"):
            raise PermissionError("no")
        return f"<title>{url}</title>"

    rows = {r.url: r for r in connectors.fetch_all(found, fetch, wait=0).collect()}
    assert rows["https://a.org/2"].fetch_status == "blocked" and rows["https://g/1"].html == "<title>https://g/1</title>"
    asked = connectors.batched(found, lambda texts: [t.upper() for t in texts], "url", size=2).collect()
    assert sorted(r.answer for r in asked) == ["HTTPS://A.ORG/2", "HTTPS://G/1", "HTTPS://G/3"]
    assert connectors.sweep_plan(spark, ["ynet", "walla"], ["a"], [("1", "2"), ("2", "3")]).count() == 4
    ring = spark.createDataFrame([("p", "b", [1, 2, 3]), ("p", "a", [1, 2]), ("q", "c", [1, 2, 3])], "place string, tag string, ring array<int>")
    assert [r.place for r in connectors.polygons(ring, ["a", "b"]).collect()] == ["p"]
    w = spark.range(1).select(connectors.window_of(F.lit("2031-01-31").cast("date"), F.lit(30)).alias("w")).first().w
    assert (str(w.date_from), str(w.date_to)) == ("2031-01-01", "2031-01-31")


def test_settings_and_scans(spark, tmp_path):
    assert scans.settings({"JARO_THRESHOLD": "0.9", "ROBOTS_TXT_RESPECT": "false"}).jaro_threshold == 0.9
    for bad in ({"JARO_THRESHOLD": "2"}, {"LLM_CONCURRENCY": "0"}, {"LLM_CONCURRENCY": "many"}):
        with pytest.raises(ValueError):
            scans.settings(bad)
    spark.createDataFrame([(1, "a")], "id int, url string").write.parquet(f"{tmp_path}/store/articles")
    store = scans.open_store(spark, f"{tmp_path}/store", {"articles": "id int, url string, note string", "cases": "id int"})
    assert store["articles"].collect()[0].note is None and store["cases"].count() == 0
    (tmp_path / "runs").mkdir()
    for n in ("_x.json", "a.json"):
        (tmp_path / "runs" / n).write_text('{"review_pairs": [{"a": 1}], "cases": []}')
    assert scans.newest_run(spark, f"{tmp_path}/runs").endswith("a.json") and scans.runs(spark, f"{tmp_path}/runs").count() == 1
    assert scans.review_pairs(spark, f"{tmp_path}/runs/a.json").collect()[0].a == 1
    (tmp_path / "names.json").write_text('{"محمد": {"he": "מוחמד"}}')
    assert scans.name_dictionary(spark, f"{tmp_path}/names.json") == {"محمد": {"he": "מוחמד"}} and scans.name_dictionary(spark, f"{tmp_path}/none.json") == {}
    places = spark.createDataFrame([(1, "Lod", None, ["Lydda"], "D", "R"), (2, "New", None, ["lydda "], "E", "S"), (3, "", "عكا", None, "D", None)], "pos int, name_en string, name_ar string, aliases_en array<string>, district string, region string")
    assert {r.alias: r.name_en for r in scans.places_by_alias(places).where("alias <> ''").collect()} == {"lod": "Lod", "new": "New", "lydda": "New", "عكا": ""}
    assert [r.city for r in scans.cities(places).collect()] == ["Lod", "New", "عكا"]
    edges = spark.createDataFrame([("a", "b", "merge", 0.9), ("c", "d", "review", 0.7), ("a", "d", "review", 0.8)], "record_a_id string, record_b_id string, decision string, cosine_score double")
    assert [r.cosine_score for r in scans.review_edges(edges).collect()] == [0.8, 0.7] and scans.merge_edges(edges).count() == 1 and scans.edge_counts(edges).count() == 2


def test_exports(spark, tmp_path):
    cases = spark.createDataFrame([(i, f"n{i}", "survived" if i == 3 else "died", dt.date(2031, 1, 1)) for i in range(50)], "case_id int, victim_name string, victim_outcome string, incident_date date")
    lines = exports.envelope(cases, exports.case_stats(cases), cases.limit(1).select("case_id"), "r1")
    exports.write_lines(lines, f"{tmp_path}/env")
    text = [x for f in sorted(glob.glob(f"{tmp_path}/env/part*")) for x in open(f).read().splitlines()]
    assert len(text) == 51 and '"case_count":49' in text[0] and '"case_id":0' in text[1] and '"n3"' not in "".join(text)
    head = exports.run_header({"started_at": "a", "finished_at": "b", "stages_executed": ["x"], "n": 1}, "r1")
    assert head["stats"] == {"n": 1} and head["run"]["stages_executed"] == ["x"]
    stamp = spark.range(1).select(exports.duration_seconds(F.lit("2031-01-01T00:00:00Z"), F.lit("2031-01-01T00:01:30+00:00")), exports.duration_seconds(F.lit(None).cast("string"), F.lit("x"))).first()
    assert tuple(stamp) == (90.0, None)
    said = exports.summary_lines({"clusters": 4}, cases.limit(2)).orderBy("place", "part").collect()
    assert said[3].line.split() == ["Clusters:", "4"] and said[8].line == "Case 0"
    assert exports.write_audit(cases.where("false"), f"{tmp_path}/no") is False and exports.write_audit(cases, f"{tmp_path}/audit")
    exports.write_csv(cases.limit(2), f"{tmp_path}/csv")
    assert "﻿" in open(glob.glob(f"{tmp_path}/csv/part*")[0], encoding="utf-8").read()
    exports.write_static(cases.limit(3).withColumn("case_index", F.col("case_id")), f"{tmp_path}/static")
    assert len(glob.glob(f"{tmp_path}/static/case_index=*")) == 3
    assert exports.rewrite(cases, f"{tmp_path}/v", "2", dry_run=True) is None and exports.rewrite(cases, f"{tmp_path}/v", "2").endswith("version=2")
    funnel = spark.createDataFrame([("r", "s", 10, 5, 0.5, 2, 0.4, 1, 0.5, 0)], "pipeline_run_id string, source string, discovered int, fetched int, fetched_yield double, triaged int, triaged_yield double, extracted int, extracted_yield double, extraction_failed int")
    table = [r.line for r in exports.funnel_table(funnel).orderBy("place").collect()]
    assert table[0].split() == ["RUN_ID", "SOURCE", "DISC", "FETCH", "TRIAGE", "EXT_OK", "EXT_FAIL"] and "5(50%)" in table[2] and len({len(x) for x in table}) == 1
    labels = {"gun": {"ar": "سلاح"}}
    shown = spark.range(1).select(exports.shown_label(F.lit("gun"), labels, "ar"), exports.shown_label(F.lit("gun"), labels, "en"), exports.shown_label(F.lit(""), labels, "ar"), exports.shown_field(F.lit(" "), F.lit("x"), "ar"), exports.shown_narrative(F.lit(""), F.lit("h"), F.lit("e"), F.lit(None).cast("string"), "ar"), exports.shown_date(F.lit("2031-03-09"), "he"), exports.shown_date(F.lit("soon"))).first()
    assert tuple(shown) == ("سلاح", "gun", "—", "—", "h", "9 במרץ 2031", "soon")
    name = spark.range(1).select(exports.shown_name({"ar": F.lit(None).cast("string"), "he": F.lit("x")}, F.lit(None).cast("array<struct<value:string,target_script:string,source_script:string,method:string,source_value:string>>"), "ar").alias("n")).first().n
    assert tuple(name) == ("—", True, None)


def test_upserts_touch_only_their_parts(spark, tmp_path):
    path = f"{tmp_path}/t"
    schema = "k int, v string, o int"

    def put(rows, name):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{tmp_path}/{name}")
        stream = ingest.read_stream(spark, f"{tmp_path}/{name}", spark.createDataFrame([], schema).schema)
        ingest.upsert_batches(stream, path, "k", "o", ["v", "o"], f"{tmp_path}/cp_{name}", parts=4).start().awaitTermination()

    put([(i, "a", 1) for i in range(20)], "one")
    before = ingest.versions(spark, path)
    put([(3, "b", 2), (3, "c", 3), (99, "n", 1)], "two")  # a new checkpoint goes on from what is there
    after = ingest.versions(spark, path)
    got = {r.k: r.v for r in ingest.read_table(spark, path).collect()}
    assert got == {**{i: "a" for i in range(20)}, 3: "c", 99: "n"}
    assert 1 <= sum(after[p][0] != before.get(p, (-1, 0))[0] for p in after) <= 2
