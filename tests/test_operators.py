"""Rules of the case operators on small literal rows with invented names."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from casegraph.functions import dates, html, names, text, vectors
from casegraph.operators import cases, media, pairs, resolve, tables, verify
from casegraph.operators.graph import connected_components
from casegraph.sources import stores


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("a, b, score", [("martha", "marhta", 0.9611), ("dixon", "dicksonx", 0.8133), ("abc", "xyz", 0.0), ("", "a", 0.0), ("same", "same", 1.0)])
def test_jaro_winkler(a, b, score):
    assert round(float(names.jaro_winkler_many([a], [b])[0]), 4) == score


def test_names(spark):
    df = spark.createDataFrame([("José  Ñandú", "a b", "a b c"), ("سلمى", "x", "x y")], "n string, a string, b string")
    got = df.select(text.romanize(F.col("n")), text.strict_subset(F.col("a"), F.col("b")), text.surname(F.col("b")), text.mentions(F.col("b"), F.col("a"))).collect()
    assert [tuple(r) for r in got] == [("jose nandu", True, "b c", True), ("slmy", False, "y", True)]


@pytest.mark.parametrize(
    "jaro, cosine, a, b, art, want",
    [
        (0.99, 0.9, "lena mor", "lena mor", ("1", "1"), "distinct"), (0.97, 0.9, "lena mor", "lena moor", ("1", "2"), "merge"),
        (0.90, 0.9, "lena mor", "lena katz", ("1", "2"), "review"), (0.10, 0.9, "lena mor", "lena ruth mor", ("1", "2"), "merge"),
        (0.10, 0.97, None, "lena mor", (None, None), "merge"), (0.10, 0.96, None, "lena mor", (None, None), "review"),
        (0.10, 0.75, "lena mor", "lena ruth mor", ("1", "2"), "merge"), (0.99, 0.70, "lena mor", "lena mor", ("1", "2"), "review"), (0.99, 0.69, "lena mor", "lena mor", ("1", "2"), "distinct"),
    ],
)
def test_pair_decision(spark, jaro, cosine, a, b, art, want):
    df = spark.createDataFrame([(jaro, cosine, a, b, *art)], "j double, c double, a string, b string, x string, y string")
    assert df.select(pairs.decide(*[F.col(c) for c in "jcabxy"])).first()[0] == want


def test_block_pairs(spark):
    df = spark.createDataFrame([(1, "Lod", dt.date(2031, 1, 3), "samira"), (2, "lod ", dt.date(2031, 1, 9), "x"), (3, None, None, "samira samira"), (4, "Lod", dt.date(2031, 2, 1), "y")], "id int, city string, day date, name string")
    keyed = df.select("id", pairs.block_keys(F.col("city"), F.col("day"), F.col("name")).alias("keys"))
    assert rows(pairs.block_pairs(keyed, "keys")) == [(1, 2), (1, 3)]


def test_near_in_time(spark):
    day = dt.date(2031, 1, 1)
    df = spark.createDataFrame([(1, "a", day), (2, "a", day + dt.timedelta(3)), (3, "a", day + dt.timedelta(7)), (4, "b", day)], "id int, g string, d date")
    assert rows(pairs.near_in_time(df, "g", "d", "id", 3)) == [("a", 1, 2, 3)]
    assert rows(pairs.near_in_time(df, "g", "d", "id", 4)) == [("a", 1, 2, 3), ("a", 2, 3, 4)]


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (8, 9), (7, 7), (3, 1), (None, 2)], "src long, dst long")
    assert rows(connected_components(edges)) == [(1, 1), (3, 1), (4, 1), (5, 1), (7, 7), (8, 8), (9, 8)]
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "src long, dst long")
    assert {r.component for r in connected_components(chain).collect()} == {0}
    assert connected_components(edges.where("src > 99")).count() == 0


def test_resolvers(spark):
    df = spark.createDataFrame([("k", "x", 2, 0.5, 1), ("k", None, 1, 0.9, 2), ("k", "y", 2, 0.8, 3), ("l", "z", 3, 0.9, 4)], "g string, v string, p int, c double, id int")
    got = rows(df.groupBy("g").agg(resolve.by_priority(F.col("v"), F.col("p"), F.col("c"), F.col("id")), resolve.conflicting(F.col("v")), resolve.weighted_confidence(F.col("c"), 3 - F.col("p")), resolve.positive_count(F.col("p"))))
    assert got == [("k", "y", True, 0.775, 2), ("l", "z", False, 0.6, 3)]
    modes = resolve.mode_first(spark.createDataFrame([(1, "a", 5), (1, "b", 1), (1, "b", 9), (1, "a", 2), (2, None, 1)], "k int, v string, o int"), ["k"], "v", "o")
    assert rows(modes.select("k", "v")) == [(1, "b")]


def test_dates(spark):
    df = spark.createDataFrame([("2031-01-XX",), ("2031-02-03T10:00",), ("????",), ("",), (None,), ("2031-13-01",)], "s string")
    assert [r[0] for r in df.select(dates.whole_date(F.col("s"))).collect()] == [None, dt.date(2031, 2, 3), None, None, None, None]
    df = spark.createDataFrame([(dt.date(2030, 5, 1),), (dt.date(2029, 5, 1),), (dt.date(2028, 5, 1),), (dt.date(2032, 5, 1),), (dt.date(2032, 2, 29),)], "d date")
    got = [r[0].year for r in df.select(dates.clamp_year(F.col("d"), F.lit(2031))).collect()]
    assert got == [2031, 2031, 2028, 2031, 2032]


def test_html(spark):
    page = '<html lang="he"><title> T </title><meta property="og:image" content="u.jpg"><script>var x="<p>"</script><a href="/a">A</a><!-- no --><p>b  c</p>'
    df = spark.createDataFrame([(page, "a.jpg 320w, b.jpg 1280w, c.jpg")], "h string, s string")
    h = F.col("h")
    assert tuple(df.select(html.title(h), html.language(h), html.meta(h, "og:image"), html.links(h), html.clean_text(h), html.best_source(F.col("s"))).first()) == ("T", "he", "u.jpg", ["/a"], "T A b c", "b.jpg")


def test_vectors(spark):
    df = spark.createDataFrame([("00000000000000ff", "0000000000000000", [1.0, 0.0], [1.0, 1.0]), (None, "0" * 16, [0.0], [1.0]), ("00", "0" * 16, [1.0], [1.0, 2.0])], "a string, b string, u array<double>, v array<double>")
    got = df.select(vectors.hamming(F.col("a"), F.col("b")), F.round(vectors.cosine(F.col("u"), F.col("v")), 4)).collect()
    assert [tuple(r) for r in got] == [(8, 0.7071), (999, 0.0), (999, 0.0)]


def test_same_image(spark):
    df = spark.createDataFrame([(1, "c", "s", "0" * 16), (2, "c", "s", None), (3, "c", "t", "00000000000000ff"), (4, "c", "u", "00000000000001ff"), (5, "d", "s", "0" * 16)], "id int, c string, sha string, p string")
    assert rows(media.same_image(df, "c", "id", "sha", "p")) == [(1, 2), (1, 3), (3, 4)]


def test_greedy_matches(spark):
    df = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (3, 10), (3, 12), (4, 11)], "truth_id int, case_id int")
    assert rows(verify.greedy_matches(df)) == [(1, 10), (3, 12), (4, 11)]


def test_reconcile_rule(spark):
    def rule(name_a, name_b, city_b, day_b, score, shared=False):
        df = spark.createDataFrame([(name_a, "Lod", dt.date(2031, 1, 1), name_b, city_b, day_b, score)], "na string, ca string, da date, nb string, cb string, db date, s double")
        a, b = ({"name": F.col(f"n{x}"), "city": F.col(f"c{x}"), "date": F.col(f"d{x}")} for x in "ab")
        return df.select(cases.reconcile_rule(a, b, F.col("s"), F.lit(False), F.lit(False), F.lit(shared))).first()[0]

    first = dt.date(2031, 1, 1)
    assert rule("lena mor", "lena mor", "Lod", first, 1.0) == "name_match"
    assert rule("lena mor", "lena mor", "Lod", dt.date(2031, 2, 1), 1.0) is None
    assert rule("lena mor", "lena mur", "Haifa", first, 0.94) is None
    assert rule("lena mor", "lena mur", None, first, 0.92) is None  # surnames differ
    assert rule("lena mor", None, "lod", first, 0.0) == "city_date_match"
    assert rule("lena mor", None, "lod", first, 0.0, shared=True) is None


def test_upsert_and_records(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(2, "c", "z"), (3, "d", "q"), (1, None, None)], "k int, v string, w string")
    assert rows(tables.upsert(base, new, "k", ["v"])) == [(1, "a", "x"), (2, "c", "y"), (3, "d", "q")]
    df = spark.createDataFrame([(1, "p", [("q",), (" ",), (None,), ("r",)]), (2, "s", None)], "id int, name string, more array<struct<name:string>>")
    assert rows(tables.records(df, ["name"], "more", ["id"])) == [(1, 0, "p"), (1, 1, "q"), (1, 2, "r"), (2, 0, "s")]


def test_numbered(spark):
    df = spark.range(1000).withColumn("x", F.col("id") * 7 % 1000)
    got = tables.numbered(df, "n", F.desc("x")).select("x", "n").collect()
    assert all(r.n == 999 - r.x for r in got) and len(got) == 1000


def test_stores(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('# note\n\n{"city": "Lod", "n": 1}\n{"city": null, "n": 2}\n')
    assert rows(stores.read_truth(spark, str(tmp_path / "t.jsonl"), "city string, n int").select("n")) == [(1,), (2,)]
    one = spark.createDataFrame([(1, "r1"), (2, "r2")], "id int, pipeline_run_id string")
    stores.write_run(one, str(tmp_path / "runs"))
    stores.write_run(spark.createDataFrame([(3, "r2")], "id int, pipeline_run_id string"), str(tmp_path / "runs"))
    assert rows(spark.read.parquet(str(tmp_path / "runs")).select("id")) == [(1,), (3,)]


def test_streaming(spark, tmp_path):
    from casegraph.streaming import ingest

    data = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k int, v string, o int")
    data.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = ingest.read_stream(spark, str(tmp_path / "in"), data.schema)
    q = ingest.upsert_batches(stream, str(tmp_path / "out"), "k", "o", ["v", "o"], str(tmp_path / "cp")).start()
    q.awaitTermination(60)
    assert rows(ingest.read_table(spark, str(tmp_path / "out")).select("k", "v")) == [(1, "b"), (2, "c")]


def test_join_counted_keeps_hot_and_rare_keys(spark):
    left = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 2500).alias("k"))
    counted = left.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    got = tables.join_counted(left, counted, ["k"], "n", 5000)
    assert rows(got.select("id", "k", "n")) == rows(left.join(counted, "k").select("id", "k", "n"))


def test_pairs_of_frequent_keys_are_made_once_and_compared_by_class(spark, monkeypatch):
    monkeypatch.setattr(pairs, "CHUNK", 3)
    monkeypatch.setattr(pairs, "BLOCK", 8)
    monkeypatch.setattr(pairs, "TASK_PAIRS", 50)
    data = [(i, [None, "hot"] + (["b"] if i % 2 else []) + ([f"k{i % 7}"] if i % 3 else []), f"n{i % 4}") for i in range(60)] + [(61, None, "n"), (62, [], "n"), (None, ["hot"], "n"), (5, ["k9"], "n1"), (63, ["k9"], "n1")]
    df = spark.createDataFrame(data, "id long, keys array<string>, name string")
    held = {}
    for i, keys, _ in data:
        if i is not None:
            held.setdefault(i, set()).update(k for k in keys or [] if k)
    want = sorted((x, y) for x in held for y in held if x < y and held[x] & held[y])
    found = pairs.block_pairs(df, "keys")
    assert rows(found) == want
    # no pair is shuffled to be made distinct
    assert "Distinct" not in found._jdf.queryExecution().analyzed().toString()

    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("string")
    def both(x: pd.Series, y: pd.Series) -> pd.Series:
        seen.add(len(x))
        return x + y

    plain = df.where("id < 60").dropDuplicates(["id"]).withColumn("keys", F.array(F.lit("hot")))
    out = pairs.compared(plain, "keys", ["name"], lambda a, b: F.when(both(a["name"], b["name"]) != "n0n1", both(a["name"], b["name"])), ["name"])
    names = dict((i, n) for i, _, n in data if i is not None and i < 60)
    want = sorted((x, y, names[x] + names[y], names[x], names[y]) for x in names for y in names if x < y and names[x] + names[y] != "n0n1")
    assert rows(out) == want
    assert 0 < seen.value < len(want)


def test_cosine_links_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(pairs, "VECTORS", 8)
    rng = random.Random(5)
    data = [(i, [rng.uniform(-1, 1) for _ in range(4)], i % 2) for i in range(50)] + [(50, [0.0] * 4, 0), (51, None, 0), (52, [1.0, None, 1.0, 1.0], 0), (53, [1.0, 1.0], 0), (54, [float("nan")] + [1.0] * 3, 1), (55, [1.0] * 4, None)]
    df = spark.createDataFrame(data, "vec_id long, v array<float>, label int")
    a, b = df.select("label", F.col("vec_id").alias("id_a"), F.col("v").alias("va")), df.select("label", F.col("vec_id").alias("id_b"), F.col("v").alias("vb"))
    met = a.join(b, "label").where("id_a < id_b").select("id_a", "id_b", vectors.cosine(F.col("va"), F.col("vb")).alias("cosine")).where("cosine >= 0.3")
    want, found = rows(met), pairs.cosine_links(df, "label", "vec_id", "v", 0.3)
    assert [(x, y, repr(s)) for x, y, s in rows(found)] == [(x, y, repr(s)) for x, y, s in want] and len(want) > 100
    assert [r[0] for r in rows(pairs.cosine_links(df, "label", "vec_id", "v", 0.3, ends=True))] == sorted({i for p in want for i in p[:2]})


def test_lists_that_agree_with_no_other_are_matched_by_rank(spark, monkeypatch):
    t = [(i, i % 5) for i in range(40)] + [(3, 3), (100, 0), (101, 1), (101, 2), (None, 4), (102, 9)]
    c = [(i, i % 7 % 5) for i in range(200, 230)] + [(300, 8), (301, None)]
    agree, near = [(0, 0), (1, 1), (2, 2), (3, 3), (3, 4), (4, 8)], [(0, 300), (102, 300)]
    edges = sorted({(x, y) for x, l in t for y, m in c if x is not None and (l, m) in agree} | set(near))
    want, used = [], set()
    for x in sorted({x for x, _ in edges}):
        y = next((y for k, y in edges if k == x and y not in used), None)
        if y is not None:
            used.add(y)
            want.append((x, y))
    seen, plain = [], verify.greedy_matches
    monkeypatch.setattr(verify, "greedy_matches", lambda df, *a: (seen.append(df.count()), plain(df, *a))[1])
    frame = lambda data, names: spark.createDataFrame(data, names)
    for pairs_, near_ in ((agree, near), ([(0, 0), (3, 3)], [])):
        got = rows(verify.matches_by_lists(frame(t, "truth_id int, _list_t int"), frame(c, "case_id int, _list_c int"), frame(pairs_, "_list_t int, _list_c int"), frame(near_, "truth_id int, case_id int")))
        assert pairs_ is not agree or got == want
    # lists of one partner aren't paired row by row
    assert seen == [len(edges), 0] and len(got) == 13


def test_pairs_leave_in_runs_that_parquet_packs(spark, tmp_path):
    df = spark.range(2000).select(F.xxhash64("id").alias("id"), F.array(F.lit("hot"), F.concat(F.lit("k"), F.col("id") % 10)).alias("keys"))
    pairs.compared(df, "keys").write.parquet(str(tmp_path / "out"))
    found = spark.read.parquet(str(tmp_path / "out"))
    assert found.count() == found.distinct().count() == 2000 * 1999 // 2 and found.where("id_a >= id_b").isEmpty()
    assert sum(p.stat().st_size for p in (tmp_path / "out").glob("*.parquet")) < 0.5 * found.count()
