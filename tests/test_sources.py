"""Feeds, windows, geometry and cached results."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from casegraph.functions import dates, geometry, text
from casegraph.operators import tables
from casegraph.sources import feeds


def test_feed_halves_full_windows(spark):
    spark.dataSource.register(feeds.FeedSource)
    df = spark.read.format("feed").option("fetch", "tests.fake_feed:fetch").option("query", "q").option("blocked", "sport").option("date_from", "2031-01-01").option("date_to", "2031-01-05").option("source", "s").load()
    got = df.collect()
    hours = {r.url for r in got if r.published}
    assert len(hours) == 4 * 23 and not any("/sport/" in u for u in hours) and {r.source for r in got} == {"s"}
    assert df.rdd.getNumPartitions() == 2 and len({r.url for r in got}) == 93
    assert not any(r.is_full for r in got)
    # windows that stay full at the least length are marked
    tight = spark.read.format("feed").option("fetch", "tests.fake_feed:fetch").option("full", "3").option("date_from", "2031-01-01").option("date_to", "2031-01-02").load().collect()
    assert any(r.is_full for r in tight)


def test_windows():
    a = dt.datetime(2031, 1, 1)
    assert [(w.start, w.end) for w in feeds.windows(a, a + dt.timedelta(hours=50))] == [(a, a + dt.timedelta(hours=48)), (a + dt.timedelta(hours=48), a + dt.timedelta(hours=50))]


def test_adaptive_windows(spark):
    start = dt.datetime(2031, 1, 1)
    rows = [(i, start + dt.timedelta(minutes=10 * i)) for i in range(30)] + [(99, start + dt.timedelta(days=9))]
    got = dates.adaptive_window(spark.createDataFrame(rows, "id int, ts timestamp"), "ts", 18).collect()
    assert len(got) == 31 and {r.window_hours for r in got if r.id < 99} == {3} and [r.window_hours for r in got if r.id == 99] == [48]


def test_simplify(spark):
    ring = [[0.0, 0.0], [1.0, 0.001], [2.0, 0.0], [2.0, 2.0], [0.0, 0.0]]
    df = spark.createDataFrame([(ring,), (None,), ([],)], "r array<array<double>>")
    got = [r[0] for r in df.select(geometry.simplify(0.002)("r")).collect()]
    assert got == [[[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 0.0]], None, []]
    assert geometry.thin(np.zeros((0, 2)), 1).tolist() == []


def test_text_rules(spark):
    df = spark.createDataFrame([("He was hurt. He died later.", "lena mor", "Lod"), ("He was hurt.", None, "Lod"), ("Last year one died. He was hurt!", "x", None), ("", None, None)], "t string, n string, c string")
    got = df.select(text.lethality(F.lit(None).cast("string"), F.col("t"), ["lived"], ["hurt"], ["died"], ["last year", "Last year"]), text.search_queries(F.col("n"), F.col("c"), F.lit(2031), ["fire"], 3)).collect()
    assert [tuple(r) for r in got] == [(None, ["lena mor", "lena mor Lod", "lena mor 2031"]), ("survived", ["Lod fire 2031"]), ("survived", ["x", "x 2031", "x fire"]), (None, [])]


def test_cache_and_order(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    cache = spark.createDataFrame([(1, 2, "x"), (2, 1, "y")], "id int, version int, text string")
    assert sorted(r.id for r in tables.stale(rows, cache, ["id"], 2).collect()) == [2, 3]
    assert {r.id: r.text for r in tables.attach_cached(rows, cache, ["id"], 2).collect()} == {1: "x", 2: None, 3: None}
    assert [r.id for r in rows.orderBy(*tables.sort_keys("v", True, "id")).collect()] == [3, 2, 1]
    assert [r.id for r in rows.orderBy(*tables.sort_keys("v", False, "id")).collect()] == [1, 2, 3]
