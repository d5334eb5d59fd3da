"""Each registered query of the case engine against its DuckDB counterpart on the smallest tables."""

import datetime
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from casegraph.plans import bindings

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else v


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", list(bindings.queries()))
def test_query(spark, duck, name):
    df = bindings.queries()[name](spark, FOLDER)
    got = table(df.columns, df.collect())
    if name not in bindings.oracle_sql():
        assert got
        return
    done = duck.execute(bindings.oracle_sql()[name])
    names = [d[0] for d in done.description]
    assert sorted(names) == sorted(df.columns)
    assert got == table(names, done.fetchall())


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["case_id", "n_sources", "n_publishers", "title", "longest"] and out.count() > 0


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_verify_metrics_matches_whole_items(spark, tmp_path):
    items = [f"item {i} opens with the same sixty characters in all of its copies, {end}" for i, end in enumerate(("but ends so", "and ends here"))]
    texts = [f"before {items[0][:70]} something else", f"before {items[1]} after", None]
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = bindings.verify_metrics(spark, str(tmp_path)).collect()
    assert [(r.truth_count, r.pipeline_count, r.true_positive, r.false_negative, r.false_positive) for r in got] == [(2, 3, 1, 1, 2)]
