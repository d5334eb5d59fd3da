"""Readers and writers of the engine's stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_truth(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """JSON lines without blank lines and # comments; a malformed line fails with its text."""
    lines = spark.read.text(path).where("trim(value) <> '' and not startswith(ltrim(value), '#')")
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def read_envelope(spark: SparkSession, path: str) -> DataFrame:
    """The cases of an export, with their place in it."""
    return spark.read.option("multiLine", True).json(path).select(F.posexplode("cases").alias("case_index", "c")).select("case_index", "c.*")


def read_places(spark: SparkSession, path: str) -> DataFrame:
    """(alias, name_en, ...) of a place file; of places that share an alias the last one wins."""
    raw = spark.read.option("multiLine", True).json(path).select("*", F.monotonically_increasing_id().alias("_pos"))
    names = [c for c in ("name_en", "name_ar", "name_he") if c in raw.columns]
    lists = [c for c in ("aliases_en", "aliases_ar", "aliases_he") if c in raw.columns]
    keys = F.array_union(F.array(*[F.col(c) for c in names]), F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in lists])) if lists else F.array(*names)
    posted = raw.select("*", F.explode(keys).alias("alias")).where("alias is not null").withColumn("alias", place_key(F.col("alias")))
    return posted.groupBy("alias").agg(F.max_by(F.struct(*[c for c in raw.columns if c != "_pos"]), "_pos").alias("p")).select("alias", "p.*")


def place_key(c):
    return F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """CSV rows that aren't in the store yet."""
    return spark.read.csv(path, header=True).where("coalesce(in_db, '') <> 'yes'")


def write_run(cases: DataFrame, path: str, run_col: str = "pipeline_run_id") -> None:
    """Replaces the runs that cases hold and leaves the others."""
    cases.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(run_col).parquet(path)


def append_history(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def envelope(cases: DataFrame, run_id: str, order: str = "case_id") -> DataFrame:
    """JSON lines of an export: one line of run and counts, then one per case in order.

    Cases aren't gathered in one row, so an export of any size is written by many tasks.
    """
    head = cases.agg(F.count("*").alias("n_cases")).select(F.lit(-1).cast("long").alias("line"), F.to_json(F.struct(F.lit("2.0").alias("schema"), F.lit(run_id).alias("run"), "n_cases")).alias("json"))
    body = cases.select(F.col(order).cast("long").alias("line"), F.to_json(F.struct(*cases.columns)).alias("json"))
    return head.unionByName(body)
