"""Streaming ingest: windowed counts and idempotent upserts per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from casegraph.operators.tables import latest, upsert


def read_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def windowed_counts(events: DataFrame, ts: str, keys: list[str], window: str = "48 hours", late: str = "14 days") -> DataFrame:
    """Counts per window and key; rows later than the watermark are dropped, as follow-ups of two weeks are expected."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, window), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), *keys, "n")


PARTS = 64


def upsert_batches(stream: DataFrame, path: str, key: str, order: str, mutable: list[str], checkpoint: str, parts: int = PARTS):
    """Merges each micro-batch into a table under path; a batch that is run again changes nothing more.

    The table lies in folders by the hash of the key, and a batch rewrites only those that it touches, each as a new file set beside
    the old one. Which set of a folder holds is told by the folder's number of the batch, so a torn write is never read and a new
    checkpoint goes on from what is there. Sets older than the one before are deleted.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
        new = latest(batch, [key], F.col(order).desc()).withColumn("_part", part)
        touched = sorted(r["_part"] for r in new.select("_part").distinct().collect())  # at most parts numbers
        held = versions(spark, path)
        for p in touched:
            done, seen = held.get(p, (-1, -1))
            rows = new.where(F.col("_part") == p).drop("_part")
            if done >= 0:
                rows = upsert(spark.read.parquet(f"{path}/part={p}/set={done}"), rows, key, mutable)
            target = f"{path}/part={p}/set={done + 1}"
            rows.write.mode("overwrite").parquet(target)
            _drop(spark, f"{path}/part={p}/set={done - 1}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def _files(spark: SparkSession, pattern: str) -> list[str]:
    where = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return [str(s.getPath()) for s in found] if found is not None else []


def _drop(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def versions(spark: SparkSession, path: str) -> dict[int, tuple[int, int]]:
    """Of each part of a table: its newest whole set and the number of whole sets there are."""
    out: dict[int, tuple[int, int]] = {}
    for f in _files(spark, f"{path}/part=*/set=*/_SUCCESS"):
        p, v = (int(x.split("=")[1]) for x in f.split("/")[-3:-1])
        best, n = out.get(p, (-1, 0))
        out[p] = (max(best, v), n + 1)
    return out


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table that upsert_batches() keeps: the newest whole set of each part."""
    return spark.read.parquet(*[f"{path}/part={p}/set={v}" for p, (v, _) in sorted(versions(spark, path).items())])
