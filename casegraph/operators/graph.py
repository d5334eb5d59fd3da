"""Connected components of an edge table, without gathering it anywhere.

Edges are rewritten until nothing changes: in turn each vertex links its larger
neighbours, then its smaller ones, to the smallest vertex it knows (large star
and small star). Every round is two aggregations and two joins on vertices;
results are checkpointed to the folder in ``spark.checkpoint.dir``, so the
lineage stays short and a lost executor costs no more than a round.
"""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession, functions as F


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the session names; in local mode one is set where there is none, as in tests.

    Elsewhere a folder of this machine would be out of the executors' sight, so a missing setting is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints"))
    return spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()


def durable(df: DataFrame, eager: bool = True) -> DataFrame:
    """A checkpoint of a small table."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager)


def _at(spark: SparkSession, path: str):
    """The file system and path object of a folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def stored(df: DataFrame) -> DataFrame:
    """df written as Parquet to the shared folder and read again: compressed, and read by column.

    The folder goes when the driver ends, or before that by discard().
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    system, where = _at(spark, path)
    system.deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more; other tables are left alone."""
    for df in tables:
        path = getattr(df, "_stored_at", None)
        if path:
            system, where = _at(df.sparkSession, path)
            with suppress(Exception):
                system.delete(where, True)


def release(spark: SparkSession) -> None:
    """Frees the shuffle files of tables that nothing refers to any more.

    Spark drops them when the driver's collector finds their plans unreachable; called between the large
    phases of an operator, this keeps disk use at one phase's files.
    """
    gc.collect()
    spark._jvm.System.gc()


def _settled(now: DataFrame) -> bool:
    """Each vertex has one edge, to a vertex without a smaller neighbour: the edges are stars."""
    several = now.groupBy("u").agg(F.count("*").alias("_n")).where("_n > 1")
    deeper = now.select("v").distinct().join(now.select(F.col("u").alias("v")), "v", "left_semi")
    return several.isEmpty() and deeper.isEmpty()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 50) -> DataFrame:
    """(id, component) of every vertex of the edges; the component is its smallest vertex.

    Edges that are null at either end are left out; self loops keep their vertex.
    """
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null")
    # u is always the larger end
    now = durable(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    loops = now.where("u = v").select(F.col("u").alias("id")).distinct()
    now = now.where("u <> v")
    for _ in range(max_rounds):
        if _settled(now):
            break
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.greatest("v", "m").alias("a"), F.least("v", "m").alias("b")).where("a <> b")
        now = durable(small.select(F.col("a").alias("u"), F.col("b").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct())
    else:
        raise RuntimeError("components did not settle")
    found = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    alone = loops.join(found, "id", "left_anti").join(roots, "id", "left_anti").select("id", F.col("id").alias("component"))
    return found.unionByName(roots).unionByName(alone)


def label_all(vertices: DataFrame, components: DataFrame, id_col: str = "id") -> DataFrame:
    """Adds component to vertices; one without edges is a component of its own."""
    known = components.withColumnRenamed("id", "_component_of")
    return vertices.join(known, vertices[id_col] == known["_component_of"], "left").withColumn("component", F.coalesce("component", F.col(id_col))).drop("_component_of")
