"""Relational operators on stored tables: latest rows, snapshots, funnels, upserts, lists and rollups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from casegraph.operators.graph import durable, stored


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key: the first in the order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top_k(df: DataFrame, keys: list[str], k: int, *order: Column) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Adds a dense index from 0 in a total order, without one task that holds all rows.

    Rows are range-partitioned, sorted and stored once with their partition and place, since range bounds are
    sampled anew in each run; a row's index is its place after the counts of the partitions before.
    """
    part = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    part = stored(part.withColumn("_seq", F.monotonically_increasing_id()))
    counts = part.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_seq").alias("_base"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return part.join(F.broadcast(before.select("_part", "_base", "_before")), "_part").withColumn(name, F.col("_before") + F.col("_seq") - F.col("_base")).drop("_part", "_seq", "_base", "_before")


#: Shares of a table from which a key counts as hot; there are at most as many hot keys.
HOT = 1000


def join_counted(left: DataFrame, counted: DataFrame, keys: list[str], n: str, total: int) -> DataFrame:
    """left joined with counted, which has a row per key and the number n of left's rows that hold it; left has total rows.

    Keys with more than a thousandth of all rows are at most a thousand and are sent to all tasks, so their rows stay where they are;
    the others meet by a shuffle. left is read twice and should be a stored table.
    """
    hot = durable(counted.where(F.col(n) * HOT > total))
    rest = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(counted.where(F.col(n) * HOT <= total), keys)
    return left.join(F.broadcast(hot), keys).unionByName(rest)


def funnel(df: DataFrame, keys: list[str], stages: dict[str, Column]) -> DataFrame:
    """Counts per stage and each stage's yield of the one before, 0 where that is empty."""
    counted = df.groupBy(*keys).agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in stages.items()])
    names = list(stages)
    return counted.select("*", *[F.coalesce(F.try_divide(F.col(b).cast("double"), F.col(a)), F.lit(0.0)).alias(f"{b}_yield") for a, b in zip(names, names[1:])])


def upsert(base: DataFrame, update: DataFrame, key: str, mutable: list[str]) -> DataFrame:
    """base with the update's non-null mutable fields; new keys are added. Other fields keep the base's value."""
    u = update.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in update.columns if c != key])
    joined = base.join(u, base[key] == u["_key"], "full_outer")
    pick = lambda c: F.coalesce(f"_new_{c}", c) if c in mutable else F.coalesce(c, f"_new_{c}")
    return joined.select(F.coalesce(key, "_key").alias(key), *[pick(c).alias(c) if c in update.columns else F.col(c) for c in base.columns if c != key])


def union_distinct(parts: list[DataFrame], key: str) -> DataFrame:
    """The parts' rows, the first part that has a key winning."""
    tagged = [p.withColumn("_order", F.lit(i)) for i, p in enumerate(parts)]
    return latest(reduce(DataFrame.unionByName, tagged), [key], F.col("_order")).drop("_order")


def page(df: DataFrame, number: int, size: int, *order: Column) -> DataFrame:
    """One page of a total order; sizes are capped at 200, as the list view's contract says."""
    size = min(size, 200)
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def histogram(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(name))


def first_reason(rules: list[tuple[str, Column]], otherwise: str) -> Column:
    """The name of the first rule that holds."""
    out = None
    for name, rule in rules:
        out = F.when(rule, name) if out is None else out.when(rule, name)
    return out.otherwise(otherwise) if out is not None else F.lit(otherwise)


def records(df: DataFrame, primary: list[str], more: str, keep: list[str]) -> DataFrame:
    """One row for the primary record and one for each named nested record, with a dense index."""
    first = F.array(F.struct(*[F.col(c) for c in primary]))
    rest = F.coalesce(F.col(more), F.array().cast(df.schema[more].dataType))
    return df.select(*keep, F.posexplode(F.concat(first, F.filter(rest, lambda r: F.coalesce(F.trim(r[primary[0]]) != "", F.lit(False))))).alias("record_index", "_r")).select(*keep, "record_index", "_r.*")


def virtual_records(df: DataFrame, fields: list[str], more: str = "additional_victims", aliases: str = "victim_aliases") -> DataFrame:
    """One row per victim of an extraction, with victim_index: the first as it stands, each named further one (a struct) with its own fields.

    A field that further victims don't have keeps the extraction's value; one that they have replaces it, missing or not. The
    extraction's aliases are the first victim's alone.
    """
    inner = [f.name for f in df.schema[more].dataType.elementType.fields]
    names = [n for n in fields if n in inner and "name" in n]
    named = F.filter(F.coalesce(more, F.array().cast(df.schema[more].dataType)), lambda v: v.isNotNull() & F.exists(F.array(*[v[n] for n in names]), lambda x: F.coalesce(F.trim(x), F.lit("")) != ""))
    whole = df.withColumn("_all", F.concat(F.array(F.lit(None).cast(df.schema[more].dataType.elementType)), named))
    rest = [c for c in df.columns if c != more]
    long = whole.select(*rest, F.posexplode("_all").alias("victim_index", "_v"))
    first = F.col("victim_index") == 0
    pick = lambda c: F.when(first, F.col(c)).otherwise(F.col(f"_v.{c}")) if c in fields and c in inner else F.when(first, F.col(c)).otherwise(F.array().cast(df.schema[c].dataType)) if c == aliases else F.col(c)
    return long.select(*[pick(c).alias(c) for c in rest], "victim_index")


def victim_count(more: Column, name: str = "victim_name") -> Column:
    """The first victim and the named further ones."""
    return 1 + F.coalesce(F.size(F.filter(more, lambda v: F.coalesce(F.trim(v[name]), F.lit("")) != "")), F.lit(0))


def rollup_by_place(cases: DataFrame, places: DataFrame, key: str, measures: dict[str, Column]) -> DataFrame:
    """Cases per place of a small dimension; cases without a place are left out here and counted as unresolved elsewhere."""
    return cases.join(places, key).groupBy(*places.columns).agg(*[c.alias(n) for n, c in measures.items()])


def sort_keys(field: str, descending: bool, tie: str) -> list[Column]:
    """A list view's order: missing values last upwards and first downwards, as the direction flips them too."""
    return [F.col(field).desc_nulls_first() if descending else F.col(field).asc_nulls_last(), F.col(tie)]


def stale(rows: DataFrame, cache: DataFrame, keys: list[str], version: int) -> DataFrame:
    """Rows whose cached result is missing or of an older version."""
    return rows.join(cache.where(F.col("version") >= version).select(*keys).distinct(), keys, "left_anti")


def attach_cached(rows: DataFrame, cache: DataFrame, keys: list[str], version: int) -> DataFrame:
    return rows.join(cache.where(F.col("version") >= version).drop("version"), keys, "left")
