"""Resolution of a cluster's conflicting values, as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A cluster of one source is trusted no more than this.
SINGLE_CAP = 0.60
REVIEW_BELOW = 0.55


def by_priority(value: Column, priority: Column, confidence: Column, tie: Column) -> Column:
    """The non-null value of the smallest (priority, -confidence, tie)."""
    return F.min_by(value, F.when(value.isNotNull(), F.struct(priority, -confidence, tie)))


def conflicting(value: Column) -> Column:
    return F.count_distinct(value) > 1


def by_rank(value: Column, rank: Column) -> Column:
    """The value of the highest rank."""
    return F.max_by(value, rank)


def any_true(value: Column) -> Column:
    return F.bool_or(value)


def positive_count(value: Column) -> Column:
    """The largest positive number, else 1."""
    return F.coalesce(F.max(F.when(value > 0, value)), F.lit(1))


def age(df: DataFrame, keys: list[str], value: str, source: str, order: str, spread: int = 5, trusted: str = "police") -> DataFrame:
    """keys, age and age_conflict: ages that differ by more than spread conflict, and the trusted source's counts, else the first; others give their mode."""
    known = df.where(F.col(value).isNotNull())
    wide = known.groupBy(*keys).agg((F.max(value) - F.min(value) > spread).alias("age_conflict"), F.min_by(value, F.when(F.col(source) == trusted, F.col(order))).alias("_trusted"), F.min_by(value, order).alias("_first"))
    mode = mode_first(df, keys, value, order).withColumnRenamed(value, "_mode")
    return wide.join(mode, keys).select(*keys, F.when(F.col("age_conflict"), F.coalesce("_trusted", "_first")).otherwise(F.col("_mode")).alias("age"), "age_conflict")


def regressed(rank: Column) -> Column:
    """Several ranks were told, so one of them goes back."""
    return F.count_distinct(rank) > 1


def fatal_first(outcome: Column) -> Column:
    """died if any source says so, else the weightiest of critical, survived and unknown."""
    return F.max_by(outcome, F.array_position(F.array(*[F.lit(x) for x in ("unknown", "survived", "critical", "died")]), outcome))


def most_specific(value: Column, order: list[str], tie: Column) -> Column:
    """The value that comes first in the order of specificity; others come after all."""
    at = F.array_position(F.array(*[F.lit(x) for x in order]), value)
    return F.min_by(value, F.when(value.isNotNull(), F.struct(F.when(at > 0, at).otherwise(len(order) + 1), tie)))


def source_list(order: Column, *fields: str) -> Column:
    """One struct per source in order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(order.alias("_o"), F.struct(*fields).alias("s")))), lambda x: x["s"])


def conflict_map(df: DataFrame, keys: list[str], source: str, value: str, order: str) -> DataFrame:
    """keys and a map of each source's last value, where a cluster's values conflict."""
    last = df.where(F.col(value).isNotNull()).groupBy(*keys, source).agg(F.max_by(value, order).alias(value))
    whole = last.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(source, value)))).alias("conflict"), F.count_distinct(value).alias("_n"))
    return whole.where("_n > 1").drop("_n")


def mode_first(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """keys and value: the most frequent value, the one seen first of several."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"), F.min(order).alias("_first"))
    return counted.groupBy(*keys).agg(F.max_by(value, F.struct("_n", -F.col("_first"))).alias(value))


def weighted_confidence(confidence: Column, weight: Column) -> Column:
    """Weighted mean, the plain one if all weights are 0; clamped, and capped for a single row."""
    mean = F.when(F.sum(weight) > 0, F.sum(confidence * weight) / F.sum(weight)).otherwise(F.avg(confidence))
    clamped = F.least(F.greatest(mean, F.lit(0.0)), F.lit(1.0))
    return F.bround(F.when(F.count("*") == 1, F.least(clamped, F.lit(SINGLE_CAP))).otherwise(clamped), 3)


def needs_review(confidence: Column, flags: Column) -> Column:
    marked = F.exists(flags, lambda f: F.contains(f, F.lit("conflict")) | F.contains(f, F.lit("regression")))
    return F.when((confidence < REVIEW_BELOW) | marked, "needs_review").otherwise("auto")


def conflict_rows(df: DataFrame, keys: list[str], source: str, value: str) -> DataFrame:
    """One row per (keys, source) with its last value, where a cluster's values conflict."""
    last = df.where(F.col(value).isNotNull()).groupBy(*keys, source).agg(F.max(value).alias(value))
    bad = last.groupBy(*keys).agg(F.count_distinct(value).alias("_n")).where("_n > 1").drop("_n")
    return last.join(bad, keys)
