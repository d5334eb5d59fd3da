"""Cases that take in others, and extractions that are merged into cases: ordered folds, as aggregations over a rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from casegraph.functions import values as V
from casegraph.operators.tables import latest

#: Outcomes in order of weight; a death wins over all.
OUTCOMES = ("unknown", "survived", "critical", "died")
NAMES = ("victim_name", "victim_name_ar", "victim_name_he", "victim_name_en")


def outcome_of(outcomes: Column) -> Column:
    """Struct of the outcome that wins and a flag: died if it is among them, else the weightiest; several are an outcome_conflict."""
    known = F.array_distinct(F.filter(outcomes, lambda o: o.isNotNull()))
    rank = lambda o: F.array_position(F.array(*[F.lit(x) for x in OUTCOMES]), o)
    best = F.array_max(F.transform(known, lambda o: F.struct(rank(o).alias("r"), o.alias("o"))))["o"]
    return F.struct(best.alias("outcome"), F.when(F.size(known) > 1, "outcome_conflict").alias("flag"))


def union_by_key(lists: Column, key) -> Column:
    """The elements of lists of structs, end to end, each key's first one; elements without a key go."""
    flat = F.filter(F.flatten(lists), lambda x: key(x).isNotNull())
    keys = F.transform(flat, key)
    return F.filter(F.transform(flat, lambda x, i: F.when(F.array_position(keys, key(x)) == i + 1, x)), lambda x: x.isNotNull())


def union_distinct_json(first: Column, more: Column) -> Column:
    """first with the elements of more that it doesn't hold, told apart by their JSON."""
    text = lambda x: F.to_json(F.struct(x.alias("v")))
    seen = F.transform(F.concat(first, more), text)
    return F.filter(F.transform(F.concat(first, more), lambda x, i: F.when(F.array_position(seen, text(x)) == i + 1, x)), lambda x: x.isNotNull())


def source_confidence(sources: Column, weights: dict[str, int] = V.PUBLISHER_WEIGHTS) -> Column:
    """Mean of the sources' confidences (0.5 if missing), weighted by publisher, up to 1; null without sources."""
    weight = lambda s: F.coalesce(*[F.when(F.coalesce(s["publisher"], F.lit("")) == k, F.lit(float(w))) for k, w in weights.items()], F.lit(1.0))
    total = F.aggregate(sources, F.lit(0.0), lambda a, s: a + weight(s))
    score = F.aggregate(sources, F.lit(0.0), lambda a, s: a + weight(s) * F.coalesce(s["confidence_score"].cast("double"), F.lit(0.5)))
    return F.when(F.size(sources) > 0, F.bround(F.least(F.lit(1.0), score / total), 3))


def absorb(cases: DataFrame, group: str, scalars: list[str], lists: dict[str, object], *strength: Column, weighted: bool = True) -> DataFrame:
    """One case per group: the strongest one's fields, missing ones from the next that has them.

    Aliases take in the others' main names, lists (name: key of an element) are united in order of strength, flags too; of a group
    with two sources or more the single_source flag goes. A death wins among outcomes. With weighted, confidence is the sources' mean.
    """
    rank = F.struct(*strength)
    ordered = lambda c: F.array_sort(F.collect_list(F.struct(rank.alias("r"), F.col(c).alias("v"))))["v"]
    aggs = [F.min_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) for c in scalars]
    aggs += [ordered(c).alias(f"_{c}") for c in ("aliases", "flags", "victim_outcome", *lists)]
    names = [n for n in NAMES if n in cases.columns]
    aggs += [ordered("_names").alias("_all_names"), F.count("*").alias("n_merged")]
    out = cases.withColumn("_names", F.array(*names).cast("array<string>")).groupBy(group).agg(*aggs)
    fate = outcome_of(F.col("_victim_outcome"))
    main = F.array(*names).cast("array<string>")
    keep = lambda c: F.filter(c, lambda x: x.isNotNull() & (x != ""))
    others = F.filter(keep(F.flatten("_all_names")), lambda n: ~F.coalesce(F.array_contains(keep(main), n), F.lit(False)))
    out = out.withColumn("_fate", fate).withColumns({
        **{c: union_by_key(F.col(f"_{c}"), k) for c, k in lists.items()},
        "aliases": F.array_distinct(F.concat(keep(F.flatten("_aliases")), others)),
        "flags": F.array_distinct(F.concat(F.flatten("_flags"), F.filter(F.array("_fate.flag"), lambda x: x.isNotNull()))),
        "victim_outcome": F.col("_fate.outcome"),
    })
    if "sources" in lists:
        out = out.withColumn("flags", F.when(F.size("sources") >= 2, F.array_remove("flags", "single_source")).otherwise(F.col("flags")))
        if weighted:
            out = out.withColumn("confidence_score", F.coalesce(source_confidence(F.col("sources")), F.col("confidence_score")))
    return out.drop("_fate", "_all_names", *[f"_{c}" for c in ("aliases", "flags", "victim_outcome", *lists)])


def merge_values(existing: DataFrame, news: DataFrame, fields: list[str], key: str = "case_id") -> tuple[DataFrame, DataFrame]:
    """Cases with their missing fields from the first of news (case, source, seq and fields) that has them, and the conflicts.

    A value that differs from the one that stands when its turn comes is a conflict (case, field, source, value) and changes nothing;
    of one source the last such value counts.
    """
    long = news.select(key, "source", "seq", *[F.col(f).cast("string").alias(f) for f in fields]).unpivot([key, "source", "seq"], fields, "field", "value").where("value is not null and value <> ''")
    own = existing.select(key, *[F.col(f).cast("string").alias(f) for f in fields]).unpivot([key], fields, "field", "_own")
    w = Window.partitionBy(key, "field").orderBy("seq", "source")
    met = long.join(own, [key, "field"]).withColumn("_own", F.coalesce(F.nullif("_own", F.lit("")), F.first("value").over(w)))
    conflicts = latest(met.where(F.col("value") != F.col("_own")), [key, "field", "source"], F.desc("seq")).select(key, "field", "source", "value")
    filled = met.groupBy(key).pivot("field", fields).agg(F.min("_own"))
    joined = existing.join(filled.select(F.col(key).alias("_key"), *[F.col(f).alias(f"_{f}") for f in fields]), F.col(key) == F.col("_key"), "left")
    kind = dict(existing.dtypes)
    blank = lambda f: F.nullif(F.col(f), F.lit("")) if kind[f] == "string" else F.col(f)
    return joined.select(*[F.coalesce(blank(c), F.col(f"_{c}").cast(kind[c])).alias(c) if c in fields else F.col(c) for c in existing.columns]), conflicts
