"""License scans: ordered signature rules over normalised words, in DataFrame functions only.

A text is put in lower case (A-Z) and cut into words of digits, a-z and all
characters beyond ASCII. Base detections are places where a phrase's words stand
consecutively. Texts with a gate word meet the rules whose keyword they hold (a
broadcast of a few hundred rows, fixed in license_rules.py); each rule gives all
its intervals of words. A detection inside another, or on the same words with a
lower priority, is suppressed by one running maximum over the text's detections,
sorted by their starts. What is left starts and ends in one order, so a detection
that overlaps others in part overlaps a neighbour most; it goes if it shares half of
its words or more with a neighbour of a better priority (the longer one of equal
ones, then the one before).

Null and empty texts have no words, no labels and score 0; missing places are
null. Very long texts are scanned whole. Rows that repeat an id and text each get the
same result; ids may be null. Ties of rules go to the one listed first. Other columns
take no part, whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from casegraph.llm.license_rules import BASE, GATES, rules
from casegraph.llm.line_dedup import ascii_lower

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normalised(text: Column) -> Column:
    """A space before each word and one after the last; one space if there is no word."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), GAP, " ")), F.lit(" "))


def spaces(c: Column) -> Column:
    return F.octet_length(c) - F.octet_length(F.replace(c, F.lit(" "), F.lit("")))


def whole(pattern: str) -> str:
    return f" {pattern}(?= )"


def base_places(norm: Column, n_words: Column, phrase: str) -> Column:
    """Struct of n, first and last: the phrase's places in a normalised text."""
    k = phrase.count(" ") + 1
    parts = F.split(norm, whole(phrase), -1)
    found = F.struct(
        (F.size(parts) - 1).cast("long").alias("n"),
        spaces(F.get(parts, F.lit(0))).cast("long").alias("first"),
        (n_words - spaces(F.element_at(parts, -1)) + 1 - k).cast("long").alias("last"),
    )
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last"))
    return F.when(F.contains(norm, F.lit(f" {phrase} ")), found).otherwise(none)


def detections(texts: DataFrame) -> DataFrame:
    """(_key, _h, label, priority, confidence, start, end) of the rules on gated (_key, _h, _norm), overlaps resolved."""
    spark = texts.sparkSession
    table = rules()
    rule_rows = F.broadcast(spark.createDataFrame(table, "rule_id int, label string, priority int, keyword string, pattern string, confidence double"))
    keywords = F.array(*[F.lit(k) for k in sorted({r.keyword for r in table})])
    hit = texts.select("*", F.explode(F.filter(keywords, lambda k: F.contains(F.col("_norm"), k))).alias("keyword")).join(rule_rows, "keyword")
    hit = hit.withColumn("pattern", F.concat(F.lit(" "), F.col("pattern"), F.lit("(?= )"))).where(F.regexp("_norm", F.col("pattern")))
    parts = hit.select(
        "_key", "_h", "rule_id", "label", "priority", "confidence",
        F.posexplode(F.arrays_zip(F.split("_norm", F.col("pattern"), -1).alias("gap"), F.regexp_extract_all("_norm", F.col("pattern"), F.lit(0)).alias("match"))).alias("_i", "_part"),
    ).where("_part.match is not null")
    size = spaces(F.col("_part.match"))
    before = Window.partitionBy("_key", "_h", "rule_id").orderBy("_i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = parts.withColumn("_size", size).withColumn("end", F.sum(spaces(F.col("_part.gap")) + size).over(before)).withColumn("start", F.col("end") - F.col("_size"))
    by_start = Window.partitionBy("_key", "_h").orderBy("start", F.desc("end"), "priority", "rule_id").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.coalesce(F.max("end").over(by_start) >= F.col("end"), F.lit(False))
    kept = placed.select("_key", "_h", "rule_id", "label", "priority", "confidence", "start", "end", covered.alias("_covered")).where("not _covered")
    # neighbours by start; a smaller (priority, -length, start) is better
    order = Window.partitionBy("_key", "_h").orderBy("start", "rule_id")
    rank = F.struct(F.col("priority"), F.col("start") - F.col("end"), F.col("start"))
    beside = {n: f(F.struct(rank.alias("rank"), "start", "end"), 1).over(order) for n, f in (("before", F.lag), ("after", F.lead))}
    size = F.col("end") - F.col("start")
    lost = lambda n: F.coalesce((F.col(f"{n}.rank") < rank) & (2 * (F.least(F.col("end"), F.col(f"{n}.end")) - F.greatest(F.col("start"), F.col(f"{n}.start"))) >= size), F.lit(False))
    return kept.withColumns(beside).where(~(lost("before") | lost("after"))).select("_key", "_h", "label", "priority", "confidence", "start", "end")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    # explode of one element keeps the normalised text from being computed anew in each use
    norm = docs.select(F.col(id_col).alias("_key"), F.explode(F.array(normalised(F.col(text_col)))).alias("_norm"))
    n_words = F.when(F.trim("_norm") == "", 0).otherwise(spaces(F.col("_norm")) - 1)
    gate = reduce(lambda a, b: a | b, [F.contains(F.col("_norm"), F.lit(g)) for g in GATES])
    base = norm.select(
        "_key", "_norm", F.when(gate, F.xxhash64("_norm")).alias("_h"), n_words.cast("long").alias("n_words"),
    )
    for i, p in enumerate(BASE):
        base = base.select("*", F.explode(F.array(base_places(F.col("_norm"), F.col("n_words"), p))).alias(f"_p{i}"))
    found = [F.col(f"_p{i}") for i in range(len(BASE))]
    labels = F.array_sort(F.array_distinct(F.filter(F.array(*[F.when(c["n"] > 0, F.lit(x)) for c, x in zip(found, BASE.values(), strict=True)]), lambda x: x.isNotNull())))
    rows = base.select(
        "_key", "_h", "n_words", sum((c["n"] for c in found[1:]), found[0]["n"]).alias("n_base"),
        F.least(*[c["first"] for c in found]).alias("first_word"), F.greatest(*[c["last"] for c in found]).alias("last_word"), labels.alias("_base"),
    )
    gated = norm.where(gate).select("_key", F.xxhash64("_norm").alias("_h"), "_norm").dropDuplicates(["_key", "_h"])
    more = detections(gated).groupBy("_key", "_h").agg(F.collect_set("label").alias("_more"), F.max("confidence").alias("_score"))
    more = more.withColumnsRenamed({"_key": "_key2", "_h": "_h2"})
    joined = rows.join(more, F.col("_key").eqNullSafe(F.col("_key2")) & (F.col("_h") == F.col("_h2")), "left")
    every = F.array_sort(F.array_union(F.col("_base"), F.coalesce("_more", F.array().cast("array<string>"))))
    score = F.greatest(F.coalesce("_score", F.lit(0.0)), F.when(F.size("_base") > 0, 0.9).otherwise(0.0))
    return joined.select(
        F.col("_key").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join("_base", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), score.alias("score"),
    )
