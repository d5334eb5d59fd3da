"""Verification of cases against a truth set: greedy one-to-one matches and their scores."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from casegraph.operators.graph import connected_components, durable

#: Candidate pairs of one component that a task walks in order; larger components are matched in rounds.
WALKED = 1_000_000


def _walk(table: pa.Table) -> pa.Table:
    """The sequential greedy matches of one component."""
    t, c = table["t"].combine_chunks(), table["c"].combine_chunks()
    (keys, t_code), (values, c_code) = (np.unique(x.to_numpy(zero_copy_only=False), return_inverse=True) for x in (t, c))
    order = np.lexsort((c_code, t_code))
    t_code, c_code = t_code[order], c_code[order]
    begin = np.searchsorted(t_code, np.arange(len(keys) + 1))
    used = np.zeros(len(values), bool)
    out = []
    for i in range(len(keys)):
        wanted = c_code[begin[i] : begin[i + 1]]
        free = ~used[wanted]
        if free.any():
            j = wanted[free.argmax()]
            used[j] = True
            out.append((i, j))
    rows = np.array(out, np.int64).reshape(-1, 2)
    return pa.table({"t": pa.array(keys[rows[:, 0]], t.type), "c": pa.array(values[rows[:, 1]], c.type)})


def greedy_matches(candidates: DataFrame, truth: str = "truth_id", case: str = "case_id", walked: int = WALKED) -> DataFrame:
    """One-to-one matches in the order of truth, then of cases.

    Rows of different components of the candidate graph can't take each other's
    cases, so components of up to walked pairs are walked by a task each. Larger
    ones are matched in rounds, until no candidate is left: every open truth row
    asks for its first open case, and the smallest asker of a case gets it unless
    an earlier truth row could still want it. The first open truth row wins in
    every round, so rounds end; the result is that of one sequential walk.
    """
    pairs = durable(candidates.select(F.col(truth).alias("t"), F.col(case).alias("c")).where("t is not null and c is not null").distinct())
    node = lambda side, c: F.struct(F.lit(side).alias("side"), F.col(c).cast("string").alias("key"))
    parts = durable(connected_components(pairs.select(node(0, "t").alias("src"), node(1, "c").alias("dst"))))
    of = parts.where("id.side = 0").select(F.col("id.key").alias("_t"), F.col("component.key").alias("_part"))
    placed = pairs.join(of, F.col("t").cast("string") == F.col("_t")).select("t", "c", "_part")
    size = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    large = durable(size.where(F.col("_n") > walked).select("_part"))
    kinds = pairs.dtypes
    done = placed.join(large, "_part", "left_anti").groupBy("_part").applyInArrow(lambda x: _walk(x), ", ".join(f"{n} {k}" for n, k in kinds))
    left = durable(placed.join(large, "_part", "left_semi").select("t", "c"))
    while not left.isEmpty():
        asks = left.groupBy("t").agg(F.min("c").alias("c"))
        first = left.groupBy("c").agg(F.min("t").alias("_first"))
        won = durable(asks.join(first, "c").where(F.col("t") == F.col("_first")).select("t", "c"))
        done = done.unionByName(won)
        left = durable(left.join(won.select("t"), "t", "left_anti").join(won.select("c"), "c", "left_anti").select("t", "c"))
    return done.select(F.col("t").alias(truth), F.col("c").alias(case))


def matches_by_lists(truths: DataFrame, cases: DataFrame, agree: DataFrame, near: DataFrame, truth: str = "truth_id", case: str = "case_id") -> DataFrame:
    """The matches that greedy_matches() gives for all pairs whose lists agree and for the pairs in near.

    truths: truth, _list_t; cases: case, _list_c; agree: pairs of lists; near: further pairs of truth and case. Where two lists
    agree with each other only, and their rows stand in no near pair and under no other list, the walk gives the first truth the
    first case and so on; these are matched by rank, without their pairs. All others are paired.
    """
    truths, cases = (rows.where(F.col(key).isNotNull()).select(key, name).distinct() for rows, key, name in ((truths, truth, "_list_t"), (cases, case, "_list_c")))
    agree, near = durable(agree.select("_list_t", "_list_c").distinct()), durable(near.select(truth, case))

    def busy(rows: DataFrame, key: str, name: str) -> DataFrame:
        several = agree.groupBy(name).agg(F.count("*").alias("_n")).where("_n > 1").select(name)
        twice = rows.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key)
        return several.union(rows.join(near.select(key).union(twice), key, "left_semi").select(name)).distinct()

    plain = durable(agree.join(busy(truths, truth, "_list_t"), "_list_t", "left_anti").join(busy(cases, case, "_list_c"), "_list_c", "left_anti").select("_list_t", "_list_c"))
    ranked = lambda rows, key, name: rows.join(plain, name).withColumn("_rank", F.row_number().over(Window.partitionBy(name).orderBy(key)))
    first = ranked(truths, truth, "_list_t").join(ranked(cases, case, "_list_c").drop("_list_t"), ["_list_c", "_rank"]).select(truth, case)
    rest = agree.join(plain, ["_list_t", "_list_c"], "left_anti")
    paired = truths.join(rest, "_list_t").join(cases, "_list_c").select(truth, case)
    return first.unionByName(greedy_matches(paired.unionByName(near), truth, case))


def metrics(n_truth: DataFrame, n_cases: DataFrame, matches: DataFrame) -> DataFrame:
    """One row: counts, precision, recall and F1."""
    counts = n_truth.agg(F.count("*").alias("truth_count")).crossJoin(n_cases.agg(F.count("*").alias("pipeline_count"))).crossJoin(matches.agg(F.count("*").alias("true_positive")))
    out = counts.withColumn("false_negative", F.col("truth_count") - F.col("true_positive")).withColumn("false_positive", F.col("pipeline_count") - F.col("true_positive"))
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    out = out.withColumn("precision", share("true_positive", "pipeline_count")).withColumn("recall", share("true_positive", "truth_count"))
    return out.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))
