"""Blocking, pair decisions, and joins of near records."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casegraph.functions.names import jw
from casegraph.functions.text import strict_subset, surname
from casegraph.operators.graph import durable

#: Thresholds of the pair decision; all can be overridden.
COSINE, JARO = 0.82, 0.88

#: Rows of a class that stand together, and rows of a key that form a block.
CHUNK, BLOCK = 256, 2048
#: Vectors of a block.
VECTORS = 1024
#: Pairs that a task makes, about, and tasks at most.
TASK_PAIRS, TASKS = 4_000_000, 20_000


def block_keys(city: Column, day: Column, name: Column) -> Column:
    """Keys under which a record meets others: place and month (else one common key), and the first 8 letters of each name token of 5 or more."""
    place = F.when(city.isNotNull() & day.isNotNull(), F.concat_ws("|", F.lower(F.trim(city)), F.date_format(day, "yyyy-MM"))).otherwise("__no_block__")
    long = F.filter(F.split(F.coalesce(name, F.lit("")), " +"), lambda t: F.length(t) >= 5)
    return F.array_distinct(F.concat(F.array(place), F.transform(long, lambda t: F.concat(F.lit("nametok|"), F.substring(t, 1, 8)))))


def _classes(df: DataFrame, keys: Column, columns: list[str], own: list[str], id_col: str) -> DataFrame:
    """Rows (_c, _keys, columns, _rows) of up to CHUNK or so input rows that are equal in their keys and columns; _rows has their ids, with own if there is any."""
    known = F.array_sort(F.array_distinct(F.filter(keys, lambda k: k.isNotNull())))
    member = F.struct(F.col(id_col).alias("id"), *own) if own else F.col(id_col)
    rows = df.where(F.col(id_col).isNotNull()).select(member.alias("_row"), F.xxhash64(id_col).alias("_deal"), known.alias("_keys"), *columns).where(F.size("_keys") > 0)
    rows = rows.withColumn("_h", F.xxhash64("_keys", *columns))
    # a hash tells only into how many chunks a class is cut
    many = rows.groupBy("_h").agg(F.count("*").alias("_n")).where(F.col("_n") > CHUNK)
    cut = rows.join(many, "_h", "left").withColumn("_cut", F.coalesce(F.pmod("_deal", F.ceil(F.col("_n") / CHUNK)), F.lit(0)))
    # lists of ids are sorted: their pairs then leave in runs that Parquet packs well
    rows = F.collect_list("_row") if own else F.sort_array(F.collect_list("_row"))
    grouped = cut.groupBy("_keys", *columns, "_cut").agg(rows.alias("_rows")).drop("_cut")
    return durable(grouped.withColumn("_c", F.monotonically_increasing_id()))


def compared(df: DataFrame, keys: str | Column, columns: list[str] = [], compare: Callable | None = None, own: list[str] = [], id_col: str = "id") -> DataFrame:  # noqa: B006
    """(id_a, id_b, result, own columns as x_a and x_b) of all pairs of rows that share a key, id_a < id_b, each once.

    compare(a, b) gets dicts of columns and gives the result; pairs where it is null are left out. Rows that are equal in keys
    and columns are one class: compare sees pairs of classes, in both orders, and only then do these become pairs of rows.
    A pair is met under the first key that both have, so nothing is made distinct afterwards. The rows of a frequent key are
    cut into blocks, and pairs of blocks are dealt over as many tasks as the number of pairs asks for.
    """
    keys = F.col(keys) if isinstance(keys, str) else keys
    classes = _classes(df, keys, columns, own, id_col)
    posted = classes.select("_c", "_rows", *columns, "_keys", F.posexplode("_keys").alias("_pos", "_key"))
    posted = posted.withColumn("_before", F.slice("_keys", F.lit(1), F.col("_pos"))).drop("_keys", "_pos")
    sizes = durable(posted.groupBy("_key").agg(F.sum(F.size("_rows")).alias("_n")).where("_n > 1"))
    total = sizes.agg(F.sum(F.col("_n").cast("double") * F.col("_n") / 2)).first()[0] or 0
    placed = posted.join(sizes, "_key").withColumn("_blocks", F.ceil(F.col("_n") / BLOCK).cast("int")).drop("_n")
    placed = placed.withColumn("_own", F.pmod(F.xxhash64("_c"), F.col("_blocks")).cast("int"))
    named = lambda s: [F.col(c).alias(f"{c}_{s}") for c in ("_c", "_rows", "_before", *columns)]
    left = placed.select("_key", F.col("_own").alias("_i"), F.explode(F.sequence("_own", F.col("_blocks") - 1)).alias("_j"), *named("a"))
    right = placed.select("_key", F.explode(F.sequence(F.lit(0), "_own")).alias("_i"), F.col("_own").alias("_j"), *named("b"))
    meet = ["_key", "_i", "_j"]
    if total > TASK_PAIRS:
        tasks = int(min(total / TASK_PAIRS + df.sparkSession.sparkContext.defaultParallelism, TASKS))
        left, right = left.repartition(tasks, *meet), right.repartition(tasks, *meet)
    met = left.join(right, meet).where(((F.col("_i") < F.col("_j")) | (F.col("_c_a") <= F.col("_c_b"))) & ~F.arrays_overlap("_before_a", "_before_b"))
    a, b = ({c: F.col(f"{c}_{s}") for c in columns} for s in "ab")
    results = []
    if compare is not None:
        met = met.withColumns({"_ab": compare(a, b), "_ba": compare(b, a)}).where("_ab is not null or _ba is not null")
        results = ["_ab", "_ba"]
    met = met.select((F.col("_c_a") == F.col("_c_b")).alias("_same"), "_rows_b", *results, F.explode("_rows_a").alias("_x"))
    met = met.select("_same", "_x", *results, F.explode("_rows_b").alias("_y"))
    x, y = (F.col(f"{v}.id") if own else F.col(v) for v in ("_x", "_y"))
    met = met.where((x < y) | (~F.col("_same") & (x > y)))
    out = [F.least(x, y).alias("id_a"), F.greatest(x, y).alias("id_b")]
    if compare is not None:
        out.append(F.when(x < y, F.col("_ab")).otherwise(F.col("_ba")).alias("result"))
    for c in own:
        out += [F.when(x < y, F.col(f"_x.{c}")).otherwise(F.col(f"_y.{c}")).alias(f"{c}_a"), F.when(x < y, F.col(f"_y.{c}")).otherwise(F.col(f"_x.{c}")).alias(f"{c}_b")]
    met = met.select(*out)
    return met if compare is None else met.where("result is not null")


def block_pairs(df: DataFrame, keys: str, id_col: str = "id") -> DataFrame:
    """Distinct (id_a, id_b), id_a < id_b, that share a key."""
    whole = df.groupBy(id_col).agg(F.flatten(F.collect_list(keys)).alias("_own_keys"))
    return compared(whole, "_own_keys", id_col=id_col)


def decide(jaro: Column, cosine: Column, name_a: Column, name_b: Column, article_a: Column, article_b: Column, cosine_min: float = COSINE, jaro_min: float = JARO) -> Column:
    """merge, review or distinct."""
    subset = strict_subset(name_a, name_b)
    weak_surname = surname(name_a).isNotNull() & surname(name_b).isNotNull() & (jw(surname(name_a), surname(name_b)) < 0.85)
    doubtful = ~subset & (jaro >= jaro_min) & (jaro < 0.95) & F.coalesce(weak_surname, F.lit(False))
    return (
        F.when(article_a.isNotNull() & (article_a == article_b), "distinct")
        .when((cosine >= cosine_min) & ((jaro >= jaro_min) | subset), F.when(doubtful, "review").otherwise("merge"))
        .when((cosine >= cosine_min) & (name_a.isNull() | name_b.isNull()) & (cosine >= 0.97), "merge")
        .when(cosine >= cosine_min, "review")
        .when((cosine >= 0.70) & subset, "merge")
        .when(cosine >= 0.70, "review")
        .otherwise("distinct")
    )


def near_in_time(df: DataFrame, group: str, day: str, id_col: str, days: int) -> DataFrame:
    """(group, id_a, id_b, days) of records of one group at most so many days apart.

    Days are cut into cells of that length; a record meets its own cell and the next, so a group is never paired with itself whole.
    """
    cell = F.floor(F.unix_date(F.col(day).cast("date")) / F.lit(days + 1))
    a = df.select(F.col(group).alias("group"), F.col(id_col).alias("id_a"), F.col(day).cast("date").alias("day_a"), F.explode(F.array(cell, cell + 1)).alias("cell_a"))
    b = df.select(F.col(group).alias("group_b"), F.col(id_col).alias("id_b"), F.col(day).cast("date").alias("day_b"), cell.alias("cell_b"))
    gap = F.abs(F.date_diff("day_a", "day_b"))
    met = a.join(b, (F.col("group") == F.col("group_b")) & (F.col("cell_a") == F.col("cell_b")) & (F.col("id_a") != F.col("id_b")) & (gap <= days))
    return met.select("group", F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), gap.cast("long").alias("days")).distinct()


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products row by row, summed from the left as vectors.dot does."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k] * b[:, k]
    return out


def _cell(table: pa.Table, at_least: float, ends: bool) -> pa.Table:
    """Links between two blocks of vectors: products of matrices find them, sums from the left decide."""
    ids, part = table["_id"].combine_chunks(), table["_part"].to_numpy()
    v = table["_v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), -1)
    order = np.argsort(ids.to_numpy(zero_copy_only=False), kind="stable")
    rank = np.empty(len(ids), np.int64)
    _, code = np.unique(ids.to_numpy(zero_copy_only=False)[order], return_inverse=True)
    rank[order] = code
    found = []
    with np.errstate(all="ignore"):
        length = np.sqrt(_dots(v, v))
        left, right = np.flatnonzero(part != 1), np.flatnonzero(part != 0)
        for at in range(0, len(left), 256):
            a = left[at : at + 256]
            near = ~((v[a] @ v[right].T) / (length[a][:, None] * length[right][None, :]) < at_least - 1e-6)
            near &= rank[a][:, None] < rank[right][None, :] if (part == 2).all() else rank[a][:, None] != rank[right][None, :]
            i, j = np.nonzero(near)
            i, j = a[i], right[j]
            low = rank[i] < rank[j]
            i, j = np.where(low, i, j), np.where(low, j, i)
            norm = length[i] * length[j]
            for x in range(0, len(i), 65536):
                p, q, n = i[x : x + 65536], j[x : x + 65536], norm[x : x + 65536]
                score = np.where(~(n <= 0), _dots(v[p], v[q]) / n, 0.0)
                ok = ~(score < at_least)
                found.append((p[ok], q[ok], score[ok]))
    i, j, score = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64 if k < 2 else np.float64) for k in range(3))
    if ends:
        return pa.table({"id": ids.take(pa.array(np.unique(np.concatenate((i, j)))))})
    return pa.table({"id_a": ids.take(pa.array(i)), "id_b": ids.take(pa.array(j)), "cosine": pa.array(score)})


def cosine_links(df: DataFrame, group: str, id_col: str, vector: str, at_least: float, ends: bool = False) -> DataFrame:
    """(id_a, id_b, cosine) of rows of one group, id_a < id_b, whose cosine is at_least (over 0) or more; with ends, the distinct ids of such rows.

    All pairs are looked at, as products of blocks of vectors; scores equal those of vectors.cosine. Vectors that are null, hold
    null or differ in length have cosine 0.
    """
    if not at_least > 0:
        raise ValueError("at_least must be over 0")
    whole = df.where(F.col(group).isNotNull() & F.col(id_col).isNotNull() & F.col(vector).isNotNull()).where(~F.exists(vector, lambda x: x.isNull()) & (F.size(vector) > 0))
    rows = whole.select(F.col(group).alias("_g"), F.size(vector).alias("_size"), F.col(id_col).alias("_id"), F.col(vector).alias("_v"))
    sizes = durable(rows.groupBy("_g", "_size").agg(F.count("*").alias("_n")).where("_n > 1"))
    total = sizes.agg(F.sum(F.col("_n").cast("double") * F.col("_n") / 2)).first()[0] or 0
    placed = rows.join(sizes, ["_g", "_size"]).withColumn("_blocks", F.ceil(F.col("_n") / VECTORS).cast("int"))
    placed = placed.withColumn("_own", F.pmod(F.xxhash64("_id"), F.col("_blocks")).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    part = F.when(F.col("_own") == F.col("_other"), 2).when(F.col("_own") < F.col("_other"), 0).otherwise(1)
    dealt = placed.select("_g", "_size", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), part.alias("_part"), "_id", "_v")
    cell = ["_g", "_size", "_i", "_j"]
    if total > VECTORS * VECTORS:
        dealt = dealt.repartition(int(min(total / TASK_PAIRS + 4 * df.sparkSession.sparkContext.defaultParallelism, TASKS)), *cell)
    kind = df.schema[id_col].dataType.simpleString()
    out = dealt.groupBy(*cell).applyInArrow(lambda t: _cell(t, at_least, ends), f"id {kind}" if ends else f"id_a {kind}, id_b {kind}, cosine double")
    return out.distinct() if ends else out
