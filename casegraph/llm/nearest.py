"""Approximate nearest neighbours by cosine: low-dimensional stable projections in a kd-tree.

Unit vectors are projected on DIMS Gaussian directions. The squared distance of
two projections, over the squared distance of the vectors, follows a chi-square
law with DIMS degrees of freedom. A search visits the tree's leaves by their
distance from the projected query, verifies what they hold on the original
vectors, and stops when the next leaf lies so far that a vector nearer than the
present k-th would, by that law, have been met before with probability CERTAINTY.

Every row is indexed. Cells come from a kd-tree over a sample of SAMPLE projections
at most; each row goes to its cell, and a cell's box covers all its rows. Cells of
more than SHARD rows are dealt by hash to shards, each with a tree of its own. A
query visits the cells by their boxes' distance, its nearest one first, then twice
as many in each round, until the stopping test holds for all cells left; so far
cells are never sent to it. Queries of a cell go in blocks of BLOCK; a (shard,
block) is a group of bounded size.

Equal vectors are one: of each, the rows with the smallest ids, as many as a result
can hold, stand in the index, and equal queries are searched once. So copies make
no group large and no result differs.

Vectors that are null, zero, or hold null or non-finite components take no part;
a query among them has no result. Only vectors of the same length are compared.
Ties go to the smaller id; rows that share the query's id are its own. Very long
vectors are arrays like others. Other columns take no part, whatever their names.
An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from casegraph.operators.graph import durable, stored

DIMS = 12
CERTAINTY = 0.97
LEAF = 64
SHARD = 8192
BLOCK = 2048
#: Projections that the cells are cut from, and of which each cell holds PER_CELL at least.
SAMPLE, PER_CELL = 1 << 16, 16
#: Leaves verified between two stopping tests.
STEP = 8
SEED = 20240229


def chi_square_quantile(p: float, dims: int = DIMS) -> float:
    """Of an even number of degrees of freedom, by bisection of the closed form."""
    lo, hi = 0.0, 40.0 * dims
    for _ in range(80):
        mid = (lo + hi) / 2
        tail = math.exp(-mid / 2) * sum((mid / 2) ** i / math.factorial(i) for i in range(dims // 2))
        lo, hi = (mid, hi) if 1 - tail < p else (lo, mid)
    return hi


def usable(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def projection(size: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size, DIMS))


class Tree:
    """A kd-tree of projected points: halves by rank on the widest axis down to leaves, with the leaves' boxes."""

    def __init__(self, points: np.ndarray) -> None:
        todo, done = [np.arange(len(points))], []
        while todo:
            part = todo.pop()
            if len(part) <= LEAF:
                done.append(part)
                continue
            p = points[part]
            axis = int(np.argmax(p.max(0) - p.min(0)))
            half = len(part) // 2
            order = np.argpartition(p[:, axis], half)
            todo += [part[order[:half]], part[order[half:]]]
        self.leaves = done
        self.low = np.array([points[x].min(0) for x in done])
        self.high = np.array([points[x].max(0) for x in done])


def bounds(low: np.ndarray, high: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances of a point from boxes."""
    gap = np.maximum(np.maximum(low - q, q - high), 0.0)
    return (gap * gap).sum(1)


def cuts(points: np.ndarray, cells: int) -> list[tuple[int, float, int, int]]:
    """Nodes (axis, value, left, right) of a tree with so many cells; a child below 0 is the cell -1 - child."""
    nodes: list = []
    if cells < 2:
        return nodes
    found = 0
    todo = [(np.arange(len(points)), cells, -1, 0)]
    while todo:
        part, share, parent, side = todo.pop()
        p = points[part]
        axis = int(np.argmax(p.max(0) - p.min(0))) if len(part) else 0
        value = float(np.median(p[:, axis])) if len(part) else 0.0
        left = part[p[:, axis] < value] if len(part) else part
        if share < 2 or not 0 < len(left) < len(part):
            child, found = -1 - found, found + 1
        else:
            child = len(nodes)
            nodes.append([axis, value, 0, 0])
            todo += [(left, share // 2, child, 2), (part[p[:, axis] >= value], share - share // 2, child, 3)]
        if parent >= 0:
            nodes[parent][side] = child
    return [tuple(x) for x in nodes]


def cell_of(nodes: list[tuple[int, float, int, int]], points: np.ndarray) -> np.ndarray:
    at = np.zeros(len(points), np.int64) if nodes else np.full(len(points), -1)
    if nodes:
        axis, value, left, right = (np.array(x) for x in zip(*nodes))
        while (open_ := np.flatnonzero(at >= 0)).size:
            n = at[open_]
            at[open_] = np.where(points[open_, axis[n]] < value[n], left[n], right[n])
    return -1 - at


def search(ids: np.ndarray, vectors: np.ndarray, q_ids: np.ndarray, queries: np.ndarray, k: int, known: np.ndarray | None = None, certainty: float = CERTAINTY):
    """(query id, id, cosine) of up to k nearest of each query, ties to smaller ids; known is the k-th score that a query has already, or nan."""
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    q_unit = queries / np.linalg.norm(queries, axis=1)[:, None]
    proj = projection(unit.shape[1])
    points, q_points = unit @ proj, q_unit @ proj
    tree = Tree(points)
    far = chi_square_quantile(certainty)
    out = []
    for qi in range(len(q_ids)):
        bound = bounds(tree.low, tree.high, q_points[qi])
        order = np.argsort(bound, kind="stable")
        best_i, best_s = np.zeros(0, np.int64), np.zeros(0)
        floor = known[qi] if known is not None else math.nan
        for at in range(0, len(order), STEP):
            kth = np.fmax(floor, best_s[k - 1] if len(best_i) >= k else math.nan)
            if bound[order[at]] > far * max(2.0 - 2.0 * kth, 0.0) + 1e-9:  # never with nan
                break
            rows = np.concatenate([tree.leaves[x] for x in order[at : at + STEP]])
            i, s = np.concatenate((best_i, rows)), np.concatenate((best_s, unit[rows] @ q_unit[qi]))
            if len(i) > 4 * k:
                # copies of a vector must not differ in the last bits here, so ties at the edge all stay
                near = s >= np.partition(s, -k)[-k] - 1e-9
                i, s = i[near], s[near]
            o = np.lexsort((ids[i], -np.round(s, 12)))
            best_i, best_s = i[o[:k]], s[o[:k]]
        if not len(best_i):
            continue
        v, q = vectors[best_i], queries[qi]
        exact = (v * q).sum(1) / (np.sqrt((v * v).sum(1)) * math.sqrt(float((q * q).sum())))
        out.append((np.full(len(best_i), q_ids[qi]), ids[best_i], exact))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _projected(column: pa.Array) -> np.ndarray:
    v = _matrix(column)
    return (v / np.linalg.norm(v, axis=1)[:, None]) @ projection(v.shape[1])


def _index(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Adds _cell and the projection _p to rows (_id, _v, _q, _dim)."""
    sampled = None
    for dim, n in counts.items():
        part = rows.where((F.col("_dim") == dim) & (F.pmod(F.xxhash64(F.lit("cells"), "_id"), F.lit(-(-n // SAMPLE))) == 0)).select("_dim", "_v") if n > SHARD else None
        sampled = part if sampled is None else sampled if part is None else sampled.unionByName(part)
    points: dict[int, list] = {}
    if sampled is not None:

        def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dims = batch.column(0).to_numpy()
                for dim in np.unique(dims):
                    at = pa.array(np.flatnonzero(dims == dim))
                    p = _projected(batch.column(1).take(at))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(list(p), pa.list_(pa.float64()))], names=["_dim", "_p"])

        for r in sampled.mapInArrow(project, "_dim int, _p array<double>").toLocalIterator():
            points.setdefault(r["_dim"], []).append(r["_p"])
    nodes = {d: cuts(np.array(p), min(-(-counts[d] // SHARD), max(1, len(p) // PER_CELL))) for d, p in points.items()}
    sent = rows.sparkSession.sparkContext.broadcast(nodes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(3).to_numpy()
            for dim in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                p = _projected(part.column(1))
                cell = cell_of(sent.value.get(int(dim), []), p)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int32)), pa.array(list(p), pa.list_(pa.float64()))], names=[*part.schema.names, "_cell", "_p"])

    return rows.mapInArrow(place, "_id long, _v array<double>, _q boolean, _dim int, _cell int, _p array<double>")


def nearest(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", certainty: float = CERTAINTY) -> DataFrame:
    """(query_id, rank, id, score) of the k nearest rows of each row for which queries holds."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"), F.coalesce(queries, F.lit(False)).alias("_q"))
    rows = rows.where("_id is not null").where(usable(F.col("_v"))).withColumn("_dim", F.size("_v"))
    counts = {r["_dim"]: r["n"] for r in rows.groupBy("_dim").agg(F.count("*").alias("n")).collect()}
    placed = stored(_index(rows, counts))
    asking = placed.where("_q").select("_id", F.xxhash64("_v").alias("_h1"), F.xxhash64(F.lit(1), "_v").alias("_h2"), "_v", "_dim", "_cell", "_p").dropDuplicates(["_id"])
    repeats = placed.join(asking.select("_id"), "_id", "left_semi").groupBy("_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    most = k + repeats
    alike = Window.partitionBy("_dim", "_cell", F.xxhash64("_v"), F.xxhash64(F.lit(1), "_v")).orderBy("_id")
    index = placed.withColumn("_rn", F.row_number().over(alike)).where(F.col("_rn") <= most).select("_id", "_v", "_dim", "_cell", "_p")
    index = stored(index)
    sides = [f(F.get("_p", F.lit(i))).alias(f"{n}{i}") for n, f in (("low", F.min), ("high", F.max)) for i in range(DIMS)]
    # at most SAMPLE / PER_CELL cells of each vector length
    boxes = sorted(index.groupBy("_dim", "_cell").agg(F.count("*").alias("n"), *sides).collect(), key=lambda r: (r["_dim"], r["_cell"]))
    of_dim: dict[int, tuple] = {}
    for dim in {r["_dim"] for r in boxes}:
        own = [r for r in boxes if r["_dim"] == dim]
        of_dim[dim] = (np.array([r["_cell"] for r in own]), *(np.array([[r[f"{n}{i}"] for i in range(DIMS)] for r in own]) for n in ("low", "high")))
    sent = spark.sparkContext.broadcast(of_dim)
    far = chi_square_quantile(certainty)
    shards = spark.createDataFrame([(r["_dim"], r["_cell"], -(-r["n"] // SHARD)) for r in boxes], "_dim int, _cell int, _shards int")
    held = index.join(F.broadcast(shards), ["_dim", "_cell"]).withColumn("_shard", F.pmod(F.xxhash64("_id"), F.col("_shards")).cast("int"))
    members = stored(asking.select("_id", "_h1", "_h2"))
    open_ = stored(asking.groupBy("_h1", "_h2").agg(F.min_by(F.struct("_id", "_v", "_dim", "_p"), "_id").alias("_r")).select("_r.*", "_h1", "_h2"))
    best = None
    begin, end = 0, 1

    def visits(low: int, high: int):
        """Cells ranked from low to high by distance of each query that may hold something nearer than its k-th."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                row, cell = [], []
                kth = batch.column(4).to_numpy(zero_copy_only=False).astype(np.float64)
                for i in range(batch.num_rows):
                    names, lows, highs = sent.value[batch.column(2)[i].as_py()]
                    bound = bounds(lows, highs, batch.column(3)[i].values.to_numpy())
                    order = np.argsort(bound, kind="stable")[low:high]
                    reach = far * max(2.0 - 2.0 * kth[i], 0.0) + 1e-9
                    order = order[~(bound[order] > reach)]
                    row += [i] * len(order)
                    cell += names[order].tolist()
                at = pa.array(np.array(row, np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), batch.column(2).take(at), batch.column(4).take(at), pa.array(cell, pa.int32())], names=["_qid", "_qv", "_qdim", "_kth", "_qcell"])

        return run

    def group(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            got = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        else:
            got = search(left["_id"].to_numpy(), _matrix(left["_v"]), right["_qid"].to_numpy(), _matrix(right["_qv"]), most, right["_kth"].to_numpy().astype(np.float64), certainty)
        return pa.table({"query_id": pa.array(got[0], pa.int64()), "_id": pa.array(got[1], pa.int64()), "score": pa.array(got[2], pa.float64())})

    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 12)), "_id")
    cells = max((len(x[0]) for x in of_dim.values()), default=0)
    while begin < cells:
        if best is None:
            known = open_.withColumn("_kth", F.lit(float("nan")))
        else:
            kth = best.where(F.col("rank") == most).select(F.col("query_id").alias("_id"), F.col("score").alias("_kth"))
            known = open_.join(kth, "_id", "left").withColumn("_kth", F.coalesce("_kth", F.lit(float("nan"))))
        asked = stored(known.select("_id", "_v", "_dim", "_p", "_kth").mapInArrow(visits(begin, end), "_qid long, _qv array<double>, _qdim int, _kth double, _qcell int"))
        begin, end = end, 2 * end + 1
        load = asked.groupBy("_qdim", "_qcell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
        plan = durable(load.join(shards, (F.col("_qdim") == F.col("_dim")) & (F.col("_qcell") == F.col("_cell"))).select("_dim", "_cell", "_shards", "_blocks"))
        if plan.isEmpty():
            break  # cells left lie farther still
        left = held.join(F.broadcast(plan.drop("_shards")), ["_dim", "_cell"]).select("_id", "_v", "_dim", "_cell", "_shard", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"))
        right = asked.join(F.broadcast(plan), (F.col("_qdim") == F.col("_dim")) & (F.col("_qcell") == F.col("_cell"))).select(
            "_qid", "_qv", "_qdim", "_qcell", "_kth", F.explode(F.sequence(F.lit(0), F.col("_shards") - 1)).alias("_qshard"), F.pmod(F.xxhash64(F.lit(1), "_qid"), F.col("_blocks")).cast("int").alias("_qblock"),
        )
        found = left.groupBy("_dim", "_cell", "_shard", "_block").cogroup(right.groupBy("_qdim", "_qcell", "_qshard", "_qblock")).applyInArrow(group, "query_id long, _id long, score double")
        found = found if best is None else found.unionByName(best.drop("rank"))
        best = durable(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most))
    if best is None:
        best = spark.createDataFrame([], "query_id long, _id long, score double, rank int")
    of = open_.select(F.col("_id").alias("query_id"), "_h1", "_h2")
    expanded = best.drop("rank").join(of, "query_id").drop("query_id").join(members.select(F.col("_id").alias("query_id"), "_h1", "_h2"), ["_h1", "_h2"]).where("query_id <> _id")
    return expanded.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", F.col("_id").alias(id_col), "score")
