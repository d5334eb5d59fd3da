"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader updates and scored as sparse dot products.

Features are the words (between ASCII blanks) and the pairs of neighbours, once
as they stand and once as outlines, in which runs of capitals, of small letters
and of digits shrink to one character each: made-up words share outlines. A
feature's value is its share of the text's features.

The model is fitted on at most SAMPLE labelled rows, those with the smallest
hashes of their ids, so the bound doesn't grow with the corpus; scoring reads
whole texts only. Rows whose crc32 (of the id as text) is divisible by 5 are
held out. Labels that are null, or that contradict each other for one id, teach
nothing. Without any label each text scores 0.5. Null and empty texts have the
intercept alone. Very long texts are slices of their own, read whole. Repeated rows
score alike; labels that repeat for an id count once, and of more labels than SAMPLE
those with the smallest hashes, then ids. Other columns take no part, whatever their
names. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casegraph.llm import kernels as K

#: Labelled rows that the model is fitted on, at most.
SAMPLE = 4000
BITS = 18
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.0, 1e-4
#: Values are shares times this.
SCALE = 8.0

_OUTLINE = np.arange(256, dtype=np.uint8)
_OUTLINE[48:58] = 48
_OUTLINE[65:91] = 65
_OUTLINE[97:123] = 97
_OUTLINE[128:] = 97


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and rows of all features of a slice of texts."""
    start, end, row = K.runs(~K.BLANK[data], offsets)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    plain = K.Prefix(data).spans(start, end)
    drawn = _OUTLINE[data]
    keep = ~K.BLANK[data]
    keep[1:] &= drawn[1:] != drawn[:-1]
    keep[start] = True
    at = np.concatenate(([0], np.cumsum(keep)))
    outline = K.Prefix(drawn[keep]).spans(at[start], at[end])
    same = row[1:] == row[:-1]
    again = (plain[1:] == plain[:-1]).astype(K.U64)  # a word that stands twice in a row
    hashes, rows = [np.where(again == 1, K.U64(5), K.U64(6))[same]], [row[1:][same]]
    for salt, h in ((1, plain), (2, outline)):
        hashes += [h + K.U64(salt), (h[:-1] * K._M1 + h[1:] * K.U64(2 * salt + 1) + again * K._M2)[same]]
        rows += [row, row[1:][same]]
    return (K.mix(np.concatenate(hashes)) >> K.U64(64 - BITS)).astype(np.int64), np.concatenate(rows)


def train(examples: list[tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
    """Weights by bucket, the intercept last; examples are (buckets, values, label)."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(i) -> np.ndarray:
        zi = z[i]
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for i, x, y in examples:
            w = weights(i)
            g = (1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            more = n[i] + g * g
            z[i] += g - (np.sqrt(more) - np.sqrt(n[i])) / ALPHA * w
            n[i] = more
    return weights(np.arange(size))


def _examples(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray, int]]:
    order = np.argsort(table["_order"].to_numpy(), kind="stable")
    labels = table["_label"].to_numpy()
    out: list = [None] * len(order)
    at = 0
    for i, j, data, offsets in K.text_slices(table["_text"]):
        bucket, row = features(data, offsets)
        key, count = np.unique(row << BITS | bucket, return_counts=True)
        begin = np.searchsorted(key >> BITS, np.arange(j - i + 1))
        for k in range(j - i):
            idx, c = key[begin[k] : begin[k + 1]] & ((1 << BITS) - 1), count[begin[k] : begin[k + 1]]
            out[at] = (np.append(idx, 1 << BITS), np.append(c * (SCALE / max(c.sum(), 1)), 1.0), int(labels[at]))
            at += 1
    return [out[i] for i in order]


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> np.ndarray:
    """Weights as float32, fitted in one task on the bounded sample."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).where("_id is not null and _label in (0, 1)").where(~held_out(F.col("_id")))
    one = known.groupBy("_id").agg(F.min("_label").alias("_label"), F.max("_label").alias("_high")).where("_label = _high").drop("_high")
    chosen = one.withColumn("_order", F.xxhash64("_id")).orderBy("_order", "_id").limit(sample)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    found = rows.join(F.broadcast(chosen), "_id").select("_order", "_label", "_text")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        w = train(_examples(pa.Table.from_batches(parts))) if parts else np.zeros(0)
        yield pa.RecordBatch.from_arrays([pa.array([w.astype("<f4").tobytes()], pa.binary())], names=["w"])

    got = found.repartition(1).mapInArrow(learn, "w binary").collect()
    raw = b"".join(bytes(r.w) for r in got)
    return np.frombuffer(raw, "<f4") if raw else np.zeros((1 << BITS) + 1, np.float32)


def fresh(columns: list[str], name: str = "_score") -> str:
    """A column name that isn't taken, in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text", out: str = "_score") -> DataFrame:
    """Adds the score of each row's whole text as out, which docs must not have; the weights' size is fixed (1 MB)."""
    if out.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"docs has a column {out} already; fresh() gives a free name")
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    at = docs.columns.index(text_col)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"`{out}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value.astype(np.float64)
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for i, j, data, offsets in K.text_slices(batch.column(at)):
                bucket, row = features(data, offsets)
                total = np.bincount(row, w[bucket], minlength=j - i)
                share = total * SCALE / np.maximum(np.bincount(row, minlength=j - i), 1)
                scores[i:j] = 1.0 / (1.0 + np.exp(-np.clip(share + w[-1], -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, out])

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """(id, held_out, score, predicted) per row."""
    weights = fit(docs, labels, id_col, text_col)
    scored = score(docs.select(F.col(id_col), F.col(text_col).alias("_text")), weights, "_text")
    return scored.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))
