"""Substring dedup: paragraphs by MinHash banding, exact Jaccard and components, and passages inside them.

Paragraphs are a text's lines of MIN_WORDS words or more, in repeats() of SHINGLE
words or more; a paragraph's set is its distinct shingles of SHINGLE words (between ASCII blanks, A-Z in lower
case). Each is posted under BANDS bands of ROWS minima: at a similarity of 0.8
two paragraphs share a band with a probability over 0.9999. Colliding paragraphs
are verified by exact Jaccard similarity on the full sets, links become
components, and all of a component's paragraphs but the first (by document id,
then place) are removals. How frequent paragraphs are linked without all their
pairs is told in linking.py.

Passages inside longer lines, or across lines, are windows of WINDOW words that
begin at anchors: at the smallest hash of three words among REACH neighbouring
places. Texts that share REACH + WINDOW - 1 words share a window. Equal windows
(by 128-bit hashes) are a class; neighbours of a text are merged to one span.

Null, empty and short-lined texts have no paragraphs. Rows without an id are
left out; rows that share an id are one document whose paragraphs of one place
are linked by any of their texts. Document ids that don't lie within 2**35 of
zero are numbered first and put back at the end. Ties (equal sets) go to the
smallest document id, then place. Very long texts are slices of their own and
make as many paragraphs as they have lines. Other columns of the input take no
part, whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from casegraph.llm import kernels as K
from casegraph.llm.linking import components
from casegraph.llm.near_dups import minima, set_hashes
from casegraph.operators.graph import discard, release, stored
from casegraph.operators.tables import join_counted, numbered

MIN_WORDS = 25
SHINGLE = 5
BANDS, ROWS = 14, 3
PERCENT = 80
#: Texts that share 51 words in a row share a window.
WINDOW, REACH = 28, 24
#: A paragraph's id is its document's id times this plus its number in the document; a text has 2**31 bytes at most.
PLACES = 1 << 28
#: Document ids within this of zero are used as they are.
DOCS = 1 << 35


def paragraphs(data: np.ndarray, offsets: np.ndarray, min_words: int = MIN_WORDS):
    """Of each paragraph: row, number in the row, first byte and end in the row, words; and its words' hashes and paragraphs."""
    lines = np.union1d(offsets, np.flatnonzero(data == 10) + 1)
    word, start, end, line = K.words(data, lines)
    count = np.bincount(line, minlength=len(lines) - 1 if len(lines) else 0)
    good = np.flatnonzero(count >= min_words)
    number = np.full(len(count), -1)
    number[good] = np.arange(len(good))
    keep = number[line] >= 0 if len(line) else np.zeros(0, bool)
    row = np.searchsorted(offsets, lines[good], "right") - 1
    place = np.arange(len(good)) - np.searchsorted(row, row)
    begin = np.cumsum(count) - count
    first, last = start[begin[good]] if len(good) else good, end[(begin + count - 1)[good]] if len(good) else good
    return row, place, first - offsets[row], last - offsets[row], count[good], word[keep], number[line[keep]]


def _ids(batch: pa.RecordBatch, i: int, row: np.ndarray, place: np.ndarray) -> np.ndarray:
    if place.max() >= PLACES:
        raise ValueError(f"a text has more than {PLACES} paragraphs")
    return batch.column(0).to_numpy()[i + row] * PLACES + place


def paragraph_items(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, n, h1, h2, keys, first, last, words) of the paragraphs of rows (doc, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, data, offsets in K.text_slices(batch.column(1)):
                row, place, first, last, count, word, of = paragraphs(data, offsets, min_words)
                if not len(row):
                    continue
                of, h = K.shingles(word, of, len(row), SHINGLE)
                begin = np.searchsorted(of, np.arange(len(row)))
                low = minima(h, begin, BANDS * ROWS).astype(np.uint64).reshape(len(row), BANDS, ROWS)
                band = np.zeros((len(row), BANDS), np.uint64)
                for k in range(ROWS):
                    band = K.mix(band + low[:, :, k] + K._M2)
                h1, h2 = set_hashes(h, begin)
                lists = pa.ListArray.from_arrays(pa.array((np.arange(len(row) + 1) * BANDS).astype(np.int32)), pa.array(band.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_ids(batch, i, row, place)), pa.array(np.diff(np.append(begin, len(h)))), pa.array(h1), pa.array(h2), lists, pa.array(first), pa.array(last), pa.array(count)],
                    names=["id", "n", "h1", "h2", "keys", "first", "last", "words"],
                )

    return rows.mapInArrow(run, "id long, n long, h1 long, h2 long, keys array<long>, first long, last long, words long")


def paragraph_sets(rows: DataFrame, ids: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, set) of the paragraphs whose ids are in ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(2)
            for i, j, data, offsets in K.text_slices(batch.column(1)):
                row, place, _, _, _, word, of = paragraphs(data, offsets, min_words)
                if not len(row):
                    continue
                id_ = _ids(batch, i, row, place)
                of, h = K.shingles(word, of, len(row), SHINGLE)
                begin = np.searchsorted(of, np.arange(len(row) + 1)).astype(np.int32)
                sets = pa.ListArray.from_arrays(pa.array(begin), pa.array(h.view(np.int64)))
                pick = pa.array(np.flatnonzero(np.isin(id_, wanted[i:j].flatten().to_numpy())))
                yield pa.RecordBatch.from_arrays([pa.array(id_).take(pick), sets.take(pick)], names=["id", "set"])

    per_doc = ids.groupBy(F.floor(F.col("id") / PLACES).alias("_doc")).agg(F.collect_list("id").alias("_ids"))
    met = rows.join(per_doc, rows["doc"] == F.col("_doc")).select("doc", "text", "_ids")
    return met.mapInArrow(run, "id long, set array<long>")


def repeated_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per paragraph that has a similar one: its document, place in bytes, words, class and whether it is removed."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).where("doc is not null")
    low, high = rows.agg(F.min("doc"), F.max("doc")).first()
    wide = None
    if low is not None and (low < -DOCS or high >= DOCS):
        wide = stored(numbered(rows.select("doc").distinct(), "_number", F.col("doc")))
        rows = rows.join(wide, "doc").select(F.col("_number").alias("doc"), "text")
    found = stored(paragraph_items(rows, min_words))
    linked = components(found.select("id", "n", "h1", "h2", "keys"), lambda ids: paragraph_sets(rows, ids, min_words), 1, percent, kept=True)
    linked = stored(linked.select("id", "component").distinct())
    size = linked.groupBy("component").agg(F.count("*").alias("class_size")).where("class_size > 1")
    several = join_counted(linked, size, ["component"], "class_size", linked.count())
    places = found.select("id", "first", "last", "words").dropDuplicates(["id"])
    doc = lambda c: F.floor(F.col(c) / PLACES).cast("long")
    out = several.join(places, "id").select(
        doc("id").alias(id_col), (F.col("id") - doc("id") * PLACES).alias("paragraph"), "first", "last", "words", "class_size",
        doc("component").alias("class_doc_id"), (F.col("component") - doc("component") * PLACES).alias("class_paragraph"), (F.col("id") != F.col("component")).alias("removed"),
    )
    if wide is None:
        return out
    for c in (id_col, "class_doc_id"):
        out = out.join(wide.select(F.col("_number").alias(c), F.col("doc").alias("_wide")), c).withColumn(c, F.col("_wide")).drop("_wide")
    return out


def window_starts(word: np.ndarray, row: np.ndarray, n_rows: int, window: int = WINDOW, reach: int = REACH) -> np.ndarray:
    """First words of the windows of a slice of texts."""
    count = np.bincount(row, minlength=n_rows)
    first = np.cumsum(count) - count
    valid = np.maximum(count - window + 1, 0)
    if not valid.any():
        return np.zeros(0, np.int64)
    mult = K.powers(4, 0xD6E8FEB86659FD93)[0]
    g = K.mix(word[:-2] * mult[1] + word[1:-1] * mult[2] + word[2:] * mult[3])
    blocks = -(-(len(g) + reach) // reach)
    key = np.full(blocks * reach, np.iinfo(np.uint64).max, K.U64)
    low = K.U64(1023)
    key[: len(g)] = (g & ~low) | (np.arange(len(g)) % reach).astype(K.U64)
    grid = key.reshape(blocks, reach)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    at = np.flatnonzero(valid >= reach)
    n = valid[at] - reach + 1
    p = np.repeat(first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    take = (tail[p] & ~low) <= (head[p + reach - 1] & ~low)
    base = np.where(take, p // reach, (p + reach - 1) // reach) * reach
    found = base + (np.where(take, tail[p], head[p + reach - 1]) & low).astype(np.int64)
    short = np.flatnonzero((valid > 0) & (valid < reach))
    few = [first[r] + int(np.argmin(g[first[r] : first[r] + valid[r]] & ~low)) for r in short]
    return np.union1d(found, np.array(few, np.int64))


def windows(rows: DataFrame, spans: bool) -> DataFrame:
    """(h1) of the windows of rows (doc, text), or with their places (doc, first, last, h1, h2)."""
    names = ["doc", "first", "last", "h1", "h2"] if spans else ["h1"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in K.text_slices(batch.column(1)):
                word, start, end, row = K.words(data, offsets)
                at = window_starts(word, row, j - i)
                if not len(at):
                    continue
                h1 = pa.array(K.Prefix(word).spans(at, at + WINDOW).view(np.int64))
                if not spans:
                    yield pa.RecordBatch.from_arrays([h1], names=names)
                    continue
                h2 = pa.array(K.Prefix(word, 0xC2B2AE3D27D4EB4F).spans(at, at + WINDOW).view(np.int64))
                begin = offsets[row[at]]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row[at] + i)), pa.array((start[at] - begin).astype(np.int32)), pa.array((end[at + WINDOW - 1] - begin).astype(np.int32)), h1, h2], names=names)

    return rows.mapInArrow(run, "doc long, first int, last int, h1 long, h2 long" if spans else "h1 long")


def merged_spans(df: DataFrame, *keys: str) -> DataFrame:
    """Overlapping or touching (first, last) of equal keys as one, with the number of windows, the largest class and its first document."""
    w = Window.partitionBy(*keys).orderBy("first", "last")
    fresh = F.coalesce(F.col("first") > F.max("last").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    island = df.withColumn("_new", fresh.cast("int")).withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(*keys, "_island").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.max("class_size").alias("class_size"), F.min("class_doc_id").alias("class_doc_id")).drop("_island")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per span of repeated windows: document, place in bytes, class and whether it is removed."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).where("doc is not null")
    busy = stored(windows(rows, False).groupBy("h1").agg(F.count("*").alias("_n")).where("_n > 1").select("h1"))
    release(docs.sparkSession)
    held = stored(windows(rows, True).join(busy, "h1"))
    classes = stored(held.groupBy("h1", "h2").agg(F.count("*").alias("class_size"), F.min(F.struct("doc", "first")).alias("_one")).where("class_size > 1"))
    placed = held.join(classes, ["h1", "h2"])
    placed = placed.select("doc", "first", "last", "class_size", F.col("_one.doc").alias("class_doc_id"), ((F.col("doc") != F.col("_one.doc")) | (F.col("first") != F.col("_one.first"))).alias("removed"))
    discard(busy)
    spans = merged_spans(placed.distinct(), "doc", "removed")
    return spans.select(F.col("doc").alias(id_col), F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"), "class_size", "class_doc_id", "removed")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = SHINGLE) -> DataFrame:
    """Repeated paragraphs and passages of all documents, told apart by kind; lines from one shingle on are paragraphs."""
    passages = stored(repeated_passages(docs, id_col, text_col))
    release(docs.sparkSession)
    names = [id_col, "kind", "first", "last", "class_size", "class_doc_id", "removed"]
    return repeated_paragraphs(docs, id_col, text_col, min_words=min_words).withColumn("kind", F.lit("paragraph")).select(names).unionByName(passages.withColumn("kind", F.lit("passage")).select(names))


def remove_paragraphs(docs: DataFrame, repeated: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the removed spans' bytes cut out of their texts."""
    cuts = merged_spans(repeated.where("removed"), id_col).groupBy(F.col(id_col).alias("_doc")).agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("_cuts"))
    met = docs.join(cuts, docs[id_col] == F.col("_doc"), "left")
    raw = F.col(text_col).cast("binary")
    size = F.octet_length(F.col(text_col)).cast("long")
    begins = F.concat(F.array(F.lit(0).cast("long")), F.col("_cuts.last"))
    ends = F.concat(F.col("_cuts.first"), F.array(size))
    parts = F.zip_with(begins, ends, lambda a, b: F.substring(raw, (a + 1).cast("int"), (b - a).cast("int")).cast("string"))
    return met.withColumn(text_col, F.when(F.col("_cuts").isNull(), F.col(text_col)).otherwise(F.array_join(parts, ""))).select(docs.columns)
