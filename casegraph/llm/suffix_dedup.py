"""Suffix dedup: removes each byte covered by a string of 400 bytes that starts elsewhere too, and counts repeated passages of words.

Positions are put in buckets by a hash of the GRAM bytes at them, and buckets are
refined by identifiers of what stands at other offsets, over and over, until
equal strings are found. Sorting each position of the corpus would shuffle tens
of times the input, so a string stands in the bucket of its anchor: the place of
the smallest gram hash inside it, the leftmost of several. Equal strings have
equal anchors at equal offsets; a run of neighbouring strings shares one anchor,
and one row stands for the run.

1. Buckets of one anchor are dropped. Where the whole context of a run (the bytes
   of all its strings) occurs twice, all its strings do.
2. Of the contexts left, one each is compared with the others of its bucket: the
   hashes of all their strings are counted together. A bucket too large for a
   task is first refined: its runs are cut into shorter ones, each with the
   identifier of the bytes common to its strings as its new bucket.
3. The strings' ranges are merged to spans per document and their bytes removed.

The same search runs a second time over words (between ASCII blanks, A-Z in lower
case) in place of bytes: passages are runs covered by strings of 51 words that
start elsewhere too. They are counted and not removed; many hold under 400 bytes.

A third time it runs over strings of 25 words and asks for those that start in
another document: a passage of 51 words of which one word was changed has 25 left
on one side. Here a context is whole only if two documents hold it. All others are
compared, with the first and last of the whole ones, and a string counts if two
documents hold it.

Strings are told equal by 64-bit hashes among those of one bucket, which is itself
a 64-bit hash (in a full bucket two different ones meet with a chance of 1e-8).
Matches never cross documents. Null texts count as empty; texts under 400 bytes
lose nothing. Very long texts are slices of their own. Each row is a document of
its own: rows that repeat a text lose what they share, and no row of equal ones is
spared. Rows without an id take part as well. Other columns take no part, whatever
their names. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casegraph.llm import kernels as K
from casegraph.operators.graph import discard, durable, release, stored
from casegraph.operators.tables import join_counted


class Unit(NamedTuple):
    """What strings are made of: their length and their grams' in such units, the type of a unit, how texts become units, and which strings count."""

    span: int
    gram: int
    kind: type
    of: Callable
    apart: bool = False  # only strings that stand in two documents


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    word, _, _, row = K.words(data, offsets)
    return word, np.searchsorted(row, np.arange(len(offsets)))


BYTES = Unit(400, 64, np.uint8, lambda data, offsets: (data, offsets))
WORDS = Unit(51, 8, np.uint64, _words)
SHARED = Unit(25, 8, np.uint64, _words, True)
#: End of a range that takes in the whole text.
END = (1 << 31) - 1
#: Contexts of one bucket that a task compares at once; larger buckets are refined first.
BUCKET = 2048
#: A larger bucket's starts are cut into runs of these lengths in turn.
WIDTHS = (48, 7, 1)
#: Bytes of contexts that a task compares at once, besides the last bucket.
CHUNK = 2 << 20
#: Bytes of texts that a task scans at once; the scan keeps some twenty arrays of as many 64-bit numbers.
SLICE = 1 << 20


def anchors(data: np.ndarray, offsets: np.ndarray, span: int = BYTES.span, gram: int = BYTES.gram, prefix: K.Prefix | None = None):
    """Places of the anchors, first and last starts of the strings that they stand for, rows and gram hashes."""
    z = np.zeros(0, np.int64)
    w = span - gram + 1
    n = len(data) - gram + 1
    if len(data) < span:
        return z, z, z, z, z.astype(K.U64)
    prefix = prefix or K.Prefix(data)
    at = np.arange(n)
    g = K.mix(prefix.raw(at, at + gram))
    blocks = -(-(n + w) // w)
    key = np.full(blocks * w, np.iinfo(np.uint64).max, K.U64)
    low = K.U64((1 << 10) - 1)
    key[:n] = (g & ~low) | (at % w).astype(K.U64)
    grid = key.reshape(blocks, w)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.arange(len(data) - span + 1)
    row = np.searchsorted(offsets, starts, "right") - 1
    starts = starts[starts + span <= offsets[row + 1]]
    if not len(starts):
        return z, z, z, z, z.astype(K.U64)
    left, right = tail[starts], head[starts + w - 1]
    take = (left & ~low) <= (right & ~low)
    base = np.where(take, starts // w, (starts + w - 1) // w) * w
    place = base + np.where(take, left, right).astype(np.int64) % 1024
    row = np.searchsorted(offsets, starts, "right") - 1
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return place[first], starts[first], starts[last], row[first], g[place[first]]


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _run_hash(prefix: K.Prefix, start: np.ndarray, end: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Identifier of bytes around an anchor, with the anchor's offset in them."""
    return prefix.spans(start, end) + K.mix(offset.astype(K.U64) + K.U64(1))


def _scan(unit: Unit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, data, offsets in K.text_slices(batch.column(2), SLICE):
                data, offsets = unit.of(data, offsets)
                prefix = K.Prefix(data)
                place, first, last, row, gram = anchors(data, offsets, unit.span, unit.gram, prefix)
                begin = offsets[row]
                take = pa.array(row + i)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(take), batch.column(1).take(take), pa.array((place - begin).astype(np.int32)), pa.array((first - begin).astype(np.int32)),
                        pa.array((last - begin).astype(np.int32)), signed(gram), signed(_run_hash(prefix, first, last + unit.span, place - first)),
                    ],
                    names=["id", "h", "place", "first", "last", "bucket", "context"],
                )

    return run


def _binary(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """Parts of an array of units, as binary values."""
    ends = np.cumsum(size)
    index = np.repeat(start - (ends - size), size) + np.arange(ends[-1])
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer((np.concatenate(([0], ends)) * data.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[index]))])


def _units(column: pa.Array, unit: Unit) -> tuple[np.ndarray, np.ndarray]:
    """All units of a column made by _binary(), and where each value begins."""
    (_, _, data, offsets), = K.text_slices(column, 1 << 40)
    size = np.dtype(unit.kind).itemsize
    return np.ascontiguousarray(data).view(unit.kind), offsets // size


def _contexts(unit: Unit):
    """Rows (id, h, runs, text) to one row per run with its units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            for i, j, data, offsets in K.text_slices(batch.column(3)):
                data, offsets = unit.of(data, offsets)
                part = lists.slice(i, j - i)
                row = np.repeat(np.arange(j - i), np.diff(part.offsets.to_numpy()))
                own = part.flatten()
                place, first, last = (own.field(k).to_numpy() for k in ("place", "first", "last"))
                start, size = offsets[row] + first, (last - first + unit.span).astype(np.int64)
                for lo in range(0, len(row), 4096):
                    to = lo + 4096
                    where = pa.array(row[lo:to] + i)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(where), batch.column(1).take(where), pa.array(place[lo:to]), pa.array(first[lo:to]), pa.array(last[lo:to]), own.field("bucket")[lo:to], _binary(data, start[lo:to], size[lo:to])],
                        names=["id", "h", "place", "first", "last", "bucket", "bytes"],
                    )

    return run


def _refine(width: int, unit: Unit):
    """Cuts runs into runs of up to width starts, aligned by their offset from the anchor, in buckets of their common units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 1024):
                batch = whole.slice(low, 1024)
                if not batch.num_rows:
                    continue
                place, first, last, bucket = (batch.column(k).to_numpy() for k in (2, 3, 4, 5))
                data, offsets = _units(batch.column(6), unit)
                prefix = K.Prefix(data)
                a, b = (place - last) // width, (place - first) // width  # the offsets' cells
                n = b - a + 1
                row = np.repeat(np.arange(len(n)), n)
                cell = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + a[row]
                new_first = np.maximum(first[row], place[row] - cell * width - width + 1)
                new_last = np.minimum(last[row], place[row] - cell * width)
                begin = offsets[row] - first[row]
                # units that each string of the cell holds, so any run of it has them all
                core = begin + place[row] - cell * width
                common = _run_hash(prefix, core, core - width + 1 + unit.span, cell)
                new_bucket = K.mix(common + K.mix(bucket[row].view(K.U64)))
                where = pa.array(row)
                bytes_ = _binary(data, begin + new_first, (new_last - new_first + unit.span).astype(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(where), batch.column(1).take(where), pa.array(place[row]), pa.array(new_first.astype(np.int32)), pa.array(new_last.astype(np.int32)), signed(new_bucket), bytes_], names=batch.schema.names)

    return run


def _documents(table: pa.Table) -> np.ndarray:
    """Numbers of the rows' documents."""
    ids, h = table["id"], table["h"].to_numpy()
    pairs = np.stack([ids.is_valid().to_numpy().astype(np.int64), ids.fill_null(0).to_numpy(), h])
    return np.unique(pairs, axis=1, return_inverse=True)[1].ravel()


def _ranges(table: pa.Table, unit: Unit) -> pa.RecordBatch:
    """(id, h, start, end) of the strings that stand twice in their buckets (in two documents, if asked), neighbours as one range."""
    place, first, last, bucket = (table[k].to_numpy() for k in ("place", "first", "last", "bucket"))
    data, offsets = _units(table["bytes"].combine_chunks(), unit)
    prefix = K.Prefix(data)
    n = last - first + 1
    row = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = offsets[row] + step
    key = _run_hash(prefix, start, start + unit.span, place[row] - first[row] - step) + K.mix(bucket[row].view(K.U64))
    _, code, count = np.unique(K.mix(key), return_inverse=True, return_counts=True)
    twice = count[code] > 1
    if unit.apart:
        doc = _documents(table)[row]
        low, high = np.full(len(count), np.iinfo(np.int64).max), np.full(len(count), -1)
        np.minimum.at(low, code, doc)
        np.maximum.at(high, code, doc)
        twice = (low < high)[code]
    twice = np.flatnonzero(twice)
    new = np.ones(len(twice), bool)
    new[1:] = (twice[1:] != twice[:-1] + 1) | (row[twice[1:]] != row[twice[:-1]])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(twice))[: len(head)] - 1
    where = row[twice[head]]
    take = pa.array(where)
    begin = first[where] + step[twice[head]]
    end = first[where] + step[twice[tail]] + unit.span
    return pa.RecordBatch.from_arrays([table["id"].take(take).combine_chunks(), table["h"].take(take).combine_chunks(), pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32))], names=["id", "h", "start", "end"])


def _compare(unit: Unit):
    """Whole buckets of rows sorted by bucket, a few MB at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        each = 2 * unit.span * np.dtype(unit.kind).itemsize
        for whole in batches:
            for low in range(0, whole.num_rows, 512):
                batch = whole.slice(low, 512)
                held.append(batch)
                size += batch.num_rows * each
                if size < CHUNK:
                    continue
                table = pa.Table.from_batches(held).combine_chunks()
                bucket = table["bucket"].to_numpy()
                edge = int(np.searchsorted(bucket, bucket[-1], "left"))
                if edge:
                    yield _ranges(table.slice(0, edge), unit)
                    table = table.slice(edge).combine_chunks()
                held, size = table.to_batches(), table.num_rows * each
        if held:
            yield _ranges(pa.Table.from_batches(held).combine_chunks(), unit)

    return run


RUNS = "id long, h long, place int, first int, last int, bucket long"


def repeated_ranges(docs: DataFrame, unit: Unit = BYTES) -> DataFrame:
    """(id, h, start, end): ranges of units of rows (id, h, text) that repeat; they may overlap. Rows of equal id and h have equal texts."""
    runs = stored(docs.select("id", "h", "text").mapInArrow(_scan(unit), f"{RUNS}, context long"))
    # counted first, so that the rows of large buckets and of frequent contexts stay where they are
    busy = stored(runs.groupBy("bucket").agg(F.count("*").alias("_n")).where("_n > 1"))
    shared = stored(join_counted(runs, busy, ["bucket"], "_n", runs.count()).select(runs.columns))
    discard(runs, busy)
    run = F.struct("id", "h", "place", "first", "last")
    kinds = stored(shared.groupBy("bucket", "context").agg(F.count("*").alias("_n"), F.min(run).alias("_one"), F.max(run).alias("_last")))
    release(docs.sparkSession)
    two = F.lit(True) if not unit.apart else ~(F.col("_one.id").eqNullSafe(F.col("_last.id")) & (F.col("_one.h") == F.col("_last.h")))
    repeated = kinds.where((F.col("_n") > 1) & two)
    whole = join_counted(shared, repeated.select("bucket", "context", "_n"), ["bucket", "context"], "_n", shared.count())
    end = (F.col("last") + unit.span).alias("end")
    found = [whole.select("id", "h", F.col("first").alias("start"), end)]
    of_bucket = kinds.groupBy("bucket").agg(F.count("*").alias("_kinds"), F.min("_one").alias("_one"), F.max("_last").alias("_last"))
    several = stored(of_bucket.where((F.col("_kinds") > 1) & two).select("bucket"))
    met = kinds.join(several, "bucket")
    if unit.apart:
        # one document's contexts with all their places; of the others, a place in two documents
        ends = met.where(two).select(F.explode(F.array("_one", "_last")).alias("_one"), "bucket").select("_one.*", "bucket")
        single = shared.join(met.where(~two).select("bucket", "context"), ["bucket", "context"], "left_semi").select(ends.columns)
        # rows of equal id and text hold the same runs
        runs_of = ends.unionByName(single).groupBy("id", "h").agg(F.collect_set(F.struct("place", "first", "last", "bucket")).alias("runs"))
    else:
        runs_of = met.select("_one.*", "bucket").groupBy("id", "h").agg(F.collect_list(F.struct("place", "first", "last", "bucket")).alias("runs"))
    per_doc = stored(runs_of)
    # only the texts that have such runs are shuffled
    texts = docs.select(F.col("id").alias("_i"), F.col("h").alias("_h"), "text")
    met = per_doc.join(texts, F.col("id").eqNullSafe(F.col("_i")) & (F.col("h") == F.col("_h"))).select("id", "h", "runs", "text")
    rows = stored(met.mapInArrow(_contexts(unit), f"{RUNS}, bytes binary"))
    tables = [shared, kinds, several, per_doc, rows]
    release(docs.sparkSession)
    sizes = durable(rows.groupBy("bucket").agg(F.count("*").alias("_n")).where(F.col("_n") > BUCKET).select("bucket"))
    for width in (*(w for w in WIDTHS if w < unit.span), 0):
        large = None
        if not sizes.isEmpty():
            large = rows.join(sizes, "bucket", "left_semi").select(rows.columns)
            rows = rows.join(sizes, "bucket", "left_anti").select(rows.columns)
        if width == 0 and large is not None:
            # runs of one string in buckets of equal strings
            if unit.apart:
                held = large.groupBy("bucket").agg(F.min(F.struct("id", "h")).alias("_one"), F.max(F.struct("id", "h")).alias("_last"))
                large = large.join(held.where(two).select("bucket"), "bucket", "left_semi").select(large.columns)
            found.append(large.select("id", "h", F.col("first").alias("start"), end))
        found.append(rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_compare(unit), "id long, h long, start int, end int"))
        if large is None or width == 0:
            break
        rows = stored(large.mapInArrow(_refine(width, unit), f"{RUNS}, bytes binary"))
        tables.append(rows)
        sizes = durable(rows.groupBy("bucket").agg(F.count("*").alias("_n")).where(F.col("_n") > BUCKET).select("bucket"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    out = stored(out)
    discard(*tables)
    release(docs.sparkSession)
    return out


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges that overlap or touch as one."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order]) if len(end) else end
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    return start[heads], reach[np.append(heads[1:], len(start))[: len(heads)] - 1]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, spans = batch.column(1), batch.column(2)
        size, gone, count, passages, common, kept = [], [], [], [], [], []
        for i in range(batch.num_rows):
            text = texts[i].as_buffer()
            raw = memoryview(text) if text is not None else b""
            size.append(len(raw))
            if not spans[i].is_valid:
                gone.append(0)
                count.append(0)
                passages.append(0)
                common.append(0)
                kept.append(bytes(raw))
                continue
            ranges = spans[i].values
            start, end, unit = (ranges.field(k).to_numpy() for k in range(3))
            passages.append(len(_merged(start[unit == 1], end[unit == 1])[0]))
            s, e = _merged(start[unit == 2], end[unit == 2])
            if len(e) and e[-1] == END:
                words = len(_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0])
                e = np.array([words if words >= SHARED.span else 0])
            common.append(int((e - s).sum()))
            s, e = _merged(start[unit == 0], end[unit == 0])
            gone.append(int((e - s).sum()))
            count.append(len(s))
            kept.append(b"".join(raw[a:b] for a, b in zip([0, *e.tolist()], [*s.tolist(), len(raw)])))
        numbers = [pa.array(x, pa.int64()) for x in (size, gone, count, passages, common)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, pa.array(kept, pa.binary())], names=["id", "n_bytes", "n_removed", "n_spans", "n_passages", "n_shared_words", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, n_passages, n_shared_words, kept) per row; kept holds the remaining bytes.

    n_passages counts repeated passages of over 50 words, n_shared_words the words in strings of 25 that start in another row too.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    found = [repeated_ranges(rows, unit).withColumn("unit", F.lit(k)) for k, unit in enumerate((BYTES, WORDS, SHARED))]
    # rows of equal id and text can't be told apart: they share all their words
    twins = rows.groupBy("id", "h").count().where("count > 1").select("id", "h", F.lit(0).alias("start"), F.lit(END).alias("end"), F.lit(2).alias("unit"))
    spans = found[0].unionByName(found[1]).unionByName(found[2]).unionByName(twins).groupBy("id", "h").agg(F.collect_set(F.struct("start", "end", "unit")).alias("spans"))
    spans = spans.select(F.col("id").alias("_i"), F.col("h").alias("_h"), "spans")
    met = rows.join(spans, F.col("id").eqNullSafe(F.col("_i")) & (F.col("h") == F.col("_h")), "left").select("id", "text", "spans")
    return met.mapInArrow(_remove, "id long, n_bytes long, n_removed long, n_spans long, n_passages long, n_shared_words long, kept binary")
