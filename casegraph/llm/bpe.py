"""Byte-level BPE: encoding and decoding with recursive DuckDB queries in each partition.

Encoding. A text is cut into the matches of the vocabulary's pattern. The
distinct pieces that a worker hasn't met yet go to DuckDB as rows of (piece,
position, token), first one row per byte. A recursive query joins neighbouring
tokens with the merge table, takes each piece's smallest rank, contracts its
leftmost pair of that rank, and goes on until no pair of a piece merges. A piece
that is a token as a whole is that token.

A piece of more than LONG bytes is cut into chunks that are encoded as pieces of
their own, and the seams are mended. Two neighbouring tokens agree if their bytes
together encode to just these two. A sequence is the encoding of its bytes if and
only if all neighbours agree: until a merge crosses a border between two final
tokens, the bytes on both sides merge as if they stood alone, so the first merge
to cross would cross there for these two tokens alone as well. So only seams are
looked at, and where tokens disagree the bytes of some tokens on both sides are
encoded anew as one chunk, of more and more tokens, until all seams agree.

Decoding. Token ids with positions join the vocabulary, and an ordered
aggregation puts the bytes of each sequence together. Encoded rows carry where
their pieces end, so that equal pieces are decoded once in a worker.

The recursion runs STEPS rounds per query, and what isn't settled goes on in the
next, so the rows that a recursive query keeps stay few. Tables of pieces are
caches of bounded size. DuckDB's memory is limited and it may not spill to a
worker's folder; a query that needs more is cut in two. Null and empty texts have
no tokens. Very long texts are slices of their own. Repeated rows and ids, null
ids among them, are kept; ties of rank go to the leftmost pair; empty tables give
empty results; columns of other names take no part.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casegraph.llm import kernels as K
from casegraph.llm.pieces import MOST_PIECES, PieceTable, worker_cache

STEPS = 24
#: Bytes from which a piece is cut into chunks, and tokens on each side of a seam that are encoded anew at first.
LONG, SIDE = 48, 4
#: Rows of (piece, position) in one query.
QUERY_ROWS = 60_000

_ROUND = """
with recursive state(piece, pos, token, step) as (
  select piece, pos, token, 0 from seed
  union all
  select piece, pos, case when pos = hit then best else token end, step + 1 from (
    select piece, pos, token, step, before, key >> 32 as best, key & 4294967295 as hit from (
      select s.piece, s.pos, s.token, s.step, s.before, min((m.rank << 32) | s.pos) over (partition by s.piece) as key from (
        select piece, pos, token, step, lead(token) over w as next, lag(pos) over w as before
        from state where step < {steps} window w as (partition by piece order by pos)) s
      left join merges m on m.first = s.token and m.second = s.next)
    where key is not null)
  where before is distinct from hit
)
"""
#: The rows of each piece's last round, and whether it may go on.
_LAST = """
select s.piece, s.pos, s.token::int as token, s.step = {steps} as open
from state s join (select piece, max(step) as step from state group by piece) l using (piece, step) order by 1, 2
"""
_DECODE = """
select seq, string_agg(v.bytes, '' order by pos) as hex from ids join vocabulary v on v.token = ids.token group by seq order by seq
"""


def load_ranks(raw: bytes) -> dict[bytes, int]:
    """The ranks of a .tiktoken file's lines."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}


class Codec:
    """The pieces met so far, and one DuckDB connection with the merge table or the vocabulary, whichever is used first."""

    def __init__(self, raw: bytes) -> None:
        self.raw = raw
        self.tables: set[str] = set()
        self.table = PieceTable()
        self.start, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)
        self.text_table = PieceTable()
        self.text_start, self.text_flat = np.zeros(1, np.int64), np.zeros(0, np.uint8)

    def _need(self, name: str) -> None:
        if name in self.tables:
            return
        if not self.tables:
            import duckdb

            self.db = duckdb.connect(config={"threads": 1, "memory_limit": "160MB", "temp_directory": ""})
        ranks = load_ranks(self.raw)
        if name == "merges":
            self.ranks = ranks
            self.byte_token = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
            self.token_bytes = {r: t for t, r in ranks.items()}
            parts = ((ranks.get(t[:i]), ranks.get(t[i:]), r) for t, r in ranks.items() for i in range(1, len(t)))
            merges = np.array([x for x in parts if x[0] is not None and x[1] is not None], np.int64).reshape(-1, 3)
            made = pa.table({"first": merges[:, 0], "second": merges[:, 1], "rank": merges[:, 2]})
        else:
            made = pa.table({"token": pa.array(list(ranks.values()), pa.int32()), "bytes": [t.hex() for t in ranks]})
        self.db.register("made", made)
        self.db.execute(f"create table {name} as select * from made")
        self.db.unregister("made")
        self.tables.add(name)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        self._need("merges")
        out: list = [None] * len(pieces)
        short, long = [], []
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = np.array([whole], np.int32)
            else:
                (long if len(piece) > LONG else short).append(i)
        for i, ids in zip(short, self._merge([pieces[i] for i in short])):
            out[i] = ids
        for i, ids in zip(long, self._mend([pieces[i] for i in long])):
            out[i] = ids
        return out

    def _mend(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of long pieces, by chunks whose seams are mended."""
        chunks = [[p[a : a + LONG] for a in range(0, len(p), LONG)] for p in pieces]
        flat = iter(self._merge([c for cs in chunks for c in cs]))
        ids, seams = [], []
        for cs in chunks:
            parts = [next(flat) for _ in cs]
            ids.append(np.concatenate(parts))
            seams.append(np.cumsum([len(x) for x in parts])[:-1])
        agreed: dict[tuple[int, int], bool] = {}
        side = SIDE
        while any(len(x) for x in seams):
            pairs = {(int(t[s - 1]), int(t[s])) for t, x in zip(ids, seams) for s in x} - agreed.keys()
            asked = sorted(pairs)
            for pair, got in zip(asked, self._merge([self.token_bytes[a] + self.token_bytes[b] for a, b in asked])):
                agreed[pair] = tuple(got.tolist()) == pair
            windows = []
            for k, (t, x) in enumerate(zip(ids, seams)):
                spans: list[list[int]] = []
                for s in x:
                    if agreed[int(t[s - 1]), int(t[s])]:
                        continue
                    low, high = max(0, s - side), min(len(t), s + side)
                    if spans and low <= spans[-1][1]:
                        spans[-1][1] = high
                    else:
                        spans.append([low, high])
                windows += [(k, a, b) for a, b in spans]
                seams[k] = np.zeros(0, np.int64)
            anew = self._merge([b"".join(self.token_bytes[i] for i in ids[k][a:b].tolist()) for k, a, b in windows])
            by_piece: dict[int, list] = {}
            for (k, a, b), new in zip(windows, anew):
                by_piece.setdefault(k, []).append((a, b, new))
            for k, changes in by_piece.items():
                t, parts, at, size, edges = ids[k], [], 0, 0, []
                for a, b, new in changes:
                    parts += [t[at:a], new]
                    edges += [size + a - at, size + a - at + len(new)]
                    size, at = edges[-1], b
                ids[k] = np.concatenate([*parts, t[at:]])
                seams[k] = np.array([e for e in edges if 0 < e < len(ids[k])], np.int64)
            side *= 2
        return ids

    def _merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece by contractions alone, QUERY_ROWS bytes at once."""
        out: list = [None] * len(pieces)
        at = 0
        while at < len(pieces):
            end, size = at, 0
            while end < len(pieces) and (end == at or size + len(pieces[end]) <= QUERY_ROWS):
                size += len(pieces[end])
                end += 1
            self._contract(pieces, at, end, out)
            at = end
        return out

    def _contract(self, pieces: list[bytes], low: int, high: int, out: list) -> None:
        import duckdb

        sizes = np.array([len(p) for p in pieces[low:high]])
        seed = pa.table({
            "piece": np.repeat(np.arange(low, high), sizes), "pos": np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes),
            "token": self.byte_token[np.frombuffer(b"".join(pieces[low:high]), np.uint8)],
        })
        steps = STEPS
        while seed.num_rows:
            self.db.register("seed", seed)
            try:
                got = self.db.execute((_ROUND + _LAST).format(steps=steps)).fetchnumpy()
            except duckdb.OutOfMemoryException:
                if high - low > 1:
                    for a, b in ((low, (low + high) // 2), ((low + high) // 2, high)):
                        self._contract(pieces, a, b, out)
                    return
                if steps == 1:
                    raise
                steps = max(1, steps // 4)
                continue
            finally:
                self.db.unregister("seed")
            # a piece that ran all rounds may have more to merge
            piece, token, still = got["piece"], got["token"], got["open"]
            done = ~still
            head = np.flatnonzero(np.append(True, piece[1:] != piece[:-1])) if len(piece) else np.zeros(0, int)
            for a, b in zip(head.tolist(), np.append(head[1:], len(piece)).tolist()):
                if done[a]:
                    out[piece[a]] = token[a:b].astype(np.int32)
            seed = pa.table({"piece": piece[still], "pos": got["pos"][still], "token": token[still].astype(np.int64)})

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of a slice of texts: ids, tokens per piece, tokens per text and pieces per text."""
        start, end, row = K.pretokens(data, offsets)
        rows = len(offsets) - 1
        hashes = K.Prefix(data).spans(start, end)
        if len(self.table) > MOST_PIECES:
            self.table.clear()
            self.start, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)
        code, at, first = self.table.find(hashes)
        new = np.flatnonzero(at < 0)
        if len(new):
            raw = data.tobytes()
            ids = self.encode_pieces([raw[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())])
            at[new] = len(self.start) - 1 + np.arange(len(new))
            self.start = np.concatenate((self.start, self.start[-1] + np.cumsum([len(x) for x in ids])))
            self.flat = np.concatenate([self.flat, *ids])
            self.table.add(hashes[first[new]], at[new])
        piece = at[code]
        return (*_gather(self.flat, self.start, piece), np.bincount(row, (self.start[piece + 1] - self.start[piece]), minlength=rows).astype(np.int64), np.bincount(row, minlength=rows))

    def decode_sequences(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """Bytes of each sequence of ids; sequences have one id at least."""
        self._need("vocabulary")
        out: list[bytes] = []
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            base = ends[at] - sizes[at]
            to = max(at + 1, int(np.searchsorted(ends, base + QUERY_ROWS, "right")))
            part = sizes[at:to]
            table = pa.table({"seq": np.repeat(np.arange(to - at), part), "pos": np.arange(part.sum()), "token": ids[base : ends[to - 1]]})
            self.db.register("ids", table)
            out += [bytes.fromhex(x) for (x,) in self.db.execute(f"select hex from ({_DECODE})").fetchall()]
            self.db.unregister("ids")
            at = to
        return out

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of consecutive sequences, end to end, and the number of bytes of each."""
        if not len(sizes):
            return np.zeros(0, np.uint8), np.zeros(0, np.int64)
        ends = np.cumsum(sizes)
        hashes = K.Prefix(ids.astype(np.uint64)).spans(ends - sizes, ends)
        if len(self.text_table) > MOST_PIECES:
            self.text_table.clear()
            self.text_start, self.text_flat = np.zeros(1, np.int64), np.zeros(0, np.uint8)
        code, at, first = self.text_table.find(hashes)
        new = np.flatnonzero(at < 0)
        if len(new):
            pick = first[new]
            own, own_sizes = _gather(ids, np.append(0, ends), pick)
            got = self.decode_sequences(own, own_sizes)
            at[new] = len(self.text_start) - 1 + np.arange(len(new))
            self.text_start = np.concatenate((self.text_start, self.text_start[-1] + np.cumsum([len(x) for x in got])))
            self.text_flat = np.concatenate((self.text_flat, np.frombuffer(b"".join(got), np.uint8)))
            self.text_table.add(hashes[pick], at[new])
        return _gather(self.text_flat, self.text_start, at[code])


def _gather(flat: np.ndarray, start: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The listed parts of flat end to end, and their sizes."""
    size = start[which + 1] - start[which]
    if not len(which):
        return flat[:0], size
    ends = np.cumsum(size)
    return flat[np.repeat(start[which] - (ends - size), size) + np.arange(ends[-1])], size


def _codec(sent, key: tuple) -> Codec:
    return worker_cache(key, lambda: Codec(sent.value))


def _sent(docs: DataFrame, path: str) -> tuple:
    """The vocabulary as a broadcast; its size is fixed (under 1 MB)."""
    with open(path, "rb") as f:
        raw = f.read()
    return docs.sparkSession.sparkContext.broadcast(raw), ("bpe", hashlib.sha256(raw).hexdigest())


def _cut(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Binary values of so many items each."""
    ends = np.concatenate(([0], np.cumsum(sizes))) * values.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, piece_sizes): ids as little-endian unsigned 32-bit integers, tokens per piece likewise."""
    sent, key = _sent(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent, key)
        for batch in batches:
            for i, j, data, offsets in K.text_slices(batch.column(1)):
                ids, sizes, tokens, pieces = codec.encode(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(tokens), _cut(ids.astype("<u4"), tokens), _cut(sizes.astype("<u4"), pieces)], names=[id_col, "n_tokens", "ids", "piece_sizes"])

    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    return source.mapInArrow(run, f"`{id_col}` {source.schema[0].dataType.simpleString()}, n_tokens long, ids binary, piece_sizes binary")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", out: str = "decoded") -> DataFrame:
    """(id, n_tokens, ids, out): encode() and decode() in one worker, so that a task holds one table of pieces."""
    sent, key = _sent(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent, key)
        for batch in batches:
            for i, j, data, offsets in K.text_slices(batch.column(1)):
                ids, sizes, tokens, pieces = codec.encode(data, offsets)
                text, lengths = codec.decode(ids.astype(np.int64), sizes.astype(np.int64))
                row = np.repeat(np.arange(j - i), pieces)
                size = np.bincount(row, lengths, minlength=j - i).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(tokens), _cut(ids.astype("<u4"), tokens), _cut(text, size)], names=[id_col, "n_tokens", "ids", out])

    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    return source.mapInArrow(run, f"`{id_col}` {source.schema[0].dataType.simpleString()}, n_tokens long, ids binary, `{out}` binary")


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", sizes_col: str | None = "piece_sizes", out: str = "decoded") -> DataFrame:
    """Adds the bytes of each row's ids. Without sizes_col each row is one sequence."""
    sent, key = _sent(encoded, path)
    at, sizes_at = encoded.columns.index(ids_col), encoded.columns.index(sizes_col) if sizes_col else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent, key)
        for whole in batches:
            # a few MB of ids at once
            ends = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(whole.column(at)), 0)))
            low = 0
            while low < whole.num_rows:
                to = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + (4 << 20), "right")))
                batch = whole.slice(low, to - low)
                low = to
                raw = [bytes(x.as_py() or b"") for x in batch.column(at)]
                ids = np.frombuffer(b"".join(raw), "<u4").astype(np.int64)
                count = np.array([len(x) // 4 for x in raw])
                sizes = count[count > 0]
                pieces = (count > 0).astype(np.int64)
                if sizes_at is not None:
                    own = [bytes(x.as_py() or b"") for x in batch.column(sizes_at)]
                    sizes, pieces = np.frombuffer(b"".join(own), "<u4").astype(np.int64), np.array([len(x) // 4 for x in own])
                text, lengths = codec.decode(ids, sizes)
                row = np.repeat(np.arange(len(raw)), pieces)
                yield pa.RecordBatch.from_arrays([*batch.columns, _cut(text, np.bincount(row, lengths, minlength=len(raw)).astype(np.int64))], names=[*batch.schema.names, out])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema] + [f"`{out}` binary"])
    return encoded.mapInArrow(run, schema)
