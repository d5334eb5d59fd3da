"""Benchmark decontamination: a BM25 index of test items, block-max pruning, overlap checks.

Words are runs of digits, letters and characters beyond ASCII, in lower case. Test
items are cut into entries of ENTRY words and indexed; an entry's weights are its
BM25 contributions over its own full score. Each training text is cut whole into
passages of PASSAGE words, every STRIDE words, and each passage is a query.

A word's postings lie in blocks of BLOCK neighbouring entries, each with its
largest weight. For all passages of a slice at once, the maxima of a passage's
words are added up by block, and only blocks whose bound reaches THRESHOLD go on.
There, common words, whose weights add up to half of THRESHOLD at most in any
entry, can't make a match alone (they are the lists left of the pivot): an entry
goes on only if its other words in the passage, with all its common ones, reach
THRESHOLD. What is left is scored exactly. Items with an entry at THRESHOLD or
above are candidates; no pruning loses one. The pivot is chosen once for the whole
index and not anew for each cursor: bounds of single words prune next to nothing
here (94 % of all passages keep a pivot), and cursors would be a Python loop.

A candidate is verified on the whole text: of the item's distinct shingles of
SHINGLE words SHARE or more must stand in it, and ANSWER_SHARE of those with a
word of the item's last sentence, which counts as the answer.

The index is sent as a broadcast of SHARD_BYTES of items at most; more items are
dealt by hash to several indexes with statistics of their own, which the documents
meet one after the other. Null and empty texts and items match nothing; items under
SHINGLE words are one shingle. Items that repeat an id are items of their own; a
pair is returned once per text. Very long texts are slices of their own, scanned
whole. Ties need no rule, since all pairs over the limits are returned. Other
columns take no part, whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casegraph.llm import kernels as K
from casegraph.llm.pieces import worker_cache

ENTRY, PASSAGE, STRIDE, BLOCK = 40, 64, 32, 32
K1, B = 1.2, 0.75
THRESHOLD = 0.4
SHINGLE = 5
SHARE, ANSWER_SHARE = 0.8, 0.5
SHARD_BYTES = 32 << 20
#: Sums of bounds that are kept as a dense array.
DENSE = 4 << 20

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = True
_WORD[128:] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, rows and first bytes of the words."""
    start, end, row = K.runs(_WORD[data], offsets)
    return K.Prefix(K.LOWER[data]).spans(start, end), row, start


class Index:
    """Entries' weights by word, their largest by block, and the items' shingles."""

    def __init__(self, ids: list[int], texts: list[str]) -> None:
        self.ids = np.array(ids, np.int64)
        entries, owner, self.shingles, self.answer = [], [], [], []
        for i, text in enumerate(texts):
            data = np.frombuffer(text.encode(), np.uint8)
            word, _, start = words(data, np.array([0, len(data)]))
            last = self._last_sentence(text.rstrip())
            self._shingles(word, start >= len(text.rstrip()[:last].encode()))
            for at in range(0, max(len(word) - ENTRY // 2, min(len(word), 1)), ENTRY):
                entries.append(word[at : at + ENTRY + (ENTRY // 2 if len(word) - at - ENTRY < ENTRY // 2 else 0)])
                owner.append(i)
        self.owner = np.array(owner, np.int64)
        n = len(entries)
        word = np.concatenate([*entries, np.zeros(0, np.uint64)])
        entry = np.repeat(np.arange(n), [len(x) for x in entries]) if n else np.zeros(0, np.int64)
        self.terms, term = np.unique(word, return_inverse=True)
        cell, tf = np.unique(term * max(n, 1) + entry, return_counts=True)
        term, entry = cell // max(n, 1), cell % max(n, 1)
        df = np.bincount(term, minlength=len(self.terms))
        size = np.array([len(x) for x in entries]) if n else np.zeros(0)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        score = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[entry] / max(size.mean(), 1) if n else 1))
        weight = score / np.bincount(entry, score, minlength=n)[entry] if n else score
        self.begin = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.entry, self.weight = entry, weight
        order = np.argsort(entry, kind="stable")
        self.of_entry, self.own_term, self.own_weight = entry[order], term[order], weight[order]
        # of each (word, block): the block, the largest weight and the postings, which are neighbours
        cell = term * (n // BLOCK + 1) + entry // BLOCK
        head = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.zeros(0, np.int64)
        self.block, self.from_, self.to = entry[head] // BLOCK, head, np.append(head[1:], len(cell))[: len(head)]
        self.most = np.maximum.reduceat(weight, head) if len(head) else weight
        self.block_begin = np.searchsorted(term[head], np.arange(len(self.terms) + 1))
        # words that no match needs: the most frequent ones, as long as no entry has too much of its score from them
        self.common, self.spare = np.zeros(len(self.terms), bool), np.zeros(n)
        for t in np.argsort(-df, kind="stable"):
            part = slice(self.begin[t], self.begin[t + 1])
            more = self.spare[entry[part]] + weight[part]
            if (more <= THRESHOLD / 2).all():
                self.common[t] = True
                self.spare[entry[part]] = more

    @staticmethod
    def _last_sentence(text: str) -> int:
        """Where the last sentence begins; 0 if there is but one."""
        at = max(text.rfind(m, 0, max(len(text) - 1, 0)) for m in (". ", "! ", "? ", ".\n", "!\n", "?\n", "\n"))
        return at + 1

    def _shingles(self, word: np.ndarray, in_answer: np.ndarray) -> None:
        row, h = np.zeros(len(word), np.int64), word
        width = min(SHINGLE, len(word))
        every = K.shingles(h, row, 1, SHINGLE)[1]
        ends = np.lib.stride_tricks.sliding_window_view(in_answer, width).any(1) if width else np.zeros(0, bool)
        own = [K.shingles(word[i : i + width], row[:width], 1, SHINGLE)[1][0] for i in np.flatnonzero(ends)]
        self.shingles.append(every)
        self.answer.append(np.unique(np.array(own, np.uint64)))

    def candidates(self, word: np.ndarray, row: np.ndarray, n_rows: int) -> list[tuple[int, int, float]]:
        """(row, item, best share of an entry's score) of one slice of texts."""
        if not len(word) or not len(self.terms):
            return []
        at = np.minimum(np.searchsorted(self.terms, word), len(self.terms) - 1)
        term = np.where(self.terms[at] == word, at, len(self.terms))
        count = np.bincount(row, minlength=n_rows)
        place = np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count)
        # each word is in the passage that begins in its stride and in the one before
        passages = np.maximum(-(-(count - (PASSAGE - STRIDE)) // STRIDE), (count > 0).astype(np.int64))
        base = np.cumsum(passages) - passages
        known = np.flatnonzero(term < len(self.terms))
        cell = place[known] // STRIDE
        pairs = []
        for back in range(PASSAGE // STRIDE):
            p = cell - back
            ok = (p >= 0) & (p < passages[row[known]])
            pairs.append((base[row[known[ok]]] + p[ok]) * len(self.terms) + term[known[ok]])
        pair = np.unique(np.concatenate(pairs))
        passage, own = pair // len(self.terms), pair % len(self.terms)
        # bounds of all blocks that the passages' words touch
        size = self.block_begin[own + 1] - self.block_begin[own]
        at = np.repeat(self.block_begin[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        blocks = len(self.owner) // BLOCK + 1
        key = np.repeat(passage, size) * blocks + self.block[at]
        if passages.sum() * blocks <= DENSE:
            total = np.bincount(key, self.most[at])[key]
        else:
            _, code = np.unique(key, return_inverse=True)
            total = np.bincount(code, self.most[at])[code]
        alive = (total >= THRESHOLD - 1e-9) & ~np.repeat(self.common[own], size)
        at, passage = at[alive], np.repeat(passage, size)[alive]
        # entries that their rare words and all their common ones can bring to the threshold
        size = self.to[at] - self.from_[at]
        post = np.repeat(self.from_[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        key, code = np.unique(np.repeat(passage, size) * len(self.owner) + self.entry[post], return_inverse=True)
        gained = np.bincount(code, self.weight[post], minlength=len(key))
        reach = gained + self.spare[key % len(self.owner)] >= THRESHOLD - 1e-9
        key = key[reach]
        best: dict[tuple[int, int], float] = {}
        first = np.cumsum(count) - count
        cuts = np.flatnonzero(np.append(True, np.diff(key // len(self.owner)) > 0)) if len(key) else []
        for lo, hi in zip(cuts, np.append(cuts[1:], len(key)).astype(int) if len(key) else []):
            q = int(key[lo]) // len(self.owner)
            r = int(np.searchsorted(base, q, "right")) - 1
            low = first[r] + (q - base[r]) * STRIDE
            own = np.unique(term[low : min(low + PASSAGE, first[r] + count[r])])
            for e in (key[lo:hi] % len(self.owner)).tolist():
                # the entry's own words, of which the passage holds some
                mine = slice(*np.searchsorted(self.of_entry, [e, e + 1]))
                full = float(self.own_weight[mine][np.isin(self.own_term[mine], own)].sum())
                if full >= THRESHOLD - 1e-9:
                    found = (r, int(self.owner[e]))
                    best[found] = max(best.get(found, 0.0), full)
        return [(r, i, s) for (r, i), s in best.items()]

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, float, float, float]]:
        """(row, item, score, overlap, answer overlap) of the verified pairs."""
        word, row, _ = words(data, offsets)
        found = self.candidates(word, row, len(offsets) - 1)
        out = []
        sets: dict[int, np.ndarray] = {}
        for r, i, s in found:
            if r not in sets:
                lo, hi = np.searchsorted(row, [r, r + 1])
                own = word[lo:hi]
                sets[r] = K.shingles(own, np.zeros(len(own), np.int64), 1, SHINGLE)[1]
            share = float(np.isin(self.shingles[i], sets[r]).mean())
            answer = float(np.isin(self.answer[i], sets[r]).mean()) if len(self.answer[i]) else 1.0
            if share >= SHARE and answer >= ANSWER_SHARE:
                out.append((r, i, s, share, answer))
        return out


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item_id, score, overlap, answer_overlap): the verified pairs of documents and test items."""
    known = items.select(F.col(item_id).cast("long").alias("i"), F.lower(F.col(item_text).cast("string")).alias("t")).where("i is not null and t is not null").distinct()
    size = known.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    out = None
    for shard in range(shards):
        part = known if shards == 1 else known.where(F.pmod(F.xxhash64("i", "t"), F.lit(shards)) == shard)
        found = _contaminated(docs, part, id_col, text_col)
        out = found if out is None else out.unionByName(found)
    return out


def _contaminated(docs: DataFrame, known: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = known.orderBy("i", "t").collect()
    sent = docs.sparkSession.sparkContext.broadcast(([r.i for r in rows], [r.t for r in rows]))
    key = ("test items", hash(tuple((r.i, r.t) for r in rows)), sent._jbroadcast.id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = worker_cache(key, lambda: Index(*sent.value))
        for batch in batches:
            ids = batch.column(0)
            for i, _, data, offsets in K.text_slices(batch.column(1)):
                found = index.scan(data, offsets)
                if found:
                    r, item, s, share, answer = (np.array(x) for x in zip(*found))
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(r + i)), pa.array(index.ids[item]), pa.array(s), pa.array(share), pa.array(answer)], names=[id_col, "item_id", "score", "overlap", "answer_overlap"])

    source = docs.select(F.col(id_col), F.lower(F.col(text_col).cast("string")).alias("_text"))
    return source.mapInArrow(run, f"`{id_col}` {source.schema[0].dataType.simpleString()}, item_id long, score double, overlap double, answer_overlap double")
