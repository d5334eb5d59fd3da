"""Token counts: batch encoding in Arrow functions that return lengths only.

A text is split at boundaries that no token crosses (the matches of the
tokenizer's own pattern); equal pieces are encoded once in a worker, in batches
balanced by bytes, and the pieces' lengths are summed per document. Vocabularies
whose pieces aren't known to be independent are encoded text by text.

Null and empty texts count 0 tokens. Rows and ids are kept as they are: a
repeated id gives repeated rows, an empty table an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casegraph.llm import kernels as K
from casegraph.llm.pieces import MOST_PIECES, PieceTable, worker_cache

#: Bytes of text in one call of the library.
BATCH_BYTES = 1 << 18


def balanced(texts: list[str], limit: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Batches of about the same number of bytes; one longer text is a batch of its own."""
    batch: list[str] = []
    size = 0
    for text in texts:
        if batch and size + len(text) > limit:
            yield batch
            batch, size = [], 0
        batch.append(text)
        size += len(text) + 16
    if batch:
        yield batch


class _Json:
    """A tokenizers file. Pieces are independent if its pre-tokenizer is the byte-level one without normaliser."""

    def __init__(self, raw: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(raw.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(raw)
        pre = spec.get("pre_tokenizer") or {}
        model = spec.get("model") or {}
        self.pieces = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and not spec.get("normalizer") and model.get("type") == "BPE" and not model.get("dropout")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        )
        self.special = [t["content"].encode() for t in spec["added_tokens"]]

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(e) for b in balanced(texts) for e in self.tokenizer.encode_batch_fast(b, add_special_tokens=False)]


class _Piece:
    """A sentencepiece model; texts are encoded whole."""

    def __init__(self, raw: bytes) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.pieces = False
        self.special: list[bytes] = []

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(e) for b in balanced(texts) for e in self.model.encode(b, num_threads=1)]


class _Counter:
    def __init__(self, raw: bytes, is_json: bool) -> None:
        self.encoder = _Json(raw) if is_json else _Piece(raw)
        self.table = PieceTable()
        self.lengths = np.zeros(0, np.int64)

    def count(self, column: pa.Array) -> np.ndarray:
        out = [np.zeros(0, np.int64)]
        for _, _, data, offsets in K.text_slices(column):
            rows = len(offsets) - 1
            whole = np.zeros(rows, bool)
            if not self.encoder.pieces:
                whole[:] = True
            else:
                text = data.tobytes()
                for special in self.encoder.special:
                    at = text.find(special)
                    while at >= 0:
                        whole[np.searchsorted(offsets, at, "right") - 1] = True
                        at = text.find(special, at + 1)
            n = np.zeros(rows, np.int64)
            if not whole.all():
                n += self._pieces(data, offsets, ~whole)
            if whole.any():
                at = np.flatnonzero(whole)
                n[at] = self.encoder.lengths([data[offsets[i] : offsets[i + 1]].tobytes().decode(errors="replace") for i in at])
            out.append(n)
        return np.concatenate(out)

    def _pieces(self, data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        start, end, row = K.pretokens(data, offsets)
        if not wanted.all():
            keep = wanted[row]
            start, end, row = start[keep], end[keep], row[keep]
        hashes = K.Prefix(data).spans(start, end)
        if len(self.table) > MOST_PIECES:
            self.table.clear()
            self.lengths = np.zeros(0, np.int64)
        inverse, at, first = self.table.find(hashes)
        new = np.flatnonzero(at < 0)
        if len(new):
            s, e = start[first[new]], end[first[new]]
            raw = data.tobytes()
            got = self.encoder.lengths([raw[a:b].decode(errors="replace") for a, b in zip(s.tolist(), e.tolist())])
            at[new] = len(self.lengths) + np.arange(len(new))
            self.lengths = np.concatenate((self.lengths, np.array(got, np.int64)))
            self.table.add(hashes[first[new]], at[new])
        return np.bincount(row, self.lengths[at][inverse], minlength=len(offsets) - 1).astype(np.int64)


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of each row's whole text, by the vocabulary file at path (.json or .model).

    The file is read by the driver and sent as a broadcast: vocabularies have a
    fixed size of a few MB. Other columns of docs, whatever their names, take
    no part.
    """
    with open(path, "rb") as f:
        raw = f.read()
    key = ("token counts", hashlib.sha256(raw).hexdigest())
    sent = docs.sparkSession.sparkContext.broadcast(raw)
    is_json = path.endswith(".json")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_cache(key, lambda: _Counter(sent.value, is_json))
        for batch in batches:
            text = batch.column(1)
            size = pa.array(np.asarray(pa.compute.fill_null(pa.compute.binary_length(text), 0)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(counter.count(text))], names=[id_col, "n_bytes", "n_tokens"])

    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(count, f"`{id_col}` {kind}, n_bytes long, n_tokens long")


def over_limit(counts: DataFrame, limit: int = 512) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
