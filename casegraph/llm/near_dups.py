"""MinHash near-dedup of documents by a signature-coordinate inverted join.

A document's set is its distinct shingles of SHINGLE words (between ASCII
blanks, A-Z in lower case); fewer words are one shingle. Signatures have COORDS
minima; candidates agree on shared_at(percent) or more. The number that agree is
binomial, so a pair at the threshold itself is missed with a probability of at
most MISSED, a closer one less. Links are confirmed on the full sets.

Null, empty and blank texts have empty sets and are linked with nothing. Rows
without an id are left out; rows that share an id are one document. A component's
name is its smallest id, so ties can't arise. Very long texts are slices of their
own. Other columns take no part, whatever their names. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casegraph.llm import kernels as K
from casegraph.llm.linking import components

SHINGLE = 5
COORDS = 64
PERCENT = 85
#: Probability at most of missing a pair whose similarity is the threshold itself.
MISSED = 1e-5


def shared_at(percent: int, coords: int = COORDS) -> int:
    """Coordinates that candidates must share: 41 of 64 at 85 percent, 36 at 80."""
    p, below = percent / 100, 0.0
    for k in range(coords):
        below += comb(coords, k) * p**k * (1 - p) ** (coords - k)
        if below > MISSED:
            return max(k, 1)
    return coords


def hash_family(k: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(1729).integers(0, 1 << 32, (2, k), dtype=np.uint64).astype(np.uint32)
    return draw[0] | np.uint32(1), draw[1]


def minima(h: np.ndarray, begin: np.ndarray, k: int) -> np.ndarray:
    """(sets, k) minima of the sets that begin at these places of h."""
    a, b = hash_family(k)
    low = (h >> K.U64(32)).astype(np.uint32)
    out = np.empty((len(begin), k), np.uint32)
    for i in range(k):
        out[:, i] = np.minimum.reduceat(low * a[i] + b[i], begin)
    return out


def set_hashes(h: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set, from sums of its elements' hashes."""
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.add.reduceat(K.mix(h * m), begin).view(np.int64) for m in (K._M1, K._M2))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, coords: int = COORDS) -> DataFrame:
    """(id, n, h1, h2, keys) of each row with an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, j, data, offsets in K.text_slices(batch.column(1)):
                word, _, _, row = K.words(data, offsets)
                row, h = K.shingles(word, row, j - i, shingle)
                n = np.bincount(row, minlength=j - i)
                at = np.flatnonzero(n)
                begin = (np.cumsum(n) - n)[at]
                h1, h2 = np.zeros(j - i, np.int64), np.zeros(j - i, np.int64)
                keys = np.zeros((len(at), coords), np.uint32)
                if len(at):
                    h1[at], h2[at] = set_hashes(h, begin)
                    keys = minima(h, begin, coords)
                starts = np.concatenate(([0], np.cumsum((n > 0) * coords))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(starts), pa.array(keys.ravel().view(np.int32)))
                yield pa.RecordBatch.from_arrays([ids[i:j], pa.array(n), pa.array(h1), pa.array(h2), lists], names=["id", "n", "h1", "h2", "keys"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("_text")).where("id is not null")
    return rows.mapInArrow(run, "id long, n long, h1 long, h2 long, keys array<int>")


def shingle_sets(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, set) of the documents whose ids are in ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in K.text_slices(batch.column(1)):
                word, _, _, row = K.words(data, offsets)
                row, h = K.shingles(word, row, j - i, shingle)
                at = np.searchsorted(row, np.arange(j - i + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.ListArray.from_arrays(pa.array(at), pa.array(h.view(np.int64)))], names=["id", "set"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("_text"))
    return rows.join(ids, "id", "left_semi").mapInArrow(run, "id long, set array<long>")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, min_shared: int | None = None) -> DataFrame:
    """(id, n, component): one row per row of docs; the component is the smallest id reachable over links."""
    return components(signatures(docs, id_col, text_col), lambda ids: shingle_sets(docs, ids, id_col, text_col), min_shared or shared_at(percent), percent)


#: DuckDB SQL for the query op5: all pairs that share a shingle, counted, then reachability.
SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
s as (
  select doc_id, case when len(ws) >= 5 then list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))
    when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end as sh from w),
x as (select doc_id, unnest(sh) as g from s),
p as (select a.doc_id as a, b.doc_id as b, count(*) as k from x a join x b on a.g = b.g and a.doc_id < b.doc_id group by all),
l as (select a, b from p join s sa on sa.doc_id = a join s sb on sb.doc_id = b where 100 * k >= 85 * (len(sa.sh) + len(sb.sh) - k)),
e as (select a as x, b as y from l union all select b, a from l),
r(id, other) as (select doc_id, doc_id from documents union select r.id, e.y from r join e on e.x = r.other),
c as (select id, min(other) as component_id from r group by id)
select doc_id, len(sh)::bigint as n_shingles, component_id, doc_id = component_id as kept from s join c on c.id = doc_id
"""
