"""Vectorised text kernels on Arrow string columns.

Everything here works on the UTF-8 bytes of a whole slice of documents at once,
with numpy, so that no Python statement runs once per word or byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; one longer document is a slice of its own.
SLICE_BYTES = 2 << 20

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)

#: ASCII blank characters: space and U+0009 to U+000D.
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit hashes."""
    h = (h ^ (h >> U64(30))) * _M1
    h = (h ^ (h >> U64(27))) * _M2
    return h ^ (h >> U64(31))


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64, for i up to n."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n + 1, U64(b))
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    return _powers(size, base)


class Prefix:
    """Hashes of any span of a byte array, from one running sum."""

    def __init__(self, data: np.ndarray, base: int = _BASE) -> None:
        up, self.down = powers(len(data), base)
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=self.sums[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end) + (end - start).astype(U64) * _M2)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of each row and the end); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, j, raw[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the runs of True; a run never crosses rows."""
    n = len(mask)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    first = np.zeros(n + 1, bool)
    first[offsets] = True  # a row begins here
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = mask[:-1]
    start = np.flatnonzero(mask & (~before | first[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = mask[1:]
    end = np.flatnonzero(mask & (~after | first[1:])) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts, ends and rows of the words between ASCII blanks."""
    start, end, row = runs(~BLANK[data], offsets)
    return Prefix(LOWER[data] if lower else data).spans(start, end), start, end, row


def shingles(word: np.ndarray, row: np.ndarray, n_rows: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hash) of each row's k-word shingles, sorted; a row of fewer words gives one shingle of them all."""
    count = np.bincount(row, minlength=n_rows)
    begin = np.concatenate(([0], np.cumsum(count)))[:-1]
    mult = powers(k + 1, 0xD6E8FEB86659FD93)[0]
    width = np.minimum(count, k)
    n_out = np.maximum(count - k + 1, np.minimum(count, 1))
    out_row = np.repeat(np.arange(n_rows), n_out)
    at = np.arange(len(out_row)) - np.repeat(np.cumsum(n_out) - n_out, n_out) + begin[out_row]
    h = width[out_row].astype(U64) * _M1
    for i in range(k):
        inside = i < width[out_row]
        if inside.all():
            h = h + word[at + i] * mult[i + 1]
        else:
            h = h + np.where(inside, word[np.minimum(at + i, max(len(word) - 1, 0))] * mult[i + 1], U64(0))
    h = mix(h)
    order = np.lexsort((h, out_row))
    out_row, h = out_row[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (out_row[1:] != out_row[:-1])
    return out_row[keep], h[keep]


#: Character classes of the pre-tokenising pattern.
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of each code point."""
    import regex

    out = np.zeros(0x110000, np.uint8)
    text = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, text):
            lo, hi = ord(text[m.start()]), ord(text[m.end() - 1])
            out[lo : hi + 1] = kind
    out[0xD800:0xE000] = OTHER
    return out


def byte_classes(data: np.ndarray) -> np.ndarray:
    """For each byte the class of the character that it belongs to."""
    table = classes()
    out = table[:128][np.minimum(data, 127)]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        b = data[lead].astype(np.int32)
        at = [np.minimum(lead + i, len(data) - 1) for i in range(4)]
        c = [data[x].astype(np.int32) & 0x3F for x in at]
        two, three = ((b & 0x1F) << 6) | c[1], ((b & 0x0F) << 12) | (c[1] << 6) | c[2]
        four = ((b & 0x07) << 18) | (c[1] << 12) | (c[2] << 6) | c[3]
        point = np.where(b < 0xE0, two, np.where(b < 0xF0, three, four))
        kind = table[np.minimum(point, 0x10FFFF)]
        out[lead] = kind
        for i, least in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
            here = b >= least
            out[at[i][here]] = kind[here]
    return out


def pretokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the pattern's matches; they tile each row.

    Runs of letters, of numbers and of other characters take one space that
    stands before them; all but the last character of a longer blank run is a
    match of its own, the last one another unless it is such a space; at a
    row's end a blank run is one match. An apostrophe that begins a match takes
    s, t, m, d, re, ve or ll after it.
    """
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    kind = byte_classes(data)
    is_lead = (data & 0xC0) != 0x80
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    change = np.ones(n, bool)
    change[1:] = kind[1:] != kind[:-1]
    cut = change | first[:n]  # where a run of one class begins
    space = kind == SPACE
    # the last character of a blank run before other characters of the same row
    ends = np.flatnonzero(cut[1:] & ~first[1:n] & space[:-1]) + 1  # begins after a blank run
    last = ends - 1
    while len(last):
        cont = ~is_lead[last]
        if not cont.any():
            break
        last = last - cont
    cut[last] = True
    joined = ends[data[last] == 32]
    cut[joined] = False
    # contractions
    mark = np.flatnonzero((data == 39) & cut)
    mark = mark[mark + 1 < n]
    if len(mark):
        nxt = data[mark + 1]
        two = np.where(mark + 2 < n, data[np.minimum(mark + 2, n - 1)], 0)
        same1 = ~first[mark + 1]
        same2 = same1 & ~first[np.minimum(mark + 2, n)]
        short = same1 & np.isin(nxt, np.frombuffer(b"stmd", np.uint8))
        long = same2 & (((nxt == 114) & (two == 101)) | ((nxt == 118) & (two == 101)) | ((nxt == 108) & (two == 108)))
        for m, size in ((mark[short], 2), (mark[long], 3)):
            cut[m + 1] = False
            after = m + size
            inside = after < n
            cut[after[inside]] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], n)
    return start, end, np.searchsorted(offsets, start, "right") - 1
