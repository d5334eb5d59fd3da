"""Similarity of names, whole Arrow batches at a time: distinct pairs are scored once, as matrices of code points."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

from casegraph.functions.text import romanize, tokens
from casegraph.functions.values import DESCRIPTORS

# Thresholds of the name rules.
TOKEN_JARO = 0.85  # a token's partner in containment and verification
FUZZY_TOKEN = 0.72  # a shared token of compatible names
COMPATIBLE_JARO = 0.88
VERIFY_HIGH, VERIFY_LOW = 0.95, 0.85

#: Pairs that are scored at once.
CHUNK = 8192


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(w) for w in words], np.int64)
    width = max(int(size.max(initial=0)), 1)
    out = np.zeros((len(words), width), np.uint32)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(words)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out, size


def jaro_winkler_many(left: list[str], right: list[str]) -> np.ndarray:
    """Similarities of pairs of strings: a prefix of up to 4 letters, scale 0.1, boosted above 0.7; 0 for an empty one."""
    if len(left) > CHUNK:
        return np.concatenate([jaro_winkler_many(left[i : i + CHUNK], right[i : i + CHUNK]) for i in range(0, len(left), CHUNK)])
    (a, n), (b, m) = _codes(left), _codes(right)
    rows, places = np.arange(len(left)), np.arange(b.shape[1])
    reach = np.maximum(np.maximum(n, m) // 2 - 1, 0)
    used, mine = np.zeros(b.shape, bool), np.zeros(a.shape, bool)
    for i in range(a.shape[1]):
        open_ = (b == a[:, i : i + 1]) & ~used & (np.abs(places - i) <= reach[:, None]) & (places < m[:, None]) & (i < n)[:, None]
        first = open_.argmax(1)
        hit = open_[rows, first]
        used[rows[hit], first[hit]] = True
        mine[hit, i] = True
    common = mine.sum(1)
    width = min(a.shape[1], b.shape[1])
    ordered = [np.take_along_axis(x, np.argsort(~k, axis=1, kind="stable"), 1)[:, :width] for x, k in ((a, mine), (b, used))]
    half = ((ordered[0] != ordered[1]) & (np.arange(width) < common[:, None])).sum(1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        score = (common / n + common / m + (common - half) / common) / 3
    score = np.where(common > 0, score, 0.0)
    same = np.cumprod((a[:, : min(4, width)] == b[:, : min(4, width)]) & (np.arange(min(4, width)) < np.minimum(n, m)[:, None]), axis=1).sum(1)
    return np.where(score > 0.7, score + same * 0.1 * (1 - score), score)


class Scores:
    """Similarities of the token pairs of one batch, scored together."""

    def __init__(self, pairs: set[tuple[str, str]]) -> None:
        ordered = sorted(pairs)
        self.by_pair = dict(zip(ordered, jaro_winkler_many([x for x, _ in ordered], [y for _, y in ordered]).tolist())) if ordered else {}

    def __call__(self, x: str, y: str) -> float:
        return self.by_pair[x, y]


def _distinct(left: pd.Series, right: pd.Series) -> tuple[list, np.ndarray]:
    """The distinct pairs of a batch and each row's number among them; lists become tuples."""
    of = lambda v: tuple(v) if isinstance(v, (list, tuple, np.ndarray)) else v
    known: dict = {}
    code = np.array([known.setdefault((of(x), of(y)), len(known)) for x, y in zip(left, right)], np.int64)
    return list(known), code


@F.pandas_udf(DoubleType())
def jw(a: pd.Series, b: pd.Series) -> pd.Series:
    """Jaro-Winkler similarity; 0 if either is missing or empty."""
    pairs, code = _distinct(a, b)
    score = jaro_winkler_many([x or "" for x, _ in pairs], [y or "" for _, y in pairs]) if pairs else np.zeros(0)
    return pd.Series(score[code], dtype="float64")


def _names(values) -> list[str]:
    return [v for v in (values if values is not None else ()) if v]


@F.pandas_udf(DoubleType())
def _best_jaro(a: pd.Series, b: pd.Series) -> pd.Series:
    pairs, code = _distinct(a, b)
    lists = [(_names(x), _names(y)) for x, y in pairs]
    score = Scores({(x, y) for xs, ys in lists for x in xs for y in ys})
    best = np.array([max((score(x, y) for x in xs for y in ys), default=0.0) for xs, ys in lists])
    return pd.Series(best[code] if len(pairs) else [], dtype="float64")


def _words(name: str) -> list[str]:
    return [t for t in name.split() if len(t) > 1]


def _anchored(short: list[str], long: list[str], score: Scores) -> bool:
    """First and last tokens agree in place."""
    return score(short[0], long[0]) >= TOKEN_JARO and score(short[-1], long[-1]) >= TOKEN_JARO


def _partners(short: list[str], long: list[str], score: Scores) -> int:
    return sum(any(score(s, t) >= TOKEN_JARO for t in long) for s in short)


def _token_pairs(lists) -> set[tuple[str, str]]:
    return {p for xs, ys in lists for x in xs for y in ys for s in _words(x) for t in _words(y) for p in ((s, t), (t, s))}


@F.pandas_udf(BooleanType())
def _contained(a: pd.Series, b: pd.Series) -> pd.Series:
    pairs, code = _distinct(a, b)
    lists = [(_names(x), _names(y)) for x, y in pairs]
    score = Scores(_token_pairs(lists))

    def one(x: str, y: str) -> bool:
        short, long = sorted((_words(x), _words(y)), key=len)
        if len(short) < 2 or len(short) == len(long):
            return False
        return _partners(short, long, score) == len(short) and _anchored(short, long, score)

    found = np.array([any(one(x, y) for x in xs for y in ys) for xs, ys in lists], bool)
    return pd.Series(found[code] if len(pairs) else [], dtype="bool")


@F.pandas_udf(BooleanType())
def _verified(a: pd.Series, b: pd.Series) -> pd.Series:
    pairs, code = _distinct(a, b)
    lists = [(_names(x), _names(y)) for x, y in pairs]
    score = Scores({(x, y) for xs, ys in lists for x in xs for y in ys} | _token_pairs(lists))

    def one(xs: list[str], ys: list[str]) -> bool:
        best, at = 0.0, None
        for x in xs:
            for y in ys:
                if score(x, y) > best:
                    best, at = score(x, y), (x, y)
        if at is None or best >= VERIFY_HIGH:
            return at is not None
        left, right = _words(at[0]), _words(at[1])
        if not left or not right:
            return False
        short, long = (left, right) if len(left) <= len(right) else (right, left)
        shared = _partners(short, long, score)
        if len(short) < len(long) and shared == len(short):
            # a name inside a longer one is the same person's only if both ends agree
            return len(short) >= 2 and _anchored(short, long, score)
        return best >= VERIFY_LOW and shared >= 2

    found = np.array([one(xs, ys) for xs, ys in lists], bool)
    return pd.Series(found[code] if len(pairs) else [], dtype="bool")


@F.pandas_udf(StructType().add("ok", BooleanType()).add("reason", StringType()))
def _compatible(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    pairs, code = _distinct(a, b)
    split = lambda v: [t for t in (v or "").split() if len(t) >= 2 and t not in DESCRIPTORS]
    lists = [(split(x), split(y)) for x, y in pairs]
    whole = jaro_winkler_many([x or "" for x, _ in pairs], [y or "" for _, y in pairs]) if pairs else np.zeros(0)
    score = Scores({(s, t) for xs, ys in lists for s in xs for t in ys})
    alike = lambda s, t: s == t or score(s, t) >= FUZZY_TOKEN

    def one(x, y, xs, ys, s) -> tuple[bool, str]:
        if xs and xs == ys:
            return True, "name_exact" if x == y else "name_tokens_exact"
        if s >= COMPATIBLE_JARO:
            return True, f"name_jaro:{s:.2f}"
        left, shared = list(ys), 0
        for t in xs:
            hit = next((i for i, u in enumerate(left) if alike(t, u)), None)
            if hit is not None:
                left.pop(hit)
                shared += 1
        if shared >= 2 and (alike(xs[0], ys[0]) or (shared >= 3 and alike(xs[-1], ys[-1]))):
            return True, "name_shared_edge_tokens"
        return False, f"name_mismatch:jaro:{s:.2f}"

    found = [one(x, y, xs, ys, s) for (x, y), (xs, ys), s in zip(pairs, lists, whole.tolist())]
    return pd.DataFrame([found[i] for i in code.tolist()], columns=["ok", "reason"])


def romanized(names: Column) -> Column:
    """The Latin forms of an array of names, without missing ones."""
    return F.filter(F.transform(F.filter(names, lambda n: n.isNotNull()), romanize_plain), lambda n: n != "")


def romanize_plain(c: Column) -> Column:
    """romanize() of text that is composed already, so that it runs inside array functions."""
    return romanize(c)


def best_jaro(a: Column, b: Column) -> Column:
    """The best similarity among all pairs of two arrays of Latin names."""
    return _best_jaro(a, b)


def contained(a: Column, b: Column) -> Column:
    """One name of a pair is the other with tokens put in: of two tokens at least, each with a partner, both ends in place."""
    return _contained(a, b)


def verified(truth: Column, case: Column) -> Column:
    """Names agree for verification: nearly equal, or contained with both ends in place, or alike with two shared tokens."""
    return _verified(truth, case)


def compatible(a: Column, b: Column) -> Column:
    """Struct of ok and reason: equal, alike, or two shared fuzzy tokens with an end in place."""
    return _compatible(a, b)


def has_token(alias: Column, names: Column, at_least: int = 2) -> Column:
    """The alias shares a token of so many letters with one of the names."""
    known = F.filter(F.flatten(F.transform(F.filter(names, lambda n: n.isNotNull()), tokens)), lambda t: F.length(t) >= at_least)
    return F.arrays_overlap(tokens(alias), known)
