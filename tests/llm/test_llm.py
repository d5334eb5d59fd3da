"""The training-data operators against brute-force versions and on odd rows."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from casegraph.llm import bpe, decontamination, kernels, license_scan, line_dedup, near_dups, nearest, quality, substring_dedup, suffix_dedup, token_counts

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [None, "", " ", "\n", "a", "\n\nx\n", "é" * 10, "'s 's\n  tail  ", "a" * 3000, "the cat sat " * 300, "漢字 😀 ١٢٣", "<|endoftext|> x <|endoftext|>"]
#: Names that operators use inside; extra columns of these names must do no harm.
CLASH = ["id", "n", "h", "keys", "token", "_id", "_text", "_key", "_lines", "_pos", "lang", "start", "component", "n_tokens", "score", "rank"]


def frame(spark, texts, ids=None, clash=True):
    ids = list(range(len(texts))) if ids is None else ids
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    return df.withColumns({c: F.lit("clash") for c in CLASH}) if clash else df


def made_words(rng, n, size=400):
    return " ".join(rng.choice(VOCABULARY[:size]) for _ in range(n))


_rng = random.Random(7)
VOCABULARY = ["".join(_rng.choice("abcdefghiklmnoprstuvé") for _ in range(_rng.randint(2, 9))) for _ in range(3000)]


# --- kernels ---


def test_pretokens_match_the_pattern():
    rng = random.Random(1)
    parts = ["a", "b", "'", "s", "t", "re", "ve", "ll", " ", "  ", "\n", "\t", "é", "1", "²", "!", " ", "漢", "😀", "́", "_", "'s ", "d", "m"]
    texts = [*ODD, *["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(3000)]]
    pattern = regex.compile(public_tokenizers.PATTERN)
    got = []
    for i, j, data, offsets in kernels.text_slices(pa.array(texts), 5000):
        rows = [[] for _ in range(j - i)]
        for a, b, r in zip(*kernels.pretokens(data, offsets)):
            rows[r].append(data[a:b].tobytes().decode())
        got += rows
    assert got == [pattern.findall(t or "") for t in texts]


def test_shingles_are_sets_of_word_runs():
    rng = random.Random(2)
    texts = [*ODD, *[made_words(rng, rng.randint(0, 30), 6) for _ in range(300)]]
    sizes = []
    for i, j, data, offsets in kernels.text_slices(pa.array(texts), 2000):
        word, _, _, row = kernels.words(data, offsets)
        r, _ = kernels.shingles(word, row, j - i)
        sizes += np.bincount(r, minlength=j - i).tolist()
    assert sizes == [len(shingle_set(t)) for t in texts]


def shingle_set(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


# --- 1 and 7: tokens ---


@pytest.fixture(scope="module")
def encoding():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(MULTI, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_encodes_as_the_library_and_decodes(spark, encoding):
    rng = random.Random(3)
    texts = [*ODD, "ab" * 900, "".join(rng.choices("abcdefgh", k=700)), *["".join(rng.choices("abcdefg éß漢0123  \n'!?.", k=rng.randint(0, 120))) for _ in range(200)]]
    out = bpe.decode(bpe.encode(frame(spark, texts), MULTI), MULTI).collect()
    assert len(out) == len(texts)
    for r in out:
        want = encoding.encode_ordinary(texts[r.doc_id] or "")
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == want and r.n_tokens == len(want)
        assert bytes(r.decoded) == (texts[r.doc_id] or "").encode()
    both = {r.doc_id: (bytes(r.ids), bytes(r.decoded), r.n_tokens) for r in bpe.round_trip(frame(spark, texts), MULTI).collect()}
    assert both == {r.doc_id: (bytes(r.ids), bytes(r.decoded), r.n_tokens) for r in out}
    whole = bpe.decode(bpe.encode(frame(spark, texts[:20]), MULTI).select("doc_id", "ids"), MULTI, sizes_col=None).collect()
    assert all(bytes(r.decoded) == (texts[r.doc_id] or "").encode() for r in whole)
    assert bpe.encode(frame(spark, []), MULTI).count() == 0
    assert bpe.encode(frame(spark, ["x", "x"], [1, 1]), MULTI).count() == 2


def test_long_pieces_take_no_long_time(encoding):
    rng = random.Random(9)
    codec = bpe.Codec(open(MULTI, "rb").read())
    texts = ["".join(rng.choices(letters, k=n)) for letters, n in (("abcdefghijklmnopqrstuvwxyz", 200_000), ("ACGT", 100_000), ("a", 50_001), ("ab", 9_999), ("ethaoins", 49), ("-=", 30_000))]
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        ids = codec.encode(data, np.array([0, len(data)]))[0]
        assert ids.tolist() == encoding.encode_ordinary(t)
        assert codec.decode_sequences(ids.astype(np.int64), np.array([len(ids)])) == [t.encode()]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts_are_the_libraries(spark, name):
    path = public_tokenizers.path(name)
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        count = lambda t: len(Tokenizer.from_file(path).encode(t, add_special_tokens=False))
    else:
        import sentencepiece

        count = lambda t: len(sentencepiece.SentencePieceProcessor(model_file=path).encode(t))
    got = token_counts.over_limit(token_counts.count_tokens(frame(spark, ODD), path), 512).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in got} == {i: (len((t or "").encode()), n := count(t or ""), n > 512) for i, t in enumerate(ODD)}
    assert token_counts.count_tokens(frame(spark, []), path).count() == 0


def test_batches_are_balanced():
    texts = ["x" * 10] * 100 + ["y" * 5000]
    batches = list(token_counts.balanced(texts, 300))
    assert [t for b in batches for t in b] == texts and max(sum(map(len, b)) for b in batches[:-1]) <= 300


# --- 2: lines ---


def line_dedup_brute(rows):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = collections.defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            holders[key(x)].add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 10 and len(holders[key(x)]) >= 2 and min(holders[key(x)]) != i)]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_line_dedup(spark):
    rng = random.Random(4)
    shared = ["A shared LINE here", " a shared line here\t", "kürzer É", "exactly 10", "ÉÉÉÉÉÉÉÉÉÉ", "éééééééééé", "short"]
    texts = [*ODD, *["\n".join(rng.choice([*shared, made_words(rng, 5)]) for _ in range(rng.randint(1, 8))) for _ in range(80)]]
    got = line_dedup.kept_text(line_dedup.dedup_lines(frame(spark, texts))).collect()
    assert {r._id: (len(r._lines), len(r._dropped), r._kept) for r in got} == line_dedup_brute(list(enumerate(texts)))
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0
    same = line_dedup.kept_text(line_dedup.dedup_lines(frame(spark, ["one long line", "one long line", "one long line"], [1, 1, None]))).collect()
    assert sorted(r._kept for r in same) == ["one long line"] * 3
    three = line_dedup.dedup_lines(frame(spark, ["one long line"] * 2 + ["another long line"] * 3), min_docs=3)
    assert {r._id: len(r._dropped) for r in three.collect()} == {0: 0, 1: 0, 2: 0, 3: 1, 4: 1}


# --- 3: quality ---


def feature_brute(text):
    """Counts of the buckets of one text."""
    bucket, _ = quality.features(data := np.frombuffer((text or "").encode(), np.uint8), np.array([0, len(data)]))
    return collections.Counter(bucket.tolist())


def ftrl_brute(rows):
    """Weights by follow-the-regularised-leader updates in plain Python; rows in the order of their ids' hashes."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    order = {r.id: r.h for r in spark.createDataFrame([(i,) for i, _, _ in rows], "id long").select("id", F.xxhash64("id").alias("h")).collect()}
    rows = sorted(rows, key=lambda r: (order[r[0]], r[0]))
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(k):
        return 0.0 if abs(z[k]) <= quality.L1 else -(z[k] - math.copysign(quality.L1, z[k])) / ((quality.BETA + math.sqrt(n[k])) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for _, text, y in rows:
            counts = feature_brute(text)
            x = {k: quality.SCALE * c / sum(counts.values()) for k, c in counts.items()} | {"intercept": 1.0}
            w = {k: weight(k) for k in x}
            p = 1 / (1 + math.exp(-sum(w[k] * v for k, v in x.items())))
            for k, v in x.items():
                g = (p - y) * v
                sigma = (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / quality.ALPHA
                z[k] += g - sigma * w[k]
                n[k] += g * g
    return {k: weight(k) for k in z}


def test_features_are_words_and_pairs():
    same = feature_brute("ab cd"), feature_brute("ab\tcd")
    assert same[0] == same[1] and sum(same[0].values()) == 7  # two words and outlines, a pair of each, and whether a word is repeated
    assert sum(feature_brute("").values()) == 0 and feature_brute("ab ab") != feature_brute("ab cd")


def test_quality_learns_outlines(spark):
    rng = random.Random(5)
    texts, labels = [], []
    for _ in range(300):
        good = rng.random() < 0.7
        words = made_words(rng, 60, 3000).split()
        texts.append(" ".join(words) if good else " ".join(w.upper() + "!!" for w in words))
        labels.append(int(good))
    docs = frame(spark, [*texts, *ODD])
    known = spark.createDataFrame([*[(i, y) for i, y in enumerate(labels)], (0, None), (9999, 1)], "doc_id long, quality int").withColumn("text", F.lit("clash"))
    got = {r.doc_id: r for r in quality.classify(docs, known).collect()}
    assert len(got) == len(texts) + len(ODD)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [i for i in range(300) if got[i].held_out]
    assert sum(got[i].predicted == labels[i] for i in held) >= 0.95 * len(held)
    # each score by a plain version: dense counts, one coordinate at a time
    weights = ftrl_brute([(i, texts[i], y) for i, y in enumerate(labels) if not got[i].held_out and i != 0] + [(0, texts[0], labels[0])] * (not got[0].held_out))
    for i, t in enumerate([*texts, *ODD]):
        x = feature_brute(t)
        total = sum(x.values())
        z = sum(weights.get(k, 0.0) * quality.SCALE * c / total for k, c in x.items()) + weights.get("intercept", 0.0)
        assert abs(got[i].score - 1 / (1 + math.exp(-z))) < 1e-5
    none = quality.classify(docs, known.where("false")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.classify(frame(spark, []), known).count() == 0


# --- 4: licenses ---


def license_brute(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [(i, label) for p, label in license_scan.BASE.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    at = sorted(i for i, _ in places)
    joined = f" {' '.join(w)} "
    found = []
    if any(g in joined for g in license_scan.GATES):
        for r in license_scan.rules():
            if r.keyword in joined:
                for m in re.finditer(f" {r.pattern}(?= )", joined):
                    start = joined[: m.start()].count(" ")
                    found.append((start, start + m.group().count(" "), r))
    keep = [x for x in found if not any(y is not x and y[0] <= x[0] and y[1] >= x[1] and ((y[0], y[1]) != (x[0], x[1]) or (y[2].priority, y[2].rule_id) < (x[2].priority, x[2].rule_id)) for y in found)]
    keep.sort(key=lambda x: x[0])
    better = lambda x, y: (y[2].priority, y[0] - y[1], y[0]) < (x[2].priority, x[0] - x[1], x[0])
    lost = lambda x, y: better(x, y) and 2 * (min(x[1], y[1]) - max(x[0], y[0])) >= x[1] - x[0]
    keep = [x for i, x in enumerate(keep) if not any(lost(x, y) for y in [*keep[max(i - 1, 0) : i], *keep[i + 1 : i + 2]])]
    base = sorted({x for _, x in places})
    labels = sorted({*base, *[r.label for _, _, r in keep]})
    score = max([0.0, *[r.confidence for _, _, r in keep], *([0.9] if base else [])])
    return len(w), len(at), at[0] if at else None, at[-1] if at else None, ",".join(base), ",".join(labels), score


def test_license_scan(spark):
    lines = [
        "Licensed under the MIT License.", "under the mit license under the mit license", "Apache License, Version 2.0", "CC BY NC", "cc-by-nc-sa 4.0", "SPDX-License-Identifier: GPL-3.0",
        "released under the terms of the GNU General Public License version 2", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "Copyright (c) 2031 Somebody. All rights reserved.", "it is in the public domain", "no words of that kind", "MIT License MIT License", "https://www.apache.org/licenses/LICENSE-2.0", "übermit license",
    ]
    rng = random.Random(6)
    texts = [*ODD, *lines, *[" ".join(rng.choices([*lines, "word", "é"], k=rng.randint(1, 6))) for _ in range(150)]]
    got = license_scan.scan_licenses(frame(spark, texts))
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == {i: license_brute(t) for i, t in enumerate(texts)}
    assert len(license_scan.rules()) > 200
    assert license_scan.scan_licenses(frame(spark, [])).count() == 0
    twice = license_scan.scan_licenses(frame(spark, ["MIT license"] * 3, [1, 1, None])).collect()
    assert [r.labels for r in twice] == ["mit"] * 3


def rule_samples(pattern):
    """Texts that a pattern matches: each alternative and each optional part at least once."""
    from re import _parser

    def of(items):
        outs = [""]
        for op, arg in items:
            op = str(op)
            if op == "LITERAL":
                more = [chr(arg)]
            elif op == "IN":
                more = [x for o, v in arg for x in ([chr(v)] if str(o) == "LITERAL" else [chr(v[0])] if str(o) == "RANGE" else ["x"])]
            elif op in ("NOT_LITERAL", "ANY"):
                more = ["x"]
            elif op == "BRANCH":
                more = [x for branch in arg[1] for x in of(branch)]
            elif op == "SUBPATTERN":
                more = of(arg[3])
            elif op == "MAX_REPEAT":
                low, high, sub = arg
                one = of(sub)
                more = [""] * (low == 0) + one * (high > 0)
            else:
                assert op == "ASSERT_NOT", op
                more = [""]
            # all of the new parts, each after one of the earlier texts
            outs = [outs[k % len(outs)] + more[k % len(more)] for k in range(max(len(outs), len(more)))] + [o + more[0] for o in outs[:2]]
            outs = list(dict.fromkeys(outs))
        return outs

    return [x for x in of(_parser.parse(pattern)) if re.search(f" {pattern}(?= )", f" {x} ")]


def test_license_prefilter_loses_no_match(spark, monkeypatch):
    rules = license_scan.rules()
    samples = {r.rule_id: rule_samples(r.pattern) for r in rules}
    for r in rules:
        assert samples[r.rule_id], r
        for x in samples[r.rule_id]:
            assert r.keyword in f" {x} " and any(g in f" {x} " for g in license_scan.GATES), (r, x)
    lines = [
        "this work is licensed under the creative commons attribution 4.0 international license", "released under the zero clause bsd license", "the gnu library general public license",
        "this code is released under mit", "distributed under wtfpl", "this software is proprietary and confidential", "published by the isc", "freebsd license",
    ]
    texts = [*lines, *[x for r in rules for x in samples[r.rule_id][:2]]]
    got = {r.doc_id: tuple(r)[1:] for r in license_scan.scan_licenses(frame(spark, texts)).collect()}
    monkeypatch.setattr(license_scan, "GATES", ("",))
    monkeypatch.setattr(license_scan, "rules", lambda: [r._replace(keyword="") for r in rules])
    assert got == {i: license_brute(t) for i, t in enumerate(texts)}
    assert [got[i][5] for i in range(len(lines))] == ["cc-by", "0bsd", "lgpl", "mit", "wtfpl", "proprietary", "isc", "bsd-2-clause"]


# --- 5 and 8: similar sets ---


def grouped(sets, percent):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            k = len(sets[a] & sets[b])
            if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
                u, v = sorted((find(a), find(b)))
                root[v] = u
    return {i: find(i) for i in sets}


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(VOCABULARY)
    return " ".join(w)


def test_near_duplicates(spark):
    rng = random.Random(8)
    texts = list(ODD)
    for _ in range(12):
        base = made_words(rng, rng.randint(6, 200), 3000)
        texts += [base, base.upper().replace("É", "é"), *[edited(rng, base, rng.randint(0, 6)) for _ in range(rng.randint(1, 8))]]
    # a group beyond SHORT whose members differ by a few words each
    base = made_words(rng, 150, 3000)
    texts += [edited(rng, base, rng.randint(1, 4)) for _ in range(150)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    docs = frame(spark, [texts[i] for i in order], order)
    sets = {i: shingle_set(t) for i, t in enumerate(texts)}
    want = grouped(sets, 85)
    got = {r.id: (r.n, r.component) for r in near_dups.near_duplicates(docs).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in sets}


def test_near_duplicates_of_odd_tables(spark):
    assert near_dups.near_duplicates(frame(spark, [])).count() == 0
    got = near_dups.near_duplicates(frame(spark, ["a b c", "a b c", "A B C", "x", None], [4, 4, 2, 7, None])).collect()
    assert sorted((r.id, r.n, r.component) for r in got) == [(2, 1, 2), (4, 1, 2), (4, 1, 2), (7, 1, 7)]


def test_rounds_of_leaders_and_blocks_agree(spark, monkeypatch):
    from casegraph.llm import linking

    rng = random.Random(9)
    base = made_words(rng, 120, 3000)
    texts = [edited(rng, base, rng.randint(1, 4)) for _ in range(90)]
    want = grouped({i: shingle_set(t) for i, t in enumerate(texts)}, 85)
    monkeypatch.setattr(linking, "FOLLOWERS", 20)
    monkeypatch.setattr(linking, "SHORT", 5)
    assert {r.id: r.component for r in near_dups.near_duplicates(frame(spark, texts)).collect()} == want


def test_repeated_paragraphs(spark):
    rng = random.Random(10)
    shared = [made_words(rng, rng.randint(25, 90), 3000) for _ in range(6)]
    texts = list(ODD)
    for _ in range(40):
        texts.append("\n".join(rng.choice([edited(rng, rng.choice(shared), rng.randint(0, 2)), made_words(rng, rng.randint(3, 60), 3000)]) for _ in range(rng.randint(1, 4))))
    sets, at = {}, {}
    for i, t in enumerate(texts):
        lines = [x for x in (t or "").split("\n") if len(re.findall(r"[^\x20\x09-\x0D]+", x)) >= 25]
        for k, x in enumerate(lines):
            sets[i, k], at[i, k] = shingle_set(x), x
    root = grouped(sets, 80)
    size = collections.Counter(root.values())
    docs = frame(spark, texts)
    found = substring_dedup.repeated_paragraphs(docs)
    got = {(r.doc_id, r.paragraph): (r.class_doc_id, r.class_paragraph, r.class_size, r.removed) for r in found.collect()}
    assert got == {p: (*c, size[c], p != c) for p, c in root.items() if size[c] > 1}
    kept = {r.doc_id: r.text for r in substring_dedup.remove_paragraphs(docs, found).collect()}
    for i, t in enumerate(texts):
        want = t
        for (d, k), c in root.items():
            if d == i and c != (d, k):
                want = want.replace(at[d, k].strip(), "", 1) if want.count(at[d, k].strip()) == 1 else None
                if want is None:
                    break
        assert want is None or kept[i] == want
    assert substring_dedup.repeated_paragraphs(frame(spark, [])).count() == 0


def test_repeated_passages(spark):
    rng = random.Random(17)
    shared = [made_words(rng, rng.randint(51, 90), 3000) for _ in range(5)]
    texts, holds = list(ODD[:8]), set()
    for _ in range(60):
        parts = [made_words(rng, rng.randint(0, 60), 3000) for _ in range(2)]
        if rng.random() < 0.6:
            k = rng.randrange(5)
            parts.insert(1, shared[k])
            holds.add((len(texts), k))
        texts.append(rng.choice([" ", "\n"]).join(parts))
    used = collections.Counter(k for _, k in holds)
    want = {i for i, k in holds if used[k] > 1}
    docs = frame(spark, texts)
    found = substring_dedup.repeats(docs)
    got = found.collect()
    assert want == {r.doc_id for r in got}
    first = {k: min(i for i, x in holds if x == k) for k in used}
    assert {r.doc_id for r in got if r.removed} == {i for i, k in holds if i != first[k]}
    fold = lambda t: " ".join((t or "").split()).translate(LOWER)
    for r in (r for r in got if r.kind == "passage"):
        span = fold((texts[r.doc_id] or "").encode()[r.first : r.last].decode())
        assert sum(" ".join(span.split()[:10]) in fold(t) for t in texts) >= 2
    kept = {r.doc_id: r.text for r in substring_dedup.remove_paragraphs(docs, found).collect()}
    assert all(len(kept[i]) < len(texts[i]) - 100 for i, k in holds if i != first[k])
    assert all(kept[i] == t for i, t in enumerate(texts) if i not in want)
    assert substring_dedup.repeats(frame(spark, [])).count() == 0


def test_passages_are_the_repeated_windows(spark):
    """Each span by brute force: windows at the smallest three-word hash of each reach, equal ones by their words."""
    rng = random.Random(71)
    shared = [made_words(rng, 90, 3000) for _ in range(3)]
    texts = [*ODD]
    for _ in range(25):
        w = rng.choice(shared).split()
        a = rng.randint(0, 30)
        texts.append(" ".join([made_words(rng, rng.randint(0, 40), 3000), *w[a : a + rng.choice([20, 50, 51, 60])], made_words(rng, rng.randint(0, 40), 3000)]))
    held = collections.defaultdict(list)
    starts_of = {}
    for d, t in enumerate(texts):
        data = np.frombuffer((t or "").encode(), np.uint8)
        word, start, end, row = kernels.words(data, np.array([0, len(data)]))
        words = [bytes(data[a:b]).translate(bytes(kernels.LOWER)) for a, b in zip(start, end)]
        n = len(words) - substring_dedup.WINDOW + 1
        mult = kernels.powers(4, 0xD6E8FEB86659FD93)[0]
        key = [int(kernels.mix(np.array([word[i] * mult[1] + word[i + 1] * mult[2] + word[i + 2] * mult[3]], np.uint64))[0]) & ~1023 for i in range(max(len(words) - 2, 0))]
        at = set()
        if n > 0:
            width = min(n, substring_dedup.REACH)
            at = {min(range(lo, lo + width), key=lambda i: (key[i], i)) for lo in range(n - width + 1)}
        starts_of[d] = (start, end)
        for i in at:
            held[tuple(words[i : i + substring_dedup.WINDOW])].append((d, i))
    want = collections.defaultdict(set)
    for places in held.values():
        if len(places) > 1:
            first = min((d, int(starts_of[d][0][i])) for d, i in places)
            for d, i in places:
                s, e = int(starts_of[d][0][i]), int(starts_of[d][1][i + substring_dedup.WINDOW - 1])
                want[d, (d, s) != first].add((s, e))
    merged = set()
    for (d, removed), spans in want.items():
        at, reach = None, None
        for s, e in sorted(spans):
            if at is None or s > reach:
                if at is not None:
                    merged.add((d, at, reach, removed))
                at, reach = s, e
            reach = max(reach, e)
        merged.add((d, at, reach, removed))
    got = {(r.doc_id, r.first, r.last, r.removed) for r in substring_dedup.repeated_passages(frame(spark, texts)).collect()}
    assert got == merged and got
    assert substring_dedup.repeated_passages(frame(spark, [])).count() == 0


def test_repeats_hold_short_paragraphs(spark):
    rng = random.Random(19)
    short = [made_words(rng, n, 3000) for n in (5, 9, 16, 24)]
    close = short[3].rsplit(" ", 1)[0] + " other"
    texts = [f"{made_words(rng, 40, 3000)}\n{x}\nfew words here" for x in [*short, *short, short[1].upper().replace("É", "é"), close]]
    found = {(r.doc_id, r.class_doc_id, r.class_size) for r in substring_dedup.repeats(frame(spark, texts)).where("removed and kind = 'paragraph'").collect()}
    assert found == {(4, 0, 2), (5, 1, 3), (6, 2, 2), (7, 3, 3), (8, 1, 3), (9, 3, 3)}


# --- 6: decontamination ---


def test_repeated_paragraphs_of_wide_ids(spark):
    rng = random.Random(77)
    line = made_words(rng, 30)
    texts = [line, made_words(rng, 30), line + "\n" + made_words(rng, 40)]
    small = substring_dedup.repeated_paragraphs(frame(spark, texts, [1, 2, 3])).collect()
    for ids in ([2**40 + 1, 2**40 + 2, 2**62], [-(2**62), 5, 2**50]):
        wide = substring_dedup.repeated_paragraphs(frame(spark, texts, ids)).collect()
        back = dict(zip(ids, [1, 2, 3]))
        key = lambda r, m: (m[r.doc_id], r.paragraph, r.first, r.last, m[r.class_doc_id], r.removed)
        assert {key(r, back) for r in wide} == {key(r, {1: 1, 2: 2, 3: 3}) for r in small} and len(wide) == 2


def test_decontamination(spark):
    rng = random.Random(11)
    items = [f"{made_words(rng, rng.randint(8, 120), 3000)}. {made_words(rng, rng.randint(1, 12), 3000)}." for _ in range(60)]
    texts, want = list(ODD), set()
    for _ in range(120):
        text = made_words(rng, rng.randint(0, 400), 3000)
        if rng.random() < 0.5:
            k = rng.randrange(len(items))
            w = text.split()
            cut = rng.randint(0, len(w))
            text = " ".join([*w[:cut], items[k].upper() if rng.random() < 0.3 else items[k], *w[cut:]])
            want.add((len(texts), k))
        texts.append(text)
    bench = spark.createDataFrame([*enumerate(items), (99, None), (98, "")], "item_id long, text string")
    got = decontamination.contaminated(frame(spark, texts), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert all(r.overlap >= 0.8 and r.answer_overlap >= 0.5 and r.score >= 0.4 for r in got)
    # all pairs, by brute force
    split = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))}
    held = [grams(split(t)) for t in texts]
    every = {(d, k) for k, t in enumerate(items) for d, h in enumerate(held) if len(grams(split(t)) & h) >= 0.8 * len(grams(split(t)))}
    assert want <= every
    answers = {k: {g for g in (tuple(split(t)[i : i + 5]) for i in range(len(split(t)) - 4)) if g not in grams(split(t[: t.index(". ") + 1]))} for k, t in enumerate(items)}
    assert {(d, k) for d, k in every if len(answers[k] & held[d]) >= 0.5 * len(answers[k])} == want
    with pytest.MonkeyPatch.context() as patch:  # several indexes give the same pairs
        patch.setattr(decontamination, "SHARD_BYTES", 4000)
        patch.setattr(decontamination, "DENSE", 10)
        assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(frame(spark, texts), bench).collect()} == want
    half = [" ".join(items[0].split()[: len(items[0].split()) // 2])]
    assert decontamination.contaminated(frame(spark, half), bench).count() == 0
    assert decontamination.contaminated(frame(spark, []), bench).count() == 0
    assert decontamination.contaminated(frame(spark, texts), bench.where("false")).count() == 0


def test_bounds_lose_no_entry():
    rng = random.Random(12)
    items = [made_words(rng, rng.randint(1, 90), 200) for _ in range(80)]
    index = decontamination.Index(list(range(80)), items)
    text = " ".join([items[3], made_words(rng, 50, 200), items[70]])
    data = np.frombuffer(text.encode(), np.uint8)
    word, row, _ = decontamination.words(data, np.array([0, len(data)]))
    got = {i for _, i, _ in index.candidates(word, row, 1)}
    want = set()
    for at in range(0, max(len(word) - 32, 1), 32):
        term = np.searchsorted(index.terms, np.unique(word[at : at + 64]))
        score = collections.Counter()
        for t in term:
            for e, w in zip(index.entry[index.begin[t] : index.begin[t + 1]], index.weight[index.begin[t] : index.begin[t + 1]]):
                score[e] += w
        want |= {int(index.owner[e]) for e, s in score.items() if s >= decontamination.THRESHOLD}
    assert got == want and {3, 70} <= got


# --- 9: suffixes ---


def suffix_brute(texts, span=400):
    raw = [(t or "").encode() for t in texts]
    count = collections.Counter(b[i : i + span] for b in raw for i in range(len(b) - span + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - span + 1):
            if count[b[i : i + span]] > 1:
                gone[i : i + span] = True
        edge = np.diff(np.concatenate(([0], gone.astype(int))))
        out.append((len(b), int(gone.sum()), int((edge == 1).sum()), bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


def passages(rng):
    texts = list(ODD)
    long = [made_words(rng, 160, 3000) for _ in range(4)]
    for _ in range(40):
        part = rng.choice(long)
        a = rng.randint(0, 300)
        texts.append(made_words(rng, rng.randint(0, 80), 3000) + part[a : a + rng.choice([390, 399, 400, 401, 450, 600, 900])] + made_words(rng, rng.randint(0, 80), 3000))
    return [*texts, long[0] + "x" + long[0], "z" * 399, "z" * 400, "z" * 401, "y" * 400]


def test_suffix_dedup(spark):
    texts = passages(random.Random(13))
    got = {r.id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(frame(spark, texts)).collect()}
    assert got == dict(enumerate(suffix_brute(texts)))
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0
    twice = suffix_dedup.remove_repeats(frame(spark, ["q" + "w" * 50 + made_words(random.Random(1), 120)] * 3, [1, 1, None])).collect()
    assert [r.kept for r in twice] == [b""] * 3


def passage_brute(texts, span=51):
    words = [[w.translate(LOWER) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] for t in texts]
    count = collections.Counter(tuple(w[i : i + span]) for w in words for i in range(len(w) - span + 1))
    out = []
    for w in words:
        held = np.zeros(len(w), bool)
        for i in range(len(w) - span + 1):
            if count[tuple(w[i : i + span])] > 1:
                held[i : i + span] = True
        out.append(int((np.diff(np.concatenate(([0], held.astype(int)))) == 1).sum()))
    return out


def test_passages_of_over_50_words(spark, monkeypatch):
    rng = random.Random(41)
    texts = [*ODD, *passages(rng)]
    for n in (49, 50, 51, 52, 55):
        part = " ".join(rng.choice(["a", "an", "to", "is"]) + str(rng.randint(0, 9)) for _ in range(n))  # under 400 bytes
        texts += [made_words(rng, 60, 3000) + "\n" + part.upper() + "  " + made_words(rng, 9, 3000), part + " " + made_words(rng, 70, 3000)]
    want = passage_brute(texts)
    rows = suffix_dedup.remove_repeats(frame(spark, texts)).collect()
    assert {r.id: r.n_passages for r in rows} == dict(enumerate(want))
    assert any(r.n_passages and not r.n_removed for r in rows)
    monkeypatch.setattr(suffix_dedup, "BUCKET", 4)
    assert {r.id: r.n_passages for r in suffix_dedup.remove_repeats(frame(spark, texts)).collect()} == dict(enumerate(want))


def shared_brute(texts, span=25):
    words = [[w.translate(LOWER) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] for t in texts]
    held = collections.defaultdict(set)
    for d, w in enumerate(words):
        for i in range(len(w) - span + 1):
            held[tuple(w[i : i + span])].add(d)
    return [len({j for i in range(len(w) - span + 1) if len(held[tuple(w[i : i + span])]) > 1 for j in range(i, i + span)}) for w in words]


def test_words_shared_with_other_documents(spark, monkeypatch):
    rng = random.Random(43)
    alone, twin = made_words(rng, 60, 3000), made_words(rng, 40, 3000)
    changed = made_words(rng, 51, 3000).split()
    texts = [*ODD, *passages(rng), alone + " " + alone, " ".join(["be"] * 90), " ".join(["be"] * 20), " ".join(["so"] * 70), " ".join(["so"] * 30)]
    # a passage of 51 words, one of them changed; contexts that repeat in one document and are met by another
    texts += [made_words(rng, 30, 3000) + " " + " ".join(changed), " ".join([*changed[:25], "other", *changed[26:]]) + "\n" + made_words(rng, 30, 3000)]
    part = made_words(rng, 60, 3000)
    texts += [part + " x " + part + " x " + part, " ".join(part.upper().split()[11:38]), twin, twin, made_words(rng, 9, 3000)]
    ids = [*range(len(texts) - 3), 10**6, 10**6, None]
    want = [(i, n) for i, n in zip(ids, shared_brute(texts))]
    for bucket in (suffix_dedup.BUCKET, 4):
        monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
        rows = suffix_dedup.remove_repeats(frame(spark, texts, ids)).collect()
        assert sorted((r.id is None, r.id, r.n_shared_words) for r in rows) == sorted((i is None, i, n) for i, n in want)
    got = {r.id: r for r in rows}
    k = texts.index(alone + " " + alone)
    assert got[k].n_passages and not got[k].n_shared_words
    assert not got[k + 6].n_passages and got[k + 6].n_shared_words == 50 and got[10**6].n_shared_words == 40


def test_large_buckets_are_refined(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET", 4)
    texts = passages(random.Random(14))
    got = {r.id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(frame(spark, texts)).collect()}
    assert got == dict(enumerate(suffix_brute(texts)))


# --- 10: neighbours ---



def test_nearest(spark, monkeypatch):
    rng = np.random.default_rng(15)
    v = rng.standard_normal((2000, 24)).astype(np.float32)
    v[100:160] = v[100]  # copies: ties go to smaller ids
    rows = [(i, [float(x) for x in a]) for i, a in enumerate(v)]
    rows += [(5000, None), (5050, [0.0] * 24), (5100, [float("nan")] * 24), (5150, [None] * 24), (5200, []), (5250, [1.0, 2.0]), (None, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash")).withColumn("_v", F.lit(1))
    monkeypatch.setattr(nearest, "SHARD", 700)
    got = collections.defaultdict(list)
    for r in nearest.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    unit = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    hits = 0
    for q in range(0, 2000, 50):
        s = unit @ unit[q]
        s[q] = -2
        best = np.lexsort((np.arange(2000), -np.round(s, 12)))[:5]
        hits += len({int(x) for x in best} & {i for i, _ in got[q]})
        assert all(math.isclose(x, s[i], abs_tol=1e-12) for i, x in got[q]) and len(got[q]) == 5
    assert hits >= 0.9 * 200
    assert [i for i, _ in got[100]] == [101, 102, 103, 104, 105] and [i for i, _ in got[150]] == [100, 101, 102, 103, 104]
    assert set(got) == set(range(0, 2000, 50))
    assert nearest.nearest(df.where("vec_id < 3"), F.col("vec_id") == 0).count() == 2
    assert nearest.nearest(df.where("false"), F.lit(True)).count() == 0


def test_nearest_prunes_cells_and_keeps_recall(spark, monkeypatch):
    rng = np.random.default_rng(16)
    centres = rng.standard_normal((40, 32)) * 4
    v = centres[rng.integers(0, 40, 12000)] + rng.standard_normal((12000, 32)) * 0.4
    v[3000:7000] = v[3000]  # a third of all rows are copies
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(nearest, "SHARD", 300)
    met, real = [], nearest.durable
    monkeypatch.setattr(nearest, "durable", lambda x: met.append(x.columns) or real(x))
    got = collections.defaultdict(list)
    for r in nearest.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    hits = 0
    for q in range(0, 12000, 50):
        s = unit @ unit[q]
        s[q] = -2
        hits += len(set(np.lexsort((np.arange(12000), -np.round(s, 12)))[:5].tolist()) & set(got[q]))
    assert hits >= 0.97 * 5 * 240 and got[3050] == [3000, 3001, 3002, 3003, 3004]
    assert sum("_shards" in c for c in met) < 6  # the rounds end long before all cells are seen


def test_chi_square_quantile():
    assert abs(nearest.chi_square_quantile(0.95, 2) + 2 * math.log(0.05)) < 1e-9


# --- pipeline ---


def test_pipeline(spark, tmp_path, encoding):
    import corpus_pipeline

    rng = random.Random(16)
    line = "a line that many documents share"
    texts = [made_words(rng, 80, 3000) + ("\n" + line if i % 3 == 0 else "") for i in range(60)]
    texts += [edited(rng, texts[1], 1), texts[2], "", None]
    items = [made_words(rng, 30, 3000) for _ in range(3)]
    texts.append(f"{made_words(rng, 20, 3000)} {items[1]} {made_words(rng, 20, 3000)}")
    junk = list(range(len(texts), len(texts) + 40))
    texts += [" ".join(w.upper() + "!!" for w in made_words(rng, 50, 3000).split()) for _ in junk]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i not in junk), 0) for i in range(len(texts))], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    scores = {r.doc_id: r.predicted for r in quality.classify(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")).collect()}
    good = [(i, t) for i, t in enumerate(texts) if scores[i]]
    lines = line_dedup_brute(good)
    left = {i: lines[i][2] for i, t in good if not (lines[i][0] == lines[i][1])}
    roots = grouped({i: shingle_set(t) for i, t in left.items()}, 80)
    want = {i: t for i, t in left.items() if roots[i] == i and items[1] not in t}
    assert set(got) == set(want)
    for i, t in want.items():
        assert got[i].ids_sha256 == hashlib.sha256(np.array(encoding.encode_ordinary(t), "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert not set(junk) & set(got) and len(corpus_pipeline.STAGES) == 5


def test_pipeline_of_odd_tables(spark, tmp_path, encoding):
    """Clashing columns, nulls in all columns, repeated ids and rows, and an empty table."""
    import corpus_pipeline

    rng = random.Random(61)
    texts = [*ODD, *[made_words(rng, 40, 3000) for _ in range(10)]]
    rows = [(i, t, "en", "s", len(t or ""), "x", "y", None) for i, t in enumerate(texts)]
    rows += [(0, "again another text of the same id", "en", None, None, "x", "y", None), rows[-1], (None, "no id " + made_words(rng, 20, 3000), None, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _score string, _row string, ids binary"
    for name, part in (("full", rows), ("empty", [])):
        spark.createDataFrame(part, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(i, 1, 0) for i in range(5)] + [(None, 0, 0), (3, None, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        spark.createDataFrame([(0, None), (None, "x"), (1, "")], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/full").collect()
    assert all(r.n_tokens == len(r.ids) // 4 for r in got)
    assert {r.doc_id for r in got} >= {i for i, t in enumerate(texts) if i >= len(ODD) and i < len(texts) - 1}
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").collect() == []


def test_pipeline_drops_near_copies_from_80_percent_on(spark):
    import corpus_pipeline

    rng = random.Random(18)
    texts = []
    for _ in range(40):
        w = made_words(rng, 103, 3000).split()
        # 99 shingles; each new word changes five: similarity 89/109 with two of them, 84/114 with three
        near, far = list(w), list(w)
        near[50], near[-5] = "once", "twice"
        far[30], far[50], far[70] = "once", "twice", "thrice"
        texts += [" ".join(x) for x in (w, near, far)]
    sets = {i: shingle_set(t) for i, t in enumerate(texts)}
    want, at_85 = grouped(sets, 80), grouped(sets, 85)
    assert all(want[i] == i - i % 3 and at_85[i] == i for i in range(1, len(texts), 3)) and all(want[i] == i for i in range(2, len(texts), 3))
    docs = frame(spark, texts)
    got = {r.doc_id for r in corpus_pipeline.near_dup_stage(spark, docs, "").collect()}
    assert got == {i for i in want if want[i] == i}
    assert (near_dups.shared_at(85), near_dups.shared_at(80)) == (41, 36)
