"""Deduplication operators against brute force, with the cases their docstrings define."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from ticketflow.llm import line_dedup, ngram_jaccard, substring_dedup, suffix_dedup
from ticketflow.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, _row long, node long, h long"


def made_texts():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randint(60, 120))] for _ in range(4)]
    docs = []
    for i in range(80):
        words, kind = list(rng.choice(bases)), rng.random()
        if 0.3 <= kind < 0.6:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        elif kind < 0.7 and kind >= 0.6:
            words = ["a"] * rng.randint(30, 90)
        elif kind >= 0.7:
            passage = words[10 : 10 + rng.randint(30, 45)]
            words = [rng.choice(vocabulary) for _ in range(20)] + passage + [rng.choice(vocabulary) for _ in range(20)]
        docs.append((i * 7 % 80, " ".join(words) + rng.choice(["", "\n", " é"])))
    long = " ".join(rng.choice(vocabulary) for _ in range(6000))
    return [*docs, (500, None), (501, ""), docs[0], (None, docs[3][1]), (502, "é" * 70), (503, "xé" * 80), (504, long)]


@pytest.fixture(scope="module")
def texts():
    return made_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(d, t, "s", 1, 2, 3) for d, t in texts], SCHEMA).repartition(4)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is not None, v) for v in r])


@pytest.mark.parametrize("shard_bytes", [None, 300])
def test_repeated_word_windows(docs, texts, shard_bytes, monkeypatch):
    # Small shards deal anchors again, down to single windows.
    if shard_bytes:
        monkeypatch.setattr(substring_dedup, "PLAN", substring_dedup.PLAN._replace(shard_bytes=shard_bytes))
    words = [WORD.findall(t or "") for _, t in texts]
    seen = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    expected = []
    for (doc, _), w in zip(texts, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        expected.append((doc, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    found = substring_dedup.substring_digest(substring_dedup.dedup_substrings(docs)).collect()
    assert ordered(found) == ordered(expected)


@pytest.mark.parametrize("shard_bytes", [None, 300])
def test_repeated_byte_strings(docs, texts, shard_bytes, monkeypatch):
    # Small shards deal anchors again, down to single windows.
    if shard_bytes:
        monkeypatch.setattr(suffix_dedup, "PLAN", suffix_dedup.PLAN._replace(shard_bytes=shard_bytes))
    data = [(d, (t or "").encode()) for d, t in texts]
    first = {}
    for d, b in sorted(set(data), key=lambda x: (x[0] is not None, x[0] or 0)):
        for i in range(len(b) - 99):
            first.setdefault(b[i : i + 100], (d, i))
    expected = []
    for d, b in data:
        gone = [False] * len(b)
        for i in range(len(b) - 99):
            if first[b[i : i + 100]] != (d, i):
                gone[i : i + 100] = [True] * 100
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        expected.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    found = suffix_dedup.suffix_digest(suffix_dedup.dedup_suffixes(docs)).collect()
    assert ordered(found) == ordered(expected)


@pytest.mark.parametrize("phrase_words", [12, 60])
@pytest.mark.parametrize(
    ("module", "run"),
    [
        (substring_dedup, lambda d: substring_dedup.substring_digest(substring_dedup.dedup_substrings(d))),
        (suffix_dedup, lambda d: suffix_dedup.suffix_digest(suffix_dedup.dedup_suffixes(d))),
    ],
)
def test_hot_anchors_are_dealt_again(spark, monkeypatch, module, run, phrase_words):
    rng = random.Random(phrase_words)
    some = lambda n: [f"{rng.randrange(1 << 20):x}" for _ in range(n)]
    phrase, rows = some(phrase_words), []
    for i in range(300):
        before, after = some(30), some(30)
        rows.append((i, " ".join(before + phrase + after)))
        if i % 5 == 0:
            rows.append((1000 - i, " ".join([*some(3), *before[-25:], *phrase, *after[:20]])))
    rows.append((2000, " ".join([*phrase, *some(5), *phrase, *phrase])))
    rows.append((2001, " ".join(["same"] * 400 + phrase)))
    df = spark.createDataFrame([(d, t, "s", 1, 2, 3) for d, t in rows], SCHEMA).repartition(3)
    expected = ordered(run(df).collect())
    assert sum(r[2] for r in expected) > 0
    plan = module.PLAN._replace(shard_bytes=6000)
    judge, bound = plan.judge, 2 * plan.shard_bytes

    def bounded(contents, *rest):
        assert len(contents) == 1 or sum(map(len, contents)) <= bound
        return judge(contents, *rest)

    monkeypatch.setattr(module, "PLAN", plan._replace(judge=bounded))
    assert ordered(run(df).collect()) == expected


def test_suffix_array():
    rng = random.Random(3)
    for _ in range(200):
        text = np.array([rng.randint(1, 3) for _ in range(rng.randint(0, 60))], dtype=np.int64)
        assert suffix_dedup.suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_suffix_array_of_large_symbols():
    # Three names below 4 million do not fit one 64-bit number, as in the recursion over a shard of 10 MB.
    rng = random.Random(4)
    large = [1, 2, 2_200_000, 2_900_000, 3_999_998, 3_999_999]
    for _ in range(200):
        text = np.array([rng.choice(large) for _ in range(rng.randint(3, 90))], dtype=np.int64)
        assert suffix_dedup.suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_wavelet_matrix_counts():
    values = np.random.default_rng(1).integers(0, 13, 500)
    matrix = substring_dedup.WaveletMatrix(values, 4)
    zero = matrix.rank(np.arange(13), np.zeros(13, dtype=np.int64))
    for at in (0, 1, 63, 64, 65, 400, 500):
        counts = matrix.rank(np.arange(13), np.full(13, at)) - zero
        assert counts.tolist() == [int((values[:at] == s).sum()) for s in range(13)]


def test_repeated_lines(spark):
    line = "Shared line that is longer than forty code points"
    rows = [(i, f"own {i}\n  {line.upper() if i % 2 else line}\t\nend", 1) for i in range(6)]
    rows += [(7, None, 1), (8, "", 1), (9, "\n".join([line + "x"] * 9), 1), (None, line, 1), rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept_text long")
    found = {(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup.dedup_lines(df).collect()}
    expected = {(i, 3, 1, f"own {i}\nend") for i in range(5)}
    expected |= {(5, 3, 0, rows[5][1]), (7, 1, 0, ""), (8, 1, 0, ""), (9, 9, 0, rows[8][1]), (None, 1, 1, "")}
    assert found == expected
    assert line_dedup.dedup_lines(df).count() == len(rows)


def test_clashing_columns(spark):
    line = "Shared line that is longer than forty code points"
    rows = [(i, f"{line}\nown {i}", i, "x", None) for i in range(6)] + [(None, None, 1, None, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id int, _drop string, row int")
    found = line_dedup.dedup_lines(df)
    assert found.columns[:5] == df.columns
    assert ordered(found.select(*df.columns).collect()) == ordered(rows)
    assert found.filter("n_dropped = 1").count() == 5
    kept = ngram_jaccard.keep_one(df, 5, 80)
    assert kept.columns == df.columns
    assert ordered(kept.collect()) == ordered(rows)


def test_many_dropped_lines(spark):
    lines = [f"line {i} is shared by all, forty code points long" for i in range(30_000)]
    rows = [(i, "\n".join([*lines, f"own {i}"])) for i in range(5)]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.n_dropped, r.kept_text) for r in found} == {
        (i, 30_000, f"own {i}") if i < 4 else (4, 0, rows[4][1]) for i in range(5)
    }


def test_bloom_filter_loses_nothing():
    hashes = np.random.default_rng(2).integers(0, 1 << 63, 5000).astype(np.uint64)
    bloom = line_dedup.Bloom(5000)
    bloom.add(hashes[:4000])
    assert bloom.has(hashes[:4000]).all()
    assert bloom.has(hashes[4000:]).mean() < 0.05


def brute_components(texts, words, percent):
    sets = []
    for _, t in texts:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        grams = [tuple(w[i : i + words]) for i in range(len(w) - words + 1)] or ([tuple(w)] if w else [])
        sets.append(frozenset(grams))
    parent = {d: d for d, _ in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    low = lambda x: (x is not None, x or 0)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(texts[i][0]), root(texts[j][0])), key=low)
                parent[y] = x
    return [(d, len(s), root(d)) for (d, _), s in zip(texts, sets, strict=True)]


@pytest.mark.parametrize(("words", "percent", "block"), [(3, 90, 1 << 20), (5, 80, 1 << 20), (3, 60, 300)])
def test_near_duplicates(docs, texts, words, percent, block, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "BLOCK_TOKENS", block)
    found = ngram_jaccard.jaccard_join(docs, words, percent).collect()
    assert ordered(found) == ordered(brute_components(texts, words, percent))


def test_one_of_each_group_stays(docs, texts):
    found = ngram_jaccard.keep_one(docs, 5, 80)
    assert found.columns == docs.columns
    stay = {d for d, _, c in brute_components(texts, 5, 80) if d == c}
    assert ordered((r.doc_id,) for r in found.collect()) == ordered((d,) for d in stay)


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7)]
    found = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100}


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert substring_dedup.dedup_substrings(none).count() == 0
    assert suffix_dedup.dedup_suffixes(none).count() == 0
    assert line_dedup.dedup_lines(none).count() == 0
    assert ngram_jaccard.jaccard_join(none, 3, 90).count() == 0
