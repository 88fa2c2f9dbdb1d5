"""Collocations, spelling variants and top-k search against brute force, with the cases their docstrings define."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ticketflow.llm import automata, collocations, knn_join, spelling_variants

SPLIT = re.compile(r"[.,;:!?\x0A-\x0D]")
WORDS = re.compile(r"[^\x20\x09]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# Automata


def random_table(seed, n, depth=4):
    rng = random.Random(seed)
    labels = [b"a", b"ab", b"b", b"z" * 300, "é".encode()]
    found = Counter(tuple(rng.choice(labels) for _ in range(rng.randint(1, depth))) for _ in range(n))
    rows = np.zeros((len(found), depth), dtype=np.int32)
    for i, key in enumerate(sorted(found)):
        rows[i, : len(key)] = [labels.index(x) + 1 for x in key]
    weights = np.array([found[k] for k in sorted(found)], dtype=np.int64) * rng.choice([1, 10**12])
    return found, automata.Table(labels, rows, weights)


def as_dict(table):
    return {table.sequence(i): int(w) for i, w in enumerate(table.weights)}


@pytest.mark.parametrize("seed, n", [(0, 0), (1, 1), (2, 40), (3, 3000)])
def test_an_automaton_holds_its_sequences(seed, n):
    _, table = random_table(seed, n)
    kept = automata.unpack(automata.pack(automata.build(table)))
    back = automata.paths(kept)
    assert as_dict(back) == as_dict(table)
    assert [back.sequence(i) for i in range(len(back.rows))] == sorted(as_dict(table))


def test_equal_states_are_merged():
    # Two states after the first label, alike in all that follows.
    found = [(b"a", b"x"), (b"a", b"x", b"y"), (b"b", b"x"), (b"b", b"x", b"y"), (b"c", b"x")]
    labels = [b"a", b"b", b"c", b"x", b"y"]
    rows = np.zeros((5, 3), dtype=np.int32)
    for i, key in enumerate(found):
        rows[i, : len(key)] = [labels.index(x) + 1 for x in key]
    kept = automata.build(automata.Table(labels, rows, np.array([7, 2, 7, 2, 7])))
    # The end, the one before y, two before x, the root.
    assert len(kept.first) - 1 == 5


@pytest.mark.parametrize("high", [2, 40, 2000])
def test_rows_too_wide_for_one_number(high):
    rng = np.random.default_rng(high)
    # Up to 88 bits a row; some rows differ in the last columns only, some are repeated, some shorter.
    rows = rng.integers(1, high, (4000, 8), endpoint=True).astype(np.int32)
    rows[2000:3000, :7] = rows[1000:2000, :7]
    rows[3000:] = rows[:1000]
    rows[np.arange(8)[None, :] >= rng.integers(1, 9, 4000)[:, None]] = 0
    table = automata.summed([b""] * high, rows, np.ones(4000, dtype=np.int64))
    different, count = np.unique(rows, axis=0, return_counts=True)
    assert np.array_equal(table.rows, different) and np.array_equal(table.weights, count)
    every = automata.prefixes([b""] * high, rows)
    known = Counter(tuple(r[: d + 1]) for r in rows.tolist() for d in range(8) if r[d])
    found = [tuple(x for x in r if x) for r in every.rows.tolist()]
    assert found == sorted(known) and every.weights.tolist() == [known[x] for x in found]


def test_packed_automata_make_no_object_per_label_and_no_empty_planes():
    _, table = random_table(8, 400)
    back = automata.unpack(automata.pack(automata.build(table)))
    assert isinstance(back.labels, pa.Array) and back.labels.to_pylist() == table.labels
    small, large = np.arange(100), np.array([0, -1, 2**62, -(2**62)])
    for numbers in (small, large, small[:0]):
        assert automata.unpack_numbers(automata.pack_numbers(numbers)).tolist() == numbers.tolist()
    assert len(automata.pack_numbers(np.random.default_rng(1).integers(0, 256, 1000))) < 1100


def test_union_and_composition():
    tables = [random_table(seed, 500)[1] for seed in (4, 5, 6)]
    total = Counter()
    for t in tables:
        total.update(as_dict(t))
    united = automata.union(tables, 4)
    assert as_dict(united) == dict(total)
    asked = automata.union([random_table(7, 200, 4)[1], united], 4, np.maximum)
    known = automata.build(tables[0])
    told = automata.compose(asked, known)
    assert told.tolist() == [as_dict(tables[0]).get(asked.sequence(i), 0) for i in range(len(asked.rows))]
    assert automata.compose(asked, automata.build(random_table(0, 0)[1])).tolist() == [0] * len(asked.rows)


# Collocations


def made_phrases():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(12)] + ["Éa", "Über", "x\x01y", "\x00"]
    phrases = ["new york", "of the people", "a b c d", "New York city hall", "ü é"]
    docs = []
    for i in range(260):
        words = []
        for _ in range(rng.randint(0, 30)):
            words.append(rng.choice(phrases) if rng.random() < 0.4 else rng.choice(vocabulary))
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\x0b"]) for w in words)
        docs.append((i, text, rng.choice(["en", "en", "de", None, "und"]), i))
    docs += [(900, None, "en", 0), (901, "", "de", 0), (902, " .,; \n", None, 0), (903, "the " * 400, "fr", 0), docs[3], docs[3]]
    return docs


def brute_phrases(docs, least, most):
    f, total = defaultdict(Counter), Counter()
    for _, text, lang, _ in docs:
        lang = lang or "und"
        for piece in SPLIT.split(lower(text or "")):
            words = WORDS.findall(piece)
            total[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in often.items():
            longer = [q for q in often if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * often[q] >= 80 * a for q in longer):
                continue
            score, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), p, counts[p[:k]], counts[p[k:]], k))
        for rank, (score, a, phrase, _, left, right, k) in enumerate(sorted(kept)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score, k))
    return sorted(out)


@pytest.mark.parametrize("range_chars, fan, most", [(1 << 20, 1024, 2000), (600, 1024, 2000), (300, 4, 7)])
def test_phrases(spark, monkeypatch, range_chars, fan, most):
    docs = made_phrases()
    monkeypatch.setattr(collocations, "SLICE_BYTES", 1500)
    monkeypatch.setattr(collocations, "WIDER", 3)
    monkeypatch.setattr(collocations, "UNITED_ROWS", 100)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, automaton int").repartition(3)
    found = collocations.collocations(df, least=5, most=most, range_chars=range_chars, fan=fan)
    assert sorted(map(tuple, found.collect())) == brute_phrases(docs, 5, most)


def test_phrases_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert collocations.collocations(df).count() == 0


def test_a_long_text_is_cut_without_a_trace(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE_BYTES", 64)
    rng = random.Random(3)
    text = "".join(rng.choice(["aa", "b", "ccc", "é"]) + rng.choice([" ", " ", " ", "\t", ". "]) for _ in range(3000))
    docs = [(1, text, "en", 0), (2, "q" * 500 + " aa b " + "r" * 300, "en", 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, x int")
    assert sorted(map(tuple, collocations.collocations(df, least=5).collect())) == brute_phrases(docs, 5, 2000)


def test_scores_are_exact_beyond_64_bits():
    a = 3 * 10**18
    assert collocations.scores_of([a, 1], [7 * a + 1, 3]) == [2000000 * a // (7 * a + 1), 666666]


# Spelling variants


def made_spellings():
    rng = random.Random(21)
    words = ["collection", "collections", "colection", "Société", "sociéte", "sociétés", "abcdefg", "abcdefgh", "aaaaaaa", "aaaaaaaa"]
    words += ["common" + "".join(rng.choice("abc") for _ in range(4)) for _ in range(60)]
    docs = []
    for i in range(300):
        picked = [words[min(int(rng.expovariate(0.15)), len(words) - 1)] for _ in range(rng.randint(0, 40))]
        docs.append((i, "".join(w + rng.choice([" ", ", ", "1", "\n"]) for w in picked), i))
    return docs + [(None, "collection colections abcdefg", 0), (800, None, 0), (801, "", 0), docs[5], docs[5], (802, "é" * 3000 + " abcdefx" * 3, 0)]


def brute_spellings(docs, ratio=10):
    counts = Counter()
    for doc_id, text, _ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 7
    words = {w: n for w, n in counts.items() if n >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    around = {w: [v for v in words if near(v, w)] for w in words}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= ratio * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(around[w]), words[form[w]] if w in form else None))
    return sorted(out, key=lambda r: r[0])


@pytest.mark.parametrize("hot, held", [(32, 1 << 18), (1, 5)])
def test_spellings(spark, monkeypatch, hot, held):
    docs = made_spellings()
    monkeypatch.setattr(spelling_variants, "HOT", hot)
    monkeypatch.setattr(spelling_variants.near_pairs, "__defaults__", (hot,))
    monkeypatch.setattr(spelling_variants, "HELD_WORDS", held)
    monkeypatch.setattr(spelling_variants, "SLICE_CHARS", 50)
    df = spark.createDataFrame(docs, "doc_id long, text string, word int").repartition(3)
    expected = brute_spellings(docs)
    assert sum(r[1] is not None for r in expected) > 5
    assert sorted(map(tuple, spelling_variants.spelling_variants(df).collect())) == expected


def test_spellings_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants.spelling_variants(df).collect() == []


def test_chains_of_forms_end_at_the_root(spark):
    # Every step is ten times as frequent; 2001 occurrences at the top.
    words = [("abcdefg", 2), ("abcdefgh", 20), ("abcdefghi", 200), ("abcdefghij", 2001)]
    docs = []
    for w, n in words:
        ids = (i for i in range(100000) if zlib.crc32(f"{i}:{w}".encode()) % 31)
        docs += [(next(ids), f" {w}" * n)]
    found = {r.word: r.root for r in spelling_variants.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found == {w: "abcdefghij" for w, _ in words}


# Top-k


def brute_top(rows, k, step):
    whole = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(np.float64(x) * 256) for x in v):
            continue
        whole.append((i, [int(np.floor(np.float64(x) * 256)) for x in v]))
    out = []

    def score(a, b):
        return max(min(sum(x * y for x, y in zip(a, b)), 2**63 - 1), -(2**63))

    for q, a in {(i, tuple(v)) for i, v in whole if i % step == 0}:
        scores = sorted((-score(a, b), i) for i, b in whole if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def made_vectors():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, 8))
    rows = [(i, (centres[i % 5] + 0.05 * rng.normal(size=8)).tolist()) for i in range(400)]
    rows += [(1000 + i, centres[0].tolist()) for i in range(120)]
    rows += [(2000, None), (2001, [1.0, None]), (2002, [float("nan")] * 8), (2003, [float("inf")] * 8), (None, [1.0] * 8)]
    rows += [(2010, []), (2020, [1e30] + [0.0] * 7), (2021, [3.0, -2.0]), (2030, [1e6] * 8), (2031, [-1e6] * 8), (7, rows[7][1])]
    return rows + [(2040, [0.5] * 12), rows[20], (20, [0.25] * 8), (2050, [1e306] * 8)]


@pytest.mark.parametrize("pivots, group, block", [(64, 4096, 1 << 14), (3, 10, 40), (40, 3, 100)])
def test_top_k(spark, pivots, group, block):
    rows = made_vectors()
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, cell int, hash int").repartition(3)
    found = knn_join.top_k(df, F.col("vec_id") % 10 == 0, 5, pivots=pivots, group_queries=group, block_rows=block)
    assert sorted(map(tuple, found.collect())) == brute_top(rows, 5, 10)


def test_top_k_of_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    is_query = F.col("vec_id") % 50 == 0
    assert knn_join.top_k(spark.createDataFrame([], schema), is_query).collect() == []
    assert knn_join.top_k(spark.createDataFrame([(1, [1.0])], schema), is_query).collect() == []
    assert knn_join.top_k(spark.createDataFrame([(50, [1.0])], schema), is_query).collect() == []
    two = spark.createDataFrame([(50, [1.0]), (3, [-0.001])], schema)
    assert list(map(tuple, knn_join.top_k(two, is_query).collect())) == [(50, 1, 3, -256)]
