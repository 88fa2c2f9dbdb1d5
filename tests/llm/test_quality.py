"""Quality, decontamination, secrets, mixing, scoring and the pipeline."""

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import DATA, TABLES
from pyspark.sql import functions as F

import corpus_pipeline
from ticketflow.llm import decontaminate, lm_scoring, mixing, quality_classifier, quality_rules, queries, secrets
from ticketflow.llm.text import read

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = [(900001, None), (900002, ""), (900003, "one"), (900004, "A a a a a b"), (900005, " \t\n x \r\n"), (None, "no id")]
SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, DATA, "documents").collect()]
    return rows + EDGES + rows[:2]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(d, t, None if d is None else f"src{d % 3}", 0, 1.0) for d, t in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int, score double")


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is not None, v) for v in r])


def test_rule_counts(spark, docs, texts):
    trusted = quality_rules.trusted_ids(read(spark, DATA, "labels"))
    found = quality_rules.quality_rules(docs, trusted)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    expected = []
    for doc, text in texts:
        words = WORD.findall(text or "")
        windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        expected.append((doc, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed))
    assert ordered(found.select(*names).collect()) == ordered(expected)
    assert found.filter("kept AND base_failed").count() == 0


def test_quality_verdicts(spark):
    found = queries.op7_quality_rules(spark, SMALL).join(read(spark, SMALL, "labels"), "doc_id").filter("NOT base_failed")
    assert found.filter("quality = 1 AND NOT kept").count() == 0
    assert found.filter("quality = 0 AND kept").count() == 0


def test_rules_run_without_python(spark):
    plan = queries.op7_quality_rules(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_rules_without_target_or_rows(spark, docs):
    nobody = spark.createDataFrame([], "doc_id long")
    assert {r.score for r in quality_rules.quality_rules(docs, nobody).select("score").collect()} == {0.0}
    assert quality_rules.quality_rules(docs.limit(0), nobody).count() == 0


def test_rules_score_whole_words_and_their_order(spark):
    words = [f"{body}{end}" for body in ("mar", "tol", "sen", "vik") for end in ("ing", "ed", "ion")]
    clean = [" ".join(words[(i + k) % 12] for k in range(60)) for i in range(12)]
    # Their endings are those of the clean texts, one by one.
    garbled = " ".join("x" + word[-3:] for word in clean[0].split())
    turned = " ".join(reversed(clean[0].split()))
    rows = [*enumerate(clean), (100, garbled), (101, turned), (102, clean[0])]
    trusted = spark.createDataFrame([(i,) for i in range(12)], "doc_id long")
    found = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string"), trusted)
    score = {r.doc_id: r.score for r in found.collect()}
    assert score[102] == score[0]
    assert score[100] < score[0] - 0.1 and score[101] < score[0] - 0.1


def test_classifier_on_held_out_rows(spark):
    found = queries.op2_quality_classifier(spark, SMALL)
    judged = found.filter("held_out").join(read(spark, SMALL, "labels"), "doc_id")
    right, all_rows = judged.filter("predicted = quality").count(), judged.count()
    assert all_rows > 30 and right / all_rows > 0.95
    assert found.count() == read(spark, SMALL, "documents").count()


def test_classifier_edges(spark, docs):
    model = quality_classifier.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert model is None
    assert quality_classifier.score(docs, model, 0.3).agg(F.min("score")).first()[0] == 0.5
    model = quality_classifier.train(docs, read(spark, DATA, "labels"))
    rows = quality_classifier.score(docs, model, 0.3).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality_classifier.score(docs.limit(0), model, 0.3).count() == 0


def test_prior_estimate():
    rng = np.random.default_rng(1)
    positive, negative = rng.normal(2, 1, 4000), rng.normal(-4, 1, 1200)
    assert quality_classifier.estimate_prior(positive, np.concatenate([rng.normal(2, 1, 2800), negative])) == pytest.approx(0.7, abs=0.05)


def test_leaks(spark):
    item = " ".join(f"q{i}" for i in range(30))
    words = item.split()
    moved = " ".join(words[20:] + ["x"] + words[:10] + ["y"] + words[10:20])
    texts = [
        (1, "before " + item.upper() + " after"),
        (2, "a b " + moved + " c"),
        (3, " ".join(words[:12]) + " and nothing more of it"),
        (4, " ".join(words[i] for i in range(0, 30, 2))),
        (5, None),
        (6, ""),
        (7, "say tiny item here"),
        (8, item + " " + item),
    ]
    docs = spark.createDataFrame([(*t, 1) for t in texts], "doc_id long, text string, leaks_ int")
    bench = spark.createDataFrame([(1, item), (2, "tiny item"), (3, None), (4, " ")], "item_id long, text string")
    for block in (1 << 20, 40):
        found = {r.doc_id: [x.item_id for x in r.leaks] for r in decontaminate.leaks(docs, bench, block_bytes=block).collect()}
        assert found == {1: [1], 2: [1], 3: [], 4: [], 5: [], 6: [], 7: [2], 8: [1]}
    assert {r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()} == {3, 4, 5, 6}
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == len(texts)
    assert decontaminate.decontaminate(docs.limit(0), bench).count() == 0


def test_items_without_id_and_clashing_columns(spark):
    item = " ".join(f"q{i}" for i in range(20))
    docs = spark.createDataFrame(
        [(1, f"a {item} b", "x", 1), (2, "clean", "y", 2)], "doc_id long, text string, leaks string, _leaks_0 int"
    )
    bench = spark.createDataFrame([(None, item), (None, "other item"), (4, item)], "item_id long, text string")
    found = {r.doc_id: [x.item_id for x in r.leaks] for r in decontaminate.leaks(docs, bench).collect()}
    assert found == {1: [None, 4], 2: []}
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert [tuple(r) for r in kept.collect()] == [(2, "clean", "y", 2)]


def greedy(text, item, least):
    """Greedy string tiling by looking at every pair of places in each round."""
    used_text, used_item, tiles = set(), set(), []
    while True:
        best = None
        for b in range(len(item)):
            for a in range(len(text)):
                n = 0
                while (
                    a + n < len(text) and b + n < len(item) and text[a + n] == item[b + n]
                    and a + n not in used_text and b + n not in used_item
                ):
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (a, b, n)
        if best is None:
            return tiles
        a, b, n = best
        tiles.append((a, n))
        used_text.update(range(a, a + n))
        used_item.update(range(b, b + n))


@pytest.mark.parametrize("pairs", [1 << 20, 7])
def test_tiling_against_brute_force(pairs, monkeypatch):
    monkeypatch.setattr(decontaminate, "PAIRS", pairs)
    rng = random.Random(3)
    items = [[rng.choice("abc") for _ in range(rng.randint(1, 30))] for _ in range(12)]
    texts = [[rng.choice("abc") for _ in range(rng.randint(0, 50))] for _ in range(25)]
    texts += [["x", *item[10:], "y", *item[:10]] for item in items] + [["a"] * 40]
    block = decontaminate.Block([(k, " ".join(item)) for k, item in enumerate(items)], 3)
    found = decontaminate._scan([" ".join(t) for t in texts], block, 0.5)
    for text, hits in zip(texts, found, strict=True):
        expected = {}
        for k, item in enumerate(items):
            tiles = greedy(text, item, min(3, len(item)))
            if sum(n for _, n in tiles) / len(item) >= 0.5:
                expected[k] = sorted(tiles)
        assert {h["item_id"]: [(t["first"], t["length"]) for t in h["tiles"]] for h in hits} == expected


def test_repetitive_texts_are_tiled_in_parts():
    block = decontaminate.Block([(1, "a " * 200)], 5)
    found = decontaminate._scan(["a " * 20_000, "a " * 100], block, 0.6)
    assert [[h["item_id"] for h in hits] for hits in found] == [[1], []]


def test_rules_with_clashing_columns(spark):
    names = ["_w", "_grams", "_lines", "_sorted", "_verdict", "_at", "_ratios"]
    schema = "doc_id long, text string, " + ", ".join(f"{n} int" for n in names)
    docs = spark.createDataFrame([(1, "some words here", *range(7)), (None, None, *[None] * 7)], schema)
    found = quality_rules.quality_rules(docs, spark.createDataFrame([(1,)], "doc_id long"))
    assert found.columns[:9] == docs.columns
    assert ordered(found.select(*docs.columns).collect()) == ordered(docs.collect())


def test_tiles_take_the_longest_first():
    pairs = np.array([(i, i + 4) for i in range(6)] + [(20 + i, i) for i in range(3)])
    assert decontaminate.tile(pairs, 3) == [(0, 4, 8), (20, 0, 4)]


def test_secret_base_spans(docs, texts):
    assign = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
    found = secrets.span_digest(secrets.scan_secrets(docs)).collect()
    expected = []
    for doc, text in texts:
        text = text or ""
        spans = [("assign", m) for m in assign.finditer(text) if len(m[2]) >= 12]
        spans += [("access", m) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        spans += [("hex", m) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
        spans.sort(key=lambda x: (x[1].start(), secrets.KINDS.index(x[0])))
        counts = Counter(k for k, _ in spans)
        digest = ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in spans)
        expected.append((doc, counts["assign"], counts["access"], counts["hex"], hashlib.sha256(digest.encode()).hexdigest()))
    assert ordered(r[:5] for r in found) == ordered(expected)


def test_secret_free_tokens_stay_clear_of_base_findings():
    rng = random.Random(3)
    for _ in range(500):
        parts = []
        for _ in range(rng.randint(1, 12)):
            letters = "abcdef0123456789ABCXYZ" + rng.choice(["", " =/"])
            begin = rng.choice(["password=", "token: ", "", " ", "AKIA", "="])
            parts.append(begin + "".join(rng.choices(letters, k=rng.randint(5, 45))))
        text = rng.choice(["", " ", "\n"]).join(parts)
        found = secrets.findings(text)
        base = [(a, b) for k, a, b, _ in found if k < 3]
        free = [
            m.span()
            for m in secrets.FREE.finditer(text)
            if any(c.isdigit() for c in m[0])
            and any(c.isalpha() for c in m[0])
            and not any(a < m.end() and m.start() < b for a, b in base)
        ]
        assert [(a, b) for k, a, b, _ in found if k == 3] == free


def test_secret_ownership(spark):
    key = "Zx81kQ02mV77pL3s9TbY"
    rows = [(i, f"value {key}A end", f"o{i}", 1) for i in range(5)] + [(9, f"value {key}B end", "o1", 1), (10, None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, spans int")
    found = {r.doc_id: r.spans for r in secrets.span_digest(secrets.scan_secrets(docs)).collect()}
    assert found == {i: "" for i in range(5)} | {9: "live:6:27", 10: ""}
    assert secrets.scan_secrets(docs.limit(0)).count() == 0


def test_secret_verdict_against_brute_force(spark):
    rng = random.Random(11)
    keys = ["".join(rng.choices("ABCDEFGHJKmnpqrstuvwxyz23456789", k=24)) + "7z" for _ in range(12)]
    # Key i lies in so many documents; the last ones all under one hot owner, the others under up to four.
    rows = []
    for i, key in enumerate(keys):
        for j in range(rng.randint(1, 14) if i < 9 else 2 * secrets.MAX_REPOSITORIES):
            owner = "hot" if i >= 9 else rng.choice(["a", "b", "c", None][: 1 + i % 4])
            rows.append((len(rows), f"see {key} and {key} there", owner))
    rows += rows[:5] + [(None, f"lone {keys[0]}", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    owners, repositories = {}, {}
    for doc, text, owner in rows:
        for key in text.split():
            if key in keys:
                owners.setdefault(key, set()).add(owner)
                repositories.setdefault(key, set()).add((owner, doc))
    expected = []
    for doc, text, owner in rows:
        live = [
            f"live:{m.start()}:{m.end()}"
            for m in re.finditer(r"\S+", text)
            for k in [m[0]]
            if k in keys
            and len(owners[k]) <= secrets.MAX_OWNERS
            and len(repositories[k]) <= secrets.MAX_REPOSITORIES
            and secrets.entropy(k) >= secrets.MIN_ENTROPY
        ]
        expected.append((doc, ",".join(live)))
    found = secrets.span_digest(secrets.scan_secrets(docs)).select("doc_id", "spans").collect()
    assert ordered(tuple(r) for r in found) == ordered(expected)
    assert len({e[1] for e in expected}) > 2
    # Held by one owner alone, yet copied.
    assert all(owners[k] == {"hot"} and len(repositories[k]) > secrets.MAX_REPOSITORIES for k in keys[9:])


def test_secret_short_assignment_uses_its_text():
    assert secrets.findings("token=secret: abcdefghijklmnop") == []


def test_mixing(spark, docs):
    rows = mixing.mix_sources(docs, bucket_rows=7).collect()
    assert len(rows) == docs.count()
    total = sum(r.size for r in rows)
    by = {}
    for r in rows:
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 3 and len(r.positions) == r.copies
        taken, target, size, most = by.get(r.source, (0, r.target, 0, 0))
        by[r.source] = (taken + r.taken, target, size + r.size, max(most, r.size))
    assert sum(t for _, t, _, _ in by.values()) == pytest.approx(total)
    for taken, target, size, most in by.values():
        assert target <= 3 * size + 1e-6 and abs(taken - target) <= 3 * most
    at = [r.position for r in rows]
    assert at == sorted(at, key=lambda x: (x is None, x))
    again = {(r.doc_id, r.size, r.taken) for r in mixing.mix_sources(docs.repartition(3), bucket_rows=7).collect()}
    assert again == {(r.doc_id, r.size, r.taken) for r in rows}
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_targets_by_cutting_and_sharing_anew(spark):
    sizes = {"a": 10, "b": 400, "c": 3, None: 50, "d": 1000}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    found = {r.source: r.target for r in mixing.source_targets(df).collect()}
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    free, left, expected = set(names), sum(sizes.values()), {}
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        for s in over or free:
            expected[s] = 3 * sizes[s] if over else share[s]
        if not over:
            break
        left -= sum(3 * sizes[s] for s in over)
        free -= over
    assert found == pytest.approx(expected)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff_scores(docs, texts, order):
    words = [WORD.findall(t or "") for _, t in texts]
    counts, total = Counter(), sum(map(len, words))
    for w in words:
        for n in range(1, order + 1):
            counts.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))

    def score(w, i):
        out = 0.0
        for n in range(min(order, i + 1), 1, -1):
            gram = tuple(w[i - n + 1 : i + 1])
            if counts[gram] >= 2:
                return out + math.log(counts[gram] / counts[gram[:-1]])
            out += math.log(0.4)
        return out + math.log(counts[(w[i],)] / total)

    expected = ordered((d, len(w), sum(score(w, i) for i in range(len(w)))) for (d, _), w in zip(texts, words, strict=True))
    found = ordered(lm_scoring.score_documents(docs, order).collect())
    assert [r[:2] for r in found] == [r[:2] for r in expected]
    assert [r[2] for r in found] == pytest.approx([r[2] for r in expected])
    assert lm_scoring.score_documents(docs.limit(0), order).count() == 0


@pytest.mark.parametrize("name", sorted(queries.LLM_ORACLE))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    found = queries.LLM_QUERIES[name](spark, SMALL)
    columns = sorted(found.columns)
    expected = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.LLM_ORACLE[name]})").fetchall()
    assert ordered(found.select(*columns).collect()) == ordered(expected)


def test_pipeline(spark):
    docs = read(spark, SMALL, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SMALL)
        assert kept.columns == columns, name
        docs = spark.createDataFrame(kept.collect(), docs.schema)
    labels = {r.doc_id: r.quality for r in read(spark, SMALL, "labels").collect()}
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and not any(labels.get(i) == 0 for i in ids)
    final = corpus_pipeline.run(spark, SMALL)
    assert sorted(r.doc_id for r in final.collect()) == sorted(ids)


def test_pipeline_edges(spark):
    rows = [(d, t, "en", None, 3) for d, t in EDGES] + [(d, t, "en", None, 3) for d, t in EDGES[:2]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0
    assert corpus_pipeline.apply_quality_rules(spark, docs, SMALL).count() == 0
    assert corpus_pipeline.apply_line_dedup(spark, docs, SMALL).count() == len(rows)
    assert corpus_pipeline.apply_near_dedup(spark, docs, SMALL).count() == len(EDGES)
    assert corpus_pipeline.apply_mixing(spark, docs, SMALL).count() == len(rows)


def test_registered_scores_use_trigrams(spark, tmp_path):
    # "c" follows "a b" always, but "b" only half of the time.
    rows = [(i, "a b c") for i in range(4)] + [(i, "x b d") for i in range(4, 8)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r.log_score for r in queries.op9_lm_scoring(spark, str(tmp_path)).collect()}
    # count(a) / words, count(a b) / count(a), count(a b c) / count(a b)
    assert found == {i: round(math.log(4 / 24), 4) for i in range(8)}
