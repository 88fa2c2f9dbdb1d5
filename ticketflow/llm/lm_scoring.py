"""Stupid-backoff scores of documents under n-gram counts of the whole corpus.

Documents are dealt into chunks. A chunk's distinct n-grams are counted in
tables partitioned by hash (see `counts`), the totals are joined to the
exploded n-grams of the chunk, and the scores are summed per document. A
document is never split.

The score of a word w after the words c: count(c w) / count(c) if c w occurs
MIN_COUNT times or more in the corpus, else ALPHA times the score with one word
less before it; for a single word count(w) / number of words. The natural
logarithms are summed. MIN_COUNT is 2, so that a document is not scored by
n-grams that it alone holds once.

Defined cases: a missing or empty text has no words and score 0; repeated rows
count as often as they stand; an empty table gives an empty result; words are
taken as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.counts import LIST, answers, chunked, lists, totals_of
from ticketflow.llm.text import Words, chunks, grams, n_words_of

_KEPT = np.uint64(0xFFFFFFFFFFFFFF00)

ORDER = 3
ALPHA = 0.4
MIN_COUNT = 2


def _grams_of(texts: list, order: int) -> Iterator[tuple[int, Words, list[np.ndarray], list[np.ndarray]]]:
    """For each slice of the texts: first text, words, and per n the gram hashes and whether they lie in one text."""
    for first, _, held in chunks(texts):
        w = Words(held)
        hashes = w.hashes()
        keys, inside = [], []
        for n in range(1, order + 1):
            # The length is part of the hash, so n-grams of all lengths share one table. 56 bits of it are kept: the
            # byte plane left empty is a sixth of what travels.
            keys.append((grams(hashes, n) ^ np.uint64(n * 0x9E3779B9 << 8)) & _KEPT)
            inside.append(w.doc[: len(keys[-1])] == w.doc[n - 1 :] if len(keys[-1]) else np.zeros(0, dtype=bool))
        yield first, w, keys, inside


def _requests(order: int, shards: int):
    def ask(chunk: pd.DataFrame) -> pd.DataFrame:
        parts = [k[i] for _, _, keys, inside in _grams_of(list(chunk["text"]), order) for k, i in zip(keys, inside, strict=True)]
        none = np.zeros(0, dtype=np.uint64)
        keys, counts = np.unique(np.concatenate(parts) if parts else none, return_counts=True)
        return lists(int(chunk["chunk"].iloc[0]), keys, counts, shards)

    return ask


def _found(parts: list[np.ndarray], totals: np.ndarray) -> Iterator[np.ndarray]:
    """The totals of the hashes in each part, one part after the other; `totals` goes by sorted, distinct hash.

    One sort finds the rank of every hash; a binary search for each would miss the cache at every step.
    """
    if not parts:
        return
    keys = np.concatenate(parts)
    order = np.argsort(keys)
    keys = keys[order]
    rank = np.cumsum(np.concatenate([[0], keys[1:] != keys[:-1]])) if len(keys) else order
    every = np.empty(len(order), dtype=np.float64)
    every[order] = totals[rank]
    yield from np.split(every, np.cumsum([len(p) for p in parts])[:-1])


def _scores(order: int, alpha: float, min_count: int, total: int):
    def score(chunk: pd.DataFrame, answered: pd.DataFrame) -> pd.DataFrame:
        texts = list(chunk["text"])
        slices = list(_grams_of(texts, order))
        parts = [k[i] for _, _, keys, inside in slices for k, i in zip(keys, inside, strict=True)]
        found = _found(parts, totals_of(answered))
        n_words, sums = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts))
        for first, w, keys, inside in slices:
            n = len(w.doc)
            size = np.diff(w.first)
            n_words[first : first + len(size)] = size
            if not n:
                continue
            spread = []
            for i in inside:
                full = np.zeros(n)
                full[np.flatnonzero(i)] = next(found)
                spread.append(full)
            logs = (order - 1) * np.log(alpha) + np.log(spread[0] / total)
            # A word that has fewer words before it starts with a shorter n-gram and pays for no backoff it could not make.
            place = np.arange(n) - w.first[w.doc]
            logs -= np.maximum(order - 1 - place, 0) * np.log(alpha)
            for k in range(2, order + 1):
                seen = np.zeros(n)
                before = np.ones(n)
                seen[k - 1 :] = spread[k - 1][: n - k + 1]
                before[k - 1 :] = spread[k - 2][: n - k + 1]
                use = (place >= k - 1) & (seen >= min_count)
                rest = np.maximum(np.minimum(place, order - 1) - (k - 1), 0)
                logs[use] = np.log(seen[use] / before[use]) + rest[use] * np.log(alpha)
            sums[first : first + len(size)] = np.bincount(w.doc, weights=logs, minlength=len(size))
        return pd.DataFrame({"doc_id": chunk["doc_id"], "n_words": n_words, "log_score": sums})

    return score


def score_documents(
    docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, min_count: int = MIN_COUNT
) -> DataFrame:
    """(doc_id, n_words, log_score) for every row of `docs`: the sum of the natural logarithms of its words' scores."""
    whole = docs.agg(F.sum(F.length("text")).alias("chars"), F.sum(n_words_of(F.col("text"))).alias("words")).first()
    size, total = whole["chars"] or 0, whole["words"] or 0
    # Ids travel as text, so that a missing one stays missing.
    rows, shards = chunked(docs.select(F.col("doc_id").cast("string"), "text"), size)
    by_chunk = rows.groupBy("chunk")
    asked = by_chunk.applyInPandas(_requests(order, shards), LIST)
    answered = answers(asked)
    scored = by_chunk.cogroup(answered.groupBy("chunk")).applyInPandas(
        _scores(order, alpha, min_count, total), "doc_id string, n_words long, log_score double"
    )
    return scored.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
