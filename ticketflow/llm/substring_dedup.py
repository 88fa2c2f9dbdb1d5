"""Substring deduplication with a compressed FM-index per shard.

Words are the symbols. Shards hold the segments around repeated anchors (see
`repeats`). Over the segments of a shard stands an FM-index: the
Burrows-Wheeler transform of the segments in a wavelet matrix, plain bits with
sampled counts. The segments are streamed against it: backward search gives
the occurrences of ever longer matches, and every window that occurs twice or
more is reported. Searches run side by side for all segments.

A window found twice anywhere, in one document or two, is removed everywhere.

Defined cases: a missing or empty text has no words; a text shorter than the
window is kept; rows equal in doc_id and text are copies of one another, and
so their windows are repeated; an empty table gives an empty result; words
that contain odd characters are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.repeats import Plan, as_words, covered, named, removals
from ticketflow.llm.text import Words, chunks

WINDOW = 35
GRAM = 10
SHARD_BYTES = 4 << 20


class WaveletMatrix:
    """Rank over a sequence of numbers: one bit vector per bit, highest first."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            ones = (values >> bit) & 1
            padded = np.zeros((len(values) // 64 + 1) * 64, dtype=np.uint8)
            padded[: len(values)] = ones
            packed = np.packbits(padded, bitorder="little").view("<u8")
            counts = np.concatenate(([0], np.cumsum(np.bitwise_count(packed).astype(np.int64))))[:-1]
            zeros = len(values) - int(ones.sum())
            self.levels.append((bit, packed, counts, zeros))
            values = np.concatenate((values[ones == 0], values[ones == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position, less the symbol's own start in the last level."""
        for bit, packed, counts, zeros in self.levels:
            word = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = counts[word] + np.bitwise_count(packed[word] & below)
            at = np.where((symbol >> bit) & 1, zeros + ones, at - ones)
        return at


class FMIndex:
    """Occurrence counts of word sequences in a set of segments, each ended by a separator."""

    def __init__(self, segments: list[np.ndarray]):
        sizes = np.array([len(s) for s in segments])
        known, ids = np.unique(np.concatenate(segments), return_inverse=True)
        # Symbol 0 is the separator; separators sort in the order of their segments, below all words.
        n, m = int(sizes.sum()) + len(sizes), len(sizes)
        text = np.zeros(n, dtype=np.int64)
        self.first = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
        solid = np.ones(n, dtype=bool)
        solid[self.first + sizes] = False
        text[solid] = ids + 1
        rank = text + m - 1
        rank[~solid] = np.arange(m)
        order, step = np.argsort(rank), 1
        while True:
            key = rank[order]
            dense = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
            rank = np.empty(n, dtype=np.int64)
            rank[order] = dense
            if dense[-1] == n - 1:
                break
            ahead = np.zeros(n, dtype=np.int64)
            ahead[: n - step] = rank[step:] + 1
            rank = rank * (n + 1) + ahead
            order, step = np.argsort(rank), step * 2
        self.text = text
        bwt = text[order - 1]
        bits = max(1, int(len(known)).bit_length())
        self.matrix = WaveletMatrix(bwt, bits)
        self.n = n
        # Where each symbol's suffixes begin, less where its run begins in the last level of the matrix.
        begins = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=len(known) + 1))))[:-1]
        symbols = np.arange(len(known) + 1)
        self.shift = begins - self.matrix.rank(symbols, np.zeros(len(symbols), dtype=np.int64))

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals after putting a symbol in front."""
        both = self.matrix.rank(np.concatenate((symbol, symbol)), np.concatenate((low, high)))
        shift = self.shift[symbol]
        return both[: len(low)] + shift, both[len(low) :] + shift


def repeated_in(index: FMIndex, sizes: np.ndarray, length: int) -> np.ndarray:
    """For all segments in turn, which of their windows occur at least twice in the index.

    A search starts at the right end of `ahead` + 1 windows and goes left. If
    it reaches the first of them with two occurrences left, all of them repeat,
    and the next search takes more windows at once. If it stops before, no
    window over the place where it stopped repeats: a search over one window
    goes on behind that place, one over more starts again with one window.
    """
    lanes = np.arange(len(sizes))
    windows = sizes - length + 1
    mark_at = np.concatenate(([0], np.cumsum(np.maximum(windows, 0))))
    marked = np.zeros(mark_at[-1] + 1, dtype=np.int64)
    window, ahead = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    left = window + length
    low, high = np.zeros(len(sizes), dtype=np.int64), np.full(len(sizes), index.n)
    lanes = lanes[windows > 0]
    while len(lanes):
        symbol = index.text[index.first[lanes] + left[lanes] - 1]
        a, b = index.extend(symbol, low[lanes], high[lanes])
        good = b - a >= 2
        ok, bad = lanes[good], lanes[~good]
        left[ok] -= 1
        low[ok], high[ok] = a[good], b[good]
        done = ok[left[ok] == window[ok]]
        np.add.at(marked, mark_at[done] + window[done], 1)
        np.add.at(marked, mark_at[done] + window[done] + ahead[done] + 1, -1)
        window[done] += ahead[done] + 1
        ahead[done] = np.minimum(2 * ahead[done] + 1, 31)
        one = bad[ahead[bad] == 0]
        window[one] = left[one]
        ahead[bad] = 0
        again = np.concatenate((done, bad))
        ahead[again] = np.minimum(ahead[again], np.maximum(windows[again] - 1 - window[again], 0))
        left[again] = window[again] + ahead[again] + length
        low[again], high[again] = 0, index.n
        lanes = lanes[window[lanes] < windows[lanes]]
    return np.cumsum(marked)[:-1] > 0


def judge(
    contents: list[bytes], windows: np.ndarray, n: np.ndarray, docs: np.ndarray, begins: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Every window of a segment that occurs twice, and every window the index finds twice, goes everywhere."""
    w = Words(contents)
    hashes = w.hashes()
    segments = [hashes[w.first[k] : w.first[k + 1]] for k in range(len(contents))]
    found = repeated_in(FMIndex(segments), np.diff(w.first), WINDOW) | np.repeat(n > 1, windows)
    return found, np.zeros(len(found), dtype=bool)


PLAN = Plan(as_words, WINDOW, GRAM, SHARD_BYTES, False, judge)


def _rest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        spans, whole = list(batch["spans"]), batch["whole"].tolist()
        for first, last, held in chunks(batch["text"]):
            w = Words(held)
            kept, total, gone = [], [], []
            for d in range(len(held)):
                a, b = int(w.first[d]), int(w.first[d + 1])
                drop = covered(spans[first + d], whole[first + d], b - a, WINDOW)
                stay = np.flatnonzero(~drop) + a
                data = held[d]
                base = int(w.at[d])
                words = [data[s - base : e - base] for s, e in zip(w.starts[stay], w.ends[stay], strict=True)]
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                total.append(b - a)
                gone.append(int(drop.sum()))
            part = batch.iloc[first:last]
            yield pd.DataFrame(
                {"doc_id": part["doc_id"], "kept_text": kept, "n_words": total, "n_removed": gone}
                | {"spans": spans[first:last], "whole": whole[first:last]}
            )


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, kept_text (words joined by a space), n_words, n_removed, spans,
    whole.

    spans holds the first and last repeated window (word numbers) of every
    stretch, flat; NULL where nothing repeats. whole says that all windows are
    repeated because another row has the same text.
    """
    kept = removals(docs, PLAN).mapInPandas(
        _rest, "doc_id long, kept_text string, n_words long, n_removed long, spans array<int>, whole boolean"
    )
    return named(kept)


def substring_digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )
