"""Benchmark decontamination by greedy string tiling.

A text and a benchmark item that share a seed (MIN_MATCH consecutive words,
compared by rolling hash) are tiled: again and again the longest match between
words not marked yet, in text and item, is marked as a tile, until the longest
is shorter than MIN_MATCH. Tiles may lie in any order, so a reordered passage is
covered as well as a straight one. An item whose words are covered to COVERAGE
or more contaminates the text.

The benchmark is the stated query set. It is taken in blocks of at most
BLOCK_BYTES, and each block goes to all executors and meets every row of the
corpus: nothing that is sent grows with the benchmark or the corpus, and no
text is shuffled. Words are compared with A-Z lower-cased.

Defined cases: a missing or empty text is clean; an item with fewer words than
MIN_MATCH is looked for as a whole; an item without words matches nothing; an
item without item_id counts like any other and is reported with a NULL id;
repeated rows are judged each; an empty benchmark leaves every text clean; an
empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.text import Words, chunks, grams

MIN_MATCH = 5
COVERAGE = 0.6
BLOCK_BYTES = 8 << 20
# So many seed matches are held at a time; a text and an item that both repeat themselves have very many.
PAIRS = 1 << 20

HITS = "array<struct<item_id:bigint,coverage:double,tiles:array<struct<first:int,length:int>>>>"


class Block:
    """Benchmark items as word hashes, and the seeds that lead to them."""

    def __init__(self, items: list[tuple[int | None, str]], min_match: int):
        self.ids, self.words, self.min_match = [], [], min_match
        w = Words([text.encode("utf-8", "surrogatepass").lower() for _, text in items])
        hashes = w.hashes()
        seeds: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for k, (item_id, _) in enumerate(items):
            own = hashes[w.first[k] : w.first[k + 1]]
            if len(own):
                length = min(min_match, len(own))
                found = grams(own, length)
                seeds.setdefault(length, []).append(
                    (found, np.full(len(found), len(self.ids)), np.arange(len(found)))
                )
                self.ids.append(item_id)
                self.words.append(own)
        self.seeds = {}
        for length, parts in seeds.items():
            keys, item, at = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(keys, kind="stable")
            maybe = np.zeros(1 << 22, dtype=bool)
            maybe[keys >> np.uint64(42)] = True
            self.seeds[length] = keys[order], item[order], at[order], maybe

    def hits(self, length: int, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place in `keys`, item, place in the item) for every seed among `keys`, some PAIRS at a time, in order of
        place."""
        known, item, at, maybe = self.seeds[length]
        place = np.flatnonzero(maybe[keys >> np.uint64(42)])
        low = np.searchsorted(known, keys[place], "left")
        many = np.searchsorted(known, keys[place], "right") - low
        place, low, many = place[many > 0], low[many > 0], many[many > 0]
        cuts = np.flatnonzero(np.diff(np.cumsum(many) // PAIRS)) + 1
        for part in np.split(np.arange(len(place)), cuts):
            n = many[part]
            chosen = np.repeat(low[part] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            yield np.repeat(place[part], n), item[chosen], at[chosen]


def _joined(runs: np.ndarray) -> np.ndarray:
    """Rows (text place, item, item place, seeds) with those that go on along a diagonal of one item joined."""
    diagonal = runs[:, 0] - runs[:, 2]
    order = np.lexsort((runs[:, 0], diagonal, runs[:, 1]))
    runs, diagonal = runs[order], diagonal[order]
    if not len(runs):
        return runs
    same = (np.diff(diagonal) == 0) & (np.diff(runs[:, 1]) == 0) & (np.diff(runs[:, 0]) == runs[:-1, 3])
    begin = np.flatnonzero(np.concatenate(([True], ~same)))
    out = runs[begin]
    out[:, 3] = np.add.reduceat(runs[:, 3], begin)
    return out


def tile(pairs: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in the text, place in the item, words) from seed matches.

    `pairs` has a row (text place, item place) for each seed of `length` words.
    """
    seeds = np.stack((pairs[:, 0], np.zeros_like(pairs[:, 0]), pairs[:, 1], np.ones_like(pairs[:, 0])), axis=1)
    return _tiles([(int(a), int(b), int(n) + length - 1) for a, _, b, n in _joined(seeds)], length)


def _tiles(runs: list[tuple[int, int, int]], length: int) -> list[tuple[int, int, int]]:
    """Greedy tiles from matches (place in the text, place in the item, words), each a maximal run along a diagonal.

    The longest is marked first (ties: earliest in the item, then in the text);
    what it overlaps is cut back to the words still free.
    """
    tiles, used_text, used_item = [], set(), set()
    while runs:
        runs.sort(key=lambda r: (-r[2], r[1], r[0]))
        a, b, n = runs[0]
        tiles.append((a, b, n))
        used_text.update(range(a, a + n))
        used_item.update(range(b, b + n))
        left = []
        for x, y, m in runs[1:]:
            if x + m <= a or a + n <= x:
                if y + m <= b or b + n <= y:
                    left.append((x, y, m))
                    continue
            first = None
            for k in range(m + 1):
                free = k < m and x + k not in used_text and y + k not in used_item
                if free and first is None:
                    first = k
                elif not free and first is not None:
                    if k - first >= length:
                        left.append((x + first, y + first, k - first))
                    first = None
        runs = left
    return tiles


def _scan(texts: list, block: Block, coverage: float) -> list[list[dict]]:
    out: list[list[dict]] = []
    for _, _, held in chunks(texts):
        w = Words([t.lower() for t in held])
        hashes = w.hashes()
        found: dict[int, list[dict]] = {}
        for length in block.seeds:
            keys = grams(hashes, length)
            inside = w.doc[: len(keys)] == w.doc[length - 1 :] if len(keys) else np.zeros(0, dtype=bool)
            runs = [np.zeros((0, 4), dtype=np.int64)]
            for place, item, at in block.hits(length, keys):
                ok = inside[place]
                place = place[ok]
                runs.append(_joined(np.stack((place, item[ok], at[ok], np.ones_like(place)), axis=1)))
            runs = _joined(np.concatenate(runs)) if len(runs) > 2 else runs[-1]
            doc, item = w.doc[runs[:, 0]], runs[:, 1]
            order = np.lexsort((item, doc))
            runs, doc, item = runs[order], doc[order], item[order]
            cuts = np.flatnonzero((np.diff(doc) != 0) | (np.diff(item) != 0)) + 1
            for part in np.split(np.arange(len(doc)), cuts):
                if not len(part):
                    continue
                d, k = int(doc[part[0]]), int(item[part[0]])
                total = len(block.words[k])
                sizes = runs[part, 3] + length - 1
                if sizes.sum() < coverage * total:
                    continue  # the matches cannot cover so much
                places = (runs[part, 0] - w.first[d]).tolist(), runs[part, 2].tolist(), sizes.tolist()
                tiles = _tiles(list(zip(*places, strict=True)), length)
                share = sum(n for _, _, n in tiles) / total
                if share >= coverage:
                    found.setdefault(d, []).append(
                        {
                            "item_id": block.ids[k],
                            "coverage": share,
                            "tiles": [{"first": a, "length": n} for a, _, n in sorted(tiles)],
                        }
                    )
        out.extend(sorted(found.get(d, []), key=lambda x: (x["item_id"] is not None, x["item_id"] or 0)) for d in range(len(held)))
    return out


def _blocks(benchmark: DataFrame, block_bytes: int, min_match: int) -> Iterator[Block]:
    held, size = [], 0
    rows = benchmark.filter("text IS NOT NULL").select("item_id", "text")
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        if held and size + len(row["text"]) > block_bytes:
            yield Block(held, min_match)
            held, size = [], 0
        held.append((row["item_id"], row["text"]))
        size += len(row["text"])
    if held:
        yield Block(held, min_match)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    min_match: int = MIN_MATCH,
    block_bytes: int = BLOCK_BYTES,
    name: str = "leaks",
) -> DataFrame:
    """The rows of `docs` with `leaks`: an array of (item_id, coverage, tiles) for every item a text contains; a column
    of that name is replaced.

    A tile is a run of words of the text (first word, number of words).
    """

    def scanner(block: Block) -> Column:
        held = docs.sparkSession.sparkContext.broadcast(block)

        @F.pandas_udf(HITS)
        def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series(_scan(list(texts), held.value, coverage), dtype=object)

        return scan.asNondeterministic()("text")

    found = [scanner(block) for block in _blocks(benchmark, block_bytes, min_match)]
    if not found:
        return docs.withColumn(name, F.array().cast(HITS))
    names = [f"_{uuid.uuid4().hex}" for _ in found]
    out = docs.withColumns(dict(zip(names, found, strict=True)))
    return out.withColumn(name, F.concat(*names)).drop(*names)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options: float) -> DataFrame:
    """The rows and columns of `docs` that contain no benchmark item."""
    name = f"_{uuid.uuid4().hex}"
    return leaks(docs, benchmark, name=name, **options).filter(F.size(name) == 0).drop(name)
