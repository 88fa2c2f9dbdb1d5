"""N-gram Jaccard join with several global token orders.

A document's set holds its distinct word shingles. Documents with equal sets
form a class, and only one set per class goes on. Two sets with a similarity
of `percent` or more must share a token among the first p = n - ceil(n *
percent / 100) + 1 of each, under any order of all tokens. Several orders are
used: each puts rare tokens first, by the power of two of their document count
over the whole corpus (see `counts`), and differs in how it orders equals.

Tokens shared under the first order connect sets to candidate groups, without
any pair being written. Tokens of one document only connect nothing and are
left out. The sets of a group then meet in one task, or, if they
are many, block by block. There the other orders are intersected: a pair is
verified only if it shares a prefix token under every order and is not yet
connected. So a group of many copies costs about one check per copy, and what
leaves the task is a forest of links, never all pairs.

Bounds: a chunk and a shard of counts have a fixed size; a block holds about
BLOCK_TOKENS tokens, or one set.

Defined cases: a document with fewer words than a shingle has its whole
sequence as its one shingle; without words its set is empty and it is linked
with nothing; rows that share a doc_id count as one document and share its
component; a missing doc_id is one id below all others; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.components import components
from ticketflow.llm.counts import LIST, answers, chunked, lists, totals_of
from ticketflow.llm.text import Words, chunks, cut_lineage, grams, mix, set_aside

BLOCK_TOKENS = 1 << 20
SEEDS = (0x51ED270B, 0xA24BAED5, 0x9FB21C65)
_NO_ID = -(1 << 63)


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each, and where each text's begin (one more at the end)."""
    w = Words([t.lower() for t in texts])
    hashes = w.hashes()
    size = np.diff(w.first)
    found = grams(hashes, words)
    many = np.maximum(size - words + 1, 0)
    at = np.repeat(w.first[:-1], many) + (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many))
    doc, token = np.repeat(np.arange(len(texts)), many), found[at]
    short = np.flatnonzero((size > 0) & (size < words))
    if len(short):
        whole = [grams(hashes[w.first[d] : w.first[d + 1]], int(size[d]))[0] for d in short]
        # Marked by length, so that a short text never equals a shingle.
        whole = mix(np.array(whole, dtype=np.uint64) + size[short].astype(np.uint64))
        doc, token = np.concatenate((doc, short)), np.concatenate((token, whole))
    order = np.lexsort((token, doc))
    doc, token = doc[order], token[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (token[1:] != token[:-1])
    doc, token = doc[new], token[new]
    return token, np.searchsorted(doc, np.arange(len(texts) + 1))


def levels_of(counts: np.ndarray) -> np.ndarray:
    """The power of two of each document count, 15 at most."""
    return np.minimum(np.log2(np.maximum(counts, 1)), 15).astype(np.uint8)


def prefixes(token: np.ndarray, level: np.ndarray, first: np.ndarray, seed: int, percent: int) -> np.ndarray:
    """Which tokens are in the prefix of their set under one order."""
    key = (level.astype(np.uint64) << np.uint64(60)) | (mix(token ^ np.uint64(seed * 0x9E3779B1)) >> np.uint64(4))
    size = np.diff(first)
    length = np.where(size > 0, size + (-percent * size // 100) + 1, 0)
    order = np.lexsort((key, np.repeat(np.arange(len(size)), size)))
    place = np.arange(len(token)) - np.repeat(first[:-1], size)
    mask = np.zeros(len(token), dtype=bool)
    mask[order] = place < np.repeat(length, size)
    return mask


def _requests(words: int, shards: int):
    def ask(chunk: pd.DataFrame) -> pd.DataFrame:
        parts = [shingle_sets(held, words)[0] for _, _, held in chunks(list(chunk["text"]))]
        keys, counts = np.unique(np.concatenate(parts), return_counts=True)
        return lists(int(chunk["chunk"].iloc[0]), keys, counts, shards)

    return ask


_SET = "doc_id long, n long, set binary, front array<long>, tokens binary, levels binary"


def _sets(words: int, percent: int):
    def fronts(chunk: pd.DataFrame, answered: pd.DataFrame) -> pd.DataFrame:
        slices = [(begin, held, *shingle_sets(held, words)) for begin, _, held in chunks(list(chunk["text"]))]
        known = np.unique(np.concatenate([token for _, _, token, _ in slices])) if slices else np.zeros(0, dtype=np.uint64)
        counts = totals_of(answered)
        ids, out = chunk["doc_id"].tolist(), []
        for begin, held, token, first in slices:
            count = counts[np.searchsorted(known, token)] if len(token) else np.zeros(0, dtype=np.int64)
            level = levels_of(count)
            # A token of one document joins it to no other.
            mask = prefixes(token, level, first, SEEDS[0], percent) & (count > 1)
            for d in range(len(held)):
                own = slice(first[d], first[d + 1])
                data = token[own].tobytes()
                front = token[own][mask[own]].view(np.int64)
                full = (data, level[own].tobytes()) if len(front) else (None, None)
                digest = hashlib.blake2b(data, digest_size=16).digest()
                out.append((ids[begin + d], int(first[d + 1] - first[d]), digest, front, *full))
        return pd.DataFrame(out, columns=["doc_id", "n", "set", "front", "tokens", "levels"])

    return fronts


class _Postings:
    """The members that hold each token."""

    def __init__(self, member: np.ndarray, token: np.ndarray, n_tokens: int):
        order = np.argsort(token, kind="stable")
        self.members = member[order]
        counts = np.bincount(token, minlength=n_tokens)
        self.at = np.concatenate(([0], np.cumsum(counts)))

    def of(self, tokens: np.ndarray) -> np.ndarray:
        low = self.at[tokens]
        many = self.at[tokens + 1] - low
        total = int(many.sum())
        inner = np.arange(total) - np.repeat(np.cumsum(many) - many, many)
        return self.members[np.repeat(low, many) + inner]


def links(
    sets: list[np.ndarray], levels: list[np.ndarray], side: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """A forest of links between sets: enough to connect all that are connected by links between different sides.

    `side` is 0 throughout when every pair counts, else 0 or 1 for the two
    blocks between which pairs count.
    """
    m = len(sets)
    size = np.array([len(s) for s in sets])
    across = side.any()
    first = np.concatenate(([0], np.cumsum(size)))
    raw, level = np.concatenate(sets), np.concatenate(levels)
    known, token = np.unique(raw, return_inverse=True)
    member = np.repeat(np.arange(m), size)
    every = _Postings(member, token, len(known))
    fronts = []
    for seed in SEEDS:
        mask = prefixes(raw, level, first, seed, percent)
        where = np.concatenate(([0], np.cumsum(np.bincount(member[mask], minlength=m))))
        fronts.append((token[mask], where, _Postings(member[mask], token[mask], len(known))))
    group = np.arange(m)
    forest = []
    for x in range(1, m):
        shared = np.zeros(m, dtype=np.int8)
        for chosen, where, postings in fronts:
            hit = np.zeros(m, dtype=bool)
            hit[postings.of(chosen[where[x] : where[x + 1]])] = True
            shared += hit
        maybe = shared[:x] == len(fronts)
        maybe &= group[:x] != group[x]
        maybe &= 100 * np.minimum(size[:x], size[x]) >= percent * np.maximum(size[:x], size[x])
        if across:
            maybe &= side[:x] != side[x]
        maybe = np.flatnonzero(maybe)
        if not len(maybe):
            continue
        both = np.bincount(every.of(token[first[x] : first[x + 1]]), minlength=m)[maybe]
        for y in maybe[100 * both >= percent * (size[maybe] + size[x] - both)]:
            if group[y] != group[x]:
                forest.append((x, int(y)))
                group[group == group[y]] = group[x]
    return forest


def _verify(percent: int):
    def of(held: list) -> Iterator[pd.DataFrame]:
        if len(held) > 1:
            sets = [np.frombuffer(r.tokens, dtype=np.uint64) for r in held]
            levels = [np.frombuffer(r.levels, dtype=np.uint8) for r in held]
            side = np.array([r.block != r.low for r in held])
            forest = links(sets, levels, side, percent)
            if forest:
                yield pd.DataFrame([(held[a].node, held[b].node) for a, b in forest], columns=["a", "b"])

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []
        for batch in batches:
            for row in batch.itertuples(index=False):
                if held and (row.label, row.low, row.high) != (held[0].label, held[0].low, held[0].high):
                    yield from of(held)
                    held = []
                held.append(row)
        yield from of(held)

    return scan


def near_components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `docs`, a missing id as the smallest number.

    component_id is the smallest doc_id that links reach. Two documents link
    when their sets' intersection is `percent` hundredths of their union or
    more.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"), "text")
    rows, shards = chunked(rows, rows.agg(F.sum(F.length("text"))).first()[0] or 0)
    by_chunk = rows.groupBy("chunk")
    answered = answers(by_chunk.applyInPandas(_requests(words, shards), LIST))
    sets = cut_lineage(by_chunk.cogroup(answered.groupBy("chunk")).applyInPandas(_sets(words, percent), _SET))
    # One node per class of equal sets: its smallest doc_id.
    classes = cut_lineage(sets.filter("n > 0").groupBy("set").agg(F.min("doc_id").alias("node")))
    keeper = classes.withColumnRenamed("set", "_s")
    candidates = sets.filter("tokens IS NOT NULL").join(
        keeper, (F.col("set") == F.col("_s")) & (F.col("doc_id") == F.col("node"))
    )
    shared = cut_lineage(candidates.select("node", F.explode("front").alias("token")))
    least = shared.groupBy("token").agg(F.min("node").alias("b"), F.max("node").alias("c")).filter("b < c")
    edges = shared.join(least, "token").filter("node <> b").select(F.col("node").alias("a"), "b")
    groups = cut_lineage(components(edges)).withColumnsRenamed({"node": "_node", "component": "label"})
    members = candidates.select("node", "n", "tokens", "levels").join(groups, F.col("node") == F.col("_node")).drop("_node")
    blocks = members.groupBy("label").agg(F.ceil(F.sum("n") / BLOCK_TOKENS).alias("blocks"))
    members = members.join(blocks.withColumnRenamed("label", "_l"), F.col("label") == F.col("_l"))
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    )
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    dealt = members.select("node", "label", "block", low, high, "tokens", "levels")
    dealt = dealt.repartition("label", "low", "high").sortWithinPartitions("label", "low", "high", "node")
    forest = dealt.mapInPandas(_verify(percent), "a long, b long")
    found = components(forest).withColumnsRenamed({"node": "_node", "component": "_component"})
    # Classes get their component first. The documents then meet them in one join of two tables, which adaptive
    # execution can split where very many documents hold one set.
    placed = classes.join(found, F.col("node") == F.col("_node"), "left")
    placed = cut_lineage(placed.select(F.col("set").alias("_s"), F.coalesce("_component", "node").alias("_c")))
    named = sets.select("doc_id", "n", "set").join(placed, F.col("set") == F.col("_s"), "left")
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("_c", "doc_id").alias("component_id"))


def jaccard_join(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """As `near_components`, with missing ids as NULL again."""
    back = lambda c: F.nullif(F.col(c), F.lit(_NO_ID)).alias(c)
    return near_components(docs, words, percent).select(back("doc_id"), "n_shingles", back("component_id"))


def keep_one(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The rows of `docs` without near duplicates: of each component the document with the smallest id stays, and of
    rows equal in id and text one."""
    found = near_components(docs, words, percent).filter("doc_id = component_id")
    docs, names = set_aside(docs)
    ids = found.select(F.col("doc_id").alias("_id")).distinct()
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    kept = docs.join(ids.hint("shuffle_hash"), own == F.col("_id"), "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.withColumnsRenamed(names)
