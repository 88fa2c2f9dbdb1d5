"""Line deduplication with two Bloom filters.

Hashes of line keys are dealt out by hash. Every task streams its share into
two Bloom filters, one for hashes seen once and one for hashes seen twice, and
passes on the hashes that the second one holds: suspected repeats. Only the
suspected lines shuffle again, with a cryptographic digest of their key, for
exact counting of documents and the choice of the document that keeps them.

A task's filters have BITS_PER_HASH bits for each hash it holds, so the share
of false suspects is the same at every size; a false suspect only costs its
shuffle, the exact count clears it. Before they are dealt out, equal hashes of
an Arrow batch are merged into one row with a mark "seen twice", so a line
that very many documents share brings a row per batch, not one per document.

Defined cases: a missing or empty text is one empty line and stays; a line
found often in one document only counts once; rows that share a doc_id count as
one document; a missing doc_id counts as smaller than every other; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.text import SPACES, mix, set_aside

# Fixed by the contract: code points a key must have, documents it must be in.
MIN_LENGTH = 40
MIN_DOCS = 5
BITS_PER_HASH = 12
PROBES = 4


class Bloom:
    """A Bloom filter over 64-bit hashes, a power of two of bits."""

    def __init__(self, expected: int):
        self.log = max(10, int(np.ceil(np.log2(max(1, expected) * BITS_PER_HASH))))
        self.bits = np.zeros(1 << (self.log - 3), dtype=np.uint8)

    def _places(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        step = mix(hashes) | np.uint64(1)
        for k in range(PROBES):
            yield (hashes + np.uint64(k) * step) >> np.uint64(64 - self.log)

    def add(self, hashes: np.ndarray) -> None:
        for at in self._places(hashes):
            np.bitwise_or.at(self.bits, at >> np.uint64(3), (1 << (at & np.uint64(7))).astype(np.uint8))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), dtype=bool)
        for at in self._places(hashes):
            found &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return found


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Equal hashes of a batch as one row; `twice` says whether there were several."""
    for batch in batches:
        hashes, counts = np.unique(batch["h"].to_numpy(), return_counts=True)
        yield pd.DataFrame({"h": hashes, "twice": counts > 1})


def _suspects(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The hashes of this task that its filter of twice-seen hashes holds, each once."""
    held = [(b["h"].to_numpy().view(np.uint64), b["twice"].to_numpy()) for b in batches]
    expected = sum(len(h) for h, _ in held)
    once, twice = Bloom(expected), Bloom(expected)
    for hashes, several in held:
        hashes, place, counts = np.unique(mix(hashes), return_index=True, return_counts=True)
        again = several[place] | (counts > 1) | once.has(hashes)
        twice.add(hashes[again])
        once.add(hashes)
    for hashes, _ in held:
        hashes = np.unique(hashes)
        found = hashes[twice.has(mix(hashes))]
        if len(found):
            yield pd.DataFrame({"h": found.view(np.int64)})


def _key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def dropped_lines(docs: DataFrame, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, row, line): places of the lines to drop, in all documents but the one that keeps them; row is the hash
    of id and text."""
    # Keys are made inside the array, so that each is made once and the filter stays above.
    keys = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), _key)
    lines = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), keys.alias("_k"))
    lines = lines.select("doc_id", "row", F.posexplode_outer("_k").alias("line", "key"))
    lines = lines.filter(F.length("key") >= min_length)
    hashed = lines.select(F.xxhash64("key").alias("h")).mapInPandas(_merge, "h long, twice boolean")
    suspects = hashed.repartition("h").mapInPandas(_suspects, "h long").distinct()
    digest = F.unhex(F.sha2(F.col("key").cast("binary"), 256)).alias("digest")
    marked = lines.select(F.xxhash64("key").alias("h"), "doc_id", "row", "line", digest)
    suspected = marked.join(suspects, "h", "left_semi").select("digest", "doc_id", "row", "line")
    counted = suspected.select("digest", "doc_id").distinct()
    counted = counted.groupBy("digest").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
    often = counted.filter(F.col("n") >= min_docs).select(F.col("digest").alias("_d"), "keeper")
    drops = suspected.join(often, F.col("digest") == F.col("_d"))
    return drops.filter(~F.col("doc_id").eqNullSafe(F.col("keeper"))).select("doc_id", "row", "line")


def dedup_lines(docs: DataFrame, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS) -> DataFrame:
    """The rows of `docs` (doc_id, text, any others) with `kept_text`, n_lines and n_dropped.

    Lines with a key of `min_length` code points or more that `min_docs`
    documents hold stay only in the largest doc_id. Columns named like the new
    ones are replaced.
    """
    docs, names = set_aside(docs.drop("kept_text", "n_lines", "n_dropped"))
    drops = dropped_lines(docs, min_length, min_docs).groupBy("doc_id", "row")
    drops = drops.agg(F.collect_set("line").alias("_drop")).withColumnRenamed("doc_id", "_id")
    own = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("doc_id", "text") == F.col("row"))
    joined = docs.join(drops.hint("shuffle_hash"), own, "left")
    joined = joined.select(*docs.columns, "_drop", F.split(F.coalesce("text", F.lit("")), "\n").alias("_lines"))
    # A difference of two arrays of places, for it takes time in proportion to the lines.
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drop"))
    stays = F.transform(places, lambda i: F.get("_lines", i))
    joined = joined.withColumn("_kept", F.when(F.col("_drop").isNull(), F.col("_lines")).otherwise(stays))
    return joined.select(
        *docs.columns,
        F.array_join("_kept", "\n").alias("kept_text"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_kept")).cast("long").alias("n_dropped"),
    ).withColumnsRenamed(names)
