"""Corpus-wide counts of hashes, looked up by chunks of documents.

A chunk of documents lists its distinct hashes with their counts, split over
shards by hash. A shard adds up the counts of all chunks (its part of the count
table) and answers each list with the totals, in the list's order. A list
travels as one row: sorted 64-bit hashes as packed differences. A hash that
every document holds is one entry per chunk, so no hash is hot. Chunks and
shards grow in number with the corpus, not in size.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_CHARS = 8 << 20
SHARD_CHARS = 24 << 20

LIST = "chunk long, shard int, keys binary, counts binary"
ANSWER = "chunk long, shard int, totals binary"


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed; small numbers leave high planes empty.

    Planes hold runs or noise and no repeated strings, so only runs are sought.
    """
    packer = zlib.compressobj(1, strategy=zlib.Z_RLE)
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return packer.compress(planes.tobytes()) + packer.flush()


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def lists(chunk: int, keys: np.ndarray, counts: np.ndarray, shards: int) -> pd.DataFrame:
    """The rows that a chunk sends for its sorted, distinct hashes."""
    # Shards are equal ranges of the hash's upper half.
    shard = ((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
    bounds = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
    out = [
        (chunk, s, _pack(np.diff(keys[a:b], prepend=np.uint64(0))), _pack(counts[a:b]))
        for s, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))
        if a < b
    ]
    return pd.DataFrame(out, columns=["chunk", "shard", "keys", "counts"])


def _answers(shard: pd.DataFrame) -> pd.DataFrame:
    held = [np.cumsum(_unpack(k), dtype=np.uint64) for k in shard["keys"]]
    keys = np.concatenate(held)
    counts = np.concatenate([_unpack(c) for c in shard["counts"]]).astype(np.int64)
    # The lists are sorted runs, which the stable sort merges. Equal keys then stand together and are summed.
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sums = np.add.reduceat(counts[order], first)
    totals = np.empty(len(keys), dtype=np.int64)
    totals[order] = np.repeat(sums, np.diff(first, append=len(keys)))
    back = np.split(totals, np.cumsum([len(x) for x in held])[:-1])
    return pd.DataFrame({"chunk": shard["chunk"], "shard": shard["shard"], "totals": [_pack(t) for t in back]})


def answers(asked: DataFrame) -> DataFrame:
    return asked.groupBy("shard").applyInPandas(_answers, ANSWER)


def totals_of(answered: pd.DataFrame) -> np.ndarray:
    """The totals for a chunk's sorted, distinct hashes."""
    if not len(answered):
        return np.zeros(0, dtype=np.int64)
    return np.concatenate([_unpack(t) for t in answered.sort_values("shard")["totals"]]).astype(np.int64)


def chunked(docs: DataFrame, chars: int) -> tuple[DataFrame, int]:
    """`docs` (doc_id, text) with the column `chunk`, and the number of shards, for a corpus of so many characters."""
    number = F.pmod(F.xxhash64("doc_id", "text"), F.lit(chars // CHUNK_CHARS + 1)).alias("chunk")
    return docs.select(number, "doc_id", "text"), chars // SHARD_CHARS + 1
