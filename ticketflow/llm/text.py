"""Words, hashes and Spark helpers that the text operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.sources.sinks import scratch_folder

# Fixed by the contracts: the characters that separate words.
SPACES = " \t\n\x0b\x0c\r"
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[ord(c) for c in SPACES]] = True

# Texts are taken apart in chunks of about so many bytes, which bounds the
# memory of the arrays built over them (a longer text is a chunk of its own).
CHUNK_BYTES = 1 << 21

_ODD = np.uint64(0x9E3779B97F4A7C15)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """The same rows, read back from a table in the shared folder."""
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def set_aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """`docs` with all columns but doc_id and text under names nothing else has, and what they were called."""
    tag = uuid.uuid4().hex
    names = {c: f"_{tag}_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    return docs.withColumnsRenamed(names), {new: old for old, new in names.items()}


def words_of(text: Column) -> Column:
    """The words of a text as an array; a missing text has none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, "[ \\t-\\r]+"))


def n_words_of(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def chunks(texts: Sequence[str | None]) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first, last, UTF-8 texts) for consecutive slices of about CHUNK_BYTES."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
        if held and size + len(data) > CHUNK_BYTES:
            yield first, i, held
            first, held, size = i, [], 0
        held.append(data)
        size += len(data)
    if held:
        yield first, first + len(held), held


class Words:
    """Where the words of some texts lie, over all texts at once.

    `starts` and `ends` are byte offsets into `data`, the joined texts;
    `first[d]` is the number of the first word of text `d` (one more entry at
    the end), `doc` the text of every word.
    """

    def __init__(self, texts: list[bytes]):
        joined = b"\n".join(texts)
        self.data = np.frombuffer(joined, dtype=np.uint8)
        lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.at = np.concatenate(([0], np.cumsum(lengths + 1)))
        solid = np.empty(len(self.data) + 2, dtype=bool)
        solid[0] = solid[-1] = False
        np.logical_not(_IS_SPACE[self.data], out=solid[1:-1])
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.first = np.searchsorted(self.starts, self.at)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word, of its bytes and its length."""
        size = self.ends - self.starts
        padded = np.concatenate((self.data, np.zeros(8, dtype=np.uint8)))
        eights = np.ndarray(len(self.data) + 1, dtype="<u8", buffer=padded.data, strides=(1,))
        out = mix(size.astype(np.uint64) * _ODD)
        at, left, todo = self.starts, size, np.arange(len(size))
        while len(todo):
            piece = eights[at]
            short = left < 8
            keep = (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
            piece[short] &= keep
            out[todo] = mix(out[todo] * _ODD + piece)
            more = left > 8
            todo, at, left = todo[more], at[more] + 8, left[more] - 8
        return out


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive words; entry i starts at word i."""
    if len(hashes) < n:
        return hashes[:0]
    out = hashes[: len(hashes) - n + 1].copy()
    for k in range(1, n):
        out = out * _ODD + hashes[k : len(hashes) - n + 1 + k]
    return mix(out)


def window_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every `width` consecutive values."""
    if len(values) < width:
        return values[:0]
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[: len(values) - have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values
