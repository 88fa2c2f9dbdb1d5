"""Spelling variants: words one edit apart, grouped under the form that is written most.

Two words are near if they differ by exactly one inserted, deleted or replaced
code point. Near words are found by asymmetric q-chunks. The shorter word of a
pair (either, if equally long) gives two disjoint chunks, its halves; the other
one its positional grams of the same sizes. One edit leaves a chunk whole: the
first one in its place, or the last one shifted by the difference in length,
which is one at most. Of the positional grams only those at such a place can
join, so no others are sent. Joined pairs are verified by their edit distance.

Where over HOT words share a chunk, the edit must lie in the rest of the word,
so the rest is halved in its turn and the join is on the chunk and a half of
the rest. A common beginning or ending so never pairs all words that have it.

Words are counted in each task before they are shuffled. A word's form is its
near word of largest count (ties: the smallest in code-point order), if that is
at least RATIO times its own. Counts grow RATIO times with every form, so
following forms takes a number of steps that is bounded by the largest count's
logarithm; roots are found by doubling.

Defined cases: a missing or empty text has no words; a missing doc_id is
written as an empty text where the doc_id is hashed; repeated rows count as
often as they stand; an empty table gives an empty result; a text of any length
is read whole, in slices that end between runs; only doc_id and text are read,
so further columns do not matter.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.text import cut_lineage

# Fixed by the contract: code points and occurrences of a word, share of runs that lose a code point, count ratio.
MIN_LENGTH = 7
MIN_COUNT = 2
DAMAGED = 31
RATIO = 10
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_GAP = re.compile("[^A-Za-zÀ-ÿ]")

# Characters of a text read at once, distinct words held by a task before it passes them on.
SLICE_CHARS = 1 << 20
HELD_WORDS = 1 << 18

# Words that may share a chunk before their rests are compared by halves.
HOT = 32


def _slices(text: str) -> Iterator[list[str]]:
    """The runs of a text; no slice ends within a run."""
    begin = 0
    while begin < len(text):
        gap = _GAP.search(text, min(begin + SLICE_CHARS, len(text)))
        end = gap.start() if gap else len(text)
        yield _RUN.findall(text, begin, end)
        begin = max(end, begin + 1)


def damaged(run: str, seed: int, every: int = DAMAGED) -> str:
    """The run, or the run without one code point if its hash is a multiple of `every`; `seed` is the hash of what precedes it."""
    h = zlib.crc32(run.encode(), seed)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counts(min_length: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def frame(held: Counter) -> pd.DataFrame:
        return pd.DataFrame({"word": list(held.keys()), "n": list(held.values())})

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                if not isinstance(text, str):
                    continue
                seed = zlib.crc32(f"{doc_id if isinstance(doc_id, str) else ''}:".encode())
                # Of bytes, lower() changes A-Z alone.
                plain = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                for runs in _slices(plain):
                    for run, n in Counter(runs).items():
                        if len(run) >= min_length:
                            word = damaged(run, seed)
                            if len(word) >= min_length:
                                held[word] += n
                    if len(held) > HELD_WORDS:
                        yield frame(held)
                        held = Counter()
        if held:
            yield frame(held)

    return scan


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of all texts, some of them damaged, that are long and frequent enough."""
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    counted = rows.mapInPandas(_counts(min_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _part(word: Column, first: Column, size: Column) -> Column:
    """`size` code points of a word from place `first`, counted from 0."""
    return word.substr(first + 1, size)


def _keys(words: DataFrame, short: tuple[str, ...]) -> DataFrame:
    """(word, n, chunk, rest, shift): a hash of every chunk or gram, and the other part of the word.

    `short` names the length of the shorter word of a pair, seen from this one:
    the word itself, or one code point less than that. `shift` is how much
    longer this word is.
    """
    word, length = F.col("word"), F.length("word")
    made = []
    for which in short:
        shift = 0 if which == "same" else 1
        half = F.floor((length - shift) / 2).cast("int")
        tail = length - half - shift
        for kind, at, size, rest in (
            (0, F.lit(0), half, _part(word, half, length)),
            (1, half + shift, tail, _part(word, F.lit(0), half + shift)),
        ):
            chunk = F.xxhash64(length - shift, F.lit(kind), _part(word, at, size))
            made.append(F.struct(chunk.alias("chunk"), rest.alias("rest"), F.lit(shift).alias("shift")))
    return words.select("word", "n", F.explode(F.array(*made)).alias("k")).select(
        "word", "n", "k.chunk", "k.rest", "k.shift"
    )


def _dealt(keys: DataFrame, hot: DataFrame) -> DataFrame:
    """(key, word, n): one row per chunk, or for a hot chunk one per half of the rest."""
    length = F.length("rest") - F.col("shift")
    half = F.floor(length / 2).cast("int")
    halves = F.array(
        F.xxhash64("chunk", F.lit(0), _part(F.col("rest"), F.lit(0), half)),
        F.xxhash64("chunk", F.lit(1), _part(F.col("rest"), half + F.col("shift"), length - half)),
    )
    marked = keys.join(hot, F.col("chunk") == F.col("hot_chunk"), "left")
    key = F.explode(F.when(F.col("hot_chunk").isNotNull(), halves).otherwise(F.array("chunk")))
    return marked.select(key.alias("key"), "word", "n")


def near_pairs(words: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, a_n, b, b_n): every pair of words one edit apart, once, the shorter (or smaller) word first."""
    chunks, grams = _keys(words, ("same",)), _keys(words, ("same", "less"))
    counted = chunks.groupBy("chunk").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > hot)
    hot_chunks = counted.select(F.col("chunk").alias("hot_chunk"))
    left = _dealt(chunks, hot_chunks).withColumnsRenamed({"word": "a", "n": "a_n"})
    right = _dealt(grams, hot_chunks).withColumnsRenamed({"word": "b", "n": "b_n"})
    in_order = (F.length("a") < F.length("b")) | ((F.length("a") == F.length("b")) & (F.col("a") < F.col("b")))
    joined = left.join(right, "key").filter(in_order & (F.levenshtein("a", "b", 1) == 1))
    # A pair that differs between the chunks shares both of them.
    return joined.select("a", "a_n", "b", "b_n").distinct()


def _roots(forms: DataFrame, most: int, ratio: int) -> DataFrame:
    """(word, root) for the words of `forms` (word, form): where following forms ends."""
    found = forms.select("word", F.col("form").alias("root"))
    # Every form is written `ratio` times as often as the word before it.
    steps = max(int(math.log(max(most, 1), ratio)) + 1, 1)
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        further = found.select(F.col("word").alias("via"), F.col("root").alias("end"))
        joined = found.join(further, F.col("root") == F.col("via"), "left")
        found = cut_lineage(joined.select("word", F.coalesce("end", "root").alias("root")))
    return found


def spelling_variants(docs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of `docs`.

    `form` is the near word of largest count, if that is at least `ratio` times
    the word's, else missing; `root` is where following forms ends.
    """
    words = cut_lineage(word_counts(docs))
    pairs = near_pairs(words)
    ends = F.explode(
        F.array(
            F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("m")),
            F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("m")),
        )
    )
    near = pairs.select(ends.alias("e")).groupBy("e.word", "e.n")
    near = near.agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("e.m")).alias("minus"), F.col("e.near").alias("near"))).alias("top")
    )
    is_form = -F.col("top.minus") >= F.col("n") * ratio
    judged = cut_lineage(
        near.select(
            "word",
            "n_near",
            F.when(is_form, F.col("top.near")).alias("form"),
            F.when(is_form, -F.col("top.minus")).alias("form_n"),
        )
    )
    most = words.agg(F.max("n")).first()[0] or 0
    roots = _roots(judged.filter(F.col("form").isNotNull()), most, ratio)
    return (
        words.join(judged, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form_n",
        )
    )
