"""Phrases whose words stand together more often than their parts suggest.

Weighted acyclic automata (see `automata`) hold the counts. A task takes texts
apart into slices, sorts a slice's n-grams and builds count automata from them,
one per prefix range; the path of an n-gram is its language and then its words.
The automata of a range meet in one place, where they are united and their
weights summed. The counts of a phrase's parts lie in other ranges: a range
sends the parts it needs as an automaton, which is composed with the count
automaton of the range that has them. The same message carries, for each part, the
largest count of a phrase around it, which decides whether the part is dropped.

Ranges are cut at n-grams of a bounded sample, as a range sort does; they decide where
an n-gram is counted, never its count. No n-gram, word or language is hot: it
is one arc per slice. With more than FAN ranges, automata are united in two
rounds, first by coarse ranges within groups of slices, so that rows stay in
proportion to the text.

Defined cases: a missing or empty text has no words; a missing language is
`und`; repeated rows count as often as they stand; an empty table gives an
empty result; a text of any length is read whole, in parts that overlap by the
words a phrase may reach over; only lang and text are read, so further columns
do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketflow.llm.automata import (
    Labels,
    Table,
    as_array,
    build,
    compact,
    compose,
    first_seen,
    in_order,
    pack,
    pack_numbers,
    paths,
    prefixes,
    summed,
    union,
    unpack,
    unpack_numbers,
)
from ticketflow.llm.text import Words, cut_lineage

# Fixed by the contract.
LONGEST = 4
LEAST = 30
SCALE = 2_000_000
SHARE = 80
PHRASES = 2000
NO_LANG = "und"
_BREAKS = b".,;:!?"
_TO_LINES = bytes.maketrans(_BREAKS, b"\n" * len(_BREAKS))
_SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]")
# What a phrase that starts before a cut may still reach.
_REACH = re.compile(rb"[ \t]*(?:[^ \t\n\x0b\x0c\r]+[ \t]+){0,%d}[^ \t\n\x0b\x0c\r]*" % (LONGEST - 2))

# Bytes of text whose n-grams are sorted at once, characters of text per range, ranges united in one round.
SLICE_BYTES = 8 << 20
RANGE_CHARS = 8 << 20
FAN = 1024
# N-grams that are gathered before they are united.
UNITED_ROWS = 1 << 19
# Sampled n-grams per range; at most so many ranges, which bounds the sample on the driver (beyond, ranges grow).
SAMPLED = 16
MOST_RANGES = 1 << 16
# Phrases that occur often enough are far fewer than n-grams, so their ranges are wider by this.
WIDER = 32

DEPTH = LONGEST + 1
_PART = "grp int, coarse int, fine int, automaton binary"

Sequence = tuple[bytes, ...]


def _parts(text: bytes) -> Iterator[tuple[bytes, int]]:
    """The text in parts of about SLICE_BYTES, each with what its phrases reach over, and its size without that."""
    begin = 0
    while len(text) - begin > SLICE_BYTES:
        space = _SPACE.search(text, begin + SLICE_BYTES)
        end = space.start() if space else len(text)
        yield text[begin : _REACH.match(text, end).end()], end - begin
        begin = end
    yield text[begin:], len(text) - begin


def _windows(texts: list[bytes], own: list[int], langs: list[bytes]) -> tuple[Labels, np.ndarray]:
    """Labels, and for every word that starts within a text's own size: language and the words of its piece from there."""
    w = Words(texts)
    n = len(w.starts)
    if not n:
        return [], np.zeros((0, DEPTH), dtype=np.int32)
    at, word = first_seen(w.hashes())
    data = w.data.tobytes()
    found = [data[s:e] for s, e in zip(w.starts[at].tolist(), w.ends[at].tolist(), strict=True)]
    labels, number = in_order(as_array([*found, *langs]))
    ids = number[word]
    lines = (w.data >= 10) & (w.data <= 13)
    piece = np.cumsum(lines)[w.starts]
    rows = np.zeros((n, DEPTH), dtype=np.int32)
    rows[:, 0] = number[len(found) :][w.doc]
    rows[:, 1] = ids
    for k in range(1, LONGEST):
        rows[: n - k, k + 1] = np.where(piece[k:] == piece[: n - k], ids[k:], 0)
    return labels, rows[w.starts - w.at[w.doc] < np.array(own)[w.doc]]


def _sliced(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[Labels, np.ndarray]]:
    """The windows of all texts, by slices."""
    texts, own, langs, size = [], [], [], 0
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            if not isinstance(text, str):
                continue
            # Of bytes, lower() changes A-Z alone.
            data = text.encode("utf-8", "surrogatepass").lower().translate(_TO_LINES)
            name = lang.encode("utf-8", "surrogatepass") if isinstance(lang, str) else NO_LANG.encode()
            for part, many in _parts(data):
                texts.append(part)
                own.append(many)
                langs.append(name)
                size += len(part)
                if size >= SLICE_BYTES:
                    yield _windows(texts, own, langs)
                    texts, own, langs, size = [], [], [], 0
    if texts:
        yield _windows(texts, own, langs)


def _sampled(every: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Every so many-th n-gram of the texts (of each length in turn)."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for labels, rows in _sliced(batches):
            picked = rows[::every].copy()
            length = 2 + np.arange(len(picked)) % LONGEST
            picked[np.arange(DEPTH)[None, :] >= length[:, None]] = 0
            table = Table(labels, picked, np.ones(len(picked)))
            yield pd.DataFrame({"gram": [list(table.sequence(i)) for i in range(len(picked))]})

    return scan


def _cuts(rows: DataFrame, chars: int, ranges: int) -> list[Sequence]:
    """Where the ranges begin (all but the first), from a sample of a size that depends on their number alone."""
    if ranges == 1:
        return []
    wanted = ranges * SAMPLED
    # Words are taken as five characters; only the balance of the ranges depends on that.
    every = max(chars // (5 * wanted), 1)
    share = min(1.0, 512 * wanted / max(chars // 5, 1))
    some = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    step = max(int(every * share), 1)
    found = some.mapInPandas(_sampled(step), "gram array<binary>").limit(4 * wanted).collect()
    grams = sorted({tuple(bytes(x) for x in r["gram"]) for r in found})
    at = [len(grams) * i // ranges for i in range(1, ranges)]
    return sorted({grams[i] for i in at}) if grams else []


def _ranged(table: Table, cuts: list[Sequence]) -> Iterator[tuple[int, Table]]:
    """The table's parts by range."""
    bounds = [0, *(table.place(c) for c in cuts), len(table.rows)]
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if a < b:
            yield i, table.part(a, b)


def _coarse_cuts(cuts: list[Sequence], wider: int) -> list[Sequence]:
    """The cuts between ranges that are `wider` times as wide."""
    return cuts[wider - 1 :: wider]


def _count_rows(cuts: list[Sequence], wider: int, groups: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A row per slice and (coarse) range: the count automaton of the slice's n-grams there."""
    cuts = _coarse_cuts(cuts, wider) if wider > 1 else cuts

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for labels, rows in _sliced(batches):
            table = prefixes(labels, rows)
            if not len(table.rows):
                continue
            grp = int(table.weights.sum() + len(table.rows)) % groups
            yield pd.DataFrame(
                [(grp, i, 0, pack(build(part))) for i, part in _ranged(table, cuts)],
                columns=["grp", "coarse", "fine", "automaton"],
            )

    return scan


def _united(held: pd.Series) -> Table:
    """The union of automata; a few at a time, so that what is held is little more than the result."""
    whole, parts, size = None, [], 0
    for data in held:
        parts.append(paths(unpack(data), ordered=False))
        size += len(parts[-1].rows)
        if size >= UNITED_ROWS and (whole is None or size >= len(whole.rows)):
            whole, parts, size = union([whole, *parts] if whole else parts, DEPTH), [], 0
    return union([whole, *parts] if whole else parts, DEPTH)


def _finer(cuts: list[Sequence], wider: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The automata of one group and coarse range, united and cut into fine ranges."""

    def unite(held: pd.DataFrame) -> pd.DataFrame:
        coarse = int(held["coarse"].iloc[0])
        own = cuts[coarse * wider : (coarse + 1) * wider - 1]
        parts = [(0, coarse, i, pack(build(part))) for i, part in _ranged(_united(held["automaton"]), own)]
        return pd.DataFrame(parts, columns=["grp", "coarse", "fine", "automaton"])

    return unite


def _frequent(wider: int, least: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A range's phrases that occur often enough, and how many words each language has."""

    def unite(held: pd.DataFrame) -> pd.DataFrame:
        table = _united(held["automaton"])
        keep = (table.weights >= least) | (table.rows[:, 1] == 0)
        kept = compact(table.labels, table.rows[keep], table.weights[keep])
        fine = int(held["coarse"].iloc[0]) * wider + int(held["fine"].iloc[0])
        out = [(fine // WIDER, pack(build(kept)))] if len(kept.rows) else []
        return pd.DataFrame(out, columns=["range", "automaton"])

    return unite


def _asked(table: Table) -> tuple[Table, dict[tuple[int, int], np.ndarray], np.ndarray]:
    """All parts of the table's phrases, each with the largest count of a phrase around it.

    Also returned: for words i to j of a phrase the numbers of these parts, by
    phrase (-1 if it is not that long), and the numbers of the languages.
    """
    rows, weights = table.rows, table.weights
    words = (rows[:, 1:] > 0).sum(axis=1)
    made, around, keys = [], [], {}
    for i in range(LONGEST):
        for j in range(i + 1, LONGEST + 1):
            # Words i to j of longer phrases.
            at = np.flatnonzero((words >= j) & (words > j - i) & (words >= 2))
            part = np.zeros((len(at), DEPTH), dtype=np.int32)
            part[:, 0] = rows[at, 0]
            part[:, 1 : 1 + j - i] = rows[at, 1 + i : 1 + j]
            made.append(part)
            around.append(weights[at])
            keys[i, j] = at
    at = np.flatnonzero(words >= 2)
    lang = np.zeros((len(at), DEPTH), dtype=np.int32)
    lang[:, 0] = rows[at, 0]
    parts = np.concatenate([*made, lang])
    if not len(parts):
        return Table([], parts, np.zeros(0, dtype=np.int64)), {}, np.zeros(0, dtype=np.int64)
    asked = summed(table.labels, parts, np.concatenate([*around, weights[at]]), np.maximum)
    # The same numbers again, for every part of every phrase.
    _, number = np.unique(parts, axis=0, return_inverse=True)
    found, begin = {}, 0
    for key, at in keys.items():
        found[key] = np.full(len(rows), -1)
        found[key][at] = number[begin : begin + len(at)]
        begin += len(at)
    of_lang = np.full(len(rows), -1)
    of_lang[words >= 2] = number[begin:]
    return asked, found, of_lang


def _ask(cuts: list[Sequence]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """What a range needs to know, as an automaton per range that knows it."""

    def ask(held: pd.DataFrame) -> pd.DataFrame:
        asked, _, _ = _asked(_united(held["automaton"]))
        here = int(held["range"].iloc[0])
        out = [(to, here, pack(build(part))) for to, part in _ranged(asked, cuts)]
        return pd.DataFrame(out, columns=["to", "range", "asked"])

    return ask


def _answer(known: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """The counts that were asked for, and for the own phrases the largest count of a phrase around them."""
    if not len(known):
        return pd.DataFrame(columns=["range", "source", "counts", "around"], dtype=object)
    table = _united(known["automaton"])
    automaton = build(table)
    here = int(known["range"].iloc[0])
    parts = [paths(unpack(x)) for x in asked["asked"]]
    out = [
        (int(to), here, pack_numbers(compose(part, automaton)), None)
        for to, part in zip(asked["range"], parts, strict=True)
    ]
    around = union(parts, DEPTH, np.maximum)
    own = compose(table, build(around)) if len(around.rows) else np.zeros(len(table.rows), dtype=np.int64)
    out.append((here, here, None, pack_numbers(own)))
    return pd.DataFrame(out, columns=["range", "source", "counts", "around"])


def scores_of(a: list[int], parts: list[int], scale: int = SCALE) -> list[int]:
    """floor(scale * a / parts), exact for whole numbers of any size."""
    return [scale * x // y for x, y in zip(a, parts, strict=True)]


def _judge(scale: int, share: int, most: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The phrases of a range that no longer one stands for, with their weakest cut; the best `most` per language."""

    def judge(known: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        names = ["lang", "phrase", "a", "l", "r", "n", "score", "cut"]
        empty = pd.DataFrame(columns=names, dtype=object)
        if not len(known):
            return empty
        table = _united(known["automaton"])
        asked, found, of_lang = _asked(table)
        told = answers[answers["counts"].notna()].sort_values("source")
        counts = np.concatenate([unpack_numbers(x) for x in told["counts"]]) if len(told) else np.zeros(0, dtype=np.int64)
        around = unpack_numbers(answers.loc[answers["around"].notna(), "around"].iloc[0])
        words = (table.rows[:, 1:] > 0).sum(axis=1)
        weights = table.weights.tolist()
        covered = [share * x <= 100 * y for x, y in zip(weights, around.tolist(), strict=True)]
        rows = np.flatnonzero((words >= 2) & ~np.array(covered, dtype=bool))
        out = []
        for size in range(2, LONGEST + 1):
            at = rows[words[rows] == size]
            if not len(at):
                continue
            a = table.weights[at].tolist()
            best = None
            for k in range(1, size):
                left, right = counts[found[0, k][at]].tolist(), counts[found[k, size][at]].tolist()
                score = scores_of(a, [x + y for x, y in zip(left, right, strict=True)], scale)
                lines = list(zip(score, [k] * len(at), left, right, strict=True))
                # Ties stay with the smaller cut.
                best = lines if best is None else [min(x, y) for x, y in zip(best, lines, strict=True)]
            n = counts[of_lang[at]].tolist()
            for row, total, (score, k, left, right), many in zip(at.tolist(), a, best, n, strict=True):
                lang, *phrase = table.sequence(row)
                out.append((lang.decode("utf-8", "replace"), b" ".join(phrase), total, left, right, many, score, k))
        # Best first, so that the places in a language count up.
        out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1]))
        place, kept = 0, []
        for i, line in enumerate(out):
            place = place + 1 if i and line[0] == out[i - 1][0] else 1
            if place <= most:
                kept.append((line[0], line[1].decode("utf-8", "replace"), *line[2:]))
        return pd.DataFrame(kept, columns=names) if kept else empty

    return judge


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    scale: int = SCALE,
    share: int = SHARE,
    most: int = PHRASES,
    range_chars: int = RANGE_CHARS,
    fan: int = FAN,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, cut): per language the `most` phrases of two to four words of highest score.

    A phrase occurs `least` times or more (a), in its language of n words. Cut
    after `cut` words, its parts occur l and r times; score is floor(scale * a /
    (l + r)) for the cut where that is lowest. A phrase within a longer one that
    occurs at least `share` percent as often is left out.
    """
    rows = docs.select(F.col("lang").cast("string").alias("lang"), "text")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = min(chars // range_chars + 1, MOST_RANGES)
    cuts = _cuts(rows, chars, ranges)
    wider = 1 if len(cuts) < fan else -(-(len(cuts) + 1) // fan)
    groups = 1 if wider == 1 else chars // (range_chars * fan) + 1
    counted = rows.mapInPandas(_count_rows(cuts, wider, groups), _PART)
    if wider > 1:
        counted = counted.groupBy("grp", "coarse").applyInPandas(_finer(cuts, wider), _PART)
    # From here on one row per range.
    frequent = counted.groupBy("coarse", "fine").applyInPandas(_frequent(wider, least), "range int, automaton binary")
    frequent = cut_lineage(frequent)
    by_range = frequent.groupBy("range")
    asked = by_range.applyInPandas(_ask(_coarse_cuts(cuts, WIDER)), "to int, range int, asked binary")
    answers = (
        by_range.cogroup(asked.groupBy("to")).applyInPandas(_answer, "range int, source int, counts binary, around binary")
    )
    judged = by_range.cogroup(answers.groupBy("range")).applyInPandas(
        _judge(scale, share, most),
        "lang string, phrase string, a long, l long, r long, n long, score long, cut int",
    )
    best = judged.withColumn(
        "rank",
        F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")),
    )
    return best.filter(F.col("rank") <= most).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "cut"
    )
