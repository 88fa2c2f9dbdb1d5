"""Finding repeated windows: content-chosen anchors bring equal windows together.

A text is a row of symbols (words or bytes). A window is `length` consecutive
symbols. Every window has an anchor, the smallest hash among its grams of
`gram` symbols, so equal windows have equal anchors wherever they stand. Only
anchors found twice or more can belong to a repeated window; the stretches of
text around these anchors are cut out as segments and dealt to shards by
anchor, equal segments merged before. A shard so holds every occurrence of the
windows it holds, and an index over its segments alone decides exactly which
windows repeat.

A segment is all consecutive windows of a text that share one anchor; each
window of a text lies in one segment. Shards are consecutive whole anchors up
to a plan's shard_bytes, which bounds the index; an anchor that occurs very often
loses its equal segments before the shuffle.

An anchor whose distinct segments exceed shard_bytes is dealt again: its
segments are cut by a second anchor, the least gram under another hash, which
equal windows share as well. A piece is a segment of its own, with its own
digest: the same piece cut from many segments is merged before it is dealt, so
a common passage is carried once, and narrow links (segment, place, piece)
take the verdicts back. What is still too large after DEALS rounds is cut into
single windows, merged and linked alike. So no shard grows with the corpus.

Texts that are equal as a whole are told apart first, by two 64-bit hashes:
only the one with the smallest doc_id is searched, the others share its fate.
An anchor with a single distinct segment needs no index, for its windows stand
nowhere else.

Texts are shuffled once, by row; all passes over them (anchors, segments,
removal) read that one exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.text import Words, chunks, cut_lineage, grams, mix, window_min

# Stands in for a missing doc_id while texts go through pandas.
NO_ID = -(1 << 63)
_ANCHOR_BITS = np.uint64(20)
# How often a too large anchor is dealt again by a further anchor before its windows are dealt one by one.
DEALS = 2


class Symbols(NamedTuple):
    """Texts as symbols: a number per symbol, first symbol of each text, byte offsets."""

    values: np.ndarray  # uint64, equal for equal symbols
    first: np.ndarray
    data: np.ndarray
    starts: np.ndarray | None  # of words in `data`; None if symbols are the bytes
    ends: np.ndarray | None
    doc: np.ndarray | None

    def owner(self) -> np.ndarray:
        if self.doc is not None:
            return self.doc
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def cut(self, start: int, end: int) -> bytes:
        """The bytes of symbols start to end (exclusive)."""
        if self.starts is None:
            return self.data[start:end].tobytes()
        return self.data[self.starts[start] : self.ends[end - 1]].tobytes()


def as_words(texts: list[bytes]) -> Symbols:
    w = Words(texts)
    return Symbols(w.hashes(), w.first, w.data, w.starts, w.ends, w.doc)


def as_bytes(texts: list[bytes]) -> Symbols:
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    first = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    return Symbols(data, first, data, None, None, None)


def _byte_grams(data: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n bytes (a multiple of 8)."""
    if len(data) < n:
        return np.zeros(0, dtype=np.uint64)
    count = len(data) - n + 1
    out = np.zeros(count, dtype=np.uint64)
    for k in range(0, n, 8):
        piece = np.ndarray(count, dtype="<u8", buffer=data.data, offset=k, strides=(1,))
        out = out * np.uint64(0x9E3779B97F4A7C15) + piece
        out ^= out >> np.uint64(29)
    return mix(out)


class Runs(NamedTuple):
    """Stretches of windows that share an anchor: anchor, text, first and last window, number of anchor places."""

    anchor: np.ndarray
    doc: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    places: np.ndarray


def runs_of(symbols: Symbols, length: int, gram: int, deal: int = 0) -> Runs:
    """The stretches of all texts; every `deal` has anchors under a hash of its own."""
    words = symbols.starts is not None
    found = grams(symbols.values, gram) if words else _byte_grams(symbols.data, gram)
    if deal:
        found = mix(found ^ mix(np.uint64([deal])))
    # The low bits tell places apart, so that the same anchor twice within a stretch shows.
    place = np.arange(len(found), dtype=np.uint64) & ((np.uint64(1) << _ANCHOR_BITS) - np.uint64(1))
    found = (found >> _ANCHOR_BITS << _ANCHOR_BITS) | place
    least = window_min(found, length - gram + 1)
    size = np.diff(symbols.first)
    many = np.maximum(size - length + 1, 0)
    valid = np.repeat(symbols.first[:-1], many) + (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many))
    doc = np.repeat(np.arange(len(size)), many)
    if not len(valid):
        empty = np.zeros(0, dtype=np.int64)
        return Runs(empty, empty, empty, empty, empty)
    least = least[valid]
    anchor = (least >> _ANCHOR_BITS).view(np.int64)
    new_doc = np.concatenate(([True], doc[1:] != doc[:-1]))
    new_place = new_doc | np.concatenate(([True], least[1:] != least[:-1]))
    new_run = new_doc | np.concatenate(([True], anchor[1:] != anchor[:-1]))
    at = np.flatnonzero(new_run)
    last = np.concatenate((at[1:], [len(valid)])) - 1
    places = np.add.reduceat(new_place.astype(np.int64), at)
    return Runs(anchor[at], doc[at], valid[at], valid[last], places)


class Plan(NamedTuple):
    """How an operator reads texts and judges shards.

    `judge` takes the segments of a shard (bytes of each, number of windows,
    how often each occurs, document and place of the earliest occurrence) and
    gives two boolean arrays over all their windows: removed wherever the
    segment occurs, and removed in all but its earliest occurrence.
    `spares_first` says that the earliest of several equal strings stays.
    """

    split: Callable[[list[bytes]], Symbols]
    length: int
    gram: int
    shard_bytes: int
    spares_first: bool
    judge: Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def keyed(docs: DataFrame) -> DataFrame:
    """(_row, doc_id, text): _row is a hash of id and text, so equal rows share it; a missing id is NO_ID."""
    known = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id")
    return docs.select(F.xxhash64("doc_id", "text").alias("_row"), known, "text")


def roles(keyed_docs: DataFrame) -> DataFrame:
    """(_r, _id, alone, first) per distinct row: whether no other row has the text, and whether none with a smaller id."""
    text = keyed_docs.select("_row", "doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    per_row = text.groupBy("_row", "doc_id", "h1", "h2").agg(F.count("*").alias("n"))
    same = text.groupBy("h1", "h2").agg(F.count("*").alias("total"), F.min("doc_id").alias("least"))
    same = same.withColumnsRenamed({"h1": "g1", "h2": "g2"})
    joined = per_row.join(same, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")))
    return joined.select(
        F.col("_row").alias("_r"),
        F.col("doc_id").alias("_id"),
        (F.col("total") == 1).alias("alone"),
        (F.col("doc_id") == F.col("least")).alias("first"),
    )


def _anchors(plan: Plan) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = batch["_row"].to_numpy()
            for first, _, held in chunks(batch["text"]):
                runs = runs_of(plan.split(held), plan.length, plan.gram)
                # Once per text and anchor; n > 1 says that the text alone makes it repeated.
                order = np.lexsort((runs.anchor, runs.doc))
                anchor, doc, places = runs.anchor[order], runs.doc[order], runs.places[order]
                if not len(anchor):
                    continue
                at = np.flatnonzero(np.concatenate(([True], (np.diff(anchor) != 0) | (np.diff(doc) != 0))))
                yield pd.DataFrame(
                    {"anchor": anchor[at], "_row": rows[first + doc[at]], "n": np.add.reduceat(places, at)}
                )

    return scan


_SEGMENT = "anchor long, seg binary, n long, doc_id long, begin long, windows int, plain boolean, content binary"
_PLACE = "seg binary, _row long, doc_id long, begin long"


def _segments(plan: Plan, contents: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Segments around the wanted anchors: with contents, equal ones of a batch merged; else where each one stands."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, ids = batch["_row"].tolist(), batch["doc_id"].tolist()
            wanted = list(batch["anchors"])
            merged: dict[bytes, list] = {}
            for first, _, held in chunks(batch["text"]):
                symbols = plan.split(held)
                runs = runs_of(symbols, plan.length, plan.gram)
                bounds = np.searchsorted(runs.doc, np.arange(len(held) + 1))
                hit = np.concatenate(
                    [np.isin(runs.anchor[bounds[d] : bounds[d + 1]], wanted[first + d]) for d in range(len(held))]
                )
                hit = np.flatnonzero(hit)
                at = runs.begin[hit] - symbols.first[runs.doc[hit]]
                places = []
                for doc, anchor, begin, end, place, n in zip(
                    *(x.tolist() for x in (runs.doc[hit], runs.anchor[hit], runs.begin[hit], runs.end[hit], at)),
                    runs.places[hit].tolist(),
                    strict=True,
                ):
                    content = symbols.cut(begin, end + plan.length)
                    seg = hashlib.blake2b(content, digest_size=16).digest()
                    if not contents:
                        places.append((seg, rows[first + doc], ids[first + doc], place))
                    elif seg not in merged:
                        merged[seg] = [anchor, seg, 1, ids[first + doc], place, end - begin + 1, n == 1, content]
                    else:
                        known = merged[seg]
                        known[2] += 1
                        if (ids[first + doc], place) < (known[3], known[4]):
                            known[3], known[4] = ids[first + doc], place
                if places:
                    yield pd.DataFrame(places, columns=["seg", "_row", "doc_id", "begin"])
            if merged:
                names = ["anchor", "seg", "n", "doc_id", "begin", "windows", "plain", "content"]
                yield pd.DataFrame(list(merged.values()), columns=names)

    return scan


# What comes of judging a shard: verdicts on segments, pieces of segments to be dealt again (equal ones of a slice
# merged), and links that say which piece stands where in which segment.
_VERDICT, _PIECE, _LINK = 0, 1, 2
_DEALT = (
    "kind int, anchor long, seg binary, n long, doc_id long, begin long, windows int, plain boolean, content binary, "
    "parent binary, shift int, every array<int>, later array<int>"
)
_NAMES = [column.split()[0] for column in _DEALT.split(", ")]
_KINDS = {
    _VERDICT: "seg binary, first_doc long, first_begin long, every array<int>, later array<int>",
    _PIECE: _SEGMENT,
    _LINK: "seg binary, parent binary, shift int, doc_id long, begin long",
}


def _spread(segs: list[bytes]) -> np.ndarray:
    """A number per digest, by which rows without an anchor are dealt."""
    return np.frombuffer(b"".join(segs), dtype="<i8")[::2]


def _again(plan: Plan, held: pd.DataFrame, deal: int) -> Iterator[pd.DataFrame]:
    """Segments of one anchor cut into pieces by the anchors of this deal, or into windows after the last one.

    A piece has a digest of its own, so that the same passage within many
    segments is one piece; links lead back to the segments.
    """
    texts = list(held["content"])
    sizes = np.array([len(t) for t in texts])
    slices = np.flatnonzero(np.diff(np.cumsum(sizes) // plan.shard_bytes, prepend=-1))
    for a, b in zip(slices.tolist(), [*slices[1:].tolist(), len(texts)], strict=True):
        symbols = plan.split(texts[a:b])
        part = held.iloc[a:b]
        if deal <= DEALS:
            runs = runs_of(symbols, plan.length, plan.gram, deal)
            doc, begin, windows = runs.doc, runs.begin, runs.end - runs.begin + 1
            old = part["anchor"].to_numpy()[doc].view(np.uint64)
            anchor, plain = mix(mix(old) ^ runs.anchor.view(np.uint64)).view(np.int64), runs.places == 1
            content = [symbols.cut(x, x + w + plan.length - 1) for x, w in zip(begin.tolist(), windows.tolist(), strict=True)]
            segs = [hashlib.blake2b(c, digest_size=16).digest() for c in content]
        else:
            many = part["windows"].to_numpy()
            doc = np.repeat(np.arange(b - a), many)
            begin = symbols.first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
            windows, plain, content = np.ones(len(doc), dtype=np.int64), np.ones(len(doc), dtype=bool), None
            values, wide = symbols.values.tobytes(), symbols.values.itemsize
            segs = [
                hashlib.blake2b(values[x * wide : (x + plan.length) * wide], digest_size=16).digest()
                for x in begin.tolist()
            ]
            anchor = _spread(segs)
        shift = begin - symbols.first[doc]
        found = pd.DataFrame(
            {
                "kind": _LINK,
                "anchor": anchor,
                "seg": segs,
                "n": part["n"].to_numpy()[doc],
                "doc_id": part["doc_id"].to_numpy()[doc],
                "begin": part["begin"].to_numpy()[doc] + shift,
                "windows": windows,
                "plain": plain,
                "content": content,
                "parent": part["seg"].to_numpy()[doc],
                "shift": shift,
                "every": None,
                "later": None,
            }
        )[_NAMES]
        yield found.assign(anchor=_spread(segs), content=None)
        # Each piece once, with its earliest place and the number of all its places.
        found = found.sort_values(["doc_id", "begin"], kind="stable")
        total = found.groupby("seg")["n"].sum()
        found = found.drop_duplicates("seg")
        yield found.assign(kind=_PIECE, n=total.loc[found["seg"]].to_numpy(), parent=None)


def _judged(plan: Plan, deal: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Verdicts on the segments, sorted by anchor; those of an anchor beyond shard_bytes are dealt again."""

    def shard(held: pd.DataFrame) -> Iterator[pd.DataFrame]:
        anchor = held["anchor"].to_numpy()
        new = np.concatenate(([True], anchor[1:] != anchor[:-1], [True]))
        single = new[:-1] & new[1:] & held["plain"].to_numpy()
        # A segment that is its anchor's only one: its windows stand where the segment stands.
        only = held[single]
        only = only[only["n"].to_numpy() > 1]
        if len(only):
            whole = [[0, w - 1] for w in only["windows"].tolist()]
            none = [[]] * len(only)
            yield result(only, none if plan.spares_first else whole, whole if plan.spares_first else none)
        rest = held[~single]
        if len(rest):
            windows = rest["windows"].to_numpy()
            every, later = plan.judge(
                list(rest["content"]), windows, *(rest[name].to_numpy() for name in ("n", "doc_id", "begin"))
            )
            yield result(rest, _ranges(every, windows), _ranges(later, windows))

    def result(held: pd.DataFrame, every: list, later: list) -> pd.DataFrame:
        settled = held.assign(
            kind=_VERDICT, anchor=_spread(list(held["seg"])), content=None, parent=None, shift=0, every=every, later=later
        )
        return settled[[len(x) + len(y) > 0 for x, y in zip(every, later, strict=True)]][_NAMES]

    def shards(held: pd.DataFrame, size: np.ndarray, final: bool) -> Iterator[pd.DataFrame | int]:
        """Verdicts on full shards of the rows, and at last the number of rows done."""
        anchor = held["anchor"].to_numpy()
        bounds = np.concatenate(([0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, [len(held)]))
        total = np.concatenate(([0], np.cumsum(size)))[bounds]
        begin = 0
        for k in range(len(bounds) - 1 if final else len(bounds) - 2):
            if total[k + 1] - total[k] > plan.shard_bytes and bounds[k + 1] - bounds[k] > 1:
                if begin < k:
                    yield from shard(held.iloc[bounds[begin] : bounds[k]])
                yield from _again(plan, held.iloc[bounds[k] : bounds[k + 1]], deal + 1)
                begin = k + 1
            elif total[k + 1] - total[begin] >= plan.shard_bytes:
                yield from shard(held.iloc[bounds[begin] : bounds[k + 1]])
                begin = k + 1
        last = len(bounds) - 1 if final else len(bounds) - 2
        if final and begin < last:
            yield from shard(held.iloc[bounds[begin] :])
            begin = last
        yield int(bounds[begin])

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, size, hot = [], 0, None
        for batch in batches:
            if hot is not None and len(batch):
                more = batch["anchor"].to_numpy() == hot
                if more.any():
                    yield from _again(plan, batch[more], deal + 1)
                    batch = batch[~more]
                if len(batch):
                    hot = None
            if not len(batch):
                continue
            parts.append(batch)
            size += int(batch["content"].str.len().sum())
            if size < plan.shard_bytes:
                continue
            held = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]
            sizes = held["content"].str.len().to_numpy()
            done = 0
            for found in shards(held, sizes, False):
                if isinstance(found, int):
                    done = found
                else:
                    yield found
            held, sizes = held.iloc[done:], sizes[done:]
            # The last anchor may go on in the next batch.
            anchor = held["anchor"].to_numpy()
            tail = int(np.searchsorted(anchor, anchor[-1]))
            if sizes[tail:].sum() > plan.shard_bytes and len(held) - tail > 1:
                if tail:
                    yield from shard(held.iloc[:tail])
                yield from _again(plan, held.iloc[tail:], deal + 1)
                hot, held, sizes = int(anchor[-1]), held.iloc[:0], sizes[:0]
            parts, size = ([held.reset_index(drop=True)], int(sizes.sum())) if len(held) else ([], 0)
        if parts:
            held = pd.concat(parts, ignore_index=True)
            for found in shards(held, held["content"].str.len().to_numpy(), True):
                if not isinstance(found, int):
                    yield found

    return scan


def _of_kind(kind: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    names = [column.split()[0] for column in _KINDS[kind].split(", ")]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = batch[batch["kind"].to_numpy() == kind]
            if kind == _VERDICT:
                rows = rows.rename(columns={"doc_id": "first_doc", "begin": "first_begin"})
            if len(rows):
                yield rows[names]

    return scan


def _merged(segments: DataFrame) -> DataFrame:
    """Each distinct segment once, dealt by anchor."""
    distinct = segments.repartition("anchor").groupBy("anchor", "seg")
    distinct = distinct.agg(
        F.sum("n").alias("n"),
        F.min(F.struct("doc_id", "begin")).alias("first"),
        F.first("windows").alias("windows"),
        F.first("plain").alias("plain"),
        F.first("content").alias("content"),
    )
    return distinct.select("anchor", "seg", "n", "first.doc_id", "first.begin", "windows", "plain", "content")


def _here(by: Column) -> tuple[Column, Column]:
    """Of a place (doc_id, begin) joined to a verdict: what goes wherever the place's text stands, and what goes but at
    its earliest place. `by` shifts the windows."""
    first = (F.col("doc_id") == F.col("first_doc")) & (F.col("begin") == F.col("first_begin"))
    none = F.array().cast("array<int>")
    every = F.concat("every", F.when(first, none).otherwise(F.col("later")))
    later = F.when(first, F.col("later")).otherwise(none)
    return F.transform(every, lambda x: x + by), F.transform(later, lambda x: x + by)


def _verdicts(plan: Plan, distinct: DataFrame, deal: int = 0) -> DataFrame:
    """(seg, first_doc, first_begin, every, later) for the segments with windows to remove."""
    # All three kinds are read from this one exchange.
    judged = distinct.sortWithinPartitions("anchor", "seg").mapInPandas(_judged(plan, deal), _DEALT).repartition("anchor")
    settled, pieces, links = (judged.mapInPandas(_of_kind(k), _KINDS[k]) for k in (_VERDICT, _PIECE, _LINK))
    if deal < DEALS:
        found = _verdicts(plan, _merged(pieces), deal + 1)
    else:
        # Single windows: the same windows have the same digest and are counted.
        total = pieces.groupBy("seg").agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "begin")).alias("first"))
        gone, stays = F.array(F.lit(0), F.lit(0)), F.array().cast("array<int>")
        found = total.filter("n > 1").select(
            "seg",
            F.col("first.doc_id").alias("first_doc"),
            F.col("first.begin").alias("first_begin"),
            (stays if plan.spares_first else gone).alias("every"),
            (gone if plan.spares_first else stays).alias("later"),
        )
    # The earliest place of a segment holds the earliest place of its piece, or no place of the segment does.
    every, later = _here(F.col("shift"))
    back = links.join(found, "seg").select(
        F.col("parent").alias("seg"),
        F.col("doc_id").alias("first_doc"),
        (F.col("begin") - F.col("shift")).alias("first_begin"),
        every.alias("every"),
        later.alias("later"),
    )
    # The pieces of a segment come together again: at most as many as it has windows.
    back = back.groupBy("seg", "first_doc", "first_begin").agg(
        F.flatten(F.collect_list("every")).alias("every"), F.flatten(F.collect_list("later")).alias("later")
    )
    return settled.unionByName(back)


def _ranges(mask: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """For consecutive pieces of the mask, first and last place of every run of True in the piece, flat."""
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    piece = np.repeat(np.arange(len(sizes)), sizes)
    new = np.concatenate(([True], piece[1:] != piece[:-1]))
    last = np.concatenate((new[1:], [True]))
    begins = np.flatnonzero(mask & (new | ~np.concatenate(([False], mask[:-1]))))
    ends = np.flatnonzero(mask & (last | ~np.concatenate((mask[1:], [False]))))
    flat = np.stack((begins, ends), axis=1) - bounds[piece[begins]][:, None]
    cuts = np.searchsorted(piece[begins], np.arange(len(sizes) + 1)) * 2
    flat = flat.ravel().astype(np.int32)
    return [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def repeated_windows(searched: DataFrame, plan: Plan) -> DataFrame:
    """(_row, found) for every text with windows to remove: doc_id and spans, the flat first and last window of each
    stretch. `searched` holds (_row, doc_id, text)."""
    anchors = searched.mapInPandas(_anchors(plan), "anchor long, _row long, n long")
    repeated = anchors.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor")
    wanted = anchors.select("anchor", "_row").join(repeated, "anchor", "left_semi")
    wanted = wanted.groupBy("_row").agg(F.collect_set("anchor").alias("anchors")).withColumnRenamed("_row", "_w")
    with_anchors = searched.join(wanted.hint("shuffle_hash"), F.col("_row") == F.col("_w")).drop("_w")
    # Merged in each batch, dealt by anchor, merged for good where they arrive.
    verdicts = _verdicts(plan, _merged(with_anchors.mapInPandas(_segments(plan, True), _SEGMENT)))
    placed = with_anchors.mapInPandas(_segments(plan, False), _PLACE).join(verdicts, "seg")
    spans, _ = _here(F.col("begin").cast("int"))
    placed = placed.select("_row", "doc_id", spans.alias("spans"))
    return placed.groupBy("_row").agg(F.collect_list(F.struct("doc_id", "spans")).alias("found"))


def removals(docs: DataFrame, plan: Plan) -> DataFrame:
    """(doc_id, text, spans, whole) for every row of `docs`; spans is NULL where nothing is removed, whole says that
    all windows are; a missing id is NO_ID.

    Texts meet roles and spans by _row alone, the key they were dealt by, so
    that one exchange serves all; doc_id then tells rows apart whose hash is
    equal by chance.
    """
    rows = keyed(docs)
    role = cut_lineage(roles(rows)).groupBy("_r").agg(F.collect_list(F.struct("_id", "alone", "first")).alias("_roles"))
    with_role = rows.join(role.hint("shuffle_hash"), F.col("_row") == F.col("_r")).drop("_r")
    own_role = F.filter("_roles", lambda x: x["_id"] == F.col("doc_id"))[0]
    with_role = with_role.select("_row", "doc_id", "text", own_role["alone"].alias("alone"), own_role["first"].alias("first"))
    searched = with_role.filter("first").select("_row", "doc_id", "text")
    found = repeated_windows(searched, plan).withColumnRenamed("_row", "_r")
    joined = with_role.join(found.hint("shuffle_hash"), F.col("_row") == F.col("_r"), "left")
    own = F.filter("found", lambda x: x["doc_id"] == F.col("doc_id"))
    whole = ~F.col("first") if plan.spares_first else ~F.col("alone")
    return joined.select(
        "doc_id", "text", F.flatten(F.transform(own, lambda x: x["spans"])).alias("spans"), whole.alias("whole")
    )


def named(rows: DataFrame) -> DataFrame:
    """NO_ID turned back into a missing doc_id."""
    return rows.withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(NO_ID)))


def covered(spans: object, whole: bool, n: int, length: int) -> np.ndarray:
    """Which of n symbols lie in a removed window: one of the spans (flat first and last window), or any."""
    if whole:
        return np.full(n, n >= length)
    change = np.zeros(n + 1, dtype=np.int64)
    if spans is not None and len(spans):
        flat = np.asarray(spans, dtype=np.int64)
        np.add.at(change, flat[0::2], 1)
        np.add.at(change, flat[1::2] + length, -1)
    return np.cumsum(change)[:n] > 0
