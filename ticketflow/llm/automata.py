"""Weighted acyclic automata over word sequences.

An automaton maps sequences of at most `depth` labels (byte strings) to
weights. It is built from sorted sequences, from the last labels to the first;
states of one depth with the same arcs (label, weight, target) are one state. An arc's weight is that of the sequence it
completes; zero stands for a mere prefix. All work is done on whole arrays.

Sequences go in and out as tables: a matrix of label numbers (32 bits), 1 and
up, rows in order and filled up with 0, with an array of weights. Labels are kept as
Arrow arrays, so that no object is made per label.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from ticketflow.llm.text import mix

_ODD = np.uint64(0x9E3779B97F4A7C15)

Labels = Sequence[bytes] | pa.LargeBinaryArray


def as_array(labels: Labels) -> pa.LargeBinaryArray:
    return labels if isinstance(labels, pa.Array) else pa.array(labels, pa.large_binary())


def in_order(words: pa.LargeBinaryArray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The different words in order, and for each word its place there, from 1."""
    found = words.dictionary_encode()
    order = pc.array_sort_indices(found.dictionary)
    place = np.empty(len(order), dtype=np.int32)
    place[order.to_numpy()] = np.arange(1, len(order) + 1, dtype=np.int32)
    return found.dictionary.take(order), place[found.indices.to_numpy()]


def first_seen(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each different value comes first (ascending), and for each value its number among these."""
    number = pd.factorize(values)[0]
    return np.flatnonzero(np.diff(np.maximum.accumulate(number), prepend=-1)), number


class Table(NamedTuple):
    """Sorted sequences with weights; number i + 1 stands for labels[i], labels are sorted."""

    labels: Labels
    rows: np.ndarray
    weights: np.ndarray

    def part(self, begin: int, end: int) -> Table:
        """Rows begin to end, with the labels they use."""
        return compact(self.labels, self.rows[begin:end], self.weights[begin:end])

    def sequence(self, row: int) -> tuple[bytes, ...]:
        return tuple(as_array(self.labels)[i - 1].as_py() for i in self.rows[row].tolist() if i)

    def place(self, sequence: tuple[bytes, ...]) -> int:
        """How many sequences come before the given one."""
        low, high = 0, len(self.rows)
        while low < high:
            middle = (low + high) // 2
            if self.sequence(middle) < sequence:
                low = middle + 1
            else:
                high = middle
        return low


class Automaton(NamedTuple):
    """`first[s]` is the first arc of state s; the root is the last state, state 0 has no arcs."""

    labels: Labels
    depth: int
    first: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    target: np.ndarray


def compact(labels: Labels, rows: np.ndarray, weights: np.ndarray) -> Table:
    used = np.zeros(len(labels) + 1, dtype=bool)
    used[rows] = True
    used[0] = False
    number = np.cumsum(used, dtype=np.int32)
    number[~used] = 0
    return Table(as_array(labels).take(pa.array(np.flatnonzero(used) - 1)), number[rows], weights)


def ordered(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows, and where in that order a row differs from the one before."""
    n = len(rows)
    order, key, span = None, np.zeros(n, dtype=np.int64), 1
    for d in range(rows.shape[1]):
        column = rows[:, d]
        # Only the numbers that the column has count for the width of the key.
        there = np.zeros(int(column.max(initial=0)) + 1, dtype=bool)
        there[column] = True
        number = np.cumsum(there) - 1
        wide = int(number[-1]) + 1
        if span * wide >= 1 << 62:
            order, key = _runs(key, order)
            span = n
        key *= wide
        key += number[column if order is None else column[order]]
        span *= wide
    order, key = _runs(key, order)
    changed = np.ones(n, dtype=bool)
    np.not_equal(key[1:], key[:-1], out=changed[1:])
    return order, changed


def _runs(key: np.ndarray, order: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys (which stand in `order`), and in that order the numbers of the different keys."""
    # Keys that were ordered before by their first columns are nearly in order, which a stable sort makes use of.
    by = np.argsort(key) if order is None else np.argsort(key, kind="stable")
    key = key[by]
    number = np.zeros(len(key), dtype=np.int64)
    np.cumsum(key[1:] != key[:-1], out=number[1:])
    return by if order is None else order[by], number


def summed(labels: Labels, rows: np.ndarray, weights: np.ndarray, how: np.ufunc = np.add) -> Table:
    """A table of rows in any order; the weights of equal rows are added up (or combined by `how`)."""
    if not len(rows):
        return Table([], rows, weights)
    order, changed = ordered(rows)
    at = np.flatnonzero(changed)
    return Table(labels, rows[order[at]], how.reduceat(weights[order], at))


def prefixes(labels: Labels, rows: np.ndarray) -> Table:
    """Every prefix of the rows, with the number of rows that begin with it."""
    if not len(rows):
        return Table([], rows, np.zeros(0, dtype=np.int64))
    n, depth = rows.shape
    rows = rows[ordered(rows)[0]]
    changed = np.zeros(n, dtype=bool)
    changed[0] = True
    # Where a row leaves the one before: from there on to its end, its prefixes are new.
    leaves = np.full(n, depth)
    found = []
    for d in range(depth):
        before = changed.copy()
        changed[1:] |= rows[1:, d] != rows[:-1, d]
        leaves[changed & ~before if d else changed] = d
        at = np.flatnonzero(changed)
        real = rows[at, d] > 0
        found.append((at[real], np.diff(at, append=n)[real]))
    made = np.maximum((rows > 0).sum(axis=1) - leaves, 0)
    place = np.cumsum(made) - made - leaves
    total = int(made.sum())
    start, ends, counts = (np.empty(total, dtype=np.int64) for _ in range(3))
    for d, (at, count) in enumerate(found):
        to = place[at] + d
        start[to], ends[to], counts[to] = at, d, count
    out = rows[start]
    out[np.arange(depth)[None, :] > ends[:, None]] = 0
    return Table(labels, out, counts)


def build(table: Table) -> Automaton:
    """The automaton of a sorted table of different rows."""
    rows, weights = table.rows, table.weights
    n, depth = rows.shape
    length = (rows > 0).sum(axis=1)
    changed = np.zeros(n, dtype=bool)
    changed[:1] = True
    nodes, parents, labels, values = [], [], [], []
    above = np.zeros(n, dtype=np.int64)
    for d in range(depth):
        changed[1:] |= rows[1:, d] != rows[:-1, d]
        here = changed & (rows[:, d] > 0)
        at = np.flatnonzero(here)
        nodes.append(at)
        parents.append(above[at])
        above = np.cumsum(here) - 1
        labels.append(rows[at, d])
        values.append(np.where(length[at] == d + 1, weights[at], 0))
    firsts, arcs, n_states, n_arcs = [np.zeros(1, dtype=np.int64)], [], 1, 0
    target = np.zeros(len(nodes[-1]), dtype=np.int64)
    for d in range(depth - 1, -1, -1):
        arc = np.stack((labels[d], values[d], target)) if len(nodes[d]) else np.zeros((3, 0), dtype=np.int64)
        above = len(nodes[d - 1]) if d else 1
        # The children of a node are consecutive.
        size = np.bincount(parents[d], minlength=above)
        bounds = np.cumsum(size) - size
        held = np.flatnonzero(size) if d else np.zeros(1, dtype=np.int64)
        kept, number = _merged(arc, bounds[held], size[held])
        target = np.zeros(above, dtype=np.int64)
        target[held] = n_states + number
        begin, count = bounds[held][kept], size[held][kept]
        arcs.append(arc[:, _spread(begin, count)])
        firsts.append(n_arcs + np.cumsum(count) - count)
        n_states += len(kept)
        n_arcs += int(count.sum())
    label, weight, target = np.concatenate(arcs, axis=1) if arcs else np.zeros((3, 0), dtype=np.int64)
    return Automaton(table.labels, depth, np.append(np.concatenate(firsts), n_arcs), label, weight, target)


def _spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... for `count` entries each."""
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def _merged(arc: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the states (runs of arcs) to keep, and for each state the number of its equal among these."""
    if len(begin) <= 1:
        return np.arange(len(begin)), np.zeros(len(begin), dtype=np.int64)
    # The runs stand one after another and leave no arc out.
    h = _spread(np.zeros(len(size), dtype=np.int64), size).astype(np.uint64) * _ODD
    for part in arc:
        h = mix(h + part.astype(np.uint64) * _ODD + _ODD)
    found, same = first_seen(np.add.reduceat(h, begin))
    # States of equal hash must have equal arcs; one that has not stays by itself.
    twin = found[same]
    fits = size[twin] == size
    pairs = np.flatnonzero(fits & (twin != np.arange(len(size))))
    a, b = _spread(begin[pairs], size[pairs]), _spread(begin[twin[pairs]], size[pairs])
    differ = (arc[:, a] != arc[:, b]).any(axis=0)
    fits[np.repeat(pairs, size[pairs])[differ]] = False
    if fits.all():
        return found, same
    twin = np.where(fits, twin, np.arange(len(size)))
    kept, number = np.unique(twin, return_inverse=True)
    return kept, number


def paths(a: Automaton, ordered: bool = True) -> Table:
    """The sequences of an automaton with a weight above zero; unless `ordered`, by their lengths."""
    states = np.array([len(a.first) - 2])
    prefix = np.zeros((1, 0), dtype=np.int32)
    found, weights = [], []
    for d in range(a.depth):
        count = a.first[states + 1] - a.first[states]
        arcs = _spread(a.first[states], count)
        prefix = np.concatenate((np.repeat(prefix, count, axis=0), a.label[arcs].astype(np.int32)[:, None]), axis=1)
        states = a.target[arcs]
        real = a.weight[arcs] > 0
        found.append(np.pad(prefix[real], ((0, 0), (0, a.depth - d - 1))))
        weights.append(a.weight[arcs][real])
    rows = np.concatenate(found) if found else np.zeros((0, a.depth), dtype=np.int32)
    if not len(rows):
        return Table([], rows, np.zeros(0, dtype=np.int64))
    found = Table(a.labels, rows, np.concatenate(weights))
    return summed(*found) if ordered else found


def renumbered(tables: list[Table]) -> tuple[pa.LargeBinaryArray, list[np.ndarray]]:
    """One list of labels for all tables, and their rows in its numbers."""
    held = [as_array(t.labels) for t in tables]
    labels, number = in_order(pa.concat_arrays(held))
    ends = np.cumsum([len(x) for x in held]).tolist()
    zero = np.zeros(1, dtype=np.int32)
    rows = [np.concatenate((zero, number[e - len(x) : e]))[t.rows] for t, x, e in zip(tables, held, ends, strict=True)]
    return labels, rows


def union(tables: list[Table], depth: int, how: np.ufunc = np.add) -> Table:
    """All sequences of the tables; weights of the same sequence are added up (or combined by `how`)."""
    tables = [t for t in tables if len(t.rows)]
    if not tables:
        return Table([], np.zeros((0, depth), dtype=np.int32), np.zeros(0, dtype=np.int64))
    labels, rows = renumbered(tables)
    return summed(labels, np.concatenate(rows), np.concatenate([t.weights for t in tables]), how)


def compose(asked: Table, known: Automaton) -> np.ndarray:
    """The weight that `known` gives to each sequence of `asked`; 0 for a sequence it does not have.

    Both are walked together: the sequences as they are, the automaton along
    the arcs with the same labels.
    """
    number = pc.fill_null(pc.index_in(as_array(asked.labels), as_array(known.labels)), -2).to_numpy()
    rows = np.concatenate(([0], number.astype(np.int64) + 1))[asked.rows]
    state = np.full(len(rows), len(known.first) - 2)
    weight = np.zeros(len(rows), dtype=np.int64)
    wide = len(known.labels) + 1
    owner = np.repeat(np.arange(len(known.first) - 1), np.diff(known.first))
    # Arcs are stored by state, and in the order of labels within a state.
    keys = owner * wide + known.label
    alive = np.ones(len(rows), dtype=bool)
    for d in range(min(rows.shape[1], known.depth)):
        step = np.flatnonzero(alive & (rows[:, d] != 0))
        want = state[step] * wide + rows[step, d]
        at = np.minimum(np.searchsorted(keys, want), max(len(keys) - 1, 0))
        hit = (rows[step, d] > 0) & (keys[at] == want) if len(keys) else np.zeros(len(step), dtype=bool)
        weight[step] = np.where(hit, known.weight[at] if len(keys) else 0, 0)
        state[step[hit]] = known.target[at[hit]]
        alive[step[~hit]] = False
    return weight


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(data, asbytes=True)


def _whole(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Whole numbers as byte planes, compressed; planes above the largest number are left out."""
    planes = max(1, -(-int(numbers.max(initial=0)).bit_length() // 8)) if numbers.min(initial=0) >= 0 else 8
    low = numbers.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :planes]
    return bytes([planes]) + _squeezed(np.ascontiguousarray(low.T).tobytes())


def unpack_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_whole(data[1:]), dtype=np.uint8).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, : data[0]] = planes.T
    return out.view("<i8").ravel()


def pack(a: Automaton) -> bytes:
    labels = as_array(a.labels)
    sizes = pc.binary_length(labels).to_numpy()
    text = b""
    if len(labels):
        _, ends, held = labels.buffers()
        ends = np.frombuffer(ends, dtype=np.int64)[labels.offset : labels.offset + len(labels) + 1]
        text = held.slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes() if held else b""
    head = np.array([a.depth, len(a.first), len(a.label), len(labels)])
    numbers = [head, np.diff(a.first, prepend=0), a.label, a.weight, a.target, sizes]
    # One block for small automata: few bytes of overhead.
    body = pack_numbers(np.concatenate(numbers))
    return len(body).to_bytes(8, "little") + body + _squeezed(text)


def unpack(data: bytes) -> Automaton:
    size = int.from_bytes(data[:8], "little")
    numbers = unpack_numbers(data[8 : 8 + size])
    depth, n_first, n_arcs, n_labels = numbers[:4].tolist()
    first, label, weight, target, sizes = np.split(numbers[4:], np.cumsum([n_first, n_arcs, n_arcs, n_arcs]))
    ends = np.concatenate(([0], np.cumsum(sizes)))
    held = [None, pa.py_buffer(ends), pa.py_buffer(_whole(data[8 + size :]))]
    labels = pa.Array.from_buffers(pa.large_binary(), n_labels, held)
    return Automaton(labels, depth, np.cumsum(first), label, weight, target)
