"""Exact top-k by inner product, as a Voronoi join.

Pivots, a bounded set of the vectors themselves, part the space into cells.
Every query belongs to the cell of its nearest pivot; a cell is summed up by
its number of queries and its radius, the largest distance of a query to the
pivot. By Cauchy and Schwarz the score of a vector c against any query of a
cell with pivot p and radius r lies between p.c - r|c| and p.c + r|c|. The k+1
best lower bounds of a cell over all vectors (one more than k, as a query may
meet itself) bound from below what a vector must be able to reach; one whose
upper bound falls short is not sent to that cell. Bounds only spare work, they
never change a result.

Cells are packed into groups of at most GROUP_QUERIES queries, large cells are
cut. A vector goes once to every group with a cell that needs it. What a group
receives is dealt into blocks by hash, and each block is searched with the
group's queries by itself, so neither a popular cell nor a vector that stands
very many times makes a large task. The best k of the blocks are merged.

What is collected and sent with the jobs are the pivots and one row of totals
per cell: at most PIVOTS rows, whatever the size of the table.

Components become floor(scale * x); scores are exact integers.

Defined cases: a vector that is missing or holds a missing or non-finite
component (after scaling) takes no part, nor does one without an id. An empty
vector scores 0 against all; of vectors of different lengths the shorter counts
as filled up with zeros. A score beyond 64 bits becomes the largest (smallest)
64-bit number. An empty table gives an empty result. Rows
that share the query's id are the query's own. Rows that share another id are
candidates each. Repeated query rows are one query; different vectors under one
id are answered each. Fewer than k candidates give as many rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketflow.llm.text import cut_lineage

# Fixed by the contract.
SCALE = 256
TOP = 5

PIVOTS = 64
GROUP_QUERIES = 4096
BLOCK_ROWS = 1 << 14
# Rows that are searched at once within a task.
SLICE_ROWS = 2048
# Doubles from here on are whole numbers.
_WHOLE = 2.0**53
_SCORES = 2.0**63
# Sums below this are exact in floating point.
_EXACT = 2.0**52


def _usable(vec: Column) -> Column:
    def finite(x: Column) -> Column:
        # NaN counts as larger than any number.
        return x.isNotNull() & (F.abs(x.cast("double") * SCALE) < float("inf"))

    return vec.isNotNull() & F.forall(vec, finite)


def scaled_vectors(table: DataFrame, vector: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part; vec holds whole numbers as doubles."""

    def scaled(x: Column) -> Column:
        big = x.cast("double") * SCALE
        return F.when(F.abs(big) < _WHOLE, F.floor(big).cast("double")).otherwise(big)

    doubles = F.transform(F.col(vector), scaled)
    return table.filter(F.col("vec_id").isNotNull() & _usable(F.col(vector))).select(
        F.col("vec_id").cast("long").alias("vec_id"), doubles.alias("vec")
    )


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros (and never cut) to `width` or more."""
    sizes = {len(v) for v in vectors}
    wide = max(sizes | {width})
    if sizes == {wide}:
        return np.stack(list(vectors))
    out = np.zeros((len(vectors), wide))
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def _alike(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two matrices with as many columns."""
    wide = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, wide - m.shape[1]))) for m in (a, b))


def _lengths(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m * m).sum(axis=1))


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products; whole numbers of any size within 64 bits."""
    queries, vectors = _alike(queries, vectors)
    largest = _lengths(queries).max(initial=0) * _lengths(vectors).max(initial=0)
    if largest < _EXACT:
        return (queries @ vectors.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    info = np.iinfo(np.int64)
    return np.clip(whole(queries) @ whole(vectors).T, info.min, info.max).astype(np.int64)


def _pivots(vectors: DataFrame, count: int) -> np.ndarray:
    """Different vectors, the first ones by hash: the same on every run."""
    first = vectors.select("vec").distinct().orderBy(F.xxhash64("vec"), "vec").limit(count).collect()
    return _matrix(pd.Series([np.asarray(r["vec"], dtype=float) for r in first], dtype=object), 0)


def _cells(pivots: np.ndarray) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Queries with the nearest pivot and the distance to it."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            rows, centres = _alike(_matrix(batch["vec"], 0), pivots)
            squares = (centres * centres).sum(axis=1) - 2 * rows @ centres.T
            cell = squares.argmin(axis=1)
            distance = _lengths(rows - centres[cell])
            yield batch.assign(cell=cell.astype(np.int32), distance=distance)

    return assign


def _bounds(m: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of every vector's score against the queries of every cell, rounding allowed for."""
    rows, centres = _alike(m, centres)
    middle, reach = rows @ centres.T, _lengths(rows)[:, None] * radii[None, :]
    slack = 1 + 1e-9 * (np.abs(middle) + reach)
    # Scores beyond 64 bits are all the same.
    return np.clip(middle - reach - slack, -_SCORES, _SCORES), np.clip(middle + reach + slack, -_SCORES, _SCORES)


def _lower_bounds(centres: np.ndarray, cells: np.ndarray, radii: np.ndarray, keep: int):
    """The `keep` best lower bounds of every cell within a task."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = np.full((0, len(cells)), -np.inf)
        for batch in batches:
            if len(batch):
                low, _ = _bounds(_matrix(batch["vec"], 0), centres, radii)
                # A bound that is no number bounds nothing.
                best = -np.sort(-np.concatenate((best, np.nan_to_num(low, nan=-np.inf))), axis=0)[:keep]
        yield pd.DataFrame({"cell": np.tile(cells, len(best)), "bound": best.ravel()})

    return scan


def _sent(centres: np.ndarray, radii: np.ndarray, least: np.ndarray, groups_of: list[list[int]], blocks: int):
    """A row per vector and group with a cell that needs the vector."""
    members = np.zeros((len(radii), max((g for gs in groups_of for g in gs), default=-1) + 1), dtype=bool)
    for cell, groups in enumerate(groups_of):
        members[cell, groups] = True

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            _, high = _bounds(_matrix(batch["vec"], 0), centres, radii)
            row, group = np.nonzero((~(high < least[None, :])).astype(np.int32) @ members.astype(np.int32))
            block = (batch["hash"].to_numpy()[row] % blocks).astype(np.int32)
            yield pd.DataFrame(
                {
                    "group": group.astype(np.int32),
                    "block": block,
                    "vec_id": batch["vec_id"].to_numpy()[row],
                    "vec": batch["vec"].to_numpy()[row],
                }
            )

    return scan


def _search(top: int):
    """The best `top` vectors of a block for every query of its group, by score and then by id."""

    def solve(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(block):
            asked, own = _matrix(queries["vec"], 0), queries["query_id"].to_numpy()
            # In order of id, so that a stable sort by score settles ties.
            block = block.sort_values("vec_id", kind="stable")
            ids = block["vec_id"].to_numpy()
            for first in range(0, len(block), SLICE_ROWS):
                part = ids[first : first + SLICE_ROWS]
                scores = _scores(asked, _matrix(block["vec"].iloc[first : first + SLICE_ROWS], 0))
                for q in range(len(own)):
                    line = scores[q]
                    if len(part) > 4 * top:
                        # All rows that reach the score of place `top`, counted without the query's own rows.
                        others = line[part != own[q]]
                        if len(others) > top:
                            reach = np.partition(others, len(others) - top)[len(others) - top]
                            at = np.flatnonzero((line >= reach) & (part != own[q]))
                        else:
                            at = np.flatnonzero(part != own[q])
                    else:
                        at = np.flatnonzero(part != own[q])
                    # The complement turns the order round, for the smallest number too.
                    at = at[np.argsort(~line[at], kind="stable")][:top]
                    found.append((np.full(len(at), q), part[at], line[at]))
        if not found:
            return pd.DataFrame({"query_key": [], "query_id": [], "vec_id": [], "score": []}).astype("int64")
        q, ids, scores = (np.concatenate(x) for x in zip(*found, strict=True))
        best = pd.DataFrame({"q": q, "vec_id": ids, "score": scores})
        best = best.sort_values(["q", "score", "vec_id"], ascending=[True, False, True], kind="stable").groupby("q").head(top)
        return pd.DataFrame(
            {
                "query_key": queries["query_key"].to_numpy()[best["q"]],
                "query_id": queries["query_id"].to_numpy()[best["q"]],
                "vec_id": best["vec_id"].to_numpy(),
                "score": best["score"].to_numpy(),
            }
        )

    return solve


def _packed(counts: list[int], most: int) -> tuple[list[list[int]], list[int]]:
    """Groups of every cell, and into how many parts each cell is cut: whole cells while they fit, large ones alone."""
    groups, parts, group, held = [], [], -1, most
    for n in counts:
        if n > most:
            parts.append(-(-n // most))
            groups.append(list(range(group + 1, group + 1 + parts[-1])))
            group, held = group + parts[-1], most
            continue
        if held + n > most:
            group, held = group + 1, 0
        held += n
        parts.append(1)
        groups.append([group])
    return groups, parts


def top_k(
    table: DataFrame,
    is_query: Column,
    k: int = TOP,
    vector: str = "embedding",
    pivots: int = PIVOTS,
    group_queries: int = GROUP_QUERIES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of `table` with `is_query` (a condition on vec_id), the k other rows
    of largest inner product, ties to the smaller vec_id; `vector` names the column of vectors."""
    spark = table.sparkSession
    vectors = cut_lineage(scaled_vectors(table, vector))
    queries = vectors.filter(is_query).distinct()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    centres = _pivots(queries, pivots)
    total = vectors.count()
    if not len(centres):
        return empty
    assigned = cut_lineage(queries.mapInPandas(_cells(centres), "vec_id long, vec array<double>, cell int, distance double"))
    summary = assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("radius"))
    summary = sorted(summary.collect())
    cells = np.array([r["cell"] for r in summary], dtype=np.int32)
    radii = np.array([r["radius"] for r in summary])
    centres = centres[cells]

    lows = vectors.select("vec").mapInPandas(_lower_bounds(centres, cells, radii, k + 1), "cell int, bound double")
    in_order = Window.partitionBy("cell").orderBy(F.col("bound").desc())
    kept = lows.withColumn("place", F.row_number().over(in_order)).filter(F.col("place") == k + 1).collect()
    found = {r["cell"]: r["bound"] for r in kept}
    least = np.array([found.get(int(c), -np.inf) for c in cells])

    groups, parts = _packed([r["n"] for r in summary], group_queries)
    blocks = total // block_rows + 1
    where = spark.createDataFrame(
        [(int(c), g[0], p) for c, g, p in zip(cells, groups, parts, strict=True)], "cell int, first int, parts int"
    )
    # At most `pivots` rows.
    part = F.pmod(F.xxhash64("vec_id", "vec"), F.col("parts")).cast("int")
    asked = assigned.join(F.broadcast(where), "cell").select(
        (F.col("first") + part).alias("group"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.xxhash64("vec_id", "vec").alias("query_key"),
        F.col("vec_id").alias("query_id"),
        "vec",
    )
    hashed = vectors.withColumn("hash", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(1 << 40)))
    sent = hashed.mapInPandas(
        _sent(centres, radii, least, groups, blocks), "group int, block int, vec_id long, vec array<double>"
    )
    best = (
        asked.groupBy("group", "block")
        .cogroup(sent.groupBy("group", "block"))
        .applyInPandas(_search(k), "query_key long, query_id long, vec_id long, score long")
    )
    ranked = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
