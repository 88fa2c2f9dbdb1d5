"""Equi-join of a large table to one row per key, safe against hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# About 200 MB of booked-time rows: what one task sorts without trouble.
HOT_ROWS = 2_000_000
# Counts of a key summary: 8 MB a task at most, and enough for 10**12 rows at HOT_ROWS.
SLOTS = 1 << 20


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with over `hot_rows` rows, and into how many parts to split each.

    The result has at most rows(df) / hot_rows rows, whatever the keys are;
    that is what bounds its broadcast. Only the key column is read, and counts
    are summed on the map side.
    """
    counted = df.groupBy(F.col(key).alias("_hot_key")).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.filter((F.col("_rows") > hot_rows) & F.col("_hot_key").isNotNull()).select(
        "_hot_key", F.ceil(F.col("_rows") / F.lit(hot_rows)).cast("int").alias("_hot_parts")
    )


def hot_keys_by_summary(df: DataFrame, key: str, hot_rows: int = HOT_ROWS, slots: int = SLOTS) -> DataFrame:
    """The same rows as `hot_keys`, without a shuffle of one row per key.

    Rows are first counted by slot, a hash of the key: a summary of at most
    `slots` counts per task that adds up across tasks. A slot holds all rows of
    its keys, so a hot key always lies in a slot with over `hot_rows` rows.
    Only keys of such slots, at most rows(df) / hot_rows slots, are counted
    exactly; adaptive execution leaves that second pass out when there are
    none. With rows(df) well under slots * hot_rows few slots are full by
    chance.
    """
    slot = F.pmod(F.xxhash64("_hot_key"), F.lit(slots)).cast("int")
    keys = df.select(F.col(key).alias("_hot_key")).filter(F.col("_hot_key").isNotNull())
    summary = keys.groupBy(slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_rows"))
    full = summary.filter(F.col("_rows") > hot_rows).select("_slot")
    candidates = keys.join(F.broadcast(full), slot == F.col("_slot"), "left_semi")
    return hot_keys(candidates, "_hot_key", hot_rows)


def join_spreading_hot_keys(
    large: DataFrame,
    single: DataFrame,
    large_key: str,
    single_key: str,
    spread_by: list[str],
    hot: DataFrame,
    how: str = "inner",
    where: Column | None = None,
) -> DataFrame:
    """Join `large` to `single`, splitting the keys listed in `hot`.

    `single` holds about one row per key (a ticket, a ticket's first dates). A
    hot key's rows in `large` are cut into parts by a hash of the `spread_by`
    columns, and only that key's row in `single` is repeated once per part.
    Each row of `large` meets exactly one copy, which keeps inner, left, semi
    and anti joins exact for any list of hot keys.

    Adaptive execution drops both joins with `hot` when the list is empty.
    """
    part = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("_hot_parts")).cast("int"), F.lit(0))
    split = (
        large.join(F.broadcast(hot), F.col(large_key) == F.col("_hot_key"), "left")
        .withColumn("_hot_part", part)
        .drop("_hot_key", "_hot_parts")
    )
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_hot_parts") - 1, F.lit(0))))
    repeated = (
        single.join(F.broadcast(hot), F.col(single_key) == F.col("_hot_key"), "left")
        .withColumn("_hot_copy", copies)
        .drop("_hot_key", "_hot_parts")
    )
    on = (F.col(large_key) == F.col(single_key)) & (F.col("_hot_part") == F.col("_hot_copy"))
    if where is not None:
        on = on & where
    return split.join(repeated, on, how).drop("_hot_part", "_hot_copy")
