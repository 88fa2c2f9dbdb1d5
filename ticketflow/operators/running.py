"""Running totals: without gaps per key, and over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketflow.sources.sinks import stored


def dense_running_total(
    df: DataFrame, keys: list[str], position: str, amount: str, first: Column, last: Column
) -> DataFrame:
    """Amount and running total per key at every position from first to last.

    `df` holds one row per key and occupied position (an integer between first
    and last, which may be columns of `df`). Each row is repeated up to the
    next occupied position, so the gaps cost no join and no shuffle; the
    positions before a key's first row get a zero total. The window sorts at
    most (last - first + 1) rows per key.
    """
    by_position = Window.partitionBy(*keys).orderBy(position)
    begin = F.when(F.row_number().over(by_position) == 1, first).otherwise(F.col(position))
    end = F.coalesce(F.lead(position).over(by_position) - 1, last)
    runs = df.select(
        *keys,
        position,
        amount,
        F.sum(amount).over(by_position.rowsBetween(Window.unboundedPreceding, 0)).alias("_total"),
        begin.alias("_begin"),
        end.alias("_end"),
    )
    filled = runs.withColumn("_at", F.explode(F.sequence("_begin", "_end")))
    zero = F.lit(0).cast("bigint")
    return filled.select(
        *keys,
        F.col("_at").alias(position),
        F.when(F.col("_at") == F.col(position), F.col(amount)).otherwise(zero).alias(amount),
        F.when(F.col("_at") >= F.col(position), F.col("_total")).otherwise(zero).alias("running_total"),
    )


def prefix_totals(df: DataFrame, order: str, amount: str) -> DataFrame:
    """`order`, `amount` and the running total of the amount over the whole table, in ascending order.

    A distributed prefix sum: rows are dealt to partitions by range and summed
    up within each; the totals of the partitions, one row each, give what
    precedes every partition. `order` values are distinct. The dealt rows are
    stored, since the bounds of a range sort differ from run to run.
    """
    dealt = df.select(order, amount).repartitionByRange(order)
    dealt = stored(dealt.select(order, amount, F.spark_partition_id().alias("_part")))
    in_part = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    within = dealt.withColumn("_within", F.sum(amount).over(in_part))
    sums = dealt.groupBy("_part").agg(F.sum(amount).alias("_sum"))
    # One row per partition.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    total = (F.col("_within") + F.col("_offset")).alias("running_total")
    return within.join(F.broadcast(offsets), "_part").select(order, amount, total)
