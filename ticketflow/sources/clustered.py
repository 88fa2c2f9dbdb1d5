"""Tables of the catalog clustered by a key: joins on the key shuffle nothing of them.

A clustered table is bucketed and sorted by its key and by a slice number. The
slice is 0 for all rows of an ordinary key; a hot key's rows are cut into
slices by a hash of other columns, so they lie in several buckets. A join
repeats only the hot keys' rows of the other side, once per slice, and sends
that side alone to the buckets.

The slice counts of the hot keys stand in a second table. Its name is a
property of the clustered table, so a reader never sees the rows of one
refresh with the slices of another.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.operators.hot_keys import HOT_ROWS, hot_keys_by_summary
from ticketflow.sources.sinks import replace_table

SLICE = "key_slice"
BUCKETS = 64
SLICES_OF = "ticketflow.slices"


def write_clustered(
    df: DataFrame,
    name: str,
    key: str,
    slice_by: list[str],
    buckets: int = BUCKETS,
    hot: DataFrame | None = None,
) -> None:
    """Replace the clustered table `name` by the rows of `df`, whether or not it exists yet.

    `hot` lists the hot keys and their number of slices (see `hot_keys`);
    `slice_by` names the columns whose hash deals their rows. Choose `buckets`
    so that one holds what a task can sort. The rows are shuffled once, here,
    and each bucket is one file.
    """
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    staging, slices = f"{name}__new_{mark}", f"{name}__slices_{mark}"
    hot = hot_keys_by_summary(df, key, HOT_ROWS) if hot is None else hot
    before = _slices_of(spark, name) if spark.catalog.tableExists(name) else None
    try:
        # Read back, so that the rows are cut by the very counts a reader will find.
        hot.select("_hot_key", "_hot_parts").write.format("parquet").saveAsTable(slices)
        part = F.coalesce(F.pmod(F.xxhash64(*slice_by), F.col("_hot_parts")).cast("int"), F.lit(0))
        cut = df.join(F.broadcast(spark.table(slices)), F.col(key) == F.col("_hot_key"), "left").select(
            *df.columns, part.alias(SLICE)
        )
        dealt = cut.repartition(buckets, key, SLICE)
        dealt.write.format("parquet").bucketBy(buckets, key, SLICE).sortBy(key, SLICE).saveAsTable(staging)
        spark.sql(f"ALTER TABLE {staging} SET TBLPROPERTIES ('{SLICES_OF}' = '{slices}')")
        replace_table(spark, staging, name)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        spark.sql(f"DROP TABLE IF EXISTS {slices}")
        raise
    if before is not None:
        spark.sql(f"DROP TABLE IF EXISTS {before}")


def drop_clustered(spark: SparkSession, name: str) -> None:
    slices = _slices_of(spark, name)
    spark.sql(f"DROP TABLE {name}")
    if slices is not None:
        spark.sql(f"DROP TABLE IF EXISTS {slices}")


def _slices_of(spark: SparkSession, name: str) -> str | None:
    properties = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == SLICES_OF).first()
    return None if properties is None else properties["value"]


def read_clustered(spark: SparkSession, name: str) -> DataFrame:
    """The rows as they were written, without their slice."""
    return spark.table(name).drop(SLICE)


def join_clustered(
    spark: SparkSession,
    name: str,
    single: DataFrame,
    key: str,
    single_key: str,
    how: str = "inner",
    where: Column | None = None,
) -> DataFrame:
    """Join the clustered table `name` to `single`, which holds about one row per key.

    The clustered table is read in its buckets and is neither shuffled nor, a
    hot key's slices apart, gathered by key. Every row meets exactly one copy
    of its partner, so inner, left, semi and anti joins are exact.
    """
    slices = _slices_of(spark, name)
    if slices is None:
        raise ValueError(f"{name} was not written as a clustered table")
    rows = spark.table(name)
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_hot_parts") - 1, F.lit(0))))
    repeated = (
        single.join(F.broadcast(spark.table(slices)), F.col(single_key) == F.col("_hot_key"), "left")
        .withColumn("_hot_copy", copies)
        .drop("_hot_key", "_hot_parts")
    )
    # The buckets hold the key in its own type; a partner cast to it is dealt the same way.
    on = (rows[key] == F.col(single_key).cast(rows.schema[key].dataType)) & (rows[SLICE] == F.col("_hot_copy"))
    if where is not None:
        on = on & where
    return rows.join(repeated, on, how).drop(SLICE, "_hot_copy")
