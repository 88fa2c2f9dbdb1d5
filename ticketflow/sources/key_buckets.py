"""Tables kept in buckets of a key, of which some can be rewritten.

A table is partitioned by a hash of its key. Rows of changed keys lie in few
buckets; only these are read, changed and written again, by dynamic partition
overwrite. All other files stay untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.sources.sinks import remove_folder, scratch_folder

BUCKET = "key_bucket"
BUCKETS = 64


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, key: str, buckets: int = BUCKETS, files_per_bucket: int = 1) -> None:
    """Write the whole table.

    A bucket with one hot key is written by several tasks if `files_per_bucket`
    is above one: rows are dealt by bucket and a hash of the row.
    """
    numbered = df.withColumn(BUCKET, bucket_of(key, buckets))
    part = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_bucket))
    dealt = numbered.repartition(F.col(BUCKET), part) if files_per_bucket > 1 else numbered.repartition(BUCKET)
    dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def rewrite_buckets(
    spark: SparkSession,
    path: str,
    changed: DataFrame,
    key: str,
    change: Callable[[DataFrame], DataFrame],
    buckets: int = BUCKETS,
) -> list[int]:
    """Apply `change` to the rows of all buckets that hold a key of `changed`; the buckets rewritten are returned.

    `change` keeps the columns and the key of every row. At most `buckets`
    numbers reach the driver; they prune the scan. The new rows are complete in
    the scratch folder before the first bucket is replaced, so a failure while
    they are computed leaves the table as it was; one while they are moved in
    is mended by running the same call again.
    """
    hit = sorted(r[0] for r in changed.select(bucket_of(key, buckets).alias("b")).distinct().collect())
    if not hit:
        return []
    old = spark.read.parquet(path).filter(F.col(BUCKET).isin(hit))
    scratch = scratch_folder(spark)
    try:
        new = change(old.drop(BUCKET)).select(*(c for c in old.columns if c != BUCKET))
        new.withColumn(BUCKET, bucket_of(key, buckets)).write.parquet(scratch)
        complete = spark.read.parquet(scratch)
        complete.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            BUCKET
        ).parquet(path)
    finally:
        remove_folder(spark, scratch)
    return hit
