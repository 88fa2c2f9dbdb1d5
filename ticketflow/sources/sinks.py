"""Full-refresh table sink and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def full_refresh(df: DataFrame, path: str, sort_by: tuple[str, ...] = ()) -> None:
    """Replace the Parquet table at `path`, whether or not it exists yet.

    The new rows are written next to the table first. When complete, the old
    table moves aside and the new one takes its place; the old one is deleted
    last and moved back if the new one cannot take its place. `sort_by` orders the rows inside each file. That needs no shuffle; a table promises
    no order across its files.
    """
    spark = df.sparkSession
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    staging = hadoop.Path(f"{path.rstrip('/')}__new_{uuid.uuid4().hex}")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        df.write.parquet(staging.toString())
    except Exception:
        files.delete(staging, True)
        raise
    old = hadoop.Path(f"{path.rstrip('/')}__old_{uuid.uuid4().hex}")
    replaces = files.exists(target)
    if replaces and not files.rename(target, old):
        files.delete(staging, True)
        raise OSError(f"could not move the old table at {path} aside")
    if not files.rename(staging, target):
        if replaces:
            files.rename(old, target)
        files.delete(staging, True)
        raise OSError(f"could not move the new table to {path}")
    if replaces:
        files.delete(old, True)


def full_refresh_table(df: DataFrame, name: str, sort_by: tuple[str, ...] = ()) -> None:
    """Replace a table of the catalog by the rows of `df`, whether or not it exists yet.

    Written under another name and swapped by renaming, so `df` may read the
    table itself and a failed run leaves the old one.
    """
    spark = df.sparkSession
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    staging = f"{name}__new_{uuid.uuid4().hex}"
    try:
        df.write.format("parquet").saveAsTable(staging)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        raise
    replace_table(spark, staging, name)


def replace_table(spark: SparkSession, staging: str, name: str) -> None:
    """Give the complete table `staging` the name `name`; a table of that name is dropped, last."""
    old = f"{name}__old_{uuid.uuid4().hex}"
    replaces = spark.catalog.tableExists(name)
    if replaces:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")
    except Exception:
        if replaces:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        raise
    if replaces:
        spark.sql(f"DROP TABLE {old}")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name on storage all executors share.

    The cluster names the storage in `spark.checkpoint.dir`; only a local
    session falls back to the machine's own temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        # local[...] is one machine; local-cluster is not treated as one.
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/ticketflow-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The same rows, written once to a new scratch folder and read back.

    Cuts the lineage on storage that survives a lost executor. The folder stays
    for as long as the result may be read; the cluster's own clean-up of
    `spark.checkpoint.dir` removes it, or `remove_folder`.
    """
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder and all it holds."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
