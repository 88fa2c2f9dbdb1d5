"""Tables in versions: a commit without a moment in which there is no table.

A table is a folder. Each commit writes a version folder of its own and then
replaces one small pointer file, `_current`, by an atomic rename; readers
follow the pointer, so they find either the old or the new table whole. A job
that dies before the rename leaves the table as it was, and a folder that
`drop_versions` removes. Going back is a new pointer to an old version.

The pointer names the version and the one before it. Two writers at once: the
later rename wins; with `expected`, a commit refuses if another one came first.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"
ANY = "any"


@dataclass(frozen=True)
class Version:
    """What the pointer says: a version's folder name, and the names of those committed before it, newest first."""

    name: str
    earlier: tuple[str, ...]


def _path(spark: SparkSession, *parts: str) -> JavaObject:
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(p.rstrip("/") for p in parts))


def _files(spark: SparkSession, path: JavaObject) -> JavaObject:
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, table: str) -> Version | None:
    """The version a reader would take now; None where nothing was committed yet."""
    pointer = _path(spark, table, POINTER)
    files = _files(spark, pointer)
    if not files.exists(pointer):
        return None
    source = files.open(pointer)
    try:
        said = json.loads(bytes(source.readAllBytes()).decode())
    finally:
        source.close()
    return Version(said["name"], tuple(said["earlier"]))


def _point(spark: SparkSession, table: str, version: Version) -> None:
    """Replace the pointer in one step."""
    pointer, fresh = _path(spark, table, POINTER), _path(spark, table, f"{POINTER}_{uuid.uuid4().hex}")
    files = _files(spark, pointer)
    files.mkdirs(_path(spark, table))
    sink = files.create(fresh, False)
    try:
        sink.write(bytearray(json.dumps({"name": version.name, "earlier": list(version.earlier)}).encode()))
    finally:
        sink.close()
    jvm = spark._jvm
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.makeQualified(pointer).toUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(files.makeQualified(fresh), files.makeQualified(pointer), overwrite)


def write_version(df: DataFrame, table: str, sort_by: tuple[str, ...] = ()) -> str:
    """Write the rows as a version that nobody reads yet, and name it. `df` may read the table itself."""
    name = f"v_{uuid.uuid4().hex}"
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    df.write.parquet(f"{table.rstrip('/')}/{name}")
    return name


def publish_version(spark: SparkSession, table: str, name: str, expected: str | None = ANY) -> Version:
    """Let readers find a written version. `expected` is the version that has to be current before, None for none."""
    now = current_version(spark, table)
    if expected != ANY and expected != (now.name if now else None):
        raise RuntimeError(f"{table} has been committed by another writer: version {now.name if now else None}")
    earlier = () if now is None else (now.name, *(v for v in now.earlier if v != now.name))
    version = Version(name, tuple(v for v in earlier if v != name))
    _point(spark, table, version)
    return version


def commit(df: DataFrame, table: str, sort_by: tuple[str, ...] = ()) -> Version:
    """Write the rows and make them the table, unless another writer was faster."""
    spark = df.sparkSession
    before = current_version(spark, table)
    name = write_version(df, table, sort_by)
    return publish_version(spark, table, name, before.name if before else None)


def read_version(spark: SparkSession, table: str, name: str | None = None) -> DataFrame:
    """The current rows, or those of a version."""
    if name is None:
        now = current_version(spark, table)
        if now is None:
            raise FileNotFoundError(f"{table} has no committed version")
        name = now.name
    return spark.read.parquet(f"{table.rstrip('/')}/{name}")


def roll_back(spark: SparkSession, table: str) -> Version:
    """Make the version before the current one the table again."""
    now = current_version(spark, table)
    if now is None or not now.earlier:
        raise RuntimeError(f"{table} has no earlier version")
    version = Version(now.earlier[0], now.earlier[1:])
    _point(spark, table, version)
    return version


def drop_versions(spark: SparkSession, table: str, keep: int = 1) -> list[str]:
    """Delete all version folders but the current one and the `keep` before it, also those of failed commits.

    Not to be run while a commit or a reader of an old version is at work.
    """
    now = current_version(spark, table)
    if now is None:
        return []
    version = Version(now.name, now.earlier[:keep])
    _point(spark, table, version)
    root = _path(spark, table)
    files = _files(spark, root)
    gone = []
    for status in files.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("v_") and name not in (version.name, *version.earlier):
            files.delete(status.getPath(), True)
            gone.append(name)
    return gone
