"""Input tables: schemas and lookup by dataset name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


TICKETS = _schema(
    ("oid", T.LongType()),
    ("ticket_type", T.StringType()),
    ("appgroup", T.StringType()),
    ("created", T.TimestampNTZType()),
    ("closed", T.TimestampNTZType()),
)
WORKTIMESHEET = _schema(
    ("issue", T.LongType()),
    ("owner", T.LongType()),
    ("actiontypegroup", T.LongType()),
    ("startdate", T.TimestampNTZType()),
    ("hours", T.DoubleType()),
    ("timetype", T.StringType()),
)
PERMISSIONPOLICYUSER = _schema(
    ("oid", T.LongType()),
    ("name", T.StringType()),
    ("defaultorganization", T.LongType()),
)
ORGANIZATION = _schema(("oid", T.LongType()), ("name", T.StringType()))
ACTIONTYPEGROUP = _schema(("oid", T.LongType()), ("name", T.StringType()))
DEV_MILESTONES = _schema(
    ("oid", T.LongType()),
    ("demand_start", T.TimestampNTZType()),
    ("release_start", T.TimestampNTZType()),
)

SCHEMAS = {
    "tickets": TICKETS,
    "worktimesheet": WORKTIMESHEET,
    "permissionpolicyuser": PERMISSIONPOLICYUSER,
    "organization": ORGANIZATION,
    "actiontypegroup": ACTIONTYPEGROUP,
    "dev_milestones": DEV_MILESTONES,
}


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One input table, found by name under the base folder; empty strings count as missing.

    The declared schema spares Spark the look into a file's footer.
    """
    return without_blanks(spark.read.schema(SCHEMAS[name]).parquet(f"{base}/{name}.parquet"))


def catalog_table(spark: SparkSession, name: str, schema: str | None = None) -> DataFrame:
    """A table of the catalog, with its schema as prefix if it has one; empty strings count as missing."""
    return without_blanks(spark.table(f"{schema}.{name}" if schema else name))


# Only ever compared with one kind of booking, which an empty string does not
# equal; left as it is, the comparison reaches the file scan.
_AS_IS = ("timetype",)


def without_blanks(df: DataFrame) -> DataFrame:
    """Every empty string of a text column as a missing value, but for columns only compared with a set value."""
    return df.select(
        *(
            blank_to_null(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType) and f.name not in _AS_IS
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def blank_to_null(text: Column) -> Column:
    """An empty string is a missing value."""
    return F.nullif(text, F.lit(""))
