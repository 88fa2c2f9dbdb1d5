"""Report tables as CSV with a header: column contracts, reading, writing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.sources.sinks import stored
from ticketflow.sources.tables import blank_to_null

REPORTS = {
    "t_nb_ticket": "CREATED_MONTH string, TICKET string, NEW_TICKET bigint",
    "t_nb_ticket_team": "CREATED_MONTH string, TICKET string, APPGROUP string, NEW_TICKET bigint",
    "t_throughput_ticket": "CLOSED_MONTH string, TICKET string, THROUGHPUT bigint",
    "t_throughput_ticket_team": "CLOSED_MONTH string, TICKET string, APPGROUP string, THROUGHPUT bigint",
    "t_backlog_ticket": "CUTPOINT date, TICKET string, BACKLOG bigint",
    "t_backlog_ticket_team": "CUTPOINT date, TICKET string, APPGROUP string, BACKLOG bigint",
    "t_throughputtime_ticket": "CLOSED_MONTH string, TICKET string, THROUGHPUT_TIME double",
    "t_throughputtime_ticket_team": "CLOSED_MONTH string, TICKET string, APPGROUP string, THROUGHPUT_TIME double",
    "t_fte_ticket": "MONTH_WORKTIMESHEET string, TICKET string, FTE double, FTE_NORM double",
    "t_fte_ticket_team": (
        "MONTH_WORKTIMESHEET string, TICKET string, USERORG_WORKTIMESHEET string, FTE double, FTE_NORM double"
    ),
    "t_fte_phases": "MONTH_WORKTIMESHEET string, FTE_BREAKDOWN string, FTE double, FTE_NORM double",
    "t_fte_phases_team": (
        "MONTH_WORKTIMESHEET string, FTE_BREAKDOWN string, USERORG_WORKTIMESHEET string, FTE double, FTE_NORM double"
    ),
    "t_conf_agg": "CREATED_MONTH string, TICKET string, CONFORM boolean, COUNT bigint, CUMULATIVE_COUNT bigint",
    "t_conf": (
        "TICKET string, OID bigint, CREATED_MONTH string, HAS_DEMAND boolean, HAS_RELEASE boolean, "
        "DEMAND_BEFORE_RELEASE boolean, CONFORM boolean"
    ),
    "t_lb_tp_open": "TICKET string, RANK int, OID bigint, CREATED timestamp_ntz, AGE_DAYS int",
    "t_lb_fte_open": "TICKET string, RANK int, OID bigint, FTE double",
}

# The dialect: header line, comma, doubled quotes, NA for missing.
_DIALECT = {
    "header": "true",
    "nullValue": "NA",
    "quote": '"',
    "escape": '"',
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, multiline: bool = True) -> DataFrame:
    """CSV with a declared schema; empty strings count as missing.

    Columns are found by their name in the header line, whatever their order;
    others are left out, a missing one is an error. A cell that does not parse
    as its type fails the read; `read_csv_setting_aside` keeps such rows apart.
    Inference would turn month labels into timestamps, so a schema is needed.
    A file with quoted line breaks cannot be split between tasks; pass
    `multiline=False` for large single files known to hold none.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader, in_file = _by_name(spark, path, declared, multiline)
    df = reader.options(mode="FAILFAST", enforceSchema="false").schema(in_file).csv(path)
    return _named(df, declared)


def read_csv_setting_aside(
    spark: SparkSession, path: str, schema: T.StructType | str, multiline: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The rows of a CSV that fit the schema, and the others as their text (`record`).

    As `read_csv`, but a row with a cell that does not parse, or with too few or
    too many cells, is set aside instead of failing the read. The file is parsed
    once, whole rows into the scratch folder, so both tables show the same parse.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader, in_file = _by_name(spark, path, declared, multiline)
    record = f"record_{uuid.uuid4().hex}"
    kinds = T.StructType([*in_file.fields, T.StructField(record, T.StringType())])
    parsed = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=record, enforceSchema="false").schema(kinds)
    parsed = stored(parsed.csv(path))
    kept = _named(parsed.filter(F.col(record).isNull()), declared)
    return kept, parsed.filter(F.col(record).isNotNull()).select(F.col(record).alias("record"))


def _by_name(
    spark: SparkSession, path: str, declared: T.StructType, multiline: bool
) -> tuple[DataFrameReader, T.StructType]:
    """A reader, and the schema in the order of the header line."""
    reader = spark.read.options(**_DIALECT).option("multiLine", multiline)
    header = reader.csv(path).columns
    missing = [name for name in declared.fieldNames() if name not in header]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in the header of {path}")
    kinds = {f.name: f.dataType for f in declared.fields}
    return reader, T.StructType([T.StructField(name, kinds.get(name, T.StringType())) for name in header])


def _named(df: DataFrame, declared: T.StructType) -> DataFrame:
    """The declared columns, empty strings as missing."""
    return df.select(
        *(
            blank_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in declared.fields
        )
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_DIALECT).csv(path)


def read_report(spark: SparkSession, base: str, name: str, multiline: bool = True) -> DataFrame:
    return read_csv(spark, f"{base}/{name}.csv", REPORTS[name], multiline)


def write_report(df: DataFrame, base: str, name: str) -> None:
    """Write one report, its columns in contract order."""
    columns = T.StructType.fromDDL(REPORTS[name]).fieldNames()
    write_csv(df.select(*columns), f"{base}/{name}.csv")
