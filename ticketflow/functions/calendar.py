"""Days, months and lead times; all of it free of time zones."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def day(ts: Column) -> Column:
    return F.to_date(ts)


def month(ts: Column) -> Column:
    """First day of the month: a fixed-width grouping key."""
    return F.trunc(F.to_date(ts), "month")


def month_label(first_day: Column) -> Column:
    """`yyyy-MM` text; apply it after grouping by `month`."""
    return F.date_format(first_day, "yyyy-MM")


def lead_days(created: Column, closed: Column) -> Column:
    """Whole calendar days from created to closed."""
    return F.datediff(closed, created)


def month_starts(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One CUTPOINT per month start from `first` to `last`."""
    step = F.make_ym_interval(months=F.lit(1))
    return spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last), step)).alias("CUTPOINT"))


def month_starts_between(cases: DataFrame, start: str, end: str) -> DataFrame:
    """One CUTPOINT per month start from the first START to the last date seen in either column."""
    bounds = cases.agg(
        month(F.min(start)).alias("first"),
        month(F.greatest(F.max(start), F.max(end))).alias("last"),
    )
    step = F.make_ym_interval(months=F.lit(1))
    return bounds.select(F.explode(F.sequence("first", "last", step)).alias("CUTPOINT"))


def micros(moment: Column) -> Column:
    """Microseconds from the start of 1970 to a moment without zone, whatever the session's time zone."""
    seconds = (F.hour(moment) * 3600 + F.minute(moment) * 60).cast("bigint")
    fraction = (F.extract(F.lit("SECOND"), moment) * 1_000_000).cast("bigint")
    days = F.datediff(F.to_date(moment), F.lit(dt.date(1970, 1, 1))).cast("bigint")
    return days * F.lit(86_400_000_000) + seconds * F.lit(1_000_000).cast("bigint") + fraction
