"""Interval membership."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_interval(start: Column, end: Column, check: Column, strict: bool = False) -> Column:
    """1 when `check` lies in the closed interval [start, end], else 0.

    A missing end leaves the interval open. A missing start or check date
    counts as outside; with `strict` such a row raises where the comparison
    has no answer (a check date after the end is outside for any start).
    """
    inside = (check >= start) & (end.isNull() | (check <= end))
    flag = F.when(inside, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    if not strict:
        return flag
    return F.when(
        inside.isNull(), F.raise_error(F.lit("interval check on a missing start or check date")).cast("bigint")
    ).otherwise(flag)
