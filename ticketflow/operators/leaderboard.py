"""Top open tickets per class."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketflow.functions.calendar import lead_days
from ticketflow.operators.effort import HOURS_PER_FTE
from ticketflow.operators.tickets import open_tickets, with_class

TOP = 10


def _top(df: DataFrame, value: str, top: int) -> DataFrame:
    # Spark keeps only the first rows of each class before it shuffles.
    order = Window.partitionBy("TICKET").orderBy(F.col(value).desc_nulls_last(), F.col("OID").asc())
    return df.withColumn("RANK", F.row_number().over(order)).filter(F.col("RANK") <= top)


def longest_open(tickets: DataFrame, as_of: dt.date, top: int = TOP) -> DataFrame:
    """The oldest open tickets of each class on the day `as_of`; ties by lower id."""
    aged = with_class(open_tickets(tickets)).select(
        "TICKET",
        F.col("oid").alias("OID"),
        F.col("created").alias("CREATED"),
        lead_days(F.col("created"), F.lit(as_of)).alias("AGE_DAYS"),
    )
    return _top(aged, "AGE_DAYS", top).select("TICKET", "RANK", "OID", "CREATED", "AGE_DAYS")


def highest_fte(
    tickets: DataFrame, issue_hours: DataFrame, top: int = TOP, hours_per_fte: float = HOURS_PER_FTE
) -> DataFrame:
    """The open tickets of each class with the most booked time; ties by lower id.

    `issue_hours` holds one row per issue, so the join moves no group larger
    than one row.
    """
    booked = (
        with_class(open_tickets(tickets))
        .join(issue_hours, F.col("oid") == F.col("issue"))
        .select(
            "TICKET",
            F.col("oid").alias("OID"),
            (F.col("hours_worktimesheet") / F.lit(float(hours_per_fte))).alias("FTE"),
        )
    )
    return _top(booked, "FTE", top).select("TICKET", "RANK", "OID", "FTE")


def display_blocks(board: DataFrame) -> DataFrame:
    """A board in display order, block after block, without its class column."""
    return board.orderBy("TICKET", "RANK").drop("TICKET")
