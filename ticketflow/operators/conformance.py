"""Conformance of closed development tickets."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketflow.functions.calendar import month, month_label
from ticketflow.functions.classes import CONFORMANCE_TYPES
from ticketflow.operators.phases import with_milestones
from ticketflow.operators.running import dense_running_total
from ticketflow.operators.tickets import closed_tickets, tickets_of_types, with_class


def default_criteria() -> dict[str, Column]:
    demand, release = F.col("first_demand"), F.col("first_release")
    return {
        "HAS_DEMAND": demand.isNotNull(),
        "HAS_RELEASE": release.isNotNull(),
        "DEMAND_BEFORE_RELEASE": demand <= release,
    }


def conformance_detail(
    tickets: DataFrame, milestones: DataFrame, criteria: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per closed development ticket, a column per criterion, and their AND.

    Criteria are named predicates over the ticket columns and `first_demand`,
    `first_release`; one without an answer counts as not met.
    """
    criteria = default_criteria() if criteria is None else criteria
    population = with_class(tickets_of_types(closed_tickets(tickets), CONFORMANCE_TYPES))
    met = {name: F.coalesce(test, F.lit(False)) for name, test in criteria.items()}
    conform = reduce(lambda a, b: a & b, met.values(), F.lit(True))
    return with_milestones(population, milestones).select(
        "TICKET",
        F.col("oid").alias("OID"),
        month_label(month(F.col("created"))).alias("CREATED_MONTH"),
        *(test.alias(name) for name, test in met.items()),
        conform.alias("CONFORM"),
    )


def conformance_count(detail: DataFrame) -> DataFrame:
    """Tickets by created month, class and conformance."""
    return detail.groupBy("CREATED_MONTH", "TICKET", "CONFORM").agg(F.count(F.lit(1)).alias("COUNT"))


def conformance_cumulative(counts: DataFrame) -> DataFrame:
    """Counts and running counts for every month between the first and the last.

    Months are numbered; a class and flag holds at most one row per month, so
    the window that finds the first and last month sees a few hundred rows.
    Looking them up in the tickets would scan those once more. Tickets without a
    created month stand in no order: they keep a row of their own per class and
    flag, with their own count as the running one.
    """
    undated = counts.filter(F.col("CREATED_MONTH").isNull()).select(
        "CREATED_MONTH", "TICKET", "CONFORM", "COUNT", F.col("COUNT").alias("CUMULATIVE_COUNT")
    )
    first_day = F.to_date("CREATED_MONTH", "yyyy-MM")
    number = (F.year(first_day) * 12 + F.month(first_day) - 1).alias("_month")
    counts = counts.select(number, "TICKET", "CONFORM", "COUNT").filter(F.col("_month").isNotNull())
    everything = Window.partitionBy()
    bounds = {"_first": F.min("_month").over(everything), "_last": F.max("_month").over(everything)}
    total = dense_running_total(
        counts.withColumns(bounds), ["TICKET", "CONFORM"], "_month", "COUNT", F.col("_first"), F.col("_last")
    )
    first_day = F.make_date(F.floor(F.col("_month") / 12).cast("int"), F.col("_month") % 12 + 1, F.lit(1))
    dated = total.select(
        month_label(first_day).alias("CREATED_MONTH"),
        "TICKET",
        "CONFORM",
        "COUNT",
        F.col("running_total").alias("CUMULATIVE_COUNT"),
    )
    return dated.unionByName(undated)
