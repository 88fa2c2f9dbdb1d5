"""Ticket flow by month and class: new, closed, open, lead time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketflow.functions.calendar import month, month_label
from ticketflow.operators.backlog import backlog
from ticketflow.operators.tickets import closed_tickets, with_class, with_lead_time


def _groups(team: bool) -> list[str]:
    return ["TICKET", "APPGROUP"] if team else ["TICKET"]


def _classed(tickets: DataFrame, team: bool) -> DataFrame:
    classed = with_class(tickets)
    return classed.withColumnRenamed("appgroup", "APPGROUP") if team else classed


def _count_by_month(tickets: DataFrame, date: str, label: str, count: str, team: bool) -> DataFrame:
    groups = _groups(team)
    counts = (
        _classed(tickets, team)
        .groupBy(month(F.col(date)).alias("_month"), *groups)
        .agg(F.count(F.lit(1)).alias(count))
    )
    return counts.select(month_label(F.col("_month")).alias(label), *groups, count)


def new_tickets(tickets: DataFrame, team: bool = False) -> DataFrame:
    """Tickets created per month and class, by team if asked."""
    return _count_by_month(tickets, "created", "CREATED_MONTH", "NEW_TICKET", team)


def throughput(tickets: DataFrame, team: bool = False) -> DataFrame:
    """Tickets closed per month and class, by team if asked."""
    return _count_by_month(closed_tickets(tickets), "closed", "CLOSED_MONTH", "THROUGHPUT", team)


def throughput_time(tickets: DataFrame, team: bool = False) -> DataFrame:
    """Exact median lead time in days of the tickets closed per month and class.

    Equal lead times are counted first, a plain hash aggregation with partial
    sums on the map side; the median then works on (days, count) pairs, so a
    group's size is its number of distinct lead times, not of tickets.
    """
    groups = _groups(team)
    closed = with_lead_time(closed_tickets(_classed(tickets, team)))
    counted = closed.groupBy(month(F.col("closed")).alias("_month"), *groups, "lead_days").agg(
        F.count(F.lit(1)).alias("_tickets")
    )
    medians = counted.groupBy("_month", *groups).agg(
        F.percentile("lead_days", 0.5, F.col("_tickets")).alias("THROUGHPUT_TIME")
    )
    return medians.select(month_label(F.col("_month")).alias("CLOSED_MONTH"), *groups, "THROUGHPUT_TIME")


def lead_time_histogram(tickets: DataFrame) -> DataFrame:
    """Closed tickets counted by month, class, team and lead time in days.

    Counts add up where medians do not, so every throughput and median report,
    by class or by team, follows from this one table without the tickets.
    """
    closed = with_lead_time(closed_tickets(_classed(tickets, team=True)))
    return closed.groupBy(month(F.col("closed")).alias("CLOSED"), *_groups(True), "lead_days").agg(
        F.count(F.lit(1)).alias("TICKETS")
    )


def throughput_of(histogram: DataFrame, team: bool = False) -> DataFrame:
    """Tickets closed and their exact median lead time per month and class, by team if asked."""
    groups = _groups(team)
    # A team's counts of the same lead time come together before the median.
    counted = histogram.groupBy("CLOSED", *groups, "lead_days").agg(F.sum("TICKETS").alias("TICKETS"))
    totals = counted.groupBy("CLOSED", *groups).agg(
        F.sum("TICKETS").alias("THROUGHPUT"), F.percentile("lead_days", 0.5, F.col("TICKETS")).alias("THROUGHPUT_TIME")
    )
    return totals.select(month_label(F.col("CLOSED")).alias("CLOSED_MONTH"), *groups, "THROUGHPUT", "THROUGHPUT_TIME")


def backlog_at(tickets: DataFrame, cutpoints: DataFrame, team: bool = False) -> DataFrame:
    """Open tickets per cut date and class, by team if asked."""
    cases = _classed(tickets, team).withColumnsRenamed({"created": "START", "closed": "END"})
    return backlog(cases, cutpoints, *_groups(team)).withColumnRenamed("COUNT", "BACKLOG")


def over_teams(counts: DataFrame, count: str) -> DataFrame:
    """Class totals out of a count by team."""
    groups = [c for c in counts.columns if c not in ("APPGROUP", count)]
    return counts.groupBy(*groups).agg(F.sum(count).alias(count))
