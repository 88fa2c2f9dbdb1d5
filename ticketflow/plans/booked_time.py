"""The booked-time table and its coarser forms.

`named` is always the table of work bookings with names, see `named_work`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.operators.hot_keys import HOT_ROWS, hot_keys_by_summary, join_spreading_hot_keys
from ticketflow.operators.phases import phase_of, with_milestones
from ticketflow.operators.worktime import (
    daily_hours,
    join_tickets,
    sum_hours,
    with_names,
    with_targetday,
    with_targetmonth,
    work_only,
)
from ticketflow.sources.tables import SCHEMAS, catalog_table, read_table


@dataclass(frozen=True)
class Inputs:
    """The input tables of all plans."""

    tickets: DataFrame
    worktimesheet: DataFrame
    permissionpolicyuser: DataFrame
    organization: DataFrame
    actiontypegroup: DataFrame
    dev_milestones: DataFrame


def read_inputs(spark: SparkSession, base: str) -> Inputs:
    """The six input tables under one folder."""
    return Inputs(**{name: read_table(spark, base, name) for name in SCHEMAS})


def catalog_inputs(spark: SparkSession, schema: str | None = None) -> Inputs:
    """The six input tables of a catalog schema."""
    return Inputs(**{name: catalog_table(spark, name, schema) for name in SCHEMAS})


def named_work(bookings: DataFrame, users: DataFrame, organizations: DataFrame, groups: DataFrame) -> DataFrame:
    return with_names(work_only(bookings), users, organizations, groups)


def hot_issues(bookings: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Issues with so many work bookings that their rows are split over several tasks."""
    return hot_keys_by_summary(work_only(bookings), "issue", hot_rows)


def worktime_by_ticket(named: DataFrame, tickets: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Ticket columns with daily booked time; `hot` lists busy issues, see `hot_issues`."""
    return join_tickets(daily_hours(named), tickets, hot)


def booked_time(
    named: DataFrame, tickets: DataFrame, milestones: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """The booked-time table with its phase.

    The milestones meet the tickets first, one row per ticket on both sides, so
    the long table of daily sums is shuffled for a single join.
    """
    daily = daily_hours(named)
    joined = join_tickets(daily, with_milestones(tickets, milestones), hot)
    phase = phase_of(F.col("targetday"), F.col("first_demand"), F.col("first_release"))
    return joined.select(*tickets.columns, *daily.columns, phase.alias("phase"))


def monthly_time(named: DataFrame, tickets: DataFrame, team: bool = False) -> DataFrame:
    """Booked time per ticket and month, by the booker's organisation if asked.

    Effort by class needs no finer rows, and at this grain a busy ticket has
    only as many rows as months (times organisations).
    """
    keys = ["targetmonth"] + (["userorg_worktimesheet"] if team else [])
    hours = sum_hours(with_targetmonth(named), *keys)
    types = tickets.select("oid", "ticket_type")
    return hours.join(types, F.col("issue") == F.col("oid")).drop("issue")


def monthly_phase_time(
    named: DataFrame, tickets: DataFrame, milestones: DataFrame, team: bool = False, hot: DataFrame | None = None
) -> DataFrame:
    """Booked time per ticket, day and phase, with the month of the day.

    `hot` lists issues whose daily sums are split over several tasks. An issue
    has at most days times organisations of them, so the list is needed only
    where that product exceeds what one task sorts.
    """
    keys = ["targetday"] + (["userorg_worktimesheet"] if team else [])
    hours = sum_hours(with_targetday(named), *keys)
    types = with_milestones(tickets.select("oid", "ticket_type"), milestones)
    if hot is None:
        joined = hours.join(types, F.col("issue") == F.col("oid"))
    else:
        joined = join_spreading_hot_keys(hours, types, "issue", "oid", keys, hot)
    phase = phase_of(F.col("targetday"), F.col("first_demand"), F.col("first_release"))
    return joined.select(
        "oid",
        "ticket_type",
        *keys,
        F.trunc("targetday", "month").alias("targetmonth"),
        "hours_worktimesheet",
        phase.alias("phase"),
    )


def issue_hours(named: DataFrame) -> DataFrame:
    """Booked time per issue."""
    return sum_hours(named).filter(F.col("issue").isNotNull())
