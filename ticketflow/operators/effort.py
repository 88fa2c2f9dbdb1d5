"""Full-time-equivalent effort from booked time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketflow.functions.calendar import month_label
from ticketflow.functions.classes import DEVELOPMENT_FTE_TYPES
from ticketflow.operators.tickets import tickets_of_types, with_class

HOURS_PER_FTE = 160
# Rows that one task of the rollup takes to tickets, about 200 MB with the four sets of each.
ROLLUP_ROWS = 250_000


def monthly_effort(worktime: DataFrame) -> DataFrame:
    """A stored booked-time table summed to what the effort reports tell apart.

    One pass over the daily rows; all effort reports follow from the result.
    """
    return worktime.groupBy(
        "oid", "ticket_type", "userorg_worktimesheet", "phase", F.trunc("targetday", "month").alias("targetmonth")
    ).agg(F.sum("hours_worktimesheet").alias("hours_worktimesheet"))


def _fte(worktime: DataFrame, breakdown: str, team: bool, hours_per_fte: float) -> DataFrame:
    groups = [breakdown] + (["USERORG_WORKTIMESHEET"] if team else [])
    if team:
        worktime = worktime.withColumnRenamed("userorg_worktimesheet", "USERORG_WORKTIMESHEET")
    # One row per ticket and group first: rows that come from a join on the ticket need no shuffle
    # for it, and tickets can then be counted without a distinct.
    tickets = worktime.groupBy("oid", "targetmonth", *groups).agg(F.sum("hours_worktimesheet").alias("_hours"))
    totals = tickets.groupBy("targetmonth", *groups).agg(
        (F.sum("_hours") / F.lit(float(hours_per_fte))).alias("FTE"), F.count("_hours").alias("_tickets")
    )
    return totals.select(
        month_label(F.col("targetmonth")).alias("MONTH_WORKTIMESHEET"),
        *groups,
        "FTE",
        F.try_divide(F.col("FTE"), F.col("_tickets")).alias("FTE_NORM"),
    )


def rollup_parts(rows: int) -> int:
    """Into how many parts `effort_rollup` deals a table of so many rows."""
    return rows // ROLLUP_ROWS + 1


def effort_rollup(worktime: DataFrame, hours_per_fte: float = HOURS_PER_FTE, parts: int | None = None) -> DataFrame:
    """All four effort reports from one pass over the booked time.

    Grouping sets by class and by phase, each with and without the booker's
    organisation. `LEVEL` names the set: class, class_team, phase, phase_team;
    the columns a set does not group by are NULL. Sums are taken per ticket
    first, within each set, so a ticket counts once in every group it has
    hours in. `worktime` is a labelled table at any grain down to the month.

    A task holds the sums per ticket of all four sets at once. Adaptive
    execution sizes tasks by the bytes they read, which are few for so many
    sums, so `parts` can set their number instead, see `rollup_parts`: tickets
    are dealt to parts by ticket and month.
    """
    if parts is not None:
        worktime = worktime.repartition(parts, "oid", "targetmonth")
    types = [F.lit(t) for t in DEVELOPMENT_FTE_TYPES]
    breakdown = F.struct(F.coalesce("phase", "ticket_type").alias("value"))
    named = with_class(worktime).select(
        "oid",
        "targetmonth",
        F.struct("TICKET").alias("_class"),
        # NULL, no struct, outside development: those rows have no place in the sets by phase.
        F.when(F.col("ticket_type").isin(*types), breakdown).alias("_phase"),
        F.struct(F.col("userorg_worktimesheet").alias("value")).alias("_team"),
        "hours_worktimesheet",
    )
    grain = ["oid", "targetmonth", "_class", "_phase", "_team"]
    # At most one row per ticket, month, phase and organisation goes into the four sets.
    fine = named.groupBy(*grain).agg(F.sum("hours_worktimesheet").alias("_hours"))
    ticket = ["oid", "targetmonth"]
    sets = [[*ticket, *by] for by in (["_class"], ["_class", "_team"], ["_phase"], ["_phase", "_team"])]
    by_ticket = fine.groupingSets(sets, *grain).agg(
        F.sum("_hours").alias("_hours"), F.grouping("_class").alias("_no_class"), F.grouping("_team").alias("_no_team")
    )
    by_ticket = by_ticket.filter((F.col("_no_class") == 0) | F.col("_phase").isNotNull())
    totals = by_ticket.groupBy("_no_class", "_no_team", "targetmonth", "_class", "_phase", "_team").agg(
        (F.sum("_hours") / F.lit(float(hours_per_fte))).alias("FTE"), F.count("_hours").alias("_tickets")
    )
    level = F.concat(
        F.when(F.col("_no_class") == 0, "class").otherwise("phase"), F.when(F.col("_no_team") == 0, "_team").otherwise("")
    )
    return totals.select(
        level.alias("LEVEL"),
        month_label(F.col("targetmonth")).alias("MONTH_WORKTIMESHEET"),
        F.col("_class.TICKET").alias("TICKET"),
        F.col("_phase.value").alias("FTE_BREAKDOWN"),
        F.col("_team.value").alias("USERORG_WORKTIMESHEET"),
        "FTE",
        F.try_divide(F.col("FTE"), F.col("_tickets")).alias("FTE_NORM"),
    )


def effort_level(rollup: DataFrame, level: str) -> DataFrame:
    """One report out of a stored `effort_rollup`, with that report's columns."""
    kind, _, team = level.partition("_")
    groups = ["TICKET" if kind == "class" else "FTE_BREAKDOWN"] + (["USERORG_WORKTIMESHEET"] if team else [])
    return rollup.filter(F.col("LEVEL") == level).select("MONTH_WORKTIMESHEET", *groups, "FTE", "FTE_NORM")


def fte_by_class(worktime: DataFrame, team: bool = False, hours_per_fte: float = HOURS_PER_FTE) -> DataFrame:
    """FTE, and FTE per ticket with booked hours, by month and ticket class.

    `worktime` holds `oid`, `ticket_type`, `targetmonth`, `hours_worktimesheet`
    and, by team, the booker's `userorg_worktimesheet`.
    """
    return _fte(with_class(worktime), "TICKET", team, hours_per_fte)


def fte_by_phase(worktime: DataFrame, team: bool = False, hours_per_fte: float = HOURS_PER_FTE) -> DataFrame:
    """Development FTE by month and phase; unlabelled time shows its ticket type."""
    development = tickets_of_types(worktime, DEVELOPMENT_FTE_TYPES)
    broken_down = development.withColumn("FTE_BREAKDOWN", F.coalesce("phase", "ticket_type"))
    return _fte(broken_down, "FTE_BREAKDOWN", team, hours_per_fte)
