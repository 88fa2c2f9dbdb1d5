"""All report tables from the input tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketflow.operators import conformance, effort, flow, leaderboard, worktime
from ticketflow.plans.booked_time import Inputs, booked_time, hot_issues, named_work
from ticketflow.sources.reports import read_report, write_report
from ticketflow.sources.sinks import full_refresh, remove_folder, scratch_folder


def publish(inputs: Inputs, folder: str, cutpoints: DataFrame, as_of: dt.date) -> None:
    """Refresh the booked-time table, then write every report into `folder`.

    What several reports need is computed once and read back from shared
    storage: the booked-time table, its monthly sums, the counts by team, the
    histogram of lead times and the conformance of each ticket. A lost executor costs only its own tasks.
    Backlog comes ordered by cut date and class, a board in the order of its
    blocks. The backlog report holds dates, so a cut date with a time of day is
    an error.
    """
    spark = inputs.tickets.sparkSession
    scratch = scratch_folder(spark)
    try:
        _publish(inputs, folder, cutpoints, as_of, scratch)
    finally:
        remove_folder(spark, scratch)


def _publish(inputs: Inputs, folder: str, cutpoints: DataFrame, as_of: dt.date, scratch: str) -> None:
    tickets = inputs.tickets
    spark = tickets.sparkSession

    def stored(df: DataFrame, path: str, sort_by: tuple[str, ...] = ()) -> DataFrame:
        full_refresh(df, path, sort_by)
        return spark.read.schema(df.schema).parquet(path)

    def report(name: str, df: DataFrame) -> DataFrame:
        write_report(df, folder, name)
        return read_report(spark, folder, name)

    named = named_work(
        inputs.worktimesheet, inputs.permissionpolicyuser, inputs.organization, inputs.actiontypegroup
    )
    time = stored(
        booked_time(named, tickets, inputs.dev_milestones, hot_issues(inputs.worktimesheet)),
        f"{folder}/t_isd_worktimesheet.parquet",
        ("oid", "targetday"),
    )
    monthly = stored(effort.monthly_effort(time), f"{scratch}/monthly.parquet")
    parts = effort.rollup_parts(monthly.count())
    rollup = stored(effort.effort_rollup(monthly, parts=parts), f"{scratch}/effort.parquet")
    for suffix in ("", "_team"):
        report(f"t_fte_ticket{suffix}", effort.effort_level(rollup, f"class{suffix}"))
        report(f"t_fte_phases{suffix}", effort.effort_level(rollup, f"phase{suffix}"))

    new = report("t_nb_ticket_team", flow.new_tickets(tickets, team=True))
    report("t_nb_ticket", flow.over_teams(new, "NEW_TICKET"))
    histogram = stored(flow.lead_time_histogram(tickets), f"{scratch}/lead_times.parquet")
    for suffix, team in (("", False), ("_team", True)):
        closed = flow.throughput_of(histogram, team)
        report(f"t_throughput_ticket{suffix}", closed)
        report(f"t_throughputtime_ticket{suffix}", closed)
    day = F.to_date("CUTPOINT")
    within = F.raise_error(F.lit("a cut date of the backlog report has a time of day")).cast("date")
    whole = cutpoints.withColumn(
        "CUTPOINT", F.when(day.cast("timestamp_ntz") == F.col("CUTPOINT").cast("timestamp_ntz"), day).otherwise(within)
    )
    backlog = stored(flow.backlog_at(tickets, whole, team=True), f"{scratch}/backlog.parquet")
    report("t_backlog_ticket_team", backlog.orderBy("CUTPOINT", "TICKET", "APPGROUP"))
    report("t_backlog_ticket", flow.over_teams(backlog, "BACKLOG").orderBy("CUTPOINT", "TICKET"))

    detail = report("t_conf", conformance.conformance_detail(tickets, inputs.dev_milestones))
    report("t_conf_agg", conformance.conformance_cumulative(conformance.conformance_count(detail)))

    # A few rows per class: one file keeps their order.
    longest = leaderboard.longest_open(tickets, as_of)
    report("t_lb_tp_open", longest.orderBy("TICKET", "RANK").coalesce(1))
    highest = leaderboard.highest_fte(tickets, worktime.total_hours(monthly))
    report("t_lb_fte_open", highest.orderBy("TICKET", "RANK").coalesce(1))
