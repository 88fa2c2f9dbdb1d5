"""The registered queries: one per operator, over the whole test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ticketflow.functions.calendar import month_starts, month_starts_between
from ticketflow.functions.classes import DEVELOPMENT_FTE_TYPES
from ticketflow.functions.intervals import in_interval
from ticketflow.operators import conformance, effort, flow, leaderboard, phases, worktime
from ticketflow.operators import tickets as tk
from ticketflow.operators.backlog import STEPS, backlog
from ticketflow.operators.open_cases import open_cases
from ticketflow.plans import booked_time as bt
from ticketflow.plans import views
from ticketflow.plans.progress import observed_rows
from ticketflow.sources import clustered, key_buckets, versions
from ticketflow.sources.reports import read_csv, read_csv_setting_aside, read_report, write_csv, write_report
from ticketflow.sources.sinks import full_refresh, full_refresh_table, scratch_folder, stored
from ticketflow.sources.tables import without_blanks

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2002, 1, 1)
FIRST_CUT, LAST_CUT = dt.date(1995, 1, 1), dt.date(2001, 12, 1)
MONTH_BEGIN, MONTH_END = "1997-03-01 00:00:00", "1997-03-31 23:00:00"


def _cuts(spark: SparkSession) -> DataFrame:
    return month_starts(spark, FIRST_CUT, LAST_CUT)


def _worktime(spark: SparkSession, base: str, team: bool = True) -> DataFrame:
    hot = bt.hot_issues(views.worktimesheet(spark, base))
    return bt.worktime_by_ticket(views.named_work(spark, base), views.tickets(spark, base, team), hot)


def _cases(spark: SparkSession, base: str, team: bool = False) -> DataFrame:
    return views.tickets(spark, base, team).withColumnsRenamed({"created": "START", "closed": "END"})


# Sources and sinks


def src_tickets(spark: SparkSession, base: str) -> DataFrame:
    return views.tickets(spark, base)


def src_worktime(spark: SparkSession, base: str) -> DataFrame:
    return views.worktimesheet(spark, base)


def src_users(spark: SparkSession, base: str) -> DataFrame:
    return without_blanks(views.permissionpolicyuser(spark, base))


def src_organizations(spark: SparkSession, base: str) -> DataFrame:
    return without_blanks(views.organization(spark, base))


def src_action_groups(spark: SparkSession, base: str) -> DataFrame:
    return without_blanks(views.actiontypegroup(spark, base))


def src_milestones(spark: SparkSession, base: str) -> DataFrame:
    return views.dev_milestones(spark, base)


def src_csv_reordered(spark: SparkSession, base: str) -> DataFrame:
    """A file whose columns stand in another order than declared."""
    tickets = views.tickets(spark, base)
    path = f"{scratch_folder(spark)}/tickets.csv"
    write_csv(tickets.select(*reversed(tickets.columns)), path)
    return read_csv(spark, path, tickets.schema)


def sink_catalog_refresh(spark: SparkSession, base: str) -> DataFrame:
    """A table of the catalog replaced by rows read from itself."""
    name = f"t_isd_tickets_{uuid.uuid4().hex}"
    full_refresh_table(views.tickets(spark, base), name)
    full_refresh_table(spark.table(name).filter("closed IS NULL"), name, ("oid",))
    return spark.table(name)


def src_csv_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    tickets = views.tickets(spark, base)
    path = f"{scratch_folder(spark)}/tickets.csv"
    write_csv(tickets, path)
    return read_csv(spark, path, tickets.schema)


def src_csv_set_aside(spark: SparkSession, base: str) -> DataFrame:
    """A file in which some dates do not parse: what is kept and what is set aside, by class of ticket id."""
    tickets = views.tickets(spark, base)
    path = f"{scratch_folder(spark)}/tickets.csv"
    text = tickets.select(*(F.col(c).cast("string").alias(c) for c in tickets.columns))
    bad = F.expr("oid % 1000 = 7")
    write_csv(text.withColumn("created", F.when(bad, F.lit("some day")).otherwise(F.col("created"))), path)
    kept, aside = read_csv_setting_aside(spark, path, tickets.schema)
    aside = aside.select(F.split("record", ",")[0].cast("bigint").alias("oid"), F.lit(True).alias("ASIDE"))
    rows = kept.select("oid", F.lit(False).alias("ASIDE")).unionByName(aside)
    return rows.groupBy("ASIDE", (F.col("oid") % 100).alias("OID_CLASS")).agg(
        F.count(F.lit(1)).alias("COUNT"), F.sum("oid").alias("OIDS")
    )


def sink_full_refresh(spark: SparkSession, base: str) -> DataFrame:
    path = f"{scratch_folder(spark)}/t_isd_worktimesheet.parquet"
    labelled = phase_label(spark, base)
    full_refresh(labelled, path, sort_by=("oid", "targetday"))
    return spark.read.schema(labelled.schema).parquet(path)


def sink_versions(spark: SparkSession, base: str) -> DataFrame:
    """Three commits, each reading the one before it; the last one is rolled back."""
    path = f"{scratch_folder(spark)}/tickets"
    versions.commit(views.tickets(spark, base), path)
    versions.commit(versions.read_version(spark, path).filter("closed IS NULL"), path, ("oid",))
    versions.commit(versions.read_version(spark, path).filter("appgroup IS NULL"), path)
    versions.roll_back(spark, path)
    return versions.read_version(spark, path)


def publish_conformance_csv(spark: SparkSession, base: str) -> DataFrame:
    folder = scratch_folder(spark)
    write_report(conformance_detail(spark, base), folder, "t_conf")
    return read_report(spark, folder, "t_conf")


# Filters, projections and expressions


def filter_worktime(spark: SparkSession, base: str) -> DataFrame:
    return worktime.work_only(views.worktimesheet(spark, base))


def interval_flag(spark: SparkSession, base: str) -> DataFrame:
    """Was the ticket open when its release started?"""
    tickets = phases.with_milestones(views.tickets(spark, base, team=False), views.dev_milestones(spark, base))
    flag = in_interval(F.col("created"), F.col("closed"), F.col("first_release"))
    return tickets.select("oid", "created", "closed", "first_release", flag.alias("flag"))


def tickets_open(spark: SparkSession, base: str) -> DataFrame:
    return tk.open_tickets(views.tickets(spark, base))


def tickets_closed(spark: SparkSession, base: str) -> DataFrame:
    return tk.closed_tickets(views.tickets(spark, base))


def tickets_of_types(spark: SparkSession, base: str) -> DataFrame:
    return tk.tickets_of_types(views.tickets(spark, base), DEVELOPMENT_FTE_TYPES)


def ticket_class_query(spark: SparkSession, base: str) -> DataFrame:
    return tk.with_class(views.tickets(spark, base, team=False)).select("oid", "ticket_type", "TICKET")


def ticket_lead_time(spark: SparkSession, base: str) -> DataFrame:
    closed = tk.closed_tickets(views.tickets(spark, base, team=False))
    return tk.with_lead_time(closed).select("oid", "created", "closed", "lead_days")


def cutpoints_monthly(spark: SparkSession, base: str) -> DataFrame:
    return month_starts_between(views.tickets(spark, base, team=False), "created", "closed")


# Booked time


def worktime_enriched(spark: SparkSession, base: str) -> DataFrame:
    return views.named_work(spark, base)


def worktime_day_trunc(spark: SparkSession, base: str) -> DataFrame:
    return worktime.with_targetday(views.worktimesheet(spark, base)).select("issue", "startdate", "targetday")


def worktime_daily(spark: SparkSession, base: str) -> DataFrame:
    return worktime.daily_hours(views.named_work(spark, base))


def worktime_by_ticket(spark: SparkSession, base: str) -> DataFrame:
    return _worktime(spark, base)


def worktime_sorted(spark: SparkSession, base: str) -> DataFrame:
    return worktime.sort_worktime(_worktime(spark, base))


def phase_label(spark: SparkSession, base: str) -> DataFrame:
    tickets, milestones = views.tickets(spark, base), views.dev_milestones(spark, base)
    hot = bt.hot_issues(views.worktimesheet(spark, base))
    return bt.booked_time(views.named_work(spark, base), tickets, milestones, hot)


def phase_label_stored(spark: SparkSession, base: str) -> DataFrame:
    """The label added to an existing table of booked time."""
    hot = bt.hot_issues(views.worktimesheet(spark, base))
    return phases.label_phase(_worktime(spark, base), views.dev_milestones(spark, base), hot)


def _clustered(spark: SparkSession, base: str) -> str:
    """The name of a new clustered table of booked time."""
    name = f"t_isd_worktimesheet_{uuid.uuid4().hex}"
    hot = bt.hot_issues(views.worktimesheet(spark, base))
    clustered.write_clustered(_worktime(spark, base), name, "oid", list(worktime.DAILY_KEYS), hot=hot)
    return name


def phase_label_clustered(spark: SparkSession, base: str) -> DataFrame:
    """The label added to a clustered table of booked time, whose rows are not shuffled again."""
    return phases.label_phase_clustered(spark, _clustered(spark, base), views.dev_milestones(spark, base))


def phase_release_clustered(spark: SparkSession, base: str) -> DataFrame:
    """Rows of a clustered table with a release by that day."""
    return phases.released_clustered(spark, _clustered(spark, base), views.dev_milestones(spark, base))


def phase_relabel_changed(spark: SparkSession, base: str) -> DataFrame:
    """A stored table of labelled time after the releases of some tickets became known: their buckets are rewritten."""
    milestones = views.dev_milestones(spark, base)
    changed = milestones.filter("oid % 1000 = 3 AND release_start IS NOT NULL")
    unknown = F.when(F.expr("oid % 1000 = 3"), None).otherwise(F.col("release_start"))
    path = f"{scratch_folder(spark)}/t_isd_worktimesheet"
    hot = bt.hot_issues(views.worktimesheet(spark, base))
    before = milestones.withColumn("release_start", unknown)
    labelled = bt.booked_time(views.named_work(spark, base), views.tickets(spark, base), before, hot)
    key_buckets.write_buckets(labelled, path, "oid")
    key_buckets.rewrite_buckets(spark, path, changed, "oid", lambda rows: phases.label_phase(rows, milestones, hot))
    return key_buckets.read_buckets(spark, path)


def phase_unlabelled(spark: SparkSession, base: str) -> DataFrame:
    return phases.unlabelled(phase_label(spark, base))


def phase_release_semi(spark: SparkSession, base: str) -> DataFrame:
    hot = bt.hot_issues(views.worktimesheet(spark, base))
    return phases.released(_worktime(spark, base), views.dev_milestones(spark, base), hot)


# Backlog


def backlog_total(spark: SparkSession, base: str) -> DataFrame:
    return backlog(_cases(spark, base), _cuts(spark))


def backlog_by_type(spark: SparkSession, base: str) -> DataFrame:
    return backlog(_cases(spark, base), _cuts(spark), "ticket_type")


def backlog_by_type_team(spark: SparkSession, base: str) -> DataFrame:
    return backlog(_cases(spark, base, team=True), _cuts(spark), "ticket_type", "appgroup")


def backlog_daily(spark: SparkSession, base: str) -> DataFrame:
    """Every day between the first and the last cut date."""
    days = F.sequence(F.lit(FIRST_CUT), F.lit(LAST_CUT), F.make_dt_interval(F.lit(1)))
    return backlog(_cases(spark, base), spark.range(1).select(F.explode(days).alias("CUTPOINT")), "ticket_type")


def backlog_hourly(spark: SparkSession, base: str) -> DataFrame:
    """Every hour of one month."""
    return backlog(_cases(spark, base), _moments(spark, F.make_dt_interval(hours=F.lit(1))), "ticket_type")


def backlog_minutely(spark: SparkSession, base: str) -> DataFrame:
    """Every minute of one month."""
    return backlog(_cases(spark, base), _moments(spark, F.make_dt_interval(mins=F.lit(1))), "ticket_type")


def backlog_at_bookings(spark: SparkSession, base: str) -> DataFrame:
    """Every moment at which work was booked, found by merging cases and moments in order."""
    moments = views.worktimesheet(spark, base).select(F.col("startdate").alias("CUTPOINT")).distinct()
    return backlog(_cases(spark, base), moments, "ticket_type", local_rows=1000)


def open_cases_at(spark: SparkSession, base: str) -> DataFrame:
    """The tickets that are open at each month start."""
    return open_cases(_cases(spark, base), _cuts(spark)).select("CUTPOINT", "oid", "ticket_type")


def open_cases_matched(spark: SparkSession, base: str) -> DataFrame:
    """The tickets of each type that are open at the moments its tickets were closed."""
    closed = views.tickets(spark, base, team=False).select("ticket_type", F.col("closed").alias("CUTPOINT"))
    return open_cases(_cases(spark, base), closed.distinct(), totals=("oid",)).groupBy("CUTPOINT", "ticket_type").agg(
        F.sum("COUNT").alias("COUNT"), F.sum("oid").alias("OIDS")
    )


def _moments(spark: SparkSession, step: Column) -> DataFrame:
    bounds = (F.lit(at).cast("timestamp_ntz") for at in (MONTH_BEGIN, MONTH_END))
    return spark.range(1).select(F.explode(F.sequence(*bounds, step)).alias("CUTPOINT"))


def backlog_matched_cutpoints(spark: SparkSession, base: str) -> DataFrame:
    """Each type at its own cut dates: the month starts from its first ticket on.

    The cut dates also name a type that no ticket has; it meets nothing.
    """
    first = views.tickets(spark, base, team=False).groupBy("ticket_type").agg(F.min("created").alias("first"))
    later = F.sequence(F.trunc("first", "month"), F.lit(LAST_CUT), F.make_ym_interval(months=F.lit(1)))
    cutpoints = first.select("ticket_type", F.explode(later).alias("CUTPOINT"))
    unmatched = spark.range(1).select(F.lit("no such type").alias("ticket_type"), F.lit(LAST_CUT).alias("CUTPOINT"))
    cutpoints = cutpoints.select("ticket_type", F.to_date("CUTPOINT").alias("CUTPOINT")).unionByName(unmatched)
    return backlog(_cases(spark, base, team=True), cutpoints, "ticket_type", "appgroup")


def backlog_observed(spark: SparkSession, base: str) -> DataFrame:
    return backlog(_cases(spark, base), _cuts(spark), "ticket_type", progress={s: Observation(s) for s in STEPS})


def backlog_progress(spark: SparkSession, base: str) -> DataFrame:
    """How many rows pass each step of a backlog."""
    seen = {s: Observation(s) for s in STEPS}
    return observed_rows(backlog(_cases(spark, base), _cuts(spark), "ticket_type", progress=seen), seen)


def backlog_month_start(spark: SparkSession, base: str) -> DataFrame:
    return flow.backlog_at(views.tickets(spark, base, team=False), _cuts(spark))


def backlog_team(spark: SparkSession, base: str) -> DataFrame:
    return flow.backlog_at(views.tickets(spark, base), _cuts(spark), team=True)


# Flow


def new_tickets(spark: SparkSession, base: str) -> DataFrame:
    return flow.new_tickets(views.tickets(spark, base, team=False))


def new_tickets_team(spark: SparkSession, base: str) -> DataFrame:
    return flow.new_tickets(views.tickets(spark, base), team=True)


def throughput(spark: SparkSession, base: str) -> DataFrame:
    return flow.throughput(views.tickets(spark, base, team=False))


def throughput_team(spark: SparkSession, base: str) -> DataFrame:
    return flow.throughput(views.tickets(spark, base), team=True)


def throughput_time(spark: SparkSession, base: str) -> DataFrame:
    return flow.throughput_time(views.tickets(spark, base, team=False))


def throughput_time_team(spark: SparkSession, base: str) -> DataFrame:
    return flow.throughput_time(views.tickets(spark, base), team=True)


def throughput_rollup(spark: SparkSession, base: str) -> DataFrame:
    """Throughput and median lead time by class and by team, all from one stored histogram."""
    histogram = stored(flow.lead_time_histogram(views.tickets(spark, base)))
    by_class = flow.throughput_of(histogram).withColumns({"LEVEL": F.lit("class"), "APPGROUP": F.lit(None).cast("string")})
    by_team = flow.throughput_of(histogram, team=True).withColumn("LEVEL", F.lit("team"))
    return by_team.unionByName(by_class)


# Effort


def _by_class(spark: SparkSession, base: str, team: bool = False) -> DataFrame:
    tickets = views.tickets(spark, base, team=False)
    return effort.fte_by_class(bt.monthly_time(views.named_work(spark, base), tickets, team), team)


def _by_phase(spark: SparkSession, base: str, team: bool = False) -> DataFrame:
    tickets, milestones = views.tickets(spark, base, team=False), views.dev_milestones(spark, base)
    return effort.fte_by_phase(bt.monthly_phase_time(views.named_work(spark, base), tickets, milestones, team), team)


def fte_by_type(spark: SparkSession, base: str) -> DataFrame:
    return _by_class(spark, base).drop("FTE_NORM")


def fte_norm_by_type(spark: SparkSession, base: str) -> DataFrame:
    return _by_class(spark, base)


def fte_team(spark: SparkSession, base: str) -> DataFrame:
    return _by_class(spark, base, team=True).drop("FTE_NORM")


def fte_norm_team(spark: SparkSession, base: str) -> DataFrame:
    return _by_class(spark, base, team=True)


def fte_by_phase(spark: SparkSession, base: str) -> DataFrame:
    return _by_phase(spark, base).drop("FTE_NORM")


def fte_norm_by_phase(spark: SparkSession, base: str) -> DataFrame:
    return _by_phase(spark, base)


def fte_phase_team(spark: SparkSession, base: str) -> DataFrame:
    return _by_phase(spark, base, team=True).drop("FTE_NORM")


def fte_norm_phase_team(spark: SparkSession, base: str) -> DataFrame:
    return _by_phase(spark, base, team=True)


def fte_rollup(spark: SparkSession, base: str) -> DataFrame:
    """Effort by class and by phase, with and without organisations, from one pass over the labelled time.

    The monthly sums are at most as many as the bookings, whose number stands in the files' footers.
    """
    parts = effort.rollup_parts(views.worktimesheet(spark, base).count())
    return effort.effort_rollup(effort.monthly_effort(phase_label(spark, base)), parts=parts)


# Conformance and boards


def conformance_detail(spark: SparkSession, base: str) -> DataFrame:
    return conformance.conformance_detail(
        views.tickets(spark, base, team=False), views.dev_milestones(spark, base)
    )


def conformance_count(spark: SparkSession, base: str) -> DataFrame:
    return conformance.conformance_count(conformance_detail(spark, base))


def conformance_cumulative(spark: SparkSession, base: str) -> DataFrame:
    return conformance.conformance_cumulative(conformance_count(spark, base))


def leaderboard_longest_open(spark: SparkSession, base: str) -> DataFrame:
    return leaderboard.longest_open(views.tickets(spark, base, team=False), AS_OF)


def leaderboard_highest_fte(spark: SparkSession, base: str) -> DataFrame:
    return leaderboard.highest_fte(
        views.tickets(spark, base, team=False), bt.issue_hours(views.named_work(spark, base))
    )


def leaderboard_display(spark: SparkSession, base: str) -> DataFrame:
    return leaderboard.display_blocks(leaderboard_longest_open(spark, base))


QUERIES: dict[str, Query] = {
    "src_tickets": src_tickets,
    "src_worktime": src_worktime,
    "src_users": src_users,
    "src_organizations": src_organizations,
    "src_action_groups": src_action_groups,
    "src_milestones": src_milestones,
    "src_csv_reordered": src_csv_reordered,
    "sink_catalog_refresh": sink_catalog_refresh,
    "src_csv_roundtrip": src_csv_roundtrip,
    "src_csv_set_aside": src_csv_set_aside,
    "sink_full_refresh": sink_full_refresh,
    "sink_versions": sink_versions,
    "publish_conformance_csv": publish_conformance_csv,
    "filter_worktime": filter_worktime,
    "interval_flag": interval_flag,
    "tickets_open": tickets_open,
    "tickets_closed": tickets_closed,
    "tickets_of_types": tickets_of_types,
    "ticket_class": ticket_class_query,
    "ticket_lead_time": ticket_lead_time,
    "cutpoints_monthly": cutpoints_monthly,
    "worktime_enriched": worktime_enriched,
    "worktime_day_trunc": worktime_day_trunc,
    "worktime_daily": worktime_daily,
    "worktime_by_ticket": worktime_by_ticket,
    "worktime_sorted": worktime_sorted,
    "phase_label": phase_label,
    "phase_label_stored": phase_label_stored,
    "phase_label_clustered": phase_label_clustered,
    "phase_release_clustered": phase_release_clustered,
    "phase_relabel_changed": phase_relabel_changed,
    "phase_unlabelled": phase_unlabelled,
    "phase_release_semi": phase_release_semi,
    "backlog_total": backlog_total,
    "backlog_by_type": backlog_by_type,
    "backlog_by_type_team": backlog_by_type_team,
    "backlog_daily": backlog_daily,
    "backlog_hourly": backlog_hourly,
    "backlog_minutely": backlog_minutely,
    "backlog_at_bookings": backlog_at_bookings,
    "open_cases_at": open_cases_at,
    "open_cases_matched": open_cases_matched,
    "backlog_matched_cutpoints": backlog_matched_cutpoints,
    "backlog_observed": backlog_observed,
    "backlog_progress": backlog_progress,
    "backlog_month_start": backlog_month_start,
    "backlog_team": backlog_team,
    "new_tickets": new_tickets,
    "new_tickets_team": new_tickets_team,
    "throughput": throughput,
    "throughput_team": throughput_team,
    "throughput_time": throughput_time,
    "throughput_time_team": throughput_time_team,
    "throughput_rollup": throughput_rollup,
    "fte_by_type": fte_by_type,
    "fte_norm_by_type": fte_norm_by_type,
    "fte_team": fte_team,
    "fte_norm_team": fte_norm_team,
    "fte_by_phase": fte_by_phase,
    "fte_norm_by_phase": fte_norm_by_phase,
    "fte_phase_team": fte_phase_team,
    "fte_norm_phase_team": fte_norm_phase_team,
    "fte_rollup": fte_rollup,
    "conformance_detail": conformance_detail,
    "conformance_count": conformance_count,
    "conformance_cumulative": conformance_cumulative,
    "leaderboard_longest_open": leaderboard_longest_open,
    "leaderboard_highest_fte": leaderboard_highest_fte,
    "leaderboard_display": leaderboard_display,
}
