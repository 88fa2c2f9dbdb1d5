"""Flow, effort, conformance and leader boards on hand-written tables."""

import datetime as dt
import re

import pytest
from conftest import DATA, at, day, plan, rows
from pyspark.sql import functions as F

from ticketflow.functions.calendar import month_starts, month_starts_between
from ticketflow.operators import conformance, effort, flow, leaderboard, tickets
from ticketflow.plans import booked_time as bt
from ticketflow.plans import queries, views
from ticketflow.sources.tables import DEV_MILESTONES, TICKETS


def _tickets(spark, *cases):
    return spark.createDataFrame([(o, k, g, at(c), at(e)) for o, k, g, c, e in cases], TICKETS)


@pytest.fixture(scope="module")
def few(spark):
    return _tickets(
        spark,
        (1, "DEV", "a", "2020-01-05", "2020-02-01"),
        (2, "DEV-VIP", "a", "2020-01-31T23:00", "2020-02-02T01:00"),
        (3, "SDEV", "b", "2020-02-01", "2020-02-11"),
        (4, "RFC", "b", "2020-02-01", None),
        (5, "DEV", None, "2020-03-01", None),
    )


def test_classes(few):
    assert [r.TICKET for r in tickets.with_class(few).orderBy("oid").collect()] == [
        "Development",
        "Development Small",
        "Development Small",
        "RFC",
        "Development",
    ]


def test_open_closed_and_types(few):
    assert [r.oid for r in tickets.open_tickets(few).collect()] == [4, 5]
    assert [r.oid for r in tickets.closed_tickets(few).collect()] == [1, 2, 3]
    assert [r.oid for r in tickets.tickets_of_types(few, ["RFC", "SDEV"]).collect()] == [3, 4]


def test_new_tickets(few):
    assert rows(flow.new_tickets(few)) == [
        ("2020-01", "Development", 1),
        ("2020-01", "Development Small", 1),
        ("2020-02", "Development Small", 1),
        ("2020-02", "RFC", 1),
        ("2020-03", "Development", 1),
    ]
    assert ("2020-03", "Development", None, 1) in rows(flow.new_tickets(few, team=True))


def test_throughput_and_lead_time(few):
    assert rows(flow.throughput(few)) == [("2020-02", "Development", 1), ("2020-02", "Development Small", 2)]
    assert rows(flow.throughput_time(few)) == [("2020-02", "Development", 27.0), ("2020-02", "Development Small", 6.0)]
    assert rows(flow.throughput_time(few, team=True)) == [
        ("2020-02", "Development", "a", 27.0),
        ("2020-02", "Development Small", "a", 2.0),
        ("2020-02", "Development Small", "b", 10.0),
    ]


def test_class_totals_from_team_counts(few):
    for counts, name in ((flow.new_tickets, "NEW_TICKET"), (flow.throughput, "THROUGHPUT")):
        assert rows(flow.over_teams(counts(few, team=True), name)) == rows(counts(few))


def test_median_of_an_even_number_interpolates(spark):
    df = _tickets(spark, *((i, "DEV", "a", "2020-01-01", f"2020-01-{1 + d:02d}") for i, d in enumerate([1, 2, 5, 9, 2, 5])))
    assert rows(flow.throughput_time(df)) == [("2020-01", "Development", 3.5)]


def test_backlog_on_month_starts(spark, few):
    cuts = month_starts(spark, dt.date(2020, 1, 1), dt.date(2020, 3, 1))
    result = {(str(r.CUTPOINT), r.TICKET): r.BACKLOG for r in flow.backlog_at(few, cuts).collect()}
    assert result == {
        ("2020-01-01", "Development"): 0,
        ("2020-01-01", "Development Small"): 0,
        ("2020-01-01", "RFC"): 0,
        ("2020-02-01", "Development"): 1,
        ("2020-02-01", "Development Small"): 2,
        ("2020-02-01", "RFC"): 1,
        ("2020-03-01", "Development"): 1,
        ("2020-03-01", "Development Small"): 0,
        ("2020-03-01", "RFC"): 1,
    }


def test_month_starts_from_data(few):
    assert [str(r.CUTPOINT) for r in month_starts_between(few, "created", "closed").collect()] == [
        "2020-01-01",
        "2020-02-01",
        "2020-03-01",
    ]


def _time(spark, *cases):
    schema = (
        "oid bigint, ticket_type string, userorg_worktimesheet string, targetmonth date, hours_worktimesheet double, "
        "phase string"
    )
    return spark.createDataFrame([(o, k, g, day(m), h, p) for o, k, g, m, h, p in cases], schema)


@pytest.fixture
def time(spark):
    return _time(
        spark,
        (1, "DEV", "x", "2020-01-01", 80.0, "Demand"),
        (1, "DEV", "x", "2020-01-01", 80.0, "Release"),
        (2, "DEV", "y", "2020-01-01", 160.0, "Demand"),
        (3, "SDEV", "y", "2020-02-01", 40.0, None),
        (4, "INC", None, "2020-02-01", 8.0, None),
        (5, "INC", None, "2020-02-01", None, None),
        (6, "DEV-VIP", "x", "2020-03-01", None, None),
    )


def test_fte_by_class(time):
    assert rows(effort.fte_by_class(time)) == [
        ("2020-01", "Development", 2.0, 1.0),
        ("2020-02", "Development Small", 0.25, 0.25),
        ("2020-02", "INC", 0.05, 0.05),
        ("2020-03", "Development Small", None, None),
    ]
    by_team = rows(effort.fte_by_class(time, team=True, hours_per_fte=80))
    assert by_team[:2] == [("2020-01", "Development", "x", 2.0, 2.0), ("2020-01", "Development", "y", 2.0, 2.0)]
    assert ("2020-02", "INC", None, 0.1, 0.1) in by_team


def test_fte_by_phase(time):
    assert rows(effort.fte_by_phase(time)) == [
        ("2020-01", "Demand", 1.5, 0.75),
        ("2020-01", "Release", 0.5, 0.5),
        ("2020-02", "SDEV", 0.25, 0.25),
    ]
    assert ("2020-01", "Demand", "y", 1.0, 1.0) in rows(effort.fte_by_phase(time, team=True))


def test_stored_booked_time_gives_the_same_effort(spark):
    named, df = views.named_work(spark, DATA), views.tickets(spark, DATA, team=False)
    stones = views.dev_milestones(spark, DATA)
    stored = effort.monthly_effort(bt.booked_time(named, df, stones))
    for team in (False, True):
        assert rows(effort.fte_by_class(stored, team)) == rows(effort.fte_by_class(bt.monthly_time(named, df, team), team))
        assert rows(effort.fte_by_phase(stored, team)) == rows(
            effort.fte_by_phase(bt.monthly_phase_time(named, df, stones, team), team)
        )


def test_rollup_holds_all_four_reports(spark, time):
    for worktime, hours in ((time, 160), (time, 80), (effort.monthly_effort(queries.phase_label(spark, DATA)), 160)):
        rollup = effort.effort_rollup(worktime, hours)
        reports = {
            "class": effort.fte_by_class(worktime, hours_per_fte=hours),
            "class_team": effort.fte_by_class(worktime, True, hours),
            "phase": effort.fte_by_phase(worktime, hours_per_fte=hours),
            "phase_team": effort.fte_by_phase(worktime, True, hours),
        }
        for level, report in reports.items():
            found = effort.effort_level(rollup, level)
            assert found.columns == report.columns
            assert rows(found) == rows(report)
        assert rollup.count() == sum(report.count() for report in reports.values())
    assert effort.effort_rollup(time.limit(0)).count() == 0


def test_rollup_reads_its_table_once(spark, time, tmp_path):
    time.write.parquet(f"{tmp_path}/time")
    text = plan(effort.effort_rollup(spark.read.parquet(f"{tmp_path}/time")))
    assert text.count("FileScan") == 1


def test_rollup_is_dealt_to_parts_by_rows(spark, time, monkeypatch):
    for parts in (1, 7):
        assert rows(effort.effort_rollup(time, parts=parts)) == rows(effort.effort_rollup(time))
    bookings = views.worktimesheet(spark, DATA).count()
    monkeypatch.setattr(effort, "ROLLUP_ROWS", bookings // 9)
    text = plan(queries.fte_rollup(spark, DATA))
    # Adaptive execution leaves a number of parts that is asked for as it is.
    assert re.search(rf"hashpartitioning\(oid#\d+L?, targetmonth#\d+, {effort.rollup_parts(bookings)}\), REPARTITION_BY_NUM", text)
    assert effort.rollup_parts(0) == 1 and effort.rollup_parts(bookings) >= 9
    whole = effort.effort_rollup(effort.monthly_effort(queries.phase_label(spark, DATA)))
    assert rows(queries.fte_rollup(spark, DATA)) == rows(whole)


def test_hot_issues_are_split_at_the_day(spark):
    named, df = views.named_work(spark, DATA), views.tickets(spark, DATA, team=False)
    stones = views.dev_milestones(spark, DATA)
    hot = bt.hot_issues(views.worktimesheet(spark, DATA), 3)
    assert hot.count() > 0
    for team in (False, True):
        split = bt.monthly_phase_time(named, df, stones, team, hot)
        assert rows(split) == rows(bt.monthly_phase_time(named, df, stones, team))


def _stones(spark, *cases):
    return spark.createDataFrame([(o, at(d), at(r)) for o, d, r in cases], DEV_MILESTONES)


def test_conformance(spark):
    df = _tickets(
        spark,
        (1, "DEV", "a", "2020-01-05", "2020-02-01"),
        (2, "DEV", "a", "2020-01-06", "2020-02-01"),
        (3, "DEV", "a", "2020-04-06", "2020-05-01"),
        (4, "SDEV", "a", "2020-03-06", "2020-05-01"),
        (5, "RFC", "a", "2020-01-01", "2020-05-01"),
        (6, "DEV", "a", "2019-01-01", None),
    )
    stones = _stones(spark, (1, "2020-01-06", "2020-01-20"), (2, None, "2020-01-20"), (3, "2020-04-10", "2020-04-09"))
    detail = conformance.conformance_detail(df, stones)
    assert [tuple(r)[1:] for r in detail.orderBy("OID").collect()] == [
        (1, "2020-01", True, True, True, True),
        (2, "2020-01", False, True, False, False),
        (3, "2020-04", True, True, False, False),
        (4, "2020-03", False, False, False, False),
    ]
    assert rows(conformance.conformance_count(detail)) == [
        ("2020-01", "Development", False, 1),
        ("2020-01", "Development", True, 1),
        ("2020-03", "Development Small", False, 1),
        ("2020-04", "Development", False, 1),
    ]
    cumulative = conformance.conformance_cumulative(conformance.conformance_count(detail))
    months = ["2020-01", "2020-02", "2020-03", "2020-04"]
    expected = {
        ("Development", False): ([1, 0, 0, 1], [1, 1, 1, 2]),
        ("Development", True): ([1, 0, 0, 0], [1, 1, 1, 1]),
        ("Development Small", False): ([0, 0, 1, 0], [0, 0, 1, 1]),
    }
    assert rows(cumulative) == sorted(
        (m, t, c, counts[i], totals[i]) for (t, c), (counts, totals) in expected.items() for i, m in enumerate(months)
    )


def test_own_criteria(spark):
    df = _tickets(spark, (1, "DEV", "a", "2020-01-05", "2020-02-01"), (2, "DEV", None, "2020-01-05", "2020-02-01"))
    criteria = {"IN_TEAM": F.col("appgroup") == "a"}
    detail = conformance.conformance_detail(df, _stones(spark), criteria)
    assert detail.columns == ["TICKET", "OID", "CREATED_MONTH", "IN_TEAM", "CONFORM"]
    assert [(r.OID, r.CONFORM) for r in detail.orderBy("OID").collect()] == [(1, True), (2, False)]


def test_last_running_count_is_the_sum(spark):
    counts = queries.conformance_count(spark, DATA).groupBy("TICKET", "CONFORM").agg(F.sum("COUNT"))
    last = queries.conformance_cumulative(spark, DATA).groupBy("TICKET", "CONFORM").agg(F.max("CUMULATIVE_COUNT"))
    assert rows(counts) == rows(last)


def test_longest_open(spark):
    df = _tickets(
        spark,
        *((i, "DEV", "a", "2020-01-01", None) for i in range(20, 0, -1)),
        *((100 + i, "RFC", "a", f"2020-01-0{i}", None) for i in range(1, 4)),
        (999, "RFC", "a", "2010-01-01", "2010-02-01"),
    )
    board = leaderboard.longest_open(df, dt.date(2020, 2, 1))
    assert [tuple(r) for r in board.filter("TICKET = 'Development'").orderBy("RANK").select("RANK", "OID").collect()] == [
        (i, i) for i in range(1, 11)
    ]
    assert [tuple(r) for r in board.filter("TICKET = 'RFC'").orderBy("RANK").select("RANK", "OID", "AGE_DAYS").collect()] == [
        (1, 101, 31),
        (2, 102, 30),
        (3, 103, 29),
    ]
    shown = leaderboard.display_blocks(board).collect()
    assert [r.OID for r in shown] == [*range(1, 11), 101, 102, 103]
    assert "TICKET" not in shown[0].asDict()


def test_highest_fte(spark):
    df = _tickets(spark, *((i, "DEV", "a", "2020-01-01", None) for i in range(1, 4)), (4, "DEV", "a", "2020-01-01", "2020-01-02"))
    hours = spark.createDataFrame([(1, 80.0), (2, 160.0), (4, 999.0), (5, 7.0)], "issue bigint, hours_worktimesheet double")
    assert rows(leaderboard.highest_fte(df, hours)) == [("Development", 1, 2, 1.0), ("Development", 2, 1, 0.5)]


def test_boards_are_cut_before_the_shuffle(spark):
    text = plan(queries.leaderboard_longest_open(spark, DATA))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_tickets_without_a_month_stay_in_the_running_counts(spark):
    counts = spark.createDataFrame(
        [("2020-01", "Development", True, 2), ("2020-03", "Development", True, 1), (None, "Development", True, 4)],
        "CREATED_MONTH string, TICKET string, CONFORM boolean, COUNT bigint",
    )
    found = {r.CREATED_MONTH: (r.COUNT, r.CUMULATIVE_COUNT) for r in conformance.conformance_cumulative(counts).collect()}
    assert found == {"2020-01": (2, 2), "2020-02": (0, 2), "2020-03": (1, 3), None: (4, 4)}
