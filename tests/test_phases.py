import datetime as dt
import random

import pytest
from conftest import at, day, rows
from test_worktime import make_inputs, named

from ticketflow.operators import phases
from ticketflow.operators.hot_keys import hot_keys
from ticketflow.plans import booked_time as bt
from ticketflow.sources import tables

WORKTIME = (
    "oid bigint, user_worktimesheet string, userorg_worktimesheet string, actiontypegroup string, targetday date, "
    "hours_worktimesheet double"
)


def _worktime(spark, days):
    return spark.createDataFrame([(o, f"u{i}", "org", "group", d, 1.0) for i, (o, d) in enumerate(days)], WORKTIME)


def _label(spark, milestones, booked):
    stones = spark.createDataFrame([(1, at(d), at(r)) for d, r in milestones], tables.DEV_MILESTONES)
    result = phases.label_phase(_worktime(spark, [(1, day(booked))]), stones).collect()
    assert len(result) == 1
    return result[0].phase


@pytest.mark.parametrize(
    "milestones, booked, phase",
    [
        ([("2020-01-10", "2020-01-05")], "2020-01-07", "Release"),
        ([("2020-01-10", "2020-01-20")], "2020-01-20", "Release"),
        ([("2020-01-10", "2020-01-20")], "2020-01-10", "Demand"),
        ([("2020-01-10", "2020-01-20")], "2020-01-09", "Pre-demand"),
        ([(None, "2020-01-05")], "2020-01-04", None),
        ([(None, "2020-01-05")], "2020-01-05", "Release"),
        ([("2020-01-10T09:00", None)], "2020-01-10", "Pre-demand"),
        ([("2020-01-10T09:00", None)], "2020-01-11", "Demand"),
        ([("2020-01-05", None), ("2020-01-20", None)], "2020-01-10", "Demand"),
        ([("2020-01-05", None), ("2020-01-20", None)], "2020-01-01", "Pre-demand"),
        ([("2020-01-20", None), (None, "2020-01-09")], "2020-01-10", "Release"),
        ([(None, None)], "2020-01-10", None),
        ([], "2020-01-10", None),
        ([("2020-01-05", "2020-01-06")], None, None),
    ],
)
def test_label(spark, milestones, booked, phase):
    assert _label(spark, milestones, booked) == phase


def _three_tests(stones, oid, booked):
    """The three EXISTS tests in order, over all milestone rows."""
    if booked is None:
        return None
    moment = dt.datetime.combine(booked, dt.time())
    mine = [(d, r) for o, d, r in stones if o == oid]
    if any(r is not None and moment >= r for _, r in mine):
        return "Release"
    if any(d is not None and moment >= d for d, _ in mine):
        return "Demand"
    if any(d is not None and moment < d for d, _ in mine):
        return "Pre-demand"
    return None


@pytest.mark.parametrize("hot_rows", [5, 1_000_000])
def test_equals_three_exists_tests(spark, hot_rows):
    rnd = random.Random(11)
    start = dt.datetime(2020, 1, 1)

    def moment():
        return None if rnd.random() < 0.3 else start + dt.timedelta(days=rnd.randrange(40), hours=rnd.choice([0, 9]))

    stones = [(rnd.randrange(20), moment(), moment()) for _ in range(40)]
    days = [
        (rnd.choice([0, rnd.randrange(25)]), None if rnd.random() < 0.05 else (start + dt.timedelta(days=rnd.randrange(45))).date())
        for _ in range(500)
    ]
    df, stones_df = _worktime(spark, days), spark.createDataFrame(stones, tables.DEV_MILESTONES)
    hot = hot_keys(df, "oid", hot_rows)
    labelled = phases.label_phase(df, stones_df, hot)
    assert labelled.columns == [*df.columns, "phase"]
    got = sorted((r.user_worktimesheet, r.phase) for r in labelled.collect())
    expected = sorted((f"u{i}", _three_tests(stones, o, d)) for i, (o, d) in enumerate(days))
    assert got == expected
    semi = {r.user_worktimesheet for r in phases.released(df, stones_df, hot).collect()}
    assert semi == {u for u, phase in expected if phase == "Release"}


def test_whole_table_keeps_rows_and_hours(spark):
    bookings = [(i % 3, 10 + i % 2, 5, f"2020-01-{1 + i % 28:02d}T10:00", float(i), "WorkTime") for i in range(200)]
    inputs = make_inputs(
        spark, bookings, milestones=[(1, "2020-01-05", "2020-01-20"), (1, "2020-01-07", None), (2, None, "2020-01-10")]
    )
    parts = named(inputs), inputs.tickets, inputs.dev_milestones
    plain, labelled = bt.worktime_by_ticket(*parts[:2]), bt.booked_time(*parts)
    assert rows(labelled.drop("phase")) == rows(plain)
    assert rows(bt.booked_time(*parts, bt.hot_issues(inputs.worktimesheet, 3))) == rows(labelled)
    assert rows(phases.label_phase(plain, inputs.dev_milestones)) == rows(labelled)
    assert {r.phase for r in labelled.collect()} == {"Pre-demand", "Demand", "Release", None}
    assert max(len(r.phase or "") for r in labelled.collect()) == 10
