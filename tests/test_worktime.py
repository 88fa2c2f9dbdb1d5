from conftest import at, day, plan, rows
from pyspark.sql import functions as F

from ticketflow.functions.calendar import day as to_day
from ticketflow.operators import worktime
from ticketflow.plans import booked_time as bt
from ticketflow.sources import tables


def make_inputs(spark, bookings, tickets=((1, "DEV"), (2, "RFC")), users=None, milestones=()):
    users = users if users is not None else [(10, "Ann", 100), (11, "Ann", 100), (12, "Bob", None)]
    full = [(*t, "team", at("2020-01-01"), None) for t in tickets]
    return bt.Inputs(
        tickets=spark.createDataFrame(full, tables.TICKETS),
        worktimesheet=spark.createDataFrame([(i, o, g, at(s), h, t) for i, o, g, s, h, t in bookings], tables.WORKTIMESHEET),
        permissionpolicyuser=spark.createDataFrame(users, tables.PERMISSIONPOLICYUSER),
        organization=spark.createDataFrame([(100, "Org")], tables.ORGANIZATION),
        actiontypegroup=spark.createDataFrame([(5, "Build")], tables.ACTIONTYPEGROUP),
        dev_milestones=spark.createDataFrame([(o, at(d), at(r)) for o, d, r in milestones], tables.DEV_MILESTONES),
    )


def named(inputs):
    return bt.named_work(inputs.worktimesheet, inputs.permissionpolicyuser, inputs.organization, inputs.actiontypegroup)


def _daily(spark, *bookings, **kwargs):
    return rows(worktime.daily_hours(named(make_inputs(spark, bookings, **kwargs))))


def test_namesakes_share_a_row(spark):
    day_start, evening = "2020-01-10T08:00", "2020-01-10T20:00"
    assert _daily(spark, (1, 10, 5, day_start, 2.0, "WorkTime"), (1, 11, 5, evening, 3.0, "WorkTime")) == [
        (1, "Ann", "Org", "Build", day("2020-01-10"), 5.0)
    ]


def test_unknown_owner_and_group_keep_the_row(spark):
    assert _daily(spark, (1, 99, 6, "2020-01-10", 2.0, "WorkTime")) == [(1, None, None, None, day("2020-01-10"), 2.0)]
    assert _daily(spark, (1, None, None, "2020-01-10", 2.0, "WorkTime")) == [(1, None, None, None, day("2020-01-10"), 2.0)]


def test_user_without_organisation(spark):
    assert _daily(spark, (1, 12, 5, "2020-01-10", 2.0, "WorkTime")) == [(1, "Bob", None, "Build", day("2020-01-10"), 2.0)]


def test_missing_hours(spark):
    assert _daily(spark, (1, 10, 5, "2020-01-10", None, "WorkTime")) == [(1, "Ann", "Org", "Build", day("2020-01-10"), None)]
    both = _daily(spark, (1, 10, 5, "2020-01-10", None, "WorkTime"), (1, 10, 5, "2020-01-10", 4.0, "WorkTime"))
    assert both == [(1, "Ann", "Org", "Build", day("2020-01-10"), 4.0)]


def test_other_time_types_go(spark):
    assert _daily(spark, (1, 10, 5, "2020-01-10", 2.0, None), (1, 10, 5, "2020-01-10", 2.0, "TravelTime")) == []


def test_missing_issue_and_day_are_groups(spark):
    assert _daily(spark, (None, 10, 5, None, 2.0, "WorkTime"), (None, 10, 5, None, 1.0, "WorkTime")) == [
        (None, "Ann", "Org", "Build", None, 3.0)
    ]


def test_repeated_user_id_repeats_hours(spark):
    users = [(10, "Ann", 100), (10, "Ann", 100)]
    assert _daily(spark, (1, 10, 5, "2020-01-10", 2.0, "WorkTime"), users=users) == [
        (1, "Ann", "Org", "Build", day("2020-01-10"), 4.0)
    ]


def test_blank_name_is_missing(spark):
    users = [(10, "", 100), (11, None, 100)]
    bookings = [(1, 10, 5, "2020-01-10", 2.0, "WorkTime"), (1, 11, 5, "2020-01-10", 2.0, "WorkTime")]
    assert _daily(spark, *bookings, users=users) == [(1, None, "Org", "Build", day("2020-01-10"), 4.0)]


def test_tickets_without_bookings_drop_out(spark):
    inputs = make_inputs(spark, [(1, 10, 5, "2020-01-10", 2.0, "WorkTime"), (77, 10, 5, "2020-01-10", 1.0, "WorkTime")])
    joined = bt.worktime_by_ticket(named(inputs), inputs.tickets)
    assert joined.columns == [
        *inputs.tickets.columns,
        "issue",
        "user_worktimesheet",
        "userorg_worktimesheet",
        "actiontypegroup",
        "targetday",
        "hours_worktimesheet",
    ]
    assert [(r.oid, r.issue, r.hours_worktimesheet) for r in joined.collect()] == [(1, 1, 2.0)]


def test_sorted_by_ticket_and_day_missing_last(spark):
    df = spark.createDataFrame(
        [(2, day("2020-01-01")), (None, day("2020-01-01")), (1, None), (1, day("2020-01-02")), (1, day("2020-01-01"))],
        "oid bigint, targetday date",
    )
    assert [tuple(r) for r in worktime.sort_worktime(df).collect()] == [
        (1, day("2020-01-01")),
        (1, day("2020-01-02")),
        (1, None),
        (2, day("2020-01-01")),
        (None, day("2020-01-01")),
    ]


def test_day_of_a_timestamp(spark):
    df = spark.createDataFrame([(at("2020-02-29T23:59:59"),)], "t timestamp_ntz")
    assert df.select(to_day(F.col("t"))).first()[0] == day("2020-02-29")


def test_stored_tables_are_read_narrowly(spark, tmp_path):
    inputs = make_inputs(spark, [(1, 10, 5, "2020-01-10", 2.0, "WorkTime"), (2, 10, 5, "2020-01-11", 2.0, "Travel")])
    for name in tables.SCHEMAS:
        getattr(inputs, name).write.parquet(f"{tmp_path}/{name}.parquet")
    stored = bt.read_inputs(spark, str(tmp_path))
    assert rows(bt.booked_time(named(stored), stored.tickets, stored.dev_milestones)) == rows(
        bt.booked_time(named(inputs), inputs.tickets, inputs.dev_milestones)
    )
    daily = plan(worktime.daily_hours(named(stored)))
    assert "EqualTo(timetype,WorkTime)" in daily
    assert daily.count("BroadcastHashJoin") == 3
    monthly = plan(bt.monthly_time(named(stored), stored.tickets))
    assert "ReadSchema: struct<oid:bigint,ticket_type:string>" in monthly
    assert "name:string" not in monthly


def test_hot_owner_is_split_when_users_are_too_many_to_broadcast(spark, conf, tmp_path):
    spark.range(200_000).selectExpr(
        "id % 1000 AS issue",
        "if(id % 3 = 0, NULL, if(id % 3 = 1, 7, id % 500)) AS owner",
        "5L AS actiontypegroup",
        "timestamp_ntz'2020-01-01 08:00:00' AS startdate",
        "1D AS hours",
        "'WorkTime' AS timetype",
    ).write.parquet(f"{tmp_path}/bookings")
    spark.range(500).selectExpr("id AS oid", "concat('u', id) AS name", "id % 3 AS defaultorganization").write.parquet(
        f"{tmp_path}/users"
    )
    bookings, users = spark.read.parquet(f"{tmp_path}/bookings"), spark.read.parquet(f"{tmp_path}/users")
    small = spark.createDataFrame([(1, "x"), (5, "y")], "oid bigint, name string")
    expected = rows(worktime.daily_hours(worktime.with_names(bookings, users, small, small)))
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10000")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    conf("spark.sql.shuffle.partitions", "20")
    df = worktime.daily_hours(worktime.with_names(bookings, users, small, small))
    assert rows(df) == expected
    assert "skew=true" in plan(df)
