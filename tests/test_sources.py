import datetime as dt
from pathlib import Path

import pytest
from conftest import DATA, at, rows
from pyspark.sql import types as T

from ticketflow import session
from ticketflow.functions.calendar import month_starts
from ticketflow.plans import booked_time, queries, views
from ticketflow.plans.reports import publish
from ticketflow.sources import reports, sinks, tables


def test_csv_text(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('MONTH,TEXT,N\n2020-01,"x ""q"", y",1\nNA,"line one\nline two",NA\n2020-03,,3\n2020-04,"",4\n')
    df = reports.read_csv(spark, str(path), "MONTH string, TEXT string, N int")
    assert [tuple(r) for r in df.collect()] == [
        ("2020-01", 'x "q", y', 1),
        (None, "line one\nline two", None),
        ("2020-03", None, 3),
        ("2020-04", None, 4),
    ]


def test_csv_round_trip(spark, tmp_path):
    schema = "s string, n bigint, x double, d date, t timestamp_ntz, b boolean"
    data = [
        ('a "quoted", word\nnext', 1, 0.1, dt.date(2020, 1, 1), at("2020-01-01T10:00:00.123456"), True),
        (None, None, None, None, None, None),
        ("plain", -5, 1e300, dt.date(1, 1, 1), at("1900-01-01"), False),
    ]
    df = spark.createDataFrame(data, schema)
    reports.write_csv(df, f"{tmp_path}/t.csv")
    back = reports.read_csv(spark, f"{tmp_path}/t.csv", df.schema)
    assert rows(back) == rows(df)
    first = next(Path(f"{tmp_path}/t.csv").glob("part-*")).read_text()
    assert first.startswith("s,n,x,d,t,b\n")


def test_csv_columns_go_by_name(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("CREATED_MONTH,OTHER,NEW_TICKET,TICKET\n2020-01,x,5,DEV\n")
    df = reports.read_csv(spark, str(path), reports.REPORTS["t_nb_ticket"])
    assert [tuple(r) for r in df.collect()] == [("2020-01", "DEV", 5)]
    with pytest.raises(ValueError, match="APPGROUP"):
        reports.read_csv(spark, str(path), reports.REPORTS["t_nb_ticket_team"])


def test_csv_bad_cell_is_an_error(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("TICKET,N\nDEV,5 x\n")
    with pytest.raises(Exception, match="5 x|MALFORMED"):
        reports.read_csv(spark, str(path), "TICKET string, N int").collect()


def test_csv_bad_rows_are_set_aside(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('N,TICKET,OTHER\n1,DEV,a\n5 x,RFC,b\n2,"two\nlines",c\n3,short\n4,,d\n9,INC,e,more\n')
    kept, aside = reports.read_csv_setting_aside(spark, str(path), "TICKET string, N int")
    assert rows(kept) == [("DEV", 1), ("two\nlines", 2), (None, 4)]
    assert sorted(r.record for r in aside.collect()) == ["3,short", "5 x,RFC,b", "9,INC,e,more"]
    path.write_text("TICKET,N\n")
    kept, aside = reports.read_csv_setting_aside(spark, str(path), "TICKET string, N int")
    assert kept.count() == aside.count() == 0


def test_catalog_refresh_reads_itself_and_keeps_the_old_table(spark):
    name = "refreshed_catalog_table"
    try:
        sinks.full_refresh_table(spark.range(5), name)
        sinks.full_refresh_table(spark.table(name).filter("id > 2"), name)
        assert [r.id for r in spark.table(name).orderBy("id").collect()] == [3, 4]
        with pytest.raises(Exception, match="broken"):
            sinks.full_refresh_table(spark.range(3).selectExpr("if(id = 1, raise_error('broken'), id) AS id"), name)
        assert spark.table(name).count() == 2
        assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_empty_text_counts_as_missing(spark, tmp_path):
    tickets = spark.createDataFrame([(1, "", "", None, None), (2, "DEV", "A", None, None)], tables.TICKETS)
    tickets.write.parquet(f"{tmp_path}/tickets.parquet")
    found = {r.oid: (r.ticket_type, r.appgroup) for r in tables.read_table(spark, str(tmp_path), "tickets").collect()}
    assert found == {1: (None, None), 2: ("DEV", "A")}


def test_publish_refuses_a_time_of_day(spark, tmp_path):
    cuts = spark.sql("SELECT TIMESTAMP_NTZ '2000-01-01 06:00:00' AS CUTPOINT")
    with pytest.raises(Exception, match="time of day"):
        publish(views.inputs(spark, DATA), str(tmp_path), cuts, queries.AS_OF)


def test_full_refresh_with_and_without_an_old_table(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    sinks.full_refresh(spark.range(10), path)
    assert spark.read.parquet(path).count() == 10
    # The new rows may come from the old table.
    sinks.full_refresh(spark.read.parquet(path).filter("id > 6"), path, sort_by=("id",))
    assert [r.id for r in spark.read.parquet(path).collect()] == [7, 8, 9]
    assert [p.name for p in tmp_path.iterdir() if "__new_" in p.name] == []


def test_failed_refresh_keeps_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    sinks.full_refresh(spark.range(3), path)
    with pytest.raises(Exception, match="broken"):
        sinks.full_refresh(spark.range(3).selectExpr("if(id = 1, raise_error('broken'), id) AS id"), path)
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["t.parquet"]


def test_catalog_tables(spark):
    spark.sql("CREATE DATABASE stage")
    try:
        for rows_now in (5, 2):
            sinks.full_refresh_table(spark.range(rows_now), "stage.t", sort_by=("id",))
            assert tables.catalog_table(spark, "t", "stage").count() == rows_now
        for name, schema in tables.SCHEMAS.items():
            sinks.full_refresh_table(spark.createDataFrame([], schema), f"stage.{name}")
        inputs = booked_time.catalog_inputs(spark, "stage")
        assert inputs.dev_milestones.schema == tables.DEV_MILESTONES
    finally:
        spark.sql("DROP DATABASE stage CASCADE")


def test_scratch_folder_follows_the_session(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    first, second = sinks.scratch_folder(spark), sinks.scratch_folder(spark)
    assert first.startswith(f"{shared}/ticketflow-") and first != second


def test_publish_writes_every_report(spark, tmp_path):
    inputs = views.inputs(spark, DATA)
    cuts = month_starts(spark, queries.FIRST_CUT, queries.LAST_CUT)
    publish(inputs, str(tmp_path), cuts, queries.AS_OF)
    assert {p.name for p in tmp_path.iterdir()} == {f"{n}.csv" for n in reports.REPORTS} | {"t_isd_worktimesheet.parquet"}
    same = {
        "t_nb_ticket": queries.new_tickets,
        "t_throughputtime_ticket_team": queries.throughput_time_team,
        "t_backlog_ticket": queries.backlog_month_start,
        "t_fte_ticket": queries.fte_norm_by_type,
        "t_fte_phases_team": queries.fte_norm_phase_team,
        "t_conf": queries.conformance_detail,
        "t_conf_agg": queries.conformance_cumulative,
        "t_lb_fte_open": queries.leaderboard_highest_fte,
    }
    for name in reports.REPORTS:
        stored = reports.read_report(spark, str(tmp_path), name)
        assert stored.schema == T.StructType.fromDDL(reports.REPORTS[name])
        assert stored.count() > 0
        if name in same:
            assert rows(stored) == rows(same[name](spark, DATA).select(*stored.columns))


def test_shuffle_partitions():
    assert session.shuffle_partitions(0, 8) == 8
    assert session.shuffle_partitions(10 * 1024**4, 8) == 163840
