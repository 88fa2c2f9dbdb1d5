"""Booked working time: filter, names, daily sums, tickets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketflow.functions.calendar import day, month
from ticketflow.operators.hot_keys import hot_keys, join_spreading_hot_keys
from ticketflow.sources.tables import blank_to_null

DAILY_KEYS = ("user_worktimesheet", "userorg_worktimesheet", "actiontypegroup", "targetday")


def work_only(bookings: DataFrame) -> DataFrame:
    """Bookings of type WorkTime; those without a type go too."""
    return bookings.filter(F.col("timetype") == "WorkTime")


def with_names(bookings: DataFrame, users: DataFrame, organizations: DataFrame, groups: DataFrame) -> DataFrame:
    """Bookings with user, organisation and action-group names.

    Three left joins; a missing partner gives a NULL name, a repeated `oid`
    repeats the booking. The lookup tables are plain scans, so Spark broadcasts
    each one whose file size is under `spark.sql.autoBroadcastJoinThreshold`
    and otherwise shuffles, where adaptive execution splits a hot or missing
    owner.
    """
    user = users.select(
        F.col("oid").alias("user_oid"),
        blank_to_null(F.col("name")).alias("user_worktimesheet"),
        F.col("defaultorganization").alias("user_organization"),
    )
    organization = organizations.select(
        F.col("oid").alias("organization_oid"), blank_to_null(F.col("name")).alias("userorg_worktimesheet")
    )
    group = groups.select(F.col("oid").alias("group_oid"), blank_to_null(F.col("name")).alias("group_name"))
    return (
        bookings.withColumnRenamed("actiontypegroup", "group_id")
        .join(user, F.col("owner") == F.col("user_oid"), "left")
        .join(organization, F.col("user_organization") == F.col("organization_oid"), "left")
        .join(group, F.col("group_id") == F.col("group_oid"), "left")
        .select(
            "issue",
            "user_worktimesheet",
            "userorg_worktimesheet",
            F.col("group_name").alias("actiontypegroup"),
            "startdate",
            "hours",
        )
    )


def with_targetday(bookings: DataFrame) -> DataFrame:
    return bookings.withColumn("targetday", day(F.col("startdate")))


def with_targetmonth(bookings: DataFrame) -> DataFrame:
    return bookings.withColumn("targetmonth", month(F.col("startdate")))


def sum_hours(bookings: DataFrame, *keys: str) -> DataFrame:
    """Hours per issue and the given keys."""
    return bookings.groupBy("issue", *keys).agg(F.sum("hours").alias("hours_worktimesheet"))


def daily_hours(named: DataFrame) -> DataFrame:
    """Hours per issue, user name, organisation name, action-group name and day."""
    return sum_hours(with_targetday(named), *DAILY_KEYS)


def join_tickets(daily: DataFrame, tickets: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """All ticket columns, then the daily sums; tickets without bookings drop out.

    `hot` lists issues to split over several tasks, see `hot_keys`. Counting
    them in the raw bookings is cheaper than counting the daily sums.
    """
    booked = daily.filter(F.col("issue").isNotNull())
    hot = hot_keys(booked, "issue") if hot is None else hot
    joined = join_spreading_hot_keys(booked, tickets, "issue", "oid", list(DAILY_KEYS), hot)
    return joined.select(*tickets.columns, *daily.columns)


def total_hours(worktime: DataFrame) -> DataFrame:
    """Hours per ticket out of finer sums."""
    return worktime.groupBy(F.col("oid").alias("issue")).agg(F.sum("hours_worktimesheet").alias("hours_worktimesheet"))


def sort_worktime(worktime: DataFrame) -> DataFrame:
    """Ordered by ticket and day, missing values last."""
    return worktime.orderBy(F.col("oid").asc_nulls_last(), F.col("targetday").asc_nulls_last())
