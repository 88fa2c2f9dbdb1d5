"""Lifecycle phase of booked time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.operators.hot_keys import hot_keys, join_spreading_hot_keys
from ticketflow.operators.worktime import DAILY_KEYS
from ticketflow.sources.clustered import join_clustered


def first_milestones(milestones: DataFrame) -> DataFrame:
    """Earliest demand and release start per ticket.

    The earliest dates decide every phase test: a day is on or after some
    start exactly when it is on or after the first one.
    """
    return milestones.groupBy(F.col("oid").alias("milestone_oid")).agg(
        F.min("demand_start").alias("first_demand"), F.min("release_start").alias("first_release")
    )


def with_milestones(tickets: DataFrame, milestones: DataFrame) -> DataFrame:
    """Tickets with their earliest milestones; NULL where there are none."""
    first = first_milestones(milestones)
    return tickets.join(first, F.col("oid") == F.col("milestone_oid"), "left").drop("milestone_oid")


def phase_of(targetday: Column, first_demand: Column, first_release: Column) -> Column:
    """Release, else Demand, else Pre-demand, else NULL.

    Milestones keep their time of day, so a day whose milestone falls at 09:00
    is not in that phase yet.
    """
    return (
        F.when(targetday >= first_release, "Release")
        .when(targetday >= first_demand, "Demand")
        .when(targetday < first_demand, "Pre-demand")
    )


def label_phase(worktime: DataFrame, milestones: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Any table with `oid` and the daily keys, plus its `phase`.

    `hot` lists tickets to split over several tasks, see `hot_keys`.
    """
    hot = hot_keys(worktime, "oid") if hot is None else hot
    joined = join_spreading_hot_keys(
        worktime, first_milestones(milestones), "oid", "milestone_oid", list(DAILY_KEYS), hot, "left"
    )
    phase = phase_of(F.col("targetday"), F.col("first_demand"), F.col("first_release"))
    kept = [name for name in worktime.columns if name != "phase"]
    return joined.select(*kept, phase.alias("phase"))


def released(worktime: DataFrame, milestones: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Rows for which a release had started by that day (a semi-join)."""
    first = first_milestones(milestones).filter(F.col("first_release").isNotNull())
    hot = hot_keys(worktime, "oid") if hot is None else hot
    started = F.col("targetday") >= F.col("first_release")
    return join_spreading_hot_keys(
        worktime, first, "oid", "milestone_oid", list(DAILY_KEYS), hot, "left_semi", where=started
    )


def label_phase_clustered(spark: SparkSession, name: str, milestones: DataFrame) -> DataFrame:
    """`label_phase` over a clustered table of the catalog: only the milestones are shuffled."""
    first = first_milestones(milestones)
    joined = join_clustered(spark, name, first, "oid", "milestone_oid", "left")
    phase = phase_of(F.col("targetday"), F.col("first_demand"), F.col("first_release"))
    return joined.drop("phase").withColumn("phase", phase).drop(*first.columns)


def released_clustered(spark: SparkSession, name: str, milestones: DataFrame) -> DataFrame:
    """`released` over a clustered table of the catalog: only the milestones are shuffled."""
    first = first_milestones(milestones).filter(F.col("first_release").isNotNull())
    started = F.col("targetday") >= F.col("first_release")
    return join_clustered(spark, name, first, "oid", "milestone_oid", "left_semi", where=started)


def unlabelled(worktime: DataFrame) -> DataFrame:
    return worktime.filter(F.col("phase").isNull())
