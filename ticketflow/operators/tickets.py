"""Ticket filters and derived ticket columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketflow.functions.calendar import lead_days
from ticketflow.functions.classes import ticket_class


def open_tickets(tickets: DataFrame) -> DataFrame:
    return tickets.filter(F.col("closed").isNull())


def closed_tickets(tickets: DataFrame) -> DataFrame:
    return tickets.filter(F.col("closed").isNotNull())


def tickets_of_types(tickets: DataFrame, types: Sequence[str]) -> DataFrame:
    return tickets.filter(F.col("ticket_type").isin(*types))


def with_class(tickets: DataFrame) -> DataFrame:
    return tickets.withColumn("TICKET", ticket_class(F.col("ticket_type")))


def with_lead_time(tickets: DataFrame) -> DataFrame:
    return tickets.withColumn("lead_days", lead_days(F.col("created"), F.col("closed")))
