"""Ticket classes from type codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Type codes and class names of the reports.
DEVELOPMENT = "Development"
DEVELOPMENT_SMALL = "Development Small"
SMALL_TYPES = ("DEV-VIP", "SDEV")
CONFORMANCE_TYPES = ("DEV", "DEV-VIP", "SDEV")
DEVELOPMENT_FTE_TYPES = ("DEV", "SDEV", "RFC")


def ticket_class(ticket_type: Column) -> Column:
    """Class of a type code; a type without a class stands for itself."""
    return (
        F.when(ticket_type == "DEV", DEVELOPMENT)
        .when(ticket_type.isin(*SMALL_TYPES), DEVELOPMENT_SMALL)
        .otherwise(ticket_type)
    )
