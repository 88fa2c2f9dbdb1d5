"""What a run has counted, as a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation


def observed_rows(df: DataFrame, progress: Mapping[str, Observation]) -> DataFrame:
    """(step, rows): the rows that passed each observed step of `df`, which is computed once and not kept.

    An observation is answered by the first action on the table that carries
    it; here all rows go to Spark's empty sink.
    """
    df.write.format("noop").mode("overwrite").save()
    found = [(step, seen.get["rows"]) for step, seen in progress.items()]
    return df.sparkSession.createDataFrame(found, "step string, rows bigint")
