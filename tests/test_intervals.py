import pytest
from conftest import at
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ticketflow.functions.intervals import in_interval

SCHEMA = "s timestamp_ntz, e timestamp_ntz, c timestamp_ntz"
# start, end, check, flag
ANSWERED = [
    ("2020-01-10", None, "2020-01-10", 1),
    ("2020-01-10", None, "2020-01-09", 0),
    ("2020-01-10", "2020-01-20", "2020-01-09", 0),
    ("2020-01-10", "2020-01-20", "2020-01-10", 1),
    ("2020-01-10", "2020-01-20", "2020-01-20", 1),
    ("2020-01-10", "2020-01-20", "2020-01-21", 0),
    ("2020-01-10", "2020-01-20", "2020-01-20T00:00:01", 0),
    ("2020-01-20", "2020-01-10", "2020-01-15", 0),
    ("2020-01-20", "2020-01-10", "2020-01-25", 0),
    (None, "2020-01-20", "2020-01-21", 0),
]
UNANSWERED = [
    (None, None, "2020-01-15"),
    (None, "2020-01-20", "2020-01-15"),
    ("2020-01-10", "2020-01-20", None),
    ("2020-01-10", None, None),
    (None, None, None),
]


def _flags(spark, cases, strict):
    df = spark.createDataFrame([tuple(at(v) for v in case[:3]) for case in cases], SCHEMA)
    flag = in_interval(F.col("s"), F.col("e"), F.col("c"), strict)
    return [r.flag for r in df.select(flag.alias("flag")).collect()]


@pytest.mark.parametrize("strict", [False, True])
def test_answered(spark, strict):
    assert _flags(spark, ANSWERED, strict) == [case[3] for case in ANSWERED]


def test_unanswered_count_as_outside(spark):
    assert _flags(spark, UNANSWERED, False) == [0] * len(UNANSWERED)


@pytest.mark.parametrize("case", UNANSWERED)
def test_unanswered_raise_when_strict(spark, case):
    with pytest.raises(PySparkException, match="missing start or check date"):
        _flags(spark, [case], True)


def test_type(spark):
    df = spark.createDataFrame([], SCHEMA)
    flag = in_interval(F.col("s"), F.col("e"), F.col("c"), True)
    assert df.select(flag.alias("flag")).dtypes == [("flag", "bigint")]
