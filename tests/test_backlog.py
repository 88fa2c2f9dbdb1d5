import datetime as dt
import random
from collections import Counter

import pytest
from conftest import at, day, plan, rows
from pyspark.errors import PySparkException
from pyspark.sql import Observation

from ticketflow.operators import backlog as module
from ticketflow.operators.backlog import backlog

CASES = "START timestamp_ntz, END timestamp_ntz, TICKET string, TEAM string"


def _cases(spark, cases):
    return spark.createDataFrame([(at(s), at(e), t, g) for s, e, t, g in cases], CASES)


def _cuts(spark, dates):
    return spark.createDataFrame([(day(d),) for d in dates], "CUTPOINT date")


def _brute(cases, cuts, group, key=lambda case: (), cut_key=lambda cut: (), extra=lambda cut: ()):
    """The full product: every matching pair adds its flag to its group."""
    total = Counter()
    for case in cases:
        for cut in cuts:
            if key(case) != cut_key(cut):
                continue
            c, (s, e) = cut[0], case[:2]
            inside = c is not None and s is not None and c >= s and (e is None or c <= e)
            total[(cut[0], *group(case), *extra(cut))] += int(inside)
    return sorted(((*k, n) for k, n in total.items()), key=lambda r: [(v is None, str(v)) for v in r])


def test_both_ends_are_open(spark):
    df = _cases(spark, [("2020-01-10", "2020-01-20", "DEV", "a")])
    cuts = _cuts(spark, ["2020-01-09", "2020-01-10", "2020-01-20", "2020-01-21"])
    assert [r.COUNT for r in backlog(df, cuts).orderBy("CUTPOINT").collect()] == [0, 1, 1, 0]


def test_open_end(spark):
    df = _cases(spark, [("2020-01-10", None, "DEV", "a")])
    cuts = _cuts(spark, ["2020-01-09", "2020-01-10", "2020-01-11"])
    assert [r.COUNT for r in backlog(df, cuts).orderBy("CUTPOINT").collect()] == [0, 1, 1]


@pytest.mark.parametrize(
    "case",
    [("2020-01-20", "2020-01-10"), (None, "2020-01-20"), (None, None), ("2030-01-01", None)],
    ids=["reversed", "start missing", "both missing", "future"],
)
def test_group_without_open_cases_shows_zeros(spark, case):
    df = _cases(spark, [(*case, "DEV", "a"), ("2020-01-01", None, "RFC", "a")])
    cuts = _cuts(spark, ["2020-01-09", "2020-01-15"])
    assert rows(backlog(df, cuts, "TICKET")) == [
        (day("2020-01-09"), "DEV", 0),
        (day("2020-01-09"), "RFC", 1),
        (day("2020-01-15"), "DEV", 0),
        (day("2020-01-15"), "RFC", 1),
    ]


def test_missing_group_value_is_a_group(spark):
    df = _cases(spark, [("2020-01-01", None, None, "a"), ("2020-01-01", None, "DEV", "a")])
    assert rows(backlog(df, _cuts(spark, ["2020-01-02"]), "TICKET")) == [
        (day("2020-01-02"), "DEV", 1),
        (day("2020-01-02"), None, 1),
    ]


def test_repeated_cases_and_cuts_count_repeatedly(spark):
    df = _cases(spark, [("2020-01-01", None, "DEV", "a")] * 2)
    cuts = _cuts(spark, ["2020-01-02", "2020-01-02", "2020-01-03"])
    assert rows(backlog(df, cuts)) == [(day("2020-01-02"), 4), (day("2020-01-03"), 2)]


def test_shared_column_matches_by_value_and_missing_meets_missing(spark):
    df = _cases(spark, [("2020-01-01", None, "DEV", "a"), ("2020-01-01", None, None, "a"), ("2020-01-01", None, "INC", "b")])
    cuts = spark.createDataFrame(
        [(day("2020-01-02"), "DEV"), (day("2020-01-03"), None), (day("2019-01-01"), None), (day("2020-01-02"), "RFC")],
        "CUTPOINT date, TICKET string",
    )
    assert rows(backlog(df, cuts, "TICKET")) == [
        (day("2019-01-01"), None, 0),
        (day("2020-01-02"), "DEV", 1),
        (day("2020-01-03"), None, 1),
    ]
    # Summed over the shared column when it is not asked for.
    assert rows(backlog(df, cuts, "TEAM")) == [
        (day("2019-01-01"), "a", 0),
        (day("2020-01-02"), "a", 1),
        (day("2020-01-03"), "a", 1),
    ]


def test_grouping_column_of_the_cut_dates(spark):
    df = _cases(spark, [("2020-01-01", "2020-01-05", "DEV", "a")])
    cuts = spark.createDataFrame(
        [(day("2020-01-02"), "first"), (day("2020-01-02"), "second"), (day("2020-01-09"), "second")],
        "CUTPOINT date, HALF string",
    )
    assert rows(backlog(df, cuts, "HALF", "TICKET")) == [
        (day("2020-01-02"), "first", "DEV", 1),
        (day("2020-01-02"), "second", "DEV", 1),
        (day("2020-01-09"), "second", "DEV", 0),
    ]


def test_missing_cut_date_counts_zero(spark):
    df = _cases(spark, [("2020-01-01", None, "DEV", "a")])
    assert rows(backlog(df, _cuts(spark, ["2020-01-02", None]), "TICKET")) == [(day("2020-01-02"), "DEV", 1), (None, "DEV", 0)]
    assert rows(backlog(df, _cuts(spark, [None]), "TICKET")) == [(None, "DEV", 0)]


def test_empty_inputs(spark):
    some = _cases(spark, [("2020-01-01", None, "DEV", "a")])
    assert rows(backlog(some.limit(0), _cuts(spark, ["2020-01-02"]), "TICKET")) == []
    assert rows(backlog(some.limit(0), _cuts(spark, ["2020-01-02"]))) == []
    assert rows(backlog(some, _cuts(spark, []), "TICKET")) == []


@pytest.mark.parametrize("local_rows", [100_000, 1])
def test_strict(spark, monkeypatch, local_rows):
    monkeypatch.setattr(module, "LOCAL_ROWS", local_rows)
    cuts = _cuts(spark, ["2020-01-10", "2020-01-20"])
    late = _cases(spark, [(None, "2020-01-09", "DEV", "a"), ("2020-01-01", None, "DEV", "a")])
    assert rows(backlog(late, cuts, strict=True)) == [(day("2020-01-10"), 1), (day("2020-01-20"), 1)]
    for end in (None, "2020-01-10"):
        with pytest.raises(PySparkException, match="missing start date"):
            backlog(_cases(spark, [(None, end, "DEV", "a")]), cuts, strict=True).collect()
    with pytest.raises(ValueError, match="missing cut date"):
        backlog(late, _cuts(spark, [None, "2020-01-01"]), strict=True)


@pytest.mark.parametrize("name", ["START", "END", "CUTPOINT", "COUNT", "count", "NOWHERE"])
def test_unusable_grouping_columns(spark, name):
    with pytest.raises(ValueError):
        backlog(_cases(spark, []), _cuts(spark, ["2020-01-01"]), name)


def test_as_a_transform(spark):
    df = _cases(spark, [("2020-01-01", None, "DEV", "a")])
    result = df.transform(backlog, _cuts(spark, ["2020-01-02"]), "TICKET", "TEAM", "TICKET")
    assert result.columns == ["CUTPOINT", "TICKET", "TEAM", "COUNT"]
    assert result.dtypes[0] == ("CUTPOINT", "date") and result.dtypes[-1] == ("COUNT", "bigint")


def _random_cases(seed, n, hours):
    rnd = random.Random(seed)
    start = dt.datetime(2020, 1, 1)

    def moment():
        return start + dt.timedelta(days=rnd.randrange(60), hours=rnd.choice(hours))

    return [
        (
            None if rnd.random() < 0.1 else moment(),
            None if rnd.random() < 0.3 else moment(),
            rnd.choice(["DEV", "RFC", None]),
            rnd.choice(["a", "b", "c", None]),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize(
    "cut_hours, broadcast_rows, local_rows, bins",
    [
        ([0], 500_000, 100_000, 4),
        ([0, 9], 500_000, 100_000, 4),
        ([0, 6, 9, 12, 18], 0, 100_000, 4),
        ([0, 6, 9, 12, 18], 500_000, 3, 4),
        ([0, 9], 0, 3, 1000),
        ([0], 0, 3, 1),
    ],
)
def test_equals_the_full_product(spark, monkeypatch, cut_hours, broadcast_rows, local_rows, bins):
    monkeypatch.setattr(module, "BROADCAST_ROWS", broadcast_rows)
    monkeypatch.setattr(module, "LOCAL_ROWS", local_rows)
    monkeypatch.setattr(module, "BINS", bins)
    rnd = random.Random(7)
    cases = _random_cases(1, 300, [0, 0, 6, 9, 12])
    moments = [dt.datetime(2020, 1, 5) + dt.timedelta(days=rnd.randrange(40), hours=rnd.choice(cut_hours)) for _ in range(30)]
    cuts = [(m,) for m in moments] + [(moments[0],), (None,)]
    df = spark.createDataFrame(cases, CASES)
    cut_df = spark.createDataFrame(cuts, "CUTPOINT timestamp_ntz")
    assert rows(backlog(df, cut_df)) == _brute(cases, cuts, lambda c: ())
    assert rows(backlog(df, cut_df, "TEAM", "TICKET")) == _brute(cases, cuts, lambda c: (c[3], c[2]))


@pytest.mark.parametrize("seed, local_rows", [(0, 100_000), (1, 100_000), (1, 3)])
def test_shared_columns_equal_the_matching_product(spark, monkeypatch, seed, local_rows):
    monkeypatch.setattr(module, "LOCAL_ROWS", local_rows)
    rnd = random.Random(seed)
    cases = _random_cases(seed, 300, [0, 9])
    cuts = [
        (dt.datetime(2020, 1, 5) + dt.timedelta(days=rnd.randrange(40), hours=rnd.choice([0, 9])), rnd.choice(["DEV", "INC", None]), rnd.choice("xy"))
        for _ in range(40)
    ]
    df = spark.createDataFrame(cases, CASES)
    cut_df = spark.createDataFrame(cuts, "CUTPOINT timestamp_ntz, TICKET string, HALF string")
    match = dict(key=lambda c: c[2], cut_key=lambda c: c[1])
    assert rows(backlog(df, cut_df, "TICKET")) == _brute(cases, cuts, lambda c: (c[2],), **match)
    assert rows(backlog(df, cut_df, "TEAM", "HALF")) == _brute(cases, cuts, lambda c: (c[3],), extra=lambda c: (c[2],), **match)


def test_groups_add_up_to_the_total(spark):
    df = spark.createDataFrame(_random_cases(3, 200, [0, 9]), CASES)
    cuts = _cuts(spark, ["2020-01-05", "2020-01-20", "2020-02-10"])
    by_group = Counter()
    for r in backlog(df, cuts, "TICKET", "TEAM").collect():
        by_group[r.CUTPOINT] += r.COUNT
    assert by_group == {r.CUTPOINT: r.COUNT for r in backlog(df, cuts).collect()}


def test_progress(spark):
    df = spark.createDataFrame(_random_cases(4, 50, [0]), CASES)
    cuts = _cuts(spark, ["2020-01-05", "2020-01-20"])
    seen = {step: Observation(step) for step in module.STEPS}
    result = backlog(df, cuts, "TICKET", progress=seen).collect()
    assert seen["cases"].get == {"rows": 50}
    assert seen["backlog"].get == {"rows": len(result)} == {"rows": 6}
    assert 3 <= seen["changes"].get["rows"] <= 9


def test_changes_are_summed_before_the_first_shuffle(spark):
    df = spark.createDataFrame(_random_cases(5, 50, [0]), CASES)
    text = plan(backlog(df, _cuts(spark, ["2020-01-05", "2020-01-20"]), "TICKET"))
    assert "partial_sum(change" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_shared_columns_scan_the_cases_once(spark, conf, tmp_path):
    conf("spark.sql.adaptive.enabled", "false")
    spark.createDataFrame(_random_cases(6, 50, [0]), CASES).write.parquet(f"{tmp_path}/cases")
    cuts = spark.createDataFrame([(day("2020-01-05"), "DEV"), (day("2020-01-20"), None)], "CUTPOINT date, TICKET string")
    text = plan(backlog(spark.read.parquet(f"{tmp_path}/cases"), cuts, "TEAM"))
    assert text.count("FileScan") == 1 and "ReusedExchange" in text


def test_progress_with_shared_columns(spark):
    df = spark.createDataFrame(_random_cases(4, 50, [0]), CASES)
    cuts = spark.createDataFrame([(day("2020-01-05"), "DEV"), (day("2020-01-20"), None)], "CUTPOINT date, TICKET string")
    seen = {step: Observation(step) for step in module.STEPS}
    result = backlog(df, cuts, "TICKET", progress=seen).collect()
    assert seen["cases"].get == {"rows": 50}
    assert seen["backlog"].get == {"rows": len(result)} == {"rows": 2}


@pytest.mark.parametrize("local_rows", [100_000, 3])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_many_cut_dates_on_one_day(spark, conf, monkeypatch, ansi, local_rows):
    conf("spark.sql.ansi.enabled", ansi)
    monkeypatch.setattr(module, "LOCAL_ROWS", local_rows)
    moments = [at("2020-01-01") + dt.timedelta(minutes=i) for i in range(30)] + [at("2020-01-09")]
    cuts = spark.createDataFrame([(m,) for m in moments], "CUTPOINT timestamp_ntz")
    cases = spark.createDataFrame([(at("2020-01-05"), None)], "START timestamp_ntz, END timestamp_ntz")
    found = {r.CUTPOINT: r.COUNT for r in backlog(cases, cuts).collect()}
    assert found == {m: int(m == moments[-1]) for m in moments}


@pytest.mark.parametrize("local_rows", [100_000, 3])
def test_the_time_zone_does_not_matter(spark, conf, monkeypatch, local_rows):
    conf("spark.sql.session.timeZone", "Europe/Paris")
    monkeypatch.setattr(module, "LOCAL_ROWS", local_rows)
    # The clock skips 02:00 to 03:00 there on 2020-03-29.
    moments = [at("2020-03-29T01:30:00") + dt.timedelta(minutes=15 * i) for i in range(10)]
    cuts = spark.createDataFrame([(m,) for m in moments], "CUTPOINT timestamp_ntz")
    cases = spark.createDataFrame([(moments[2], moments[4])], "START timestamp_ntz, END timestamp_ntz")
    found = {r.CUTPOINT: r.COUNT for r in backlog(cases, cuts).collect()}
    assert found == {m: int(2 <= i <= 4) for i, m in enumerate(moments)}


def test_the_cut_list_is_read_once(spark, tmp_path):
    spark.createDataFrame([(day("2020-01-05"),), (day("2020-01-20"),)], "CUTPOINT date").write.parquet(f"{tmp_path}/cuts")
    cases = spark.createDataFrame(_random_cases(6, 50, [0]), CASES)
    text = plan(backlog(cases, spark.read.parquet(f"{tmp_path}/cuts"), "TEAM"))
    assert "FileScan" not in text
