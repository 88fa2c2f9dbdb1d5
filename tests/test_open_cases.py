import datetime as dt
import random

from conftest import DATA, at, plan, rows
from pyspark.sql import functions as F

from ticketflow.operators import open_cases as operator
from ticketflow.operators.backlog import backlog
from ticketflow.operators.open_cases import FAN, LEVELS, _blocks, open_cases
from ticketflow.plans import queries, views

CASES = "id int, START timestamp_ntz, END timestamp_ntz, TICKET string, cut string"


def _made(seed, n):
    rnd = random.Random(seed)
    start = dt.datetime(2020, 1, 1)

    def moment():
        return start + dt.timedelta(days=rnd.randrange(60), hours=rnd.choice([0, 9]))

    return [
        (
            i,
            None if rnd.random() < 0.1 else moment(),
            None if rnd.random() < 0.3 else moment(),
            rnd.choice(["DEV", "RFC", None]),
            "x",
        )
        for i in range(n)
    ]


def _open(case, cut):
    return cut is not None and case[1] is not None and cut >= case[1] and (case[2] is None or cut <= case[2])


def test_equals_the_product(spark):
    cases = _made(1, 200) + _made(1, 1)
    cuts = [at("2019-12-01"), at("2020-01-05"), at("2020-01-05T09:00:00"), at("2020-02-10"), at("2020-02-10"), at("2021-01-01"), None]
    found = open_cases(spark.createDataFrame(cases, CASES), spark.createDataFrame([(c,) for c in cuts], "CUTPOINT timestamp_ntz"))
    assert found.columns == ["CUTPOINT", "id", "START", "END", "TICKET", "cut"]
    expected = [(cut, *case) for case in cases for cut in cuts if _open(case, cut)]
    assert rows(found) == sorted(expected, key=lambda r: [(v is None, str(v)) for v in r])


def test_shared_columns_match_by_value_and_missing_meets_missing(spark):
    cases = _made(2, 150)
    cuts = [(at("2020-01-20"), "DEV", 1), (at("2020-01-25"), None, 2), (at("2020-02-01"), "INC", 3)]
    found = open_cases(
        spark.createDataFrame(cases, CASES), spark.createDataFrame(cuts, "CUTPOINT timestamp_ntz, TICKET string, n int")
    )
    expected = [(c, k, n, *case[:3], case[4]) for case in cases for c, k, n in cuts if case[3] == k and _open(case, c)]
    assert rows(found) == sorted(expected, key=lambda r: [(v is None, str(v)) for v in r])


def test_empty_inputs(spark):
    cases = spark.createDataFrame(_made(3, 5), CASES)
    cuts = spark.createDataFrame([(at("2020-01-20"),)], "CUTPOINT timestamp_ntz")
    assert open_cases(cases, cuts.limit(0)).count() == 0
    assert open_cases(cases.limit(0), cuts).count() == 0
    assert open_cases(cases, spark.createDataFrame([(None,)], "CUTPOINT timestamp_ntz")).count() == 0


def test_rows_are_what_the_backlog_counts(spark):
    cases = views.tickets(spark, DATA, team=False).withColumnsRenamed({"created": "START", "closed": "END"})
    cuts = queries._cuts(spark)
    found = open_cases(cases, cuts)
    text = plan(found)
    assert "NestedLoop" not in text and "Cartesian" not in text
    counted = {r.CUTPOINT: r["count"] for r in found.groupBy("CUTPOINT").count().collect()}
    assert counted == {r.CUTPOINT: r.COUNT for r in backlog(cases, cuts).collect() if r.COUNT}


def test_blocks_hold_every_bin_once(spark):
    rnd = random.Random(5)
    runs = [sorted((rnd.randrange(3000), rnd.randrange(3000))) for _ in range(200)]
    runs += [[0, 0], [0, 2999], [255, 256], [256, 511], [1, 3], [4, 7], [3, 4]]
    held = spark.createDataFrame(runs, "first long, last long").withColumn("blocks", _blocks(F.col("first"), F.col("last")))
    for r in held.collect():
        bins = [n * FAN**k + i for k, n in r.blocks for i in range(FAN**k)]
        assert sorted(bins) == list(range(r.first, r.last + 1))
        assert len(r.blocks) <= len(bins) / FAN**LEVELS + 2 * FAN * LEVELS


def test_a_case_makes_far_fewer_rows_than_pairs(spark):
    """Long open cases: what is made per case before the pairs does not grow with the cut dates."""
    start = dt.datetime(2020, 1, 1)
    cases = spark.createDataFrame([(i, start, None, "DEV", "x") for i in range(20)], CASES)
    cuts = spark.createDataFrame([(start + dt.timedelta(days=k),) for k in range(1000)], "CUTPOINT timestamp_ntz")
    found = open_cases(cases, cuts)
    assert found.count() == 20 * 1000
    made = spark.createDataFrame([(0, 999)], "a long, b long").select(F.size(_blocks(F.col("a"), F.col("b")))).first()[0]
    assert made <= 1000 / FAN**LEVELS + 2 * FAN * LEVELS


def test_totals_are_those_of_the_pairs(spark):
    cases = spark.createDataFrame(_made(4, 300) + _made(4, 2), CASES)
    cuts = [(at("2020-01-20"), "DEV", 1), (at("2020-01-20"), "DEV", 1), (at("2020-01-25"), None, 2), (at("2019-01-01"), "RFC", 3)]
    cuts += [(dt.datetime(2020, 1, 1) + dt.timedelta(hours=9 * k), "RFC", 4) for k in range(160)] + [(None, "DEV", 5)]
    cuts = spark.createDataFrame(cuts, "CUTPOINT timestamp_ntz, TICKET string, n int")
    pairs = open_cases(cases, cuts).groupBy(*cuts.columns).agg(F.count(F.lit(1)).alias("COUNT"), F.sum("id").alias("id"))
    found = open_cases(cases, cuts, totals=("id",))
    assert found.columns == pairs.columns
    assert rows(found) == rows(pairs) != []
    assert open_cases(cases.limit(0), cuts, totals=("id",)).count() == 0


def test_totals_join_blocks_not_cases(spark):
    """The query's joins meet a row per block, type and edge; no row is made per case and cut date."""
    start = dt.datetime(2020, 1, 1)
    cases = spark.createDataFrame([(i, start, None, "DEV", "x") for i in range(500)], CASES)
    cuts = spark.createDataFrame([(start + dt.timedelta(days=k),) for k in range(1000)], "CUTPOINT timestamp_ntz")
    found = open_cases(cases, cuts, totals=("id",))
    assert {(r.COUNT, r.id) for r in found.collect()} == {(500, 500 * 499 // 2)}
    assert found.count() == 1000


def test_every_closed_ticket_gives_a_cut_date(spark, tmp_path):
    """The query cuts at the closing moment of each ticket, whatever its id."""
    rnd = random.Random(6)
    types = {"1-URGENT": "DEV", "2-HIGH": "DEV-VIP", "5-LOW": "INC"}
    orders = [
        (oid, 1, rnd.choice("FFO"), 1.0, dt.datetime(1995, 1, 1) + dt.timedelta(days=rnd.randrange(300)), rnd.choice([*types]))
        for oid in range(1000, 1194)  # every rest modulo 97 twice
    ]
    spark.createDataFrame(orders, views.STAR["orders"]).write.parquet(f"{tmp_path}/orders.parquet")
    cases = [(r[0], r[4], r[4] + dt.timedelta(days=r[0] % 97) if r[2] == "F" else None, types[r[5]]) for r in orders]
    cuts = {(case[2], case[3]) for case in cases if case[2] is not None}
    expected = []
    for cut, kind in cuts:
        found = [case[0] for case in cases if case[3] == kind and _open(case, cut)]
        expected.append((cut, kind, len(found), sum(found)))
    result = queries.open_cases_matched(spark, str(tmp_path))
    assert result.columns == ["CUTPOINT", "ticket_type", "COUNT", "OIDS"]
    assert rows(result) == sorted(expected, key=lambda r: [(v is None, str(v)) for v in r])


def test_more_levels_hold_every_bin_once_in_few_blocks(spark):
    levels = 7
    runs = [(0, 999_999), (1, 999_998), (5, 5), (16_383, 16_384), (16_384, 32_767)]
    held = spark.createDataFrame(runs, "first long, last long")
    for r in held.withColumn("blocks", _blocks(F.col("first"), F.col("last"), levels)).collect():
        spans = sorted((n * FAN**k, (n + 1) * FAN**k) for k, n in r.blocks)
        assert spans[0][0] == r.first and spans[-1][1] == r.last + 1
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        assert len(spans) <= (r.last - r.first + 1) / FAN**levels + 2 * FAN * levels


def test_totals_with_far_dates_and_more_levels(spark, monkeypatch):
    """A few far dates among many near ones; cases open and close before, among and after them."""
    monkeypatch.setattr(operator, "TOP", 1)
    far = [at("1900-01-01"), at("1950-06-01T12:00:00"), at("9999-12-31T23:59:59")]
    cuts = [dt.datetime(2020, 1, 1) + dt.timedelta(hours=2 * k) for k in range(700)] + far
    cases = [r for r in _made(7, 300) if r[3] == "DEV"]
    cases += [(1000, far[0], None, "DEV", "x"), (1001, at("1899-01-01"), far[2], "DEV", "x"), (1002, far[2], None, "DEV", "x")]
    cases += [(1003, far[1], at("2020-01-09"), "DEV", "x"), (1004, at("2020-01-09"), far[2], "DEV", "x")]
    found = open_cases(
        spark.createDataFrame(cases, CASES), spark.createDataFrame([(c,) for c in cuts], "CUTPOINT timestamp_ntz"), totals=("id",)
    )
    expected = []
    for cut in cuts:
        ids = [case[0] for case in cases if _open(case, cut)]
        expected += [(cut, len(ids), sum(ids))] if ids else []
    assert rows(found) == sorted(expected, key=lambda r: [(v is None, str(v)) for v in r])
