import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from ticketflow.operators.hot_keys import hot_keys, hot_keys_by_summary, join_spreading_hot_keys


@pytest.fixture
def tables(spark):
    rnd = random.Random(3)
    # Key 1 holds a third of the rows, key 2 a tenth; some keys are missing or have no partner.
    weighted = [1] * 200 + [2] * 60 + [rnd.randrange(3, 60) for _ in range(330)] + [None] * 10
    large = spark.createDataFrame([(k, i, float(i)) for i, k in enumerate(weighted)], "k bigint, i int, x double")
    single = spark.createDataFrame([(k, k * 10) for k in range(1, 50)], "id bigint, y bigint")
    return large, single


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [1, 7, 50, 10_000])
def test_equals_the_plain_join(conf, tables, how, hot_rows):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    large, single = tables
    spread = join_spreading_hot_keys(large, single, "k", "id", ["i"], hot_keys(large, "k", hot_rows), how)
    plain = large.join(single, F.col("k") == F.col("id"), how)
    assert spread.columns == plain.columns
    assert rows(spread) == rows(plain)


def test_further_condition(tables):
    large, single = tables
    where = F.col("i") * 10 < F.col("y")
    spread = join_spreading_hot_keys(large, single, "k", "id", ["i"], hot_keys(large, "k", 7), "left_semi", where)
    assert rows(spread) == rows(large.join(single, (F.col("k") == F.col("id")) & where, "left_semi"))


def test_hot_key_is_split_over_tasks(conf, tables):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")
    large, single = tables

    def hottest(hot_rows):
        joined = join_spreading_hot_keys(large, single, "k", "id", ["i"], hot_keys(large, "k", hot_rows))
        placed = joined.filter("k = 1").groupBy(F.spark_partition_id()).count()
        return max(r["count"] for r in placed.collect())

    assert hottest(10_000) == 200
    assert hottest(10) < 80


def test_hot_keys(tables):
    assert rows(hot_keys(tables[0], "k", 50)) == [(1, 4), (2, 2)]
    assert rows(hot_keys(tables[0], "k", 200)) == []


@pytest.mark.parametrize("slots", [1, 3, 1 << 20])
@pytest.mark.parametrize("hot_rows", [1, 7, 50, 200, 10_000])
def test_summary_finds_the_same_keys(tables, slots, hot_rows):
    found = hot_keys_by_summary(tables[0], "k", hot_rows, slots)
    assert rows(found) == rows(hot_keys(tables[0], "k", hot_rows))


def test_summary_counts_no_key_when_no_slot_is_full(conf, spark, tables):
    found = hot_keys_by_summary(tables[0], "k", 200)
    found.collect()
    # The second pass was taken out of the plan at run time.
    assert "ResultQueryStage 2\n   +- EmptyRelation" in plan(found).split("== Initial Plan ==")[0]


def test_summary_shuffles_slots_not_keys(spark):
    # 50,000 keys in 16 slots: what is shuffled first is at most 16 rows a task.
    large = spark.range(50_000, numPartitions=4).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert rows(hot_keys_by_summary(large, "k", 10_000, 16)) == [(-1, 2)]


def test_hot_keys_read_only_the_key_and_are_counted_once(conf, tables, tmp_path):
    conf("spark.sql.adaptive.enabled", "false")
    tables[0].write.parquet(f"{tmp_path}/large")
    large = tables[0].sparkSession.read.parquet(f"{tmp_path}/large")
    text = plan(join_spreading_hot_keys(large, tables[1], "k", "id", ["i"], hot_keys(large, "k")))
    assert "ReadSchema: struct<k:bigint>" in text
    assert text.count("partial_count(1)") == 1 and "ReusedExchange" in text


def test_columns_named_like_parts_survive(spark):
    large = spark.createDataFrame([(1, 1, 2.0), (1, 2, 3.0)], "k bigint, i int, rows double")
    single = spark.createDataFrame([(1, "a", "b")], "id bigint, part string, copy string")
    joined = join_spreading_hot_keys(large, single, "k", "id", ["i"], hot_keys(large, "k", 1))
    assert rows(joined) == [(1, 1, 2.0, 1, "a", "b"), (1, 2, 3.0, 1, "a", "b")]
