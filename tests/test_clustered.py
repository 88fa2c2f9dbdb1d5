import random
import uuid

import pytest
from conftest import DATA, plan, rows
from pyspark.sql import functions as F

from ticketflow.operators import phases
from ticketflow.operators.hot_keys import hot_keys
from ticketflow.plans import queries, views
from ticketflow.sources.clustered import (
    SLICE,
    drop_clustered,
    join_clustered,
    read_clustered,
    write_clustered,
)


@pytest.fixture
def large(spark):
    rnd = random.Random(5)
    weighted = [1] * 200 + [2] * 60 + [rnd.randrange(3, 60) for _ in range(330)] + [None] * 10
    return spark.createDataFrame([(k, i, float(i)) for i, k in enumerate(weighted)], "k bigint, i int, x double")


@pytest.fixture
def single(spark):
    return spark.createDataFrame([(k, k * 10) for k in range(1, 50)], "id int, y bigint")


@pytest.fixture
def name(spark):
    made = f"clustered_{uuid.uuid4().hex}"
    yield made
    if spark.catalog.tableExists(made):
        drop_clustered(spark, made)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(made)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [7, 10_000])
def test_join_equals_the_plain_join(spark, conf, large, single, name, how, hot_rows):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    write_clustered(large, name, "k", ["i"], buckets=8, hot=hot_keys(large, "k", hot_rows))
    assert rows(read_clustered(spark, name)) == rows(large)
    joined = join_clustered(spark, name, single, "k", "id", how)
    plain = large.join(single, F.col("k") == F.col("id"), how)
    assert joined.columns == plain.columns
    assert rows(joined) == rows(plain)


def test_further_condition(spark, large, single, name):
    write_clustered(large, name, "k", ["i"], buckets=8, hot=hot_keys(large, "k", 7))
    where = F.col("i") * 10 < F.col("y")
    joined = join_clustered(spark, name, single, "k", "id", "left_semi", where)
    assert rows(joined) == rows(large.join(single, (F.col("k") == F.col("id")) & where, "left_semi"))


def test_hot_key_lies_in_several_buckets(spark, large, name):
    write_clustered(large, name, "k", ["i"], buckets=16, hot=hot_keys(large, "k", 10))
    parts = spark.table(name).groupBy("k").agg(F.countDistinct(SLICE).alias("n"), F.count(F.lit(1)).alias("rows"))
    found = {r["k"]: (r["n"], r["rows"]) for r in parts.collect()}
    assert found[1][0] > 10 and found[1][1] == 200
    assert found[None] == (1, 10)
    files = spark.table(name).filter("k = 1").select(F.input_file_name()).distinct().count()
    assert files > 5


def test_only_the_other_side_is_shuffled(spark, conf, large, single, name):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    write_clustered(large, name, "k", ["i"], buckets=8, hot=hot_keys(large, "k", 7))
    text = plan(join_clustered(spark, name, single, "k", "id", "left"))
    assert "Bucketed: true" in text
    assert "hashpartitioning(k#" not in text and "hashpartitioning(cast(id" in text


def test_refresh_reads_itself_and_takes_its_slices_along(spark, large, single, name):
    write_clustered(large, name, "k", ["i"], buckets=8, hot=hot_keys(large, "k", 7))
    write_clustered(read_clustered(spark, name).filter("k <= 2"), name, "k", ["i"], buckets=4, hot=hot_keys(large, "k", 30))
    joined = join_clustered(spark, name, single, "k", "id")
    assert rows(joined) == rows(large.filter("k <= 2").join(single, F.col("k") == F.col("id")))


def test_failed_write_leaves_the_old_table(spark, large, name):
    write_clustered(large, name, "k", ["i"], buckets=8)
    broken = large.withColumn("x", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception, match="no"):
        write_clustered(broken, name, "k", ["i"], buckets=8, hot=hot_keys(large, "k"))
    assert rows(read_clustered(spark, name)) == rows(large)


def test_empty_table_and_a_table_of_another_kind(spark, large, single, name):
    write_clustered(large.limit(0), name, "k", ["i"], buckets=4)
    assert join_clustered(spark, name, single, "k", "id", "left").count() == 0
    drop_clustered(spark, name)
    large.write.saveAsTable(name)
    with pytest.raises(ValueError, match="clustered"):
        join_clustered(spark, name, single, "k", "id")


def test_labels_without_a_shuffle_of_the_bookings(spark, conf, name):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    booked, milestones = queries.worktime_by_ticket(spark, DATA), views.dev_milestones(spark, DATA)
    write_clustered(booked, name, "oid", ["targetday"], buckets=8, hot=hot_keys(booked, "oid", 5))
    labelled = phases.label_phase_clustered(spark, name, milestones)
    assert "hashpartitioning(oid#" not in plan(labelled).split("milestone_oid")[0]
    assert rows(labelled) == rows(phases.label_phase(booked, milestones))
    assert rows(phases.released_clustered(spark, name, milestones)) == rows(phases.released(booked, milestones))
