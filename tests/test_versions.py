import pytest
from conftest import rows
from pathlib import Path

from ticketflow.sources import key_buckets, versions


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_commit_read_and_roll_back(spark, tmp_path):
    table = f"{tmp_path}/t"
    assert versions.current_version(spark, table) is None
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, table)
    first = versions.commit(spark.range(5), table)
    # The new rows may come from the table itself.
    second = versions.commit(versions.read_version(spark, table).filter("id > 2"), table, ("id",))
    assert _ids(versions.read_version(spark, table)) == [3, 4]
    assert _ids(versions.read_version(spark, table, first.name)) == [0, 1, 2, 3, 4]
    assert second.earlier == (first.name,)
    versions.roll_back(spark, table)
    assert _ids(versions.read_version(spark, table)) == [0, 1, 2, 3, 4]
    with pytest.raises(RuntimeError, match="no earlier"):
        versions.roll_back(spark, table)


def test_a_job_that_dies_at_any_step_leaves_a_whole_table(spark, tmp_path, monkeypatch):
    table = f"{tmp_path}/t"
    versions.commit(spark.range(3), table)
    # While the rows are written.
    with pytest.raises(Exception, match="broken"):
        versions.commit(spark.range(3).selectExpr("if(id = 1, raise_error('broken'), id) AS id"), table)
    assert _ids(versions.read_version(spark, table)) == [0, 1, 2]
    # After they are written, before the pointer is replaced.
    versions.write_version(spark.range(9), table)
    assert _ids(versions.read_version(spark, table)) == [0, 1, 2]

    # While the pointer is replaced: the new pointer file is there, the rename never comes.
    def dies(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(versions, "_point", dies)
    with pytest.raises(KeyboardInterrupt):
        versions.commit(spark.range(7), table)
    monkeypatch.undo()
    assert _ids(versions.read_version(spark, table)) == [0, 1, 2]
    assert len(versions.drop_versions(spark, table)) == 3
    assert _ids(versions.read_version(spark, table)) == [0, 1, 2]


def test_a_reader_keeps_its_version_while_others_commit(spark, tmp_path):
    table = f"{tmp_path}/t"
    versions.commit(spark.range(3), table)
    reader = versions.read_version(spark, table)
    versions.commit(spark.range(10, 12), table)
    assert _ids(reader) == [0, 1, 2]
    assert _ids(versions.read_version(spark, table)) == [10, 11]


def test_the_second_of_two_writers_is_refused(spark, tmp_path):
    table = f"{tmp_path}/t"
    seen = versions.commit(spark.range(1), table).name
    mine = versions.write_version(spark.range(2), table)
    versions.commit(spark.range(3), table)
    with pytest.raises(RuntimeError, match="another writer"):
        versions.publish_version(spark, table, mine, seen)
    assert versions.read_version(spark, table).count() == 3


def test_old_versions_are_dropped(spark, tmp_path):
    table = f"{tmp_path}/t"
    names = [versions.commit(spark.range(n), table).name for n in range(1, 5)]
    assert sorted(versions.drop_versions(spark, table, keep=1)) == sorted(names[:2])
    assert versions.current_version(spark, table) == versions.Version(names[3], (names[2],))


def test_only_buckets_of_changed_keys_are_rewritten(spark, tmp_path):
    path = f"{tmp_path}/t"
    table = spark.range(200).selectExpr("id % 50 AS oid", "id", "'old' AS label")
    key_buckets.write_buckets(table, path, "oid", 8)
    before = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    changed = spark.createDataFrame([(7,), (7,), (None,)], "oid bigint").filter("oid IS NOT NULL")
    hit = key_buckets.rewrite_buckets(
        spark, path, changed, "oid", lambda df: df.selectExpr("oid", "id", "if(oid = 7, 'new', label) AS label"), 8
    )
    assert len(hit) == 1
    kept = {p for p, t in before.items() if p.exists() and p.stat().st_mtime_ns == t}
    assert {p.parent.name for p in before if p not in kept} == {f"key_bucket={hit[0]}"}
    expected = table.selectExpr("oid", "id", "if(oid = 7, 'new', label) AS label")
    assert rows(key_buckets.read_buckets(spark, path)) == rows(expected)
    assert key_buckets.rewrite_buckets(spark, path, changed.limit(0), "oid", lambda df: df, 8) == []


def test_a_failed_change_leaves_the_buckets(spark, tmp_path):
    path = f"{tmp_path}/t"
    table = spark.range(20).selectExpr("id AS oid", "id")
    key_buckets.write_buckets(table, path, "oid", 4, files_per_bucket=3)
    with pytest.raises(Exception, match="broken"):
        key_buckets.rewrite_buckets(
            spark, path, table.limit(3), "oid", lambda df: df.selectExpr("oid", "CAST(raise_error('broken') AS bigint) AS id"), 4
        )
    assert rows(key_buckets.read_buckets(spark, path)) == rows(table)
