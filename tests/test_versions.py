from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pointmill.operators import versions as ver
from pointmill.workspace import scratch_path
from tests.helpers import rows


def table(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id string, v double")


def commits(spark, *times):
    data = [(i + 1, op, at) for i, (op, at) in enumerate(times)]
    return spark.createDataFrame(data, "version int, operation string, committed_at string").withColumn(
        "committed_at", F.col("committed_at").cast("timestamp_ntz")
    )


@pytest.fixture
def five(spark):
    """Create, append, delete, update, append."""
    t = ver.create_version(table(spark, ("a", 1.0), ("b", 6.0), ("c", None), ("d", 9.0)))
    t = ver.append_version(t, table(spark, ("b", 6.6)), 2)
    t = ver.delete_where(t, F.col("v") < 5, 3)
    t = ver.update_where(t, F.col("v") > 8, {"v": F.col("v") * 2}, 4)
    return ver.append_version(t, spark.sql("SELECT 'new' AS id, 1.5 AS v"), 5)


EXPECTED = {
    1: [("a", 1.0), ("b", 6.0), ("c", None), ("d", 9.0)],
    2: [("a", 1.0), ("b", 6.0), ("b", 6.6), ("c", None), ("d", 9.0)],
    3: [("b", 6.0), ("b", 6.6), ("c", None), ("d", 9.0)],
    4: [("b", 6.0), ("b", 6.6), ("c", None), ("d", 18.0)],
    5: [("b", 6.0), ("b", 6.6), ("c", None), ("d", 18.0), ("new", 1.5)],
}


def test_every_version_stays_readable(spark, five):
    for version, expected in EXPECTED.items():
        assert rows(ver.as_of_version(five, version)) == sorted(expected, key=str), version
    assert rows(ver.current(five)) == rows(ver.as_of_version(five, 5))


def test_null_condition_keeps_the_row(spark, five):
    assert rows(ver.current(five).where("id = 'c'")) == [("c", None)]


def test_log_adds_up(spark, five):
    times = [(op, f"2024-01-01 0{i}:00:00") for i, op in enumerate(["create", "append", "delete", "update", "append"])]
    log = ver.version_log(five, commits(spark, *times)).collect()
    assert [(r.version, r.parent, r.added, r.deleted, r.total) for r in log] == [
        (1, None, 4, 0, 4), (2, 1, 1, 0, 5), (3, 2, 0, 1, 4), (4, 3, 1, 1, 4), (5, 4, 1, 0, 5),
    ]
    bounds = ver.version_bounds(ver.version_log(five, commits(spark, *times)))
    assert rows(bounds, "bound", "version") == [("first", 1), ("latest", 5)]
    assert [r.version for r in ver.history(commits(spark, *times)).collect()] == [1, 2, 3, 4, 5]
    assert rows(ver.compare_versions(five, 1, 3)) == [(4, 4, 5)]


def test_as_of_time(spark, five):
    log = commits(spark, *[("x", f"2024-01-01 0{i}:00:00") for i in range(5)])
    assert rows(ver.as_of_timestamp(five, log, "2024-01-01 01:59:59")) == rows(ver.as_of_version(five, 2))
    assert ver.version_at(log, "2024-01-01 02:00:00") == 3
    assert ver.version_at(log, F.current_timestamp() - F.expr("INTERVAL 5 MINUTES")) == 5
    with pytest.raises(ValueError, match="no version"):
        ver.as_of_timestamp(five, log, "2023-12-31 23:00:00")


def test_replace_keeps_history(spark, five):
    t = ver.replace_version(five, table(spark, ("z", 0.0)), 6)
    assert rows(ver.current(t)) == [("z", 0.0)]
    assert rows(ver.as_of_version(t, 5)) == rows(ver.as_of_version(five, 5))


def test_saved_versions_prune_partitions(spark, five):
    path = scratch_path(spark, "versions")
    ver.save_versions(five, path)
    saved = ver.load_versions(spark, path)
    for version in EXPECTED:
        assert rows(ver.as_of_version(saved, version)) == rows(ver.as_of_version(five, version))
    plan = ver.as_of_version(saved, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(cast(valid_from" in plan or "PartitionFilters: [isnotnull(valid_from" in plan
    with pytest.raises(Exception, match="(?i)already.exists"):
        ver.save_versions(five, path)


def test_append_to_a_saved_table(spark, five):
    path = scratch_path(spark, "versions")
    ver.save_versions(five, path)
    ver.append_saved(table(spark, ("y", 3.0)), path, 6)
    saved = ver.load_versions(spark, path)
    assert rows(ver.as_of_version(saved, 5)) == rows(ver.current(five))
    assert rows(ver.current(saved).where("id = 'y'")) == [("y", 3.0)]


def test_append_to_a_saved_table_casts_and_checks(spark, five):
    path = scratch_path(spark, "versions")
    ver.save_versions(five, path)
    ver.append_saved(spark.sql("SELECT 100.0 AS v, 'y' AS id"), path, 6)
    assert rows(ver.current(ver.load_versions(spark, path)).where("id = 'y'"), "id", "v") == [("y", 100.0)]
    for wrong in ("SELECT 'z' AS id", "SELECT 'z' AS id, 1.0 AS v, 2 AS w", "SELECT 'z' AS id, 1.0 AS value"):
        with pytest.raises(ValueError, match="not those of the saved table"):
            ver.append_saved(spark.sql(wrong), path, 7)


def test_wrong_updates_and_versions_are_errors(spark, five):
    for sets in ({"nope": F.lit(1)}, {"valid_from": F.lit(1)}):
        with pytest.raises(ValueError, match="cannot|not columns"):
            ver.update_where(five, F.lit(True), sets, 9)
    path = scratch_path(spark, "commits")
    for version in (1, 3):
        ver.record_commit(spark, path, version, "create", datetime(2024, 1, version))
    known = ver.read_commits(spark, path)
    assert ver.as_of_version(five, 3, known).count() == ver.as_of_version(five, 3).count()
    for version in (0, 2, 99):
        with pytest.raises(ValueError, match="no version"):
            ver.as_of_version(five, version, known)


def test_log_keeps_versions_without_a_commit(spark):
    t = ver.create_version(table(spark, ("a", 1.0), ("b", 1.0)))
    t = ver.append_version(t, table(spark, ("c", 1.0)), 2)
    t = ver.append_version(t, table(spark, ("d", 1.0)), 3)
    path = scratch_path(spark, "commits")
    for version in (1, 3):
        ver.record_commit(spark, path, version, "append", datetime(2024, 1, version))
    log = {r.version: (r.operation, r.total) for r in ver.version_log(t, ver.read_commits(spark, path)).collect()}
    assert log == {1: ("append", 2), 2: (None, 3), 3: ("append", 4)}


def test_saved_table_without_closed_rows(spark):
    path = scratch_path(spark, "versions")
    ver.save_versions(ver.create_version(table(spark, ("a", 1.0))), path)
    saved = ver.load_versions(spark, path)
    assert [saved.schema[c].dataType.simpleString() for c in ver.INTERVAL] == ["int", "int"]
    changed = ver.delete_where(saved, F.col("v") > 0, 2)
    assert rows(ver.current(changed)) == [] and rows(ver.as_of_version(changed, 1)) == [("a", 1.0)]


def test_update_reads_the_table_once(spark):
    t = ver.create_version(spark.range(10).selectExpr("CAST(id AS STRING) AS id", "CAST(id AS DOUBLE) AS v"))
    for version in range(2, 7):
        t = ver.update_where(t, F.col("v") > 3, {"v": F.col("v") + 1}, version)
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "Exchange" not in plan
    assert ver.as_of_version(t, 6).count() == 10
    assert ver.as_of_version(t, 6).agg(F.sum("v")).first()[0] == 45 + 6 * 5


def test_saved_table_knows_its_versions(spark):
    path = scratch_path(spark, "versions")
    t = ver.append_version(ver.create_version(table(spark, ("a", 1.0))), table(spark, ("b", 1.0)), 2)
    commits = scratch_path(spark, "commits")
    ver.record_commits(spark, commits, [(1, "create", datetime(2024, 1, 1)), (2, "append", datetime(2024, 1, 2))])
    ver.save_versions(t, path, ver.read_commits(spark, commits))
    ver.append_saved(table(spark, ("c", 1.0)), path, 3, datetime(2024, 1, 3))
    assert rows(ver.as_of_saved(spark, path, 2)) == [("a", 1.0), ("b", 1.0)]
    assert rows(ver.as_of_saved(spark, path, 3)) == [("a", 1.0), ("b", 1.0), ("c", 1.0)]
    assert rows(ver.as_of_saved_timestamp(spark, path, "2024-01-01 12:00:00")) == [("a", 1.0)]
    for unknown in (0, 4):
        with pytest.raises(ValueError, match=f"no version {unknown}"):
            ver.as_of_saved(spark, path, unknown)
    assert ver.load_versions(spark, path).count() == 3
