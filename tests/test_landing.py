"""Files that queries land for themselves: none needs a task that reads the whole table, and JSON is coded."""

import collections
import os

import pytest

from pointmill.plans import queries

LINEITEM = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
)


def write_files(spark, path, schema, *files):
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def folder(tmp_path, monkeypatch):
    """Where the queries write, a folder for each name they give."""
    numbers = collections.Counter()

    def scratch(spark, name):
        numbers[name] += 1
        return f"file:{tmp_path}/{name}-{numbers[name]}"

    monkeypatch.setattr(queries, "scratch_path", scratch)
    return tmp_path


def data_files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if ".json" in f and not f.endswith(".crc")]


def lines(*keys):
    return [(k, 1, 1, 1 + k % 3, 1.0, 1.0, 0.0, 0.0) for k in keys]


def test_bounded_intake_lands_in_parts(spark, tmp_path, folder, monkeypatch):
    # The second and third file lack some remainders, the fifth remainder is in none.
    each = [[0, 1, 2, 3, 5, 7, 8, 13], [6, 12, 18, 24, 26], [9, 15, 21, 27, 31]]
    write_files(spark, f"{tmp_path}/sf/lineitem.parquet", LINEITEM, *[lines(*keys) for keys in each])
    monkeypatch.setattr(queries, "LANDING_ROWS", 5, raising=False)
    found = {r.batch: (r.row_count, r.labels) for r in queries.stream_bounded(spark, f"{tmp_path}/sf").collect()}
    kept = [k for keys in each for k in keys if k % 3]
    wanted = {b: (sum(k % 6 // 2 == b for k in kept), sum(k % 3 for k in kept if k % 6 // 2 == b)) for b in {k % 6 // 2 for k in kept}}
    assert found == wanted
    assert len(data_files(folder / "landing-1")) == 6 * 3


def test_inventory_writes_files_of_whole_scan_parts(spark, tmp_path, folder):
    # Sixteen files of lineitem for four, and one of each other table for more, which a shuffle has to deal out.
    write_files(spark, f"{tmp_path}/sf/lineitem.parquet", "k long, part int", *[[(10 * f + i, f) for i in range(10)] for f in range(16)])
    for name in ("orders", "events"):
        write_files(spark, f"{tmp_path}/sf/{name}.parquet", "k long", [(i,) for i in range(50)])
    found = {r.dataset: (r.files, r.row_count, r.skipped_files, r.all_sized) for r in queries.file_inventory(spark, f"{tmp_path}/sf").collect()}
    assert found == {"lineitem": (4, 160, 1, True), "orders": (2, 50, 1, True), "events": (3, 50, 1, True)}
    written = spark.read.parquet(f"{folder}/tree-1/lineitem").selectExpr("part", "_metadata.file_name AS name").distinct().collect()
    assert len(written) == 16


def test_landed_and_cleaned_json_is_coded(spark, tmp_path, folder):
    write_files(spark, f"{tmp_path}/sf/lineitem.parquet", LINEITEM, lines(*range(40)), lines(*range(40, 60)))
    for query, targets in ((queries.stream_restart, ["cleaned-1", "cleaned-2"]), (queries.stream_clean, ["cleaned-3"])):
        assert query(spark, f"{tmp_path}/sf").count() == 40 * len(targets)
        for name in (f"landing-{1 + (targets != ['cleaned-1', 'cleaned-2'])}", *targets):
            found = data_files(folder / name)
            assert found and all(f.endswith(".json.lz4") for f in found if os.path.getsize(f) and "_spark_metadata" not in f)
