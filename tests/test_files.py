import json
import os

import pytest
from pyspark.sql import functions as F

from pointmill.operators.points import voxel_keys
from pointmill.sources import files
from pointmill.workspace import scratch_path
from tests.helpers import DEFAULTS, points, rows


def test_json_round_trip_keeps_types_and_nulls(spark):
    df = points(spark, {"x": 0.1, "label": 2}, {"red": None, "label": None})
    path = scratch_path(spark, "json")
    df.write.json(path)
    back = files.read_points_json(spark, path)
    assert back.schema == df.schema
    assert rows(back) == rows(df)


def test_corrupt_lines_and_hidden_files(spark, tmp_path):
    (tmp_path / "part-0.json").write_text('{"x":1,"label":"bad"}\nnot json\n{"x":2,"label":1}\n')
    (tmp_path / ".part-0.inprogress.x").write_text('{"x":3,"label":1}\n')
    df = files.read_points_json(spark, str(tmp_path), keep_corrupt=True)
    got = {(r.x, r.label, r["_corrupt"] is None) for r in df.collect()}
    assert got == {(1.0, None, False), (None, None, False), (2.0, 1, True)}


def test_glob_picks_by_suffix(spark):
    path = scratch_path(spark, "mixed")
    points(spark, {}).write.parquet(path)
    points(spark, {}, {}).write.mode("append").json(path)
    assert files.read_parquet_glob(spark, path).count() == 1


def test_sql_over_files(spark):
    path = scratch_path(spark, "parquet")
    files.write_parquet(points(spark, {"label": 1}, {"label": 2}), path)
    assert rows(files.query_files(spark, "count(*) AS n", path, rest="WHERE label > 1")) == [(1,)]


def test_overwrite(spark):
    path = scratch_path(spark, "parquet")
    files.write_parquet(points(spark, {}, {}), path)
    files.write_parquet(points(spark, {}), path)
    assert spark.read.parquet(path).count() == 1


def test_inventory(spark):
    path = scratch_path(spark, "parquet")
    spark.range(0, 100, 1, 4).write.parquet(path)
    listed = files.file_inventory(spark.read.parquet(path)).collect()
    assert len(listed) == 4 and sum(r.row_count for r in listed) == 100
    names = {os.path.basename(r.file_path): r.file_size for r in listed}
    local = path.removeprefix("file:")
    assert names == {n: os.path.getsize(f"{local}/{n}") for n in os.listdir(local) if n.endswith(".parquet")}


def test_listing_skips_hidden_files(spark, tmp_path):
    for name in ("a.parquet", "b.json", ".c.parquet", "_d.parquet"):
        (tmp_path / name).write_bytes(b"12345")
    listed = files.list_files(spark, str(tmp_path))
    assert {os.path.basename(r.file_path): r.file_size for r in listed.collect()} == {"a.parquet": 5, "b.json": 5}
    assert files.list_files(spark, str(tmp_path), "*.parquet").count() == 1


def test_compaction_merges_and_rolls(spark):
    small, big = scratch_path(spark, "many"), scratch_path(spark, "compact")
    spark.range(0, 1000, 1, 50).write.parquet(small)
    files.write_compacted(spark.read.parquet(small), big, max_records=400)
    listed = files.file_inventory(spark.read.parquet(big)).collect()
    assert sum(r.row_count for r in listed) == 1000
    assert len(listed) < 50 and max(r.row_count for r in listed) <= 400


def many_files(spark, sizes):
    """A folder of Parquet files with these numbers of rows."""
    path, at = scratch_path(spark, "many"), 0
    for n in sizes:
        spark.range(at, at + n, 1, 1).write.mode("append").parquet(path)
        at += n
    return path, at


def inventory(spark, path):
    return {r.file_path: r.row_count for r in files.file_inventory(spark.read.parquet(path)).collect()}


def test_only_small_files_are_compacted(spark):
    path, n = many_files(spark, [50_000, 10, 20, 60_000, 30, 40])
    before = inventory(spark, path)
    files.compact_files(spark, path, target_bytes=40_000)
    after = inventory(spark, path)
    large = {p for p, rows_in in before.items() if rows_in >= 50_000}
    assert large < after.keys() and sorted(after.values()) == [100, 50_000, 60_000]
    assert rows(spark.read.parquet(path)) == [(k,) for k in range(n)]
    files.compact_files(spark, path, target_bytes=40_000)
    assert inventory(spark, path) == after


def test_compaction_fills_groups_and_rolls(spark):
    path, n = many_files(spark, [100] * 30)
    size = max(os.path.getsize(f"{path.removeprefix('file:')}/{f}") for f in os.listdir(path.removeprefix("file:")) if f.endswith(".parquet"))
    files.compact_files(spark, path, target_bytes=size * 10)
    assert 3 <= len(inventory(spark, path)) <= 4
    other, n = many_files(spark, [100] * 30)
    files.compact_files(spark, other, target_bytes=size * 100, max_records=800)
    assert sorted(inventory(spark, other).values()) == [600, 800, 800, 800]
    assert rows(spark.read.parquet(other)) == [(k,) for k in range(n)]


def test_an_interrupted_compaction_is_finished(spark, monkeypatch):
    for step in ("before", "within"):
        path, n = many_files(spark, [10] * 5)
        finish = files._finish_compaction
        calls = []

        def stop(spark, path):
            calls.append(1)
            if len(calls) == 1:
                return finish(spark, path)
            if step == "within":
                # One old file is gone already when the run ends.
                gone = os.path.join(path.removeprefix("file:"), sorted(f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".parquet"))[0])
                os.remove(gone)
            raise RuntimeError("interrupted")

        monkeypatch.setattr(files, "_finish_compaction", stop)
        with pytest.raises(RuntimeError):
            files.compact_files(spark, path, target_bytes=1 << 20)
        monkeypatch.setattr(files, "_finish_compaction", finish)
        files.compact_files(spark, path, target_bytes=1 << 20)
        assert rows(spark.read.parquet(path)) == [(k,) for k in range(n)] and len(inventory(spark, path)) == 1
        assert not os.path.exists(f"{path.removeprefix('file:')}/_compaction")


def test_tree_inventory_shows_what_is_skipped(spark, tmp_path):
    root = tmp_path / "tree"
    spark.range(0, 100, 1, 3).write.parquet(f"{root}/a")
    points(spark, {}, {}).write.parquet(f"{root}/b c")
    spark.range(5).coalesce(1).write.parquet(f"{root}/a/part=1")
    spark.range(0).coalesce(1).write.parquet(f"{root}/empty")
    (root / "a" / ".part-0.inprogress").write_bytes(b"12345")
    listed = files.tree_inventory(spark, str(root)).collect()
    visible = [r for r in listed if not r.skipped]
    assert {d: sum(r.row_count for r in visible if r.dataset == d) for d in ("a", "b c", "empty")} == {"a": 105, "b c": 2, "empty": 0}
    assert sum(r.dataset == "a" for r in visible) == 4
    for r in visible:
        assert r.file_size == os.path.getsize(r.file_path.removeprefix("file:"))
    hidden = {(r.dataset, os.path.basename(r.file_path)): (r.file_size, r.row_count) for r in listed if r.skipped}
    assert hidden["a", ".part-0.inprogress"] == (5, None) and hidden["a", "_SUCCESS"] == (0, None)


def test_intake_counts_in_one_pass(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    lines = [json.dumps({**DEFAULTS, "x": float(k), "label": k % 3}) for k in range(30)] + ['{"x":1,"label":"bad"}', "not json"]
    (source / "a.json").write_text("\n".join(lines))
    (source / "b.json").write_text("\n".join(lines))
    assert files.clean_intake(spark, str(source), target) == {"records": 64, "corrupt": 4, "kept": 40}
    assert spark.read.parquet(target).count() == 40
    (source / "b.json").unlink()
    assert files.clean_intake(spark, str(source), target)["kept"] == 20 and spark.read.parquet(target).count() == 20


@pytest.mark.parametrize("content", [None, ""])
def test_intake_stops_on_nothing(spark, tmp_path, content):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    points(spark, {}).write.parquet(target)
    if content is not None:
        (source / "a.json").write_text(content)
    with pytest.raises(ValueError, match="no records"):
        files.clean_intake(spark, str(source), target)
    assert spark.read.parquet(target).count() == 1 and sorted(os.listdir(tmp_path)) == ["in", "out"]


def test_partitioned_table_prunes_and_replaces(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "voxel_x int, majority_label int")
    path = scratch_path(spark, "voxels")
    files.save_voxels(df, "voxels_a", path)
    picked = spark.table("voxels_a").where("majority_label = 1")
    assert picked.count() == 10
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(majority_label" in plan
    files.save_voxels(df.where("voxel_x < 5"), "voxels_a", path)
    assert spark.table("voxels_a").count() == 5
    spark.sql("DROP TABLE voxels_a")


def test_append(spark):
    df = spark.range(3).select(F.col("id").cast("int").alias("a"))
    files.save_voxels(df, "voxels_b", partition=None)
    files.append_rows(df, "voxels_b")
    assert spark.table("voxels_b").count() == 6
    spark.sql("DROP TABLE voxels_b")


def test_append_to_a_partitioned_table(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "voxel_x int, majority_label int")
    path = scratch_path(spark, "voxels")
    files.save_voxels(df, "voxels_c", path)
    files.append_rows(df.select("majority_label", "voxel_x").repartition(8), "voxels_c")
    assert spark.table("voxels_c").groupBy("majority_label").count().where("count <> 20").isEmpty()
    assert spark.table("voxels_c").where("majority_label <> voxel_x % 3").isEmpty()
    assert files.file_inventory(spark.read.parquet(path)).count() <= 6
    with pytest.raises(ValueError, match="columns are not those"):
        files.append_rows(df.withColumnRenamed("voxel_x", "x"), "voxels_c")
    spark.sql("DROP TABLE voxels_c")


def test_scratch_paths_are_new_and_shared(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(f"file:{root}")


def test_keys_survive_parquet(spark):
    path = scratch_path(spark, "parquet")
    keyed = voxel_keys(points(spark, {"x": float("nan")}, {"x": -0.5}))
    files.write_parquet(keyed, path)
    assert rows(spark.read.parquet(path), "voxel_x") == [(-1,), (None,)]
