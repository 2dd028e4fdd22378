import json

import pytest

from pointmill.operators.points import clean
from pointmill.sources.files import file_inventory, read_points_json
from pointmill.streaming import clean as streams
from tests.helpers import DEFAULTS, points, rows


def land(folder, name, *partial):
    folder.mkdir(exist_ok=True)
    lines = [p if isinstance(p, str) else json.dumps({**DEFAULTS, **p}) for p in partial]
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.fixture
def paths(tmp_path):
    return tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")


def run(spark, paths, **options):
    query = streams.stream_clean(spark, str(paths[0]), paths[1], paths[2], **options)
    query.awaitTermination()
    return query


def test_restart_neither_loses_nor_repeats(spark, paths):
    land(paths[0], "a.json", {"x": 1.0}, {"x": 2.0, "label": 0}, {"x": 3.0, "label": None})
    run(spark, paths)
    assert rows(read_points_json(spark, paths[1]), "x") == [(1.0,)]
    land(paths[0], "b.json", {"x": 4.0}, {"x": 5.0, "label": 0})
    run(spark, paths)
    run(spark, paths)
    assert rows(read_points_json(spark, paths[1]), "x") == [(1.0,), (4.0,)]


def test_new_checkpoint_replays_from_the_start(spark, paths, tmp_path):
    land(paths[0], "a.json", {"x": 1.0})
    run(spark, paths)
    run(spark, (paths[0], str(tmp_path / "out2"), str(tmp_path / "checkpoint2")))
    assert read_points_json(spark, str(tmp_path / "out2")).count() == 1


def test_equals_batch_in_small_batches(spark, paths):
    for n in range(5):
        land(paths[0], f"{n}.json", *[{"x": float(10 * n + i), "label": i % 3} for i in range(10)])
    query = run(spark, paths, per_trigger=2)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    batch = clean(read_points_json(spark, str(paths[0])))
    assert rows(read_points_json(spark, paths[1])) == rows(batch)


def test_bounded_batches_and_their_repetition(spark, paths, tmp_path):
    for n in range(7):
        land(paths[0], f"{n}.json", *[{"x": float(10 * n + i), "label": i % 3} for i in range(10)])
    streams.bounded_intake(spark, str(paths[0]), paths[1], paths[2], per_trigger=3).awaitTermination()
    taken = {r.batch: r["count"] for r in streams.read_batches(spark, paths[1]).groupBy("batch").count().collect()}
    assert sorted(taken.values(), reverse=True) == [18, 18, 6]
    # The last batch ends before it is committed: it runs again under its number.
    for commit in (tmp_path / "checkpoint" / "commits").glob("*2*"):
        commit.unlink()
    streams.bounded_intake(spark, str(paths[0]), paths[1], paths[2], per_trigger=3).awaitTermination()
    assert rows(streams.read_batches(spark, paths[1]).drop("batch")) == rows(clean(read_points_json(spark, str(paths[0]))))


def test_corrupt_records_are_counted(spark, paths):
    land(paths[0], "a.json", {"x": 1.0}, '{"x":1,"label":"bad"}', "not json")
    progress = run(spark, paths).recentProgress
    intake = [p["observedMetrics"]["intake"] for p in progress if p["numInputRows"]]
    assert [(m["records"], m["corrupt"]) for m in intake] == [(3, 2)]
    assert read_points_json(spark, paths[1]).count() == 1


def test_uncommitted_files_are_not_read(spark, paths):
    land(paths[0], "a.json", {"x": 1.0})
    run(spark, paths)
    with open(f"{paths[1]}/part-99999-left-by-a-failed-batch.json", "w") as stray:
        stray.write(json.dumps({**DEFAULTS, "x": 9.0}))
    assert rows(read_points_json(spark, paths[1]), "x") == [(1.0,)]


def test_files_are_rolled(spark, paths):
    land(paths[0], "a.json", *[{"x": float(i)} for i in range(25)])
    run(spark, paths, max_records=10)
    listed = file_inventory(read_points_json(spark, paths[1])).collect()
    assert sorted(r.row_count for r in listed) == [5, 10, 10]


def test_interval_trigger(spark, paths):
    land(paths[0], "a.json", {"x": 1.0})
    query = streams.stream_clean(spark, str(paths[0]), paths[1], paths[2], every="1 second", fmt="parquet")
    try:
        query.processAllAvailable()
        land(paths[0], "b.json", {"x": 2.0})
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(spark.read.parquet(paths[1]), "x") == [(1.0,), (2.0,)]


def test_debug_sink(spark, paths):
    land(paths[0], "a.json", {"x": 1.0}, {"x": 2.0, "label": 0})
    query = streams.debug_stream(streams.read_points_stream(spark, str(paths[0])), table="seen")
    try:
        query.processAllAvailable()
        assert rows(spark.table("seen"), "x") == [(1.0,), (2.0,)]
    finally:
        query.stop()


def test_source_needs_one_of_path_and_kafka(spark):
    with pytest.raises(ValueError):
        streams.read_points_stream(spark)


def test_kafka_is_left_to_its_package(spark):
    options = {"kafka.bootstrap.servers": "nowhere:1", "subscribe": "points"}
    with pytest.raises(Exception, match="(?i)kafka"):
        streams.read_points_stream(spark, kafka=options, per_trigger=100)


def test_message_decoding_is_shared_with_the_stream(spark):
    df = points(spark, {"x": 1.0}, {"label": 0})
    assert streams.clean_stream(df.selectExpr("*", "CAST(NULL AS STRING) AS _corrupt")).count() == 1
