import json
import pickle
import struct

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointmill import workspace
from pointmill.operators.points import normalize_points
from pointmill.plans import views
from pointmill.sources import ply
from pointmill.sources.ply import PlyReader, parse_header, read_ply
from pointmill.workspace import scratch_path
from tests.helpers import rows

PROPERTIES = "property float x\nproperty uchar red\nproperty double t\nproperty int32 n\n"


def vertex(i):
    return i / 4, i % 256, i * 1.5, -i


def header(fmt, n, before="", after="", properties=PROPERTIES):
    return f"ply\nformat {fmt} 1.0\ncomment made here\n{before}element vertex {n}\n{properties}{after}end_header\n".encode()


def write(path, fmt, n, before=b"", before_header="", after=b"", after_header=""):
    if fmt == "ascii":
        body = "".join(" ".join(map(str, vertex(i))) + "\n" for i in range(n)).encode()
    else:
        order = "<" if "little" in fmt else ">"
        body = b"".join(struct.pack(order + "fBdi", *vertex(i)) for i in range(n))
    path.write_bytes(header(fmt, n, before_header, after_header) + before + body + after)


def in_splits(spark, path, size):
    return read_ply(spark, str(path), split_bytes=size)


FORMATS = ["binary_little_endian", "binary_big_endian", "ascii"]


@pytest.mark.parametrize("fmt", FORMATS)
@pytest.mark.parametrize("split", [97, 1000, 1 << 20])
def test_any_split_gives_the_same_rows(spark, tmp_path, fmt, split):
    write(tmp_path / "a.ply", fmt, 500)
    df = in_splits(spark, tmp_path, split)
    assert df.schema.simpleString() == "struct<x:float,red:smallint,t:double,n:int>"
    assert sorted(map(tuple, df.collect()), key=lambda r: r[2]) == [vertex(i) for i in range(500)]
    if split < 1 << 20:
        assert df.select(F.spark_partition_id()).distinct().count() > 1


@pytest.mark.parametrize("fmt", FORMATS)
def test_other_elements_around_the_vertices(spark, tmp_path, fmt):
    before = b"7 8\n" if fmt == "ascii" else struct.pack("<ii" if "little" in fmt else ">ii", 7, 8)
    after = b"3 0 1 2\n" if fmt == "ascii" else bytes(13)
    write(
        tmp_path / "a.ply", fmt, 50, before, "element camera 1\nproperty int a\nproperty int b\n",
        after, "element face 1\nproperty list uchar int vertex_indices\n",
    )
    df = in_splits(spark, tmp_path, 300)
    assert sorted(map(tuple, df.collect()), key=lambda r: r[2]) == [vertex(i) for i in range(50)]


def test_tasks_split_large_and_group_small_files(tmp_path):
    schema = T.StructType([T.StructField("n", T.IntegerType())])
    plan = lambda **o: PlyReader({"path": f"file://{tmp_path}", **o}, schema).partitions()
    for i in range(40):
        write(tmp_path / f"{i:02d}.ply", "binary_little_endian", 10)
    assert [len(p.splits) for p in plan(parallelism="4")] == [10, 10, 10, 10]
    (tmp_path / "large.ply").write_bytes(bytes(40 << 20))
    parts = plan(parallelism="8")
    assert 8 <= len(parts) <= 12
    ranges = sorted((s.start, s.end) for p in parts for s in p.splits if s.path.endswith("large.ply"))
    assert ranges[0][0] == 0 and ranges[-1][1] == 40 << 20
    assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))
    assert sum(len(p.splits) for p in parts) - len(ranges) == 40


def test_tasks_get_their_ranges_only(tmp_path):
    schema = T.StructType([T.StructField("n", T.IntegerType())])
    sizes = []
    for n in (1, 100_000):
        listed = {"files": [[f"file:///data/scans/{i:06d}.ply", 1000] for i in range(n)], "size": 1 << 20, "firsts": {}}
        reader = PlyReader({"path": "file:///data/scans", "listed": json.dumps(listed)}, schema)
        assert sum(len(p.splits) for p in reader.partitions()) == n
        # The class itself may go with it.
        sizes.append((len(pickle.dumps(reader)), len(cloudpickle.dumps(reader))))
    assert sizes[0] == sizes[1] and sizes[0][0] < 10_000


def test_binary_files_start_no_counting_job(spark, tmp_path, monkeypatch):
    write(tmp_path / "a.ply", "binary_little_endian", 10)
    write(tmp_path / "b.ply", "ascii", 20)
    monkeypatch.setattr(ply, "count_lines", lambda *_: pytest.fail("lines were counted"))
    assert sorted(r.n for r in read_ply(spark, str(tmp_path), split_bytes=64).collect()) == sorted([-i for i in range(10)] + [-i for i in range(20)])
    monkeypatch.undo()
    (tmp_path / "a.ply").unlink()
    write(tmp_path / "b.ply", "ascii", 20)
    whole = (tmp_path / "b.ply").read_bytes()
    (tmp_path / "b.ply").write_bytes(whole[: whole[:-1].rfind(b"\n") + 1])
    with pytest.raises(ValueError, match="shorter"):
        read_ply(spark, str(tmp_path))


@pytest.mark.parametrize("fmt", FORMATS)
def test_limit_takes_the_first_vertices(spark, tmp_path, fmt):
    write(tmp_path / "a.ply", fmt, 30)
    write(tmp_path / "b.ply", fmt, 30)
    got = read_ply(spark, str(tmp_path), limit=40).groupBy("n").count().collect()
    assert {r.n: r["count"] for r in got} == {-i: 2 if i < 10 else 1 for i in range(30)}
    assert read_ply(spark, str(tmp_path / "a.ply"), limit=0).count() == 0


def test_schema_picks_properties(spark, tmp_path):
    write(tmp_path / "a.ply", "binary_little_endian", 10)
    df = read_ply(spark, str(tmp_path), schema="t double, red int")
    assert rows(df) == [(i * 1.5, i) for i in range(10)]
    with pytest.raises(Exception, match="no vertex property nope"):
        read_ply(spark, str(tmp_path), schema="nope double").collect()


def test_hidden_and_other_files_are_skipped(spark, tmp_path):
    write(tmp_path / "a.ply", "ascii", 10)
    write(tmp_path / ".b.ply", "ascii", 10)
    (tmp_path / "notes.txt").write_text("x")
    assert read_ply(spark, str(tmp_path)).count() == 10
    assert read_ply(spark, f"file://{tmp_path}/a.ply").count() == 10


def test_empty_cloud(spark, tmp_path):
    write(tmp_path / "a.ply", "binary_little_endian", 0)
    assert read_ply(spark, str(tmp_path)).count() == 0


def test_bad_headers():
    lists = "property float x\nproperty list uchar int marks\n"
    with pytest.raises(ValueError, match="list properties on vertex"):
        parse_header(header("ascii", 1, properties=lists), "f")
    with pytest.raises(ValueError, match="no PLY header"):
        parse_header(b"plain text", "f")
    with pytest.raises(ValueError, match="no vertex element"):
        parse_header(b"ply\nformat ascii 1.0\nelement face 1\nproperty int a\nend_header\n", "f")
    with pytest.raises(ValueError, match="cannot read header line"):
        parse_header(header("ascii", 1, properties="property quad x\n"), "f")
    before = "element face 1\nproperty list uchar int v\n"
    with pytest.raises(ValueError, match="before vertex"):
        parse_header(header("binary_little_endian", 1, before=before), "f")


def test_carriage_returns_and_long_headers():
    text = header("ascii", 3, before="comment " + "x" * 5000 + "\n").replace(b"\n", b"\r\n")
    parsed = parse_header(text, "f")
    assert parsed.count == 3 and parsed.body == len(text)


def test_short_file_is_an_error(spark, tmp_path):
    write(tmp_path / "a.ply", "binary_little_endian", 10)
    whole = (tmp_path / "a.ply").read_bytes()
    (tmp_path / "a.ply").write_bytes(whole[:-5])
    with pytest.raises(Exception, match="shorter than its header says"):
        read_ply(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("split", [97, 1 << 20])
@pytest.mark.parametrize("said", [3, 12])
def test_ascii_file_with_other_lines_than_its_header_says(spark, tmp_path, split, said):
    write(tmp_path / "a.ply", "ascii", 6)
    data = (tmp_path / "a.ply").read_bytes()
    (tmp_path / "a.ply").write_bytes(data.replace(b"element vertex 6", b"element vertex %d" % said))
    with pytest.raises(ValueError, match="longer" if said < 6 else "shorter"):
        in_splits(spark, tmp_path, split).collect()
    with pytest.raises(Exception, match="longer" if said < 6 else "shorter"):
        spark.read.format("ply").load(f"file://{tmp_path}").collect()


def test_ascii_files_with_further_elements_and_limits_are_split(spark, tmp_path):
    write(tmp_path / "a.ply", "ascii", 500, b"1\n\n2\n", "element camera 2\nproperty int a\n", b"3 0 1 2\n", "element face 1\nproperty list uchar int v\n")
    df = in_splits(spark, tmp_path, 400)
    assert sorted(map(tuple, df.collect()), key=lambda r: r[2]) == [vertex(i) for i in range(500)]
    assert df.select(F.spark_partition_id()).distinct().count() > 5
    some = read_ply(spark, str(tmp_path), limit=300, split_bytes=400)
    assert sorted(map(tuple, some.collect()), key=lambda r: r[2]) == [vertex(i) for i in range(300)]
    assert some.select(F.spark_partition_id()).distinct().count() > 3


def test_header_of_any_length(spark, tmp_path):
    write(tmp_path / "a.ply", "binary_little_endian", 5, b"", "comment " + "x" * (2 << 20) + "\n")
    assert read_ply(spark, str(tmp_path)).count() == 5
    (tmp_path / "a.ply").write_bytes(bytes(1 << 20))
    with pytest.raises(Exception, match="no PLY header"):
        read_ply(spark, str(tmp_path)).collect()


def test_lines_with_too_few_values(spark, tmp_path):
    (tmp_path / "a.ply").write_bytes(header("ascii", 2) + b"1 2 3 4\n1 2 3\n")
    with pytest.raises(Exception, match="columns"):
        read_ply(spark, str(tmp_path)).collect()


def test_paths_get_the_default_file_system(spark, tmp_path):
    assert workspace.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://one/")
    conf.set("fs.viewfs.mounttable.one.link./x", f"file://{tmp_path}")
    try:
        assert workspace.qualified(spark, "/x/y") == "viewfs://one/x/y"
    finally:
        conf.set("fs.defaultFS", before)
    files, inner = workspace.file_system(f"file:{tmp_path}/a")
    assert files.type_name == "local" and inner == f"{tmp_path}/a"
    with pytest.raises(ValueError):
        workspace.file_system("/no/scheme")


def test_written_points_come_back(spark, sf_dir):
    raw = views.raw_points(spark, sf_dir)
    path = scratch_path(spark, "ply")
    views.write_ply_files(raw, path)
    assert rows(normalize_points(read_ply(spark, path))) == rows(normalize_points(raw))
