"""PLY vertex scan as a Python data source.

Planning only lists files. Each task reads the header of its own file and then
the vertices that start in its byte range, so one large file is read by many
tasks and many files cost the driver nothing but their names.

Binary vertices have a fixed stride, so any byte range can be read on its own.
For ascii files read_ply counts the lines of each byte range in tasks first. The
sums tell each range the number of its first line, so every file is split, and one
with fewer or more lines than its header says is an error. Without these counts
(spark.read.format("ply") by itself, or a folder whose first file is binary) one
task streams an ascii file. What the driver has listed stays there: a task gets its
ranges and nothing else.
"""

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from pointmill import workspace
from pointmill.workspace import file_system

# PLY scalar type -> numpy type without byte order.
SCALARS = {
    "char": "i1", "int8": "i1",
    "uchar": "u1", "uint8": "u1",
    "short": "i2", "int16": "i2",
    "ushort": "u2", "uint16": "u2",
    "int": "i4", "int32": "i4",
    "uint": "u4", "uint32": "u4",
    "float": "f4", "float32": "f4",
    "double": "f8", "float64": "f8",
}

# Numpy type -> smallest Spark type that holds it (Spark has no unsigned types).
SPARK_TYPES = {
    "i1": T.ByteType(), "u1": T.ShortType(),
    "i2": T.ShortType(), "u2": T.IntegerType(),
    "i4": T.IntegerType(), "u4": T.LongType(),
    "f4": T.FloatType(), "f8": T.DoubleType(),
}

BYTE_ORDERS = {"binary_little_endian": "<", "binary_big_endian": ">", "ascii": ""}

_HEADER_STEP = 4096
_BATCH_ROWS = 65536
_READ_BYTES = 1 << 20
# As for Spark's own file sources: the most a task reads, and what opening a file counts as.
_SPLIT_BYTES = 128 << 20
_OPEN_BYTES = 4 << 20


@dataclass
class Header:
    order: str  # numpy byte order; "" for ascii
    fields: list[tuple[str, str]]  # vertex property, numpy type
    count: int
    body: int  # offset of the first vertex (ascii: of the first body line)
    lines_before: int  # ascii: body lines of elements before the vertices
    lines: int  # ascii: body lines of all elements

    @property
    def dtype(self) -> np.dtype:
        return np.dtype([(name, (self.order or "<") + kind) for name, kind in self.fields])


@dataclass
class Split:
    path: str
    start: int
    end: int
    take: int | None = None  # only the first `take` vertices of the file
    first: int | None = None  # ascii: number of the first line that starts in the range; None if one task reads all


@dataclass
class Splits(InputPartition):
    """What one task reads: a range of a large file, or several small files."""

    splits: list[Split]


def parse_header(data: bytes, path: str) -> Header:
    """Read the header from the first bytes of a file. Raises on vertices without a fixed layout."""
    end = data.find(b"end_header")
    stop = data.find(b"\n", end)
    if not data.startswith(b"ply") or end < 0 or stop < 0:
        raise ValueError(f"{path}: no PLY header")
    order, elements = None, []
    for words in (line.split() for line in data[:end].decode("ascii").splitlines()):
        match words:
            case ["format", name, *_] if name in BYTE_ORDERS:
                order = BYTE_ORDERS[name]
            case ["element", name, count]:
                elements.append((name, int(count), []))
            case ["property", "list", _, _, name]:
                elements[-1][2].append((name, "list"))
            case ["property", kind, name] if kind in SCALARS:
                elements[-1][2].append((name, SCALARS[kind]))
            case ["property", *_] | ["format", *_]:
                raise ValueError(f"{path}: cannot read header line {' '.join(words)!r}")
    names = [name for name, _, _ in elements]
    if order is None or "vertex" not in names:
        raise ValueError(f"{path}: no vertex element")
    at = names.index("vertex")
    _, count, fields = elements[at]
    if any(kind == "list" for _, kind in fields):
        raise ValueError(f"{path}: list properties on vertex are not supported")
    body, lines_before = stop + 1, 0
    for name, number, properties in elements[:at]:
        if order == "":
            lines_before += number
        elif any(kind == "list" for _, kind in properties):
            raise ValueError(f"{path}: element {name} before vertex has list properties")
        else:
            body += number * sum(np.dtype(kind).itemsize for _, kind in properties)
    return Header(order, fields, count, body, lines_before, sum(number for _, number, _ in elements))


def list_files(path: str) -> list[tuple[str, int]]:
    """(path, size) of a file, or of the visible .ply files under a folder."""
    fs, inner = file_system(path)
    info = fs.get_file_info(inner)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    root = path[: len(path) - len(inner)] if path.endswith(inner) else f"{path.partition(':')[0]}://"
    if info.type == pafs.FileType.File:
        found = [info]
    else:
        below = fs.get_file_info(pafs.FileSelector(inner, recursive=True))
        found = [
            f for f in below
            if f.type == pafs.FileType.File and f.extension == "ply" and not f.base_name.startswith((".", "_"))
        ]
    return sorted((root + f.path, f.size) for f in found)


def read_header(path: str) -> Header:
    fs, inner = file_system(path)
    with fs.open_input_file(inner) as file:
        data = file.read(_HEADER_STEP)
        # A file of another kind shows in its first bytes; a header may be of any length.
        while data.startswith(b"ply") and b"end_header" not in data[:-2]:
            more = file.read(len(data))
            if not more:
                break
            data += more
    return parse_header(data, path)


def _binary_batches(file: pa.NativeFile, header: Header, split: Split, size: int) -> Iterator[np.ndarray]:
    """Structured arrays of the vertices whose first byte lies in the split."""
    stride = header.dtype.itemsize
    if header.body + header.count * stride > size:
        raise ValueError(f"{split.path}: shorter than its header says")
    wanted = header.count if split.take is None else min(header.count, split.take)
    at = max(0, -((header.body - split.start) // stride))
    stop = min(wanted, max(0, -((header.body - split.end) // stride)))
    while at < stop:
        rows = min(_BATCH_ROWS, stop - at)
        data = file.read_at(rows * stride, header.body + at * stride)
        yield np.frombuffer(data, dtype=header.dtype)
        at += rows


def _lines(file: pa.NativeFile, start: int, end: int) -> Iterator[bytes]:
    """The lines whose first byte lies in [start, end), start being the first byte of a line or past one."""
    file.seek(start)
    at, rest = start, b""
    while at < end:
        block = file.read(_READ_BYTES)
        if not block:
            if rest:
                yield rest
            return
        pieces = (rest + block).split(b"\n")
        rest = pieces.pop()
        for line in pieces:
            if at >= end:
                return
            yield line
            at += len(line) + 1


def _range_lines(file: pa.NativeFile, header: Header, split: Split) -> Iterator[bytes]:
    """The lines of the body, empty ones left out, whose first byte lies in the split."""
    if split.first is None or split.start <= header.body:
        lines = _lines(file, header.body, sys.maxsize if split.first is None else split.end)
    else:
        # One byte back: a line that starts exactly at the split is then skipped to, not over.
        lines = _lines(file, split.start - 1, split.end)
        next(lines, None)
    return (line for line in lines if line.strip())


def _check_lines(path: str, found: int, header: Header) -> None:
    if found != header.lines:
        raise ValueError(f"{path}: {'shorter' if found < header.lines else 'longer'} than its header says")


def _ascii_batches(file: pa.NativeFile, header: Header, split: Split) -> Iterator[np.ndarray]:
    if split.first is None and split.start > 0:
        return
    wanted = header.count if split.take is None else min(header.count, split.take)
    low, high = header.lines_before, header.lines_before + wanted
    number = (split.first or 0) - 1
    batch = []

    def parsed() -> np.ndarray:
        rows = np.loadtxt(batch, dtype="f8", ndmin=2)
        if rows.shape[1] != len(header.fields):
            raise ValueError(f"{split.path}: {rows.shape[1]} values in a line for {len(header.fields)} properties")
        return rows

    for number, line in enumerate(_range_lines(file, header, split), number + 1):
        if number >= high and split.first is not None:
            break
        if low <= number < high:
            batch.append(line)
        if len(batch) == _BATCH_ROWS:
            yield parsed()
            batch = []
    if batch:
        yield parsed()
    if split.first is None:
        _check_lines(split.path, number + 1, header)


def _ranges(files: list[tuple[str, int]], size: int) -> list[tuple[str, int, int]]:
    return [(path, at, min(at + size, end)) for path, end in files for at in range(0, end, size)]


def count_lines(spark: SparkSession, files: list[tuple[str, int]], size: int) -> dict[str, list[int]]:
    """For each ascii file, the number of the first line of each range of size bytes; one row per range comes to the driver.

    A file whose lines are not as many as its header says is an error.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "stop")), strict=True):
                header = read_header(path)
                if header.order:
                    continue
                fs, inner = file_system(path)
                with fs.open_input_file(inner) as file:
                    rows.append((path, start, sum(1 for _ in _range_lines(file, header, Split(path, start, end, first=0))), header.lines))
            names = ["path", "start", "lines", "wanted"]
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=schema)

    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("lines", pa.int64()), ("wanted", pa.int64())])
    ranges = _ranges(files, size)
    if not ranges:
        return {}
    tasks = spark.createDataFrame(ranges, "path string, start long, stop long").repartition(min(len(ranges), 4 * spark.sparkContext.defaultParallelism))
    found = sorted(tasks.mapInArrow(count, "path string, start long, lines long, wanted long").collect())
    firsts: dict[str, list[int]] = {}
    sums: dict[str, int] = {}
    for r in found:
        firsts.setdefault(r.path, []).append(sums.get(r.path, 0))
        sums[r.path] = sums.get(r.path, 0) + r.lines
    for path, wanted in {r.path: r.wanted for r in found}.items():
        if sums[path] != wanted:
            raise ValueError(f"{path}: {'shorter' if sums[path] < wanted else 'longer'} than its header says")
    return firsts


def split_size(sizes: list[int], most: int, parallelism: int) -> int:
    share = sum(size + _OPEN_BYTES for size in sizes) // parallelism
    return min(most, max(_OPEN_BYTES, share))


class PlyReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path = options["path"]
        self.limit = int(options["limit"]) if "limit" in options else None
        self.split_bytes = int(options.get("splitbytes", _SPLIT_BYTES))
        self.parallelism = int(options.get("parallelism", 1))
        self.schema = to_arrow_schema(schema)
        self.known = json.loads(options["listed"]) if "listed" in options else None

    def __getstate__(self) -> dict:
        """For the tasks, which get their ranges: without the listing."""
        return self.__dict__ | {"known": None}

    def _files(self) -> Iterator[tuple[str, int, int | None]]:
        """(path, bytes to read, vertices to take). With a limit, headers are read until it is reached."""
        left = self.limit
        for path, size in list_files(self.path) if self.known is None else self.known["files"]:
            if left is None:
                yield path, size, None
                continue
            if left == 0:
                return
            header = read_header(path)
            take = min(left, header.count)
            left -= take
            yield path, header.body + take * header.dtype.itemsize if header.order else size, take

    def partitions(self) -> list[Splits]:
        files = list(self._files())
        size = split_size([end for _, end, _ in files], self.split_bytes, self.parallelism)
        parts, room = [], 0
        if self.known is not None:
            size = self.known["size"]
        for path, end, take in files:
            firsts = self.known["firsts"].get(path) if self.known is not None else None
            for k, at in enumerate(range(0, end, size)):
                split = Split(path, at, min(at + size, end), take, firsts[k] if firsts else None)
                cost = split.end - split.start + _OPEN_BYTES
                if cost > room or not parts:
                    parts.append(Splits([]))
                    room = size
                parts[-1].splits.append(split)
                room -= cost
        return parts or [Splits([])]

    def read(self, partition: Splits) -> Iterator[pa.RecordBatch]:
        for split in partition.splits:
            yield from self._read(split)

    def _read(self, split: Split) -> Iterator[pa.RecordBatch]:
        header = read_header(split.path)
        names = [name for name, _ in header.fields]
        missing = [f.name for f in self.schema if f.name not in names]
        if missing:
            raise ValueError(f"{split.path}: no vertex property {', '.join(missing)}")
        fs, inner = file_system(split.path)
        with fs.open_input_file(inner) as file:
            if header.order:
                batches = _binary_batches(file, header, split, file.size())
                column = lambda data, name: data[name]
            else:
                batches = _ascii_batches(file, header, split)
                column = lambda data, name: data[:, names.index(name)]
            for data in batches:
                arrays = [pa.array(column(data, f.name).astype(f.type.to_pandas_dtype())) for f in self.schema]
                yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)


class PlyDataSource(DataSource):
    """spark.read.format("ply").

    Options: limit (first N vertices), splitBytes (the most a task reads),
    parallelism (tasks to aim for while that keeps them above a few megabytes).
    """

    @classmethod
    def name(cls) -> str:
        return "ply"

    def schema(self) -> T.StructType:
        known = json.loads(self.options["listed"])["files"] if "listed" in self.options else None
        files = list_files(self.options["path"]) if known is None else known
        if not files:
            raise ValueError(f"no .ply files under {self.options['path']}")
        fields = read_header(files[0][0]).fields
        return T.StructType([T.StructField(name, SPARK_TYPES[kind]) for name, kind in fields])

    def reader(self, schema: T.StructType) -> PlyReader:
        return PlyReader(self.options, schema)


def read_ply(
    spark: SparkSession,
    path: str,
    limit: int | None = None,
    schema: str | T.StructType | None = None,
    split_bytes: int = _SPLIT_BYTES,
) -> DataFrame:
    """The vertices of a PLY file, or of all PLY files under a folder.

    A schema naming some of the properties makes the tasks decode only those.
    """
    # Shipped with the job, so workers need no copy of this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    cloudpickle.register_pickle_by_value(workspace)
    spark.dataSource.register(PlyDataSource)
    path = workspace.qualified(spark, path)
    found = list_files(path)
    parallelism = spark.sparkContext.defaultParallelism
    reader = spark.read.format("ply").option("parallelism", parallelism).option("splitbytes", split_bytes)
    if found and not read_header(found[0][0]).order:
        size = split_size([n for _, n in found], split_bytes, parallelism)
        listed = {"files": found, "size": size, "firsts": count_lines(spark, found, size)}
        reader = reader.option("listed", json.dumps(listed))
    if schema is not None:
        reader = reader.schema(schema)
    if limit is not None:
        reader = reader.option("limit", limit)
    return reader.load(path)
