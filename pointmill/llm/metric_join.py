"""Exact range join of vectors on the angle between them, by pivots.

Angles on the sphere are a metric. Some vectors are pivots, their number growing with the root of the input; each vector belongs to
the nearest one's cell. For a pair within the range, one of the two lies in the cell of lower
number, and the triangle inequality bounds the angle of the other to that cell's pivot: by its own
distance to its pivot and by the cell's inner and outer radius. So a vector also goes, as a guest,
to the lower cells it could have a partner in, and each pair meets in one cell only. Cells join
independently; large cells and many guests are split. Equal vectors are joined once.

Where pivots tell vectors apart (clusters, low intrinsic dimension) most cells are ruled out. For
directions without structure in many dimensions no bound of this kind rules out much: the
work is then that of comparing all vectors, in blocks, without writing pairs.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointmill.llm.common import resolved, saved, union_find

#: Added to bounds, so that rounding never hides a pair.
_SLACK = 1e-7
_TILE = (512, 2048)


@dataclass(frozen=True)
class Settings:
    """cell: vectors at home in a cell about, and in a part of one at most about. pivots: as many at most, or the root of the number of vectors, if that is more. angles: to pivots, that a task holds at a time about."""

    cosine: float = 0.9
    cell: int = 4096
    guests: int = 16384
    pivots: int = 512
    angles: int = 1 << 22


def _units(vectors: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector) with the components as doubles; NULL for vectors that are NULL, empty, zero or hold NULL or non-finite components."""
    components = F.col("raw").cast("array<double>")
    kind = vectors.schema[id_column].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, out = batch.column("raw"), []
            for k in range(batch.num_rows):
                x = column[k].values if column[k].is_valid else None
                if x is None or not len(x) or x.null_count:
                    out.append(None)
                    continue
                x = x.to_numpy(zero_copy_only=False) + 0.0  # one zero only
                out.append(x.astype("<f8").tobytes() if np.isfinite(x).all() and x.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], ["id", "vector"])

    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("raw")).withColumn("raw", components)
    return rows.mapInArrow(read, f"id {kind}, vector binary")


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from (batch.slice(start, rows) for start in range(0, batch.num_rows, rows))


def _placed(known: DataFrame, pivots: np.ndarray, angles: int) -> DataFrame:
    """known with home (number of the nearest pivot) and angle to it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, max(1, angles // len(pivots))):
            if batch.num_rows:
                near = _units(batch.column("vector").to_pylist()) @ pivots.T
                home = near.argmax(axis=1)
                angle = np.arccos(near[np.arange(len(home)), home].clip(-1, 1))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home, pa.int32()), pa.array(angle)], [*batch.schema.names, "home", "angle"])

    return known.mapInArrow(read, "class long, vector binary, copies long, home int, angle double")


def _sent(placed: DataFrame, pivots: np.ndarray, inner: np.ndarray, outer: np.ndarray, parts: np.ndarray, limit: float, angles: int) -> DataFrame:
    """A row for each (cell, part) that a vector goes to, at home or as a guest."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, max(1, angles // len(pivots))):
            if not batch.num_rows:
                continue
            names = batch.column("class").to_numpy()
            home, own = batch.column("home").to_numpy(), batch.column("angle").to_numpy()
            each = np.arccos((_units(batch.column("vector").to_pylist()) @ pivots.T).clip(-1, 1))
            part = names.view(np.uint64) % parts[home].astype(np.uint64)
            goes = np.arange(len(pivots)) < home[:, None]
            goes &= each <= (own + 2 * limit + _SLACK)[:, None]
            goes &= (each <= outer + limit + _SLACK) & (each >= inner - limit - _SLACK)
            out = [(k, int(home[k]), int(part[k]), True) for k in range(len(names))]
            out += [(k, int(home[k]), p, False) for k in np.flatnonzero(part) for p in range(int(part[k]))]
            out += [(k, int(cell), p, False) for k, cell in zip(*np.nonzero(goes), strict=True) for p in range(int(parts[cell]))]
            for start in range(0, len(out), 20_000):
                rows, cells, numbers, at_home = zip(*out[start : start + 20_000], strict=True)
                taken = batch.select(["class", "vector", "copies"]).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(cells, pa.int32()), pa.array(numbers, pa.int32()), pa.array(at_home)],
                    ["class", "vector", "copies", "cell", "part", "at_home"],
                )

    return placed.mapInArrow(read, "class long, vector binary, copies long, cell int, part int, at_home boolean")


def cell_links(home: np.ndarray, guests: np.ndarray, among_home: bool, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs (number of one at home, number of the other; guests are numbered after home), a tile at a time."""
    n, (high, wide) = len(home), _TILE
    everyone = np.concatenate([home, guests]) if len(guests) else home
    for top in range(0, n, high):
        for left in range(top if among_home else n, len(everyone), wide):
            close = home[top : top + high] @ everyone[left : left + wide].T >= cosine
            i, j = np.nonzero(close)
            i, j = i + top, j + left
            apart = i < j
            if apart.any():
                yield i[apart], j[apart]


def _links(known: DataFrame, settings: Settings, size: int) -> DataFrame:
    """Links between the different vectors of one dimension: (class, root, n_links)."""
    limit = float(np.arccos(settings.cosine))
    some = min(max(settings.pivots, math.isqrt(size)), max(1, size // settings.cell))
    pivots = _units([r.vector for r in known.orderBy("class").select("vector").limit(some).collect()])
    placed = saved(_placed(known, pivots, settings.angles), "placed_vectors")
    inner, outer, parts = np.full(some, np.inf), np.full(some, -np.inf), np.ones(some, np.int64)
    for r in placed.groupBy("home").agg(F.min("angle").alias("lo"), F.max("angle").alias("hi"), F.count("*").alias("n")).collect():
        inner[r.home], outer[r.home], parts[r.home] = r.lo, r.hi, -(-r.n // (2 * settings.cell))
    sent = _sent(placed, pivots, inner, outer, parts, limit, settings.angles)
    chunks = sent.where("NOT at_home").groupBy("cell", "part").agg(F.ceil(F.count("*") / settings.guests).cast("int").alias("chunks"))
    chunks = saved(chunks, "guest_chunks")
    sent = sent.join(chunks, ["cell", "part"], "left").fillna(1, "chunks")
    away = F.array(F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int"))
    sent = sent.withColumn("chunk", F.explode(F.when(F.col("at_home"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(away))).drop("chunks")

    def join(table: pa.Table) -> pa.Table:
        at_home = table.column("at_home").to_numpy().astype(bool)
        order = np.argsort(~at_home, kind="stable")
        names, copies = table.column("class").to_numpy()[order], table.column("copies").to_numpy()[order]
        units = _units(table.column("vector").to_pylist())[order]
        n = int(at_home.sum())
        degree, root = np.zeros(len(names), np.int64), np.arange(len(names))
        for i, j in cell_links(units[:n], units[n:], table.column("chunk")[0].as_py() == 0, settings.cosine):
            np.add.at(degree, i, copies[j])
            np.add.at(degree, j, copies[i])
            a, b = root[i], root[j]
            if (a != b).any():
                root = union_find(len(names), [(np.concatenate([np.arange(len(names)), a]), np.concatenate([root, b]))])
        kept = degree > 0
        return pa.table({"class": names[kept], "root": names[root][kept], "n_links": degree[kept]})

    return saved(sent.groupBy("cell", "part", "chunk").applyInArrow(join, "class long, root long, n_links long"), "vector_links")


def range_join(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", settings: Settings | None = None) -> DataFrame:
    """One row per row of vectors: id, n_links (other rows linked directly), component_id, kept (the one whose id is component_id).

    Two vectors of one length link when their cosine, in double precision, is at least the setting. Vectors that are NULL, empty,
    zero or hold NULL or non-finite components link with nothing, as do vectors of different lengths; each such row is its own
    component. Equal vectors link, also under a repeated id. A component of NULL ids only has component_id NULL and is kept.
    An empty table gives an empty result. Other columns are ignored.
    """
    settings = settings or Settings()
    # Equal vectors are known by their SHA-256; the numbers of the classes are fixed by being written.
    rows = saved(usable(vectors, id_column, vector_column).withColumn("digest", F.sha2("vector", 256)), "vectors")
    known = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.first("vector").alias("vector"), F.count("*").alias("copies"))
    known = saved(known.select(F.monotonically_increasing_id().alias("class"), "digest", "vector", "copies"), "distinct_vectors")
    classes, known = known.select("digest", "class"), known.drop("digest")
    # A row for each length there is; in a table of embeddings, one.
    lengths = known.groupBy(F.octet_length("vector").alias("bytes")).count().collect()
    linked = vectors.sparkSession.createDataFrame([], "class long, root long, n_links long")
    for r in lengths:
        linked = linked.unionAll(_links(known.where(F.octet_length("vector") == r.bytes), settings, r["count"]))
    out = resolved(rows.select("id", "digest").join(classes, "digest", "left").select("id", "class"), linked, "vector_components")
    return out.select(F.col("id").alias(id_column), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
