"""Quality classifier: random Fourier features over document statistics, ridge, isotonic calibration.

The statistics of a text are made once, in the task that reads it. The normal equations of the
ridge are sums over partitions, so the driver receives one matrix of fixed size, and the
calibration needs a histogram of scores of fixed size; both cover every labelled row.
"""

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointmill.llm.common import parallelism, saved

_CLASSES = (
    range(ord("a"), ord("z") + 1), range(ord("A"), ord("Z") + 1), range(ord("0"), ord("9") + 1), b" ", b"\n", b".,;:", b"!?", b"|", b"$&%*#@^~<>{}[]=+\\/_", b"'\"-()", range(128, 256),
)
_CLASS_OF = np.full(256, len(_CLASSES), np.uint8)
for _k, _members in enumerate(_CLASSES):
    _CLASS_OF[list(_members)] = _k
N_STATISTICS = len(_CLASSES) + 1 + 12


def statistics(text: str | None) -> np.ndarray:
    """Numbers about a text that say how it is written, not what about. NULL is an empty text."""
    raw = (text or "").encode(errors="replace")
    out = np.zeros(N_STATISTICS)
    if not raw:
        return out
    shares = np.bincount(_CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=len(_CLASSES) + 1) / len(raw)
    words, lines = raw.split(), raw.split(b"\n")
    n = max(1, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    distinct = len(set(words))
    again = sum(map(operator.eq, words, words[1:]))
    upper = sum(map(bytes.isupper, words))
    alone = sum(not w.isalnum() and w.isascii() for w in words)
    ends = sum(w[-1:] in b"!|$&%*#" for w in words)
    out[: len(shares)] = np.sqrt(shares)
    out[len(shares) :] = (
        np.log1p(len(raw)), np.log1p(len(words)), np.log1p(len(lines)), sizes.mean(), sizes.std(), distinct / n, again / n, np.sqrt(again / n),
        upper / n, alone / n, ends / n, 1 - len(set(lines)) / len(lines),
    )
    return out


@dataclass(frozen=True)
class Settings:
    """features: random Fourier features. width: of the Gaussian kernel, in standard deviations times the root of the number of statistics."""

    features: int = 384
    width: float = 0.7
    ridge: float = 1e-3
    seed: int = 17
    bins: int = 2048
    threshold: float = 0.3


@dataclass(frozen=True)
class Model:
    """What scoring needs; its size does not depend on the data."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    offsets: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    values: np.ndarray

    def lifted(self, x: np.ndarray) -> np.ndarray:
        z = np.cos(((x - self.mean) / self.scale).clip(-8, 8) @ self.directions + self.offsets) * np.sqrt(2 / len(self.offsets))
        return np.concatenate([np.ones((len(x), 1)), z], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.lifted(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.steps, self.values)


def fold(id_column: str) -> Column:
    """0 to 4; 0 is held out. A NULL id counts as an empty string."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % 5


def isotonic(x: np.ndarray, weight: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """The nondecreasing values closest to mean, ordered by x, by pooling neighbours that are out of order."""
    blocks: list[list[float]] = []
    for w, m in zip(weight[np.argsort(x)], mean[np.argsort(x)], strict=True):
        blocks.append([w, m, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w2, m2, n2 = blocks.pop()
            w1, m1, n1 = blocks.pop()
            blocks.append([w1 + w2, (w1 * m1 + w2 * m2) / (w1 + w2), n1 + n2])
    return np.concatenate([np.full(int(n), m) for _, m, n in blocks])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)


def _summed(rows: DataFrame, size: int, total) -> np.ndarray:
    """The sum over partitions of total(statistics, labels), a matrix of size rows, added up row by row in tasks."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = 0
        for batch in batches:
            if batch.num_rows:
                sums = sums + total(_matrix(batch.column("stats")), batch.column("quality").to_numpy(zero_copy_only=False).astype(float))
        if not np.isscalar(sums):
            yield pa.RecordBatch.from_pydict({"k": pa.array(range(size), pa.int32()), "row": pa.array([x.tobytes() for x in sums], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, row in zip(batch.column("k").to_pylist(), batch.column("row").to_pylist(), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(row, "<f8")
        yield pa.RecordBatch.from_pydict({"k": pa.array(list(sums), pa.int32()), "row": pa.array([x.tobytes() for x in sums.values()], pa.binary())})

    parts = rows.mapInArrow(part, "k int, row binary").repartition(min(parallelism(rows.sparkSession), size), "k")
    found = {r.k: np.frombuffer(r.row, "<f8") for r in parts.mapInArrow(add, "k int, row binary").collect()}
    return np.stack([found[k] for k in range(size)]) if found else np.zeros((size, 0))


def train(stats: DataFrame, labels: DataFrame, id_column: str = "doc_id", label_column: str = "quality", settings: Settings | None = None) -> Model | None:
    """A model from (id, stats) and labels 0 or 1. Folds 1 to 3 give the weights, fold 4 the calibration, fold 0 nothing.

    Repeated labels of an id count once, as their largest; labels that are NULL or have no document are ignored. Without any
    label outside fold 0 there is no model.
    """
    settings = settings or Settings()
    known = labels.where(F.col(label_column).isin(0, 1)).groupBy(F.col(id_column).alias("_id")).agg(F.max(label_column).alias("quality"))
    rows = stats.where(fold(id_column) > 0).join(known, F.col(id_column) == F.col("_id"))
    rows = saved(rows.select("stats", "quality", fold(id_column).alias("fold")), "labelled")
    moments = _summed(rows, 3, lambda x, y: np.stack([np.full(x.shape[1], len(x)), x.sum(0), (x * x).sum(0)]))
    if not moments.size:
        return None
    mean = moments[1] / moments[0]
    scale = np.sqrt((moments[2] / moments[0] - mean**2).clip(1e-12))
    random = np.random.default_rng(settings.seed)
    directions = random.normal(size=(N_STATISTICS, settings.features)) / (settings.width * np.sqrt(N_STATISTICS))
    offsets = random.uniform(0, 2 * np.pi, settings.features)
    draft = Model(mean, scale, directions, offsets, *np.zeros((3, 1)))

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = draft.lifted(x)
        return z.T @ np.concatenate([z, y[:, None]], axis=1)

    most = settings.features + 1
    sums = _summed(rows.where("fold < 4"), most, equations)
    if not sums.size:
        sums = _summed(rows, most, equations)
    count = sums[0, 0]
    weights = np.linalg.solve(sums[:, :-1] + settings.ridge * max(count, 1000) / most * np.eye(most), sums[:, -1])
    draft = Model(mean, scale, directions, offsets, weights, *np.zeros((2, 1)))
    low, high, bins = -0.5, 1.5, settings.bins

    def histogram(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = ((draft.raw(x) - low) / (high - low) * bins).clip(0, bins - 1).astype(int)
        return np.stack([np.bincount(at, minlength=bins), np.bincount(at, y, bins)])

    held = _summed(rows.where("fold = 4"), 2, histogram)
    if not held.size:
        held = _summed(rows, 2, histogram)
    full = np.flatnonzero(held[0])
    centres = low + (full + 0.5) * (high - low) / bins
    # One more of each label at the ends, so that no score is exactly 0 or 1.
    x = np.concatenate([[low], centres, [high]])
    weight = np.concatenate([[1], held[0][full], [1]])
    values = isotonic(x, weight, np.concatenate([[0], held[1][full] / held[0][full], [1]]))
    return Model(mean, scale, directions, offsets, weights, x, values)


def _each(texts: pa.Array) -> Iterator[np.ndarray]:
    """The statistics of each text; few texts are Python objects at a time."""
    for start in range(0, len(texts), 200):
        yield from map(statistics, texts.slice(start, 200).to_pylist())


def with_statistics(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, stats) of each row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [x.astype("<f8").tobytes() for x in _each(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], [id_column, "stats"])

    kind = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.col(id_column), F.col(text_column).alias("text"))
    return texts.mapInArrow(read, f"{id_column} {kind}, stats binary")


def quality_scores(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality", settings: Settings | None = None) -> DataFrame:
    """One row per row of docs: id, held_out, score (0 to 1), predicted (1 at the threshold and above).

    NULL texts are empty; an empty text is scored as any. Repeated rows are scored alike. Without labels every score is 0.5.
    """
    settings = settings or Settings()
    stats = saved(with_statistics(docs, id_column, text_column), "statistics")
    model = train(stats, labels, id_column, label_column, settings)

    @F.pandas_udf("double")
    def score(rows: pd.Series) -> pd.Series:
        if model is None or not len(rows):
            return pd.Series(0.5, index=rows.index)
        return pd.Series(model.score(np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), -1)))

    out = stats.select(id_column, (fold(id_column) == 0).alias("held_out"), score("stats").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= settings.threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality", settings: Settings | None = None) -> DataFrame:
    """docs whose score reaches the threshold, with their columns; labels teach as in quality_scores."""
    settings = settings or Settings()

    @F.arrow_udf("binary")
    def described(texts: pa.Array) -> pa.Array:
        return pa.array([x.astype("<f8").tobytes() for x in _each(texts)], pa.binary())

    # Documents and statistics are written together, so that no text is read twice.
    both = saved(docs.select(F.struct("*").alias("doc"), described(F.col(text_column).cast("string")).alias("stats")), "described")
    model = train(both.select(F.col(f"doc.{id_column}").alias(id_column), "stats"), labels, id_column, label_column, settings)

    @F.arrow_udf("double")
    def score(rows: pa.Array) -> pa.Array:
        if model is None or not len(rows):
            return pa.array(np.full(len(rows), 0.5))
        return pa.array(model.score(_matrix(rows)))

    return both.where(score("stats") >= settings.threshold).select("doc.*")
