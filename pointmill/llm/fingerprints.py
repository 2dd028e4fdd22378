"""Document fingerprints: quartile bucket digests that stay alike when a text is edited a little.

The byte triplets of a text (UTF-8) are hashed into 512 buckets and counted. Each bucket is written
as the number of quartiles of all counts that its count exceeds, in two bits; one byte before them holds
the length on a logarithmic scale. Two digests differ by the sum of the steps between their buckets and
of the steps between their lengths; the difference is bounded by what independent digests have on average,
so the likeness 1 - difference / bound lies between 0 and 1.
"""

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pointmill.llm.common import saved

#: Buckets, a power of two; bits of a hash that are cut off to number them.
BUCKETS = 512
SHIFT = 33 - BUCKETS.bit_length()
#: Odd multipliers of a triplet's three bytes, each plus one, modulo 2^32.
MULTIPLIERS = (2654435761, 2246822519, 3266489917)
#: Length codes of a doubling, and what one step between length codes adds to a difference.
LENGTH_STEPS = 8
LENGTH_WEIGHT = BUCKETS // 32
#: The mean difference of two independent uniform two-bit codes is 5/4.
BOUND = BUCKETS * 5 // 4
#: Hexadecimal digits of a digest: the length's byte and a byte for four buckets.
DIGITS = 2 + BUCKETS // 2

_HASHES = [((np.arange(1, 257, dtype=np.uint64) * m) % (1 << 32)).astype(np.uint32) for m in MULTIPLIERS]
_TEXTS = 200


def fingerprint(text: bytes) -> str:
    """The digest in hexadecimal. An empty text, or one of under three bytes, has all buckets at 0."""
    codes = np.zeros(BUCKETS, np.uint8)
    if len(text) > 2:
        data = np.frombuffer(text, np.uint8)
        first, second, third = (h[data] for h in _HASHES)
        counts = np.bincount((first[:-2] + second[1:-1] + third[2:]) >> np.uint32(SHIFT), minlength=BUCKETS)
        ordered = np.sort(counts)
        for k in (1, 2, 3):
            codes += counts > ordered[k * BUCKETS // 4 - 1]
    fours = codes.reshape(-1, 4)
    body = fours[:, 0] << 6 | fours[:, 1] << 4 | fours[:, 2] << 2 | fours[:, 3]
    return f"{min(255, int(LENGTH_STEPS * math.log2(len(text) + 1))):02x}{body.tobytes().hex()}"


def _unpacked(digests: list[str]) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(bytes.fromhex("".join(digests)), np.uint8).reshape(len(digests), -1)
    codes = np.stack([rows[:, 1:] >> s & 3 for s in (6, 4, 2, 0)], axis=2).reshape(len(digests), -1)
    return rows[:, 0].astype(np.int64), codes.astype(np.int8)


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """1 for equal digests down to 0 for those that differ as much as independent ones, pair by pair."""
    if not left:
        return np.zeros(0)
    (left_size, left_codes), (right_size, right_codes) = _unpacked(left), _unpacked(right)
    difference = np.abs(left_codes - right_codes).sum(axis=1, dtype=np.int64) + LENGTH_WEIGHT * np.abs(left_size - right_size)
    return (BOUND - np.minimum(difference, BOUND)) / BOUND


def likeness_column(left: Column, right: Column) -> Column:
    """The likeness of two columns of digests; NULL where one is NULL."""

    @F.pandas_udf("double")
    def compare(a: pd.Series, b: pd.Series) -> pd.Series:
        there = (a.notna() & b.notna()).to_numpy()
        out = np.full(len(a), np.nan)
        out[there] = likeness(a[there].tolist(), b[there].tolist())
        return pd.Series(out).where(there, None)

    return compare(left, right)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of docs: id, n_chars, fingerprint. NULL texts are empty. No shuffle; other columns are ignored."""
    kind = docs.schema[id_column].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(start, _TEXTS)
                texts = [t or "" for t in part.column("_text").to_pylist()]
                found = pa.array([fingerprint(t.encode()) for t in texts], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(map(len, texts), pa.int64()), found], [id_column, "n_chars", "fingerprint"])

    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_text"))
    return rows.mapInArrow(digest, f"{id_column} {kind}, n_chars long, fingerprint string")


def edited(text: str, following: str) -> str:
    """text with its last third replaced by as many first characters of the following text, or all of it."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_COLUMNS = ["task", "place", "id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "text"]


def _schema(id_type: pa.DataType) -> pa.Schema:
    kinds = [pa.int32(), pa.string(), id_type, pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.string()]
    return pa.schema(list(zip(_COLUMNS, kinds, strict=True)))


def edit_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of docs: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one after in descending order of id, the first after the last; a lone document is its own next. Rows
    of one id stand in ascending order of a hash of the text, then of the text; rows without id come last. NULL texts are empty.
    An empty table gives an empty result; other columns are ignored.

    Texts are shuffled once, by ranges of ids. A task knows the next document of all its rows but the last; the first and the last
    text of each task are written beside the finished rows, and these pairs, one for each task, are joined afterwards.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    order = F.col("id").desc_nulls_last()
    ordered = texts.withColumn("tie", F.xxhash64("text")).repartitionByRange(order, "tie").sortWithinPartitions(order, "tie", "text")

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, before = TaskContext.get().partitionId(), None
        for batch in batches:
            schema = _schema(batch.column("id").type)
            for start in range(0, batch.num_rows, _TEXTS):
                part, rows = batch.slice(start, _TEXTS), []
                for name, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    own = fingerprint(text.encode())
                    if before is None:
                        yield pa.RecordBatch.from_pylist([{"task": task, "place": "first", "text": text}], schema)
                    else:
                        rows.append((*before, text, own))
                    before = (name, text, own)
                if rows:
                    yield pa.RecordBatch.from_arrays(_reported(rows, task, schema), schema=schema)
        if before is not None:
            name, text, own = before
            yield pa.RecordBatch.from_pylist([{"task": task, "place": "last", "id": name, "fingerprint": own, "text": text}], schema)

    fields = f"task int, place string, id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, text string"
    written = saved(ordered.select("id", "text").mapInArrow(report, fields), "fingerprints")
    # One small row for each task, then one text for each.
    firsts = written.where("place = 'first'")
    tasks = firsts.select("task")
    following = tasks.select("task", F.coalesce(F.lead("task").over(Window.orderBy("task")), F.min("task").over(Window.partitionBy())).alias("next"))
    lasts = written.where("place = 'last'").select("task", "id", "text", "fingerprint").join(following, "task")
    borders = lasts.join(firsts.select(F.col("task").alias("next"), F.col("text").alias("next_text")), "next")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("id", "text", "fingerprint", "next_text")
            for start in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(start, _TEXTS)
                rows = [(*r, fingerprint(r[3].encode())) for r in zip(*(part.column(c).to_pylist() for c in names), strict=True)]
                schema = _schema(part.column("id").type)
                yield pa.RecordBatch.from_arrays(_reported(rows, 0, schema), schema=schema)

    ends = borders.select("id", "text", "fingerprint", "next_text").mapInArrow(finish, fields)
    whole = written.where("place IS NULL").unionAll(ends)
    return whole.select(F.col("id").alias(id_column), *_COLUMNS[3:9])


def _reported(rows: list[tuple], task: int, schema: pa.Schema) -> list[pa.Array]:
    """Columns of finished rows (id, text, fingerprint, text of the next, its fingerprint)."""
    changed = [edited(text, following).encode() for _, text, _, following, _ in rows]
    own, after = [r[2] for r in rows], [r[4] for r in rows]
    prints = [fingerprint(t) for t in changed]
    columns = [
        [task] * len(rows),
        [None] * len(rows),
        [r[0] for r in rows],
        [len(r[1]) for r in rows],
        [hashlib.sha256(t).hexdigest() for t in changed],
        own,
        prints,
        likeness(own, prints),
        likeness(own, after),
        [None] * len(rows),
    ]
    return [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)]
