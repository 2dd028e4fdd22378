"""Packing token sequences into windows by non-negative least squares.

Whole windows of a document are sequences of their own. What remains of each, shorter than a
window, falls into one of a few length classes. Combinations of up to three classes that fill a
window are enumerated; non-negative least squares says how often to use each so that together
they use up the histogram of classes. The numbers are rounded down and what is left over fills,
cut at will, the gaps that the rounding of lengths to classes leaves, then further windows.
A last window that stays short is cut into powers of two, which need no padding.

The driver handles the histogram and the plan, whose sizes are fixed. Documents are numbered
within their class, and tokens along the line of gaps, by sums over slices of rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pointmill.llm.common import saved
from pointmill.llm.tokens import encoder, slices

_CELL = 1 << 20
_TEXTS = 500


@dataclass(frozen=True)
class Settings:
    """window: tokens of a sequence. step: tokens of a length class; window is a multiple of it."""

    window: int = 2048
    step: int = 32
    end_id: int = 1


def combinations(classes: int) -> np.ndarray:
    """How many of each length class (rows: 1 to classes) the combinations of one, two and three that fill a window have (columns)."""
    found = [(classes,)]
    found += [(a, classes - a) for a in range(1, classes // 2 + 1)]
    found += [(a, b, classes - a - b) for a in range(1, classes // 3 + 1) for b in range(a, (classes - a) // 2 + 1)]
    out = np.zeros((classes, len(found)))
    for column, parts in enumerate(found):
        np.add.at(out, (np.array(parts) - 1, column), 1)
    return out


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with the smallest |a x - b|, by an active set: add the column that helps most, drop those that turn negative."""
    x, used = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tolerance = 1e-9 * max(1.0, np.abs(a.T @ b).max(initial=0))
    for _ in range(10 * a.shape[1]):
        gain = np.where(used, -np.inf, a.T @ (b - a @ x))
        if gain.max() <= tolerance:
            break
        used[np.argmax(gain)] = True
        while True:
            best = np.zeros_like(x)
            best[used] = np.linalg.lstsq(a[:, used], b, rcond=None)[0]
            if best[used].min() > 0:
                x = best
                break
            below = used & (best <= 0)
            share = (x[below] / np.maximum(x[below] - best[below], 1e-300)).min()
            x = x + share * (best - x)
            used &= x > tolerance * 1e-6
            x[~used] = 0
            if not used.any():
                break
    return x


def plan(histogram: np.ndarray, slack: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The combinations, and how often to use each.

    histogram: remainders of each class; slack: tokens they lack to their class's length, summed.
    Enough documents are left over to fill all gaps of the planned windows.
    """
    classes = len(histogram)
    fills = combinations(classes)
    total = max(1, histogram.sum())
    wanted = np.floor(nonnegative_least_squares(fills, histogram / total) * total + 1e-6).astype(np.int64)
    left, often = histogram.astype(np.int64).copy(), np.zeros(fills.shape[1], np.int64)
    for k in np.argsort(-wanted, kind="stable"):
        parts = fills[:, k] > 0
        often[k] = min(wanted[k], (left[parts] // fills[parts, k].astype(np.int64)).min())
        left -= often[k] * fills[:, k].astype(np.int64)
    lengths = settings.step * np.arange(1, classes + 1)
    mean_slack = np.divide(slack, histogram, out=np.zeros(classes), where=histogram > 0)
    while often.sum():
        loose = (histogram - fills @ often) @ (lengths - mean_slack)
        gaps = (fills @ often) @ mean_slack
        if loose >= gaps:
            break
        share = min(1.0, 1.02 * (gaps - loose) / settings.window / often.sum())
        often = np.maximum(0, often - np.maximum(1, np.ceil(often * share)).astype(np.int64) * (often > 0))
    return fills, often


def _running(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """df with out: the sum of value over the rows of the same keys that come before by order, a whole number.

    Sums over slices of order are added up first, so no window is longer than a slice.
    """
    cut = df.withColumn("_slice", F.shiftright(order, 17))
    sums = cut.groupBy(*keys, "_slice").agg(F.sum(value).alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = sums.select(*keys, "_slice", before.alias("_base"))
    within = Window.partitionBy(*keys, "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    here = cut.withColumn(out, F.coalesce(F.sum(value).over(within), F.lit(0)))
    return here.join(bases, [*keys, "_slice"]).withColumn(out, (F.col(out) + F.col("_base")).cast("long")).drop("_slice", "_base")


def encoded(docs: DataFrame, vocabulary: str, id_column: str, text_column: str, end_id: int) -> DataFrame:
    """(row, id, n, ids) of each row of docs, written once: its number, and its ids with end_id as little-endian numbers of two or four bytes."""
    kind = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, lengths = encode.encode(part.column("text").to_pylist())
                ends = np.cumsum(lengths)
                ids = np.insert(ids, ends, end_id).astype(_stored(encode.size))
                each = np.split(ids, (ends + np.arange(1, len(ends) + 1))[:-1])
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("id"), pa.array(lengths + 1), pa.array([x.tobytes() for x in each], pa.binary())],
                    ["row", "id", "n", "ids"],
                )

    return saved(texts.mapInArrow(read, f"row long, id {kind}, n long, ids binary"), "encoded")


def _stored(vocabulary_size: int) -> str:
    return "<u2" if vocabulary_size <= 1 << 16 else "<u4"


def place(lengths: DataFrame, settings: Settings) -> DataFrame:
    """Where each piece of (row, n) goes: (row, start, length, sequence_id, offset)."""
    window, step = settings.window, settings.step
    spark = lengths.sparkSession
    rest = F.col("n") % window
    docs = lengths.select("row", F.floor(F.col("n") / window).cast("long").alias("whole"), rest.cast("long").alias("rest"))
    docs = docs.withColumn("class", F.ceil(F.col("rest") / step).cast("int"))
    counted = docs.groupBy("class").agg(F.count("*").alias("docs"), F.sum(F.col("class") * step - F.col("rest")).alias("slack"), F.sum("whole").alias("whole")).collect()
    classes = window // step
    histogram, slack = np.zeros(classes, np.int64), np.zeros(classes, np.int64)
    for r in counted:
        if r["class"]:
            histogram[r["class"] - 1], slack[r["class"] - 1] = r.docs, r.slack
    fills, often = plan(histogram, slack, settings)
    used = (fills @ often).astype(np.int64)

    # Ranks of a class are dealt to the places of the combinations one after the other.
    first = np.cumsum(often) - often
    dealt: dict[int, list[tuple[int, int, int]]] = {k: [] for k in range(1, classes + 1)}
    at = dict.fromkeys(dealt, 0)
    for column in np.flatnonzero(often):
        slot = 0
        for k in np.flatnonzero(fills[:, column]):
            for _ in range(int(fills[k, column])):
                dealt[k + 1].append((at[k + 1], int(first[column]), slot))
                at[k + 1] += int(often[column])
                slot += 1
    planned_total = int(often.sum())

    @F.pandas_udf("sequence_id long, slot int")
    def slots(classes: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(classes), 2), np.int64)
        for k in classes.unique():
            mine = (classes == k).to_numpy()
            begin, base, slot = np.array(dealt[k]).T
            which = np.searchsorted(begin, ranks[mine], side="right") - 1
            out[mine] = np.stack([base[which] + ranks[mine] - begin[which], slot[which]], axis=1)
        return pd.DataFrame({"sequence_id": out[:, 0], "slot": out[:, 1].astype(np.int32)})

    limits = F.lit([0, *used.tolist()])
    ranked = _running(docs.where("class > 0").withColumn("one", F.lit(1)), ["class"], "row", "one", "rank")
    ranked = saved(ranked.withColumn("planned", F.col("rank") < limits[F.col("class")]), "ranked")
    seats = ranked.where("planned").select("row", "whole", "rest", slots("class", "rank").alias("seat")).select("row", "whole", "rest", "seat.*")
    mates = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    seats = saved(seats.withColumn("offset", F.coalesce(F.sum("rest").over(mates), F.lit(0))), "seats")
    pieces = seats.select("row", (F.col("whole") * window).alias("start"), F.col("rest").alias("length"), "sequence_id", "offset")

    whole = _running(docs.where("whole > 0"), [], "row", "whole", "before")
    whole_total = sum(r.whole for r in counted)
    whole = whole.select("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).alias("k"), "before")
    number = F.col("before") + F.col("k") + planned_total
    pieces = pieces.unionAll(whole.select("row", F.col("k") * window, F.lit(window).cast("long"), number, F.lit(0).cast("long")))

    # The rest of the documents lies on a line of tokens, the gaps lie on the same line.
    loose = saved(_running(ranked.where("NOT planned").select("row", "whole", "rest"), [], "row", "rest", "at"), "loose")
    loose_total = loose.agg(F.sum("rest")).first()[0] or 0
    gaps = seats.groupBy("sequence_id").agg(F.sum("rest").alias("filled")).where(F.col("filled") < window)
    gaps = _running(gaps.select("sequence_id", "filled", (window - F.col("filled")).alias("size")), [], "sequence_id", "size", "at")
    gaps = saved(gaps.select("sequence_id", F.col("filled").alias("offset"), "size", "at"), "gaps")
    more = max(0, loose_total - (gaps.agg(F.sum("size")).first()[0] or 0))
    begin, base = loose_total - more, planned_total + whole_total
    further = spark.range(more // window).select(
        (F.col("id") + base).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(window).cast("long").alias("size"), (F.col("id") * window + begin).alias("at")
    )
    tail, last, sequence = [], begin + more // window * window, base + more // window
    for bit in reversed(range(window.bit_length())):
        if more % window >> bit & 1:
            tail.append((sequence, 0, 1 << bit, last))
            last, sequence = last + (1 << bit), sequence + 1
    gaps = gaps.unionAll(further).unionAll(spark.createDataFrame(tail, gaps.schema))

    def cells(size: str):
        return F.explode(F.sequence(F.floor(F.col("at") / _CELL), F.floor((F.col("at") + F.col(size) - 1) / _CELL))).alias("cell")

    def overlap(tokens: pd.DataFrame, holes: pd.DataFrame) -> pd.DataFrame:
        cuts = [np.concatenate([f["at"], f["at"] + f[size]]) for f, size in ((tokens, "rest"), (holes, "size"))]
        line = np.unique(np.concatenate(cuts)) if len(tokens) and len(holes) else np.zeros(0, np.int64)
        if len(line) < 2:
            return pd.DataFrame({"row": [], "start": [], "length": [], "sequence_id": [], "offset": []}, dtype=np.int64)
        tokens, holes = tokens.sort_values("at"), holes.sort_values("at")
        low, high = line[:-1], line[1:]
        t, h = (np.searchsorted(f["at"], low, side="right") - 1 for f in (tokens, holes))
        inside = (t >= 0) & (h >= 0)
        inside &= (low < (tokens["at"] + tokens["rest"]).to_numpy()[t]) & (low < (holes["at"] + holes["size"]).to_numpy()[h])
        low, high, t, h = low[inside], high[inside], tokens.iloc[t[inside]], holes.iloc[h[inside]]
        at = low - t["at"].to_numpy()
        return pd.DataFrame(
            {
                "row": t["row"].to_numpy(),
                "start": t["whole"].to_numpy() * window + at,
                "length": high - low,
                "sequence_id": h["sequence_id"].to_numpy(),
                "offset": h["offset"].to_numpy() + low - h["at"].to_numpy(),
            }
        )

    left = loose.select("row", "whole", "rest", "at", cells("rest")).groupBy("cell")
    right = gaps.select("sequence_id", "offset", "size", "at", cells("size")).groupBy("cell")
    filled = left.cogroup(right).applyInPandas(overlap, "row long, start long, length long, sequence_id long, offset long")
    return saved(pieces.unionAll(filled.distinct()), "pieces")


def pack(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", settings: Settings | None = None) -> DataFrame:
    """One row per piece of a document: id, row, start, length, doc_tokens, sequence_id, offset, ids (little-endian 32-bit numbers).

    Each document is its ids and end_id; NULL and empty texts are end_id alone. A sequence holds at most
    window tokens without holes. Repeated rows and ids are documents of their own; row tells them apart.
    An empty table gives no pieces. Other columns are ignored.
    """
    settings = settings or Settings()
    texts = encoded(docs, vocabulary, id_column, text_column, settings.end_id)
    pieces = place(texts.select("row", "n"), settings)
    each = pieces.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("pieces"))
    joined = texts.join(each.hint("shuffle_hash"), "row").select("row", "id", "n", "ids", "pieces")
    kind = docs.schema[id_column].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(start, _TEXTS)
                out, which = [], []
                for k, (n, ids, places) in enumerate(zip(part.column("n").to_pylist(), part.column("ids").to_pylist(), part.column("pieces").to_pylist(), strict=True)):
                    wide = np.frombuffer(ids, f"<u{len(ids) // n}").astype("<u4")
                    out.extend((p["start"], p["length"], p["sequence_id"], p["offset"], wide[p["start"] : p["start"] + p["length"]].tobytes()) for p in places)
                    which.extend([k] * len(places))
                if out:
                    columns = list(zip(*out, strict=True))
                    taken = part.select(["row", "id", "n"]).take(pa.array(which))
                    yield pa.RecordBatch.from_arrays(
                        [*taken.columns, *(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.binary())],
                        ["row", id_column, "doc_tokens", "start", "length", "sequence_id", "offset", "ids"],
                    )

    return joined.mapInArrow(cut, f"row long, {id_column} {kind}, doc_tokens long, start long, length long, sequence_id long, offset long, ids binary")


def pieces_report(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", settings: Settings | None = None) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    pieces = pack(docs, vocabulary, id_column, text_column, settings)
    return pieces.select(id_column, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

