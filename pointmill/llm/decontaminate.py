"""Benchmark decontamination: windows of benchmark words looked up in every training text.

The windows of all items are a hash set that every task holds, as long as they are at most
most_windows and most_bytes; beyond that the windows of the texts are joined with them by a shuffle. Both
ways compare whole windows, so no hit rests on a hash alone.
"""

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointmill.llm.common import LOWER_WORDS, saved

WINDOW = 13
#: Windows held in every task at most; 200,000 of 13 words take about 60 MB there.
MOST_WINDOWS = 200_000
#: Bytes of these windows and their items' ids at most, which words of unusual length could pass.
MOST_BYTES = 64 << 20

_HITS = "n_words long, hit array<int>, items array<string>"


class _Known(dict):
    """Numbers of the benchmark's words; 0 for others."""

    def __missing__(self, word: bytes) -> int:
        return 0


def words_of(text: str | None) -> list[bytes]:
    return text.encode(errors="replace").translate(LOWER_WORDS).split() if text else []


def item_windows(benchmark: DataFrame, id_column: str, text_column: str, window: int) -> DataFrame:
    """Distinct (window, item) of all items: the words joined by blanks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = words_of(text)
                size = min(window, len(words))
                if size:
                    found.update((b" ".join(words[k : k + size]).decode(errors="replace"), item) for k in range(len(words) - size + 1))
            if found:
                keys, items = zip(*found, strict=True)
                yield pa.RecordBatch.from_pydict({"window": list(keys), "item": list(items)})

    items = benchmark.select(F.col(id_column).cast("string").alias("item"), F.col(text_column).alias("text"))
    return items.dropna().mapInArrow(read, "window string, item string").distinct()


def _lookup(windows: list[tuple[str, str]]):
    """A function from a text to (words, hit word numbers, items)."""
    known = _Known()
    items: dict[bytes, list[str]] = defaultdict(list)
    for key, item in windows:
        codes = [known.setdefault(w, len(known) + 1) for w in key.encode().split(b" ")]
        items[np.array(codes, np.int32).tobytes()].append(item)
    lengths = sorted({len(key) // 4 for key in items})
    items = dict(items)

    def find(text: str | None) -> tuple[int, list[int] | None, list[str]]:
        words = words_of(text)
        codes = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
        unknown = np.concatenate([[0], np.cumsum(codes == 0)])
        hit, found = np.zeros(len(words), bool), set()
        for length in lengths:
            if length <= len(words):
                data = codes.tobytes()
                for at in np.flatnonzero(unknown[length:] == unknown[:-length]).tolist():
                    if (which := items.get(data[4 * at : 4 * (at + length)])) is not None:
                        hit[at : at + length] = True
                        found.update(which)
        return len(words), np.flatnonzero(hit).tolist() if found else None, sorted(found)

    return find


def _held_hits(docs: DataFrame, text_column: str, windows: DataFrame) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in windows.collect()])

    @F.pandas_udf(_HITS)
    def hits(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        find = _lookup(held.value)
        for part in texts:
            yield pd.DataFrame([find(t) for t in part], columns=["n_words", "hit", "items"])

    return docs.withColumn("_hits", hits(F.col(text_column)))


def _joined_hits(docs: DataFrame, text_column: str, windows: DataFrame) -> DataFrame:
    """The same by a shuffle on the windows. The rows get numbers that a write makes final."""
    numbered = saved(docs.select(F.struct("*").alias("_doc"), F.monotonically_increasing_id().alias("_row")), "numbered")
    texts = numbered.select("_row", F.col(f"_doc.{text_column}").alias("text"))
    lengths = [r[0] for r in windows.select(F.size(F.split("window", " "))).distinct().collect()]  # at most WINDOW values

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column("_row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = words_of(text)
                whole = [w.decode(errors="replace") for w in words]
                out = [(k, " ".join(whole[k : k + n]), n) for n in lengths for k in range(len(words) - n + 1)]
                start, keys, sizes = zip(*out, strict=True) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row] * (len(out) + 1), pa.int64()),
                        pa.array([len(words), *start], pa.int32()),
                        pa.array([None, *keys], pa.string()),
                        pa.array([0, *sizes], pa.int32()),
                    ],
                    ["_row", "start", "window", "size"],
                )

    each = texts.mapInArrow(read, "_row long, start int, window string, size int")
    found = saved(each.where("window IS NOT NULL").join(windows, "window").select("_row", "start", "size", "item"), "window_hits")
    counts = each.where("window IS NULL").selectExpr("_row", "CAST(start AS LONG) AS n_words")
    places = found.selectExpr("_row", "explode(sequence(start, start + size - 1)) AS place").distinct()
    places = places.groupBy("_row").agg(F.array_sort(F.collect_list("place")).alias("hit"))
    items = found.groupBy("_row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    hits = counts.join(places, "_row", "left").join(items, "_row", "left")
    none = F.array().cast("array<string>")
    hits = hits.select("_row", F.struct("n_words", "hit", F.coalesce("items", none).alias("items")).alias("_hits"))
    return numbered.join(hits, "_row").select("_doc.*", "_hits")


def with_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    most_windows: int = MOST_WINDOWS,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """docs with a column _hits: n_words, hit (numbers of the words in any occurrence, NULL for none), items.

    Words are runs of ASCII letters and digits and of other characters beyond ASCII, A-Z
    lowered. An item's windows are its runs of window words; an item with fewer words is
    one window, one with none has none. NULL texts have no words; items without id or text
    are ignored; repeated rows of an item add nothing. items are ids as sorted strings.
    """
    windows = saved(item_windows(benchmark, item_id, item_text, window), "benchmark_windows")
    n, size = windows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("window") + F.octet_length("item")), F.lit(0))).first()
    way = _held_hits if n <= most_windows and size <= most_bytes else _joined_hits
    return way(docs, text_column, windows)


def _n_hit() -> Column:
    return F.coalesce(F.size("_hits.hit"), F.lit(0)).cast("long")


def _contaminated(percent: int) -> Column:
    return (_n_hit() > 0) & (_n_hit() * 100 >= F.col("_hits.n_words") * percent)


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = 5, **options) -> DataFrame:
    """One row per row of docs: id, n_words, n_hit, n_items, items, items_sha256, contaminated.

    A text is contaminated if some word is hit and percent of its words are at least.
    """
    hits = with_hits(docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")), benchmark, "_text", **options)
    return hits.select(
        F.col("_id").alias(id_column),
        F.col("_hits.n_words").alias("n_words"),
        _n_hit().alias("n_hit"),
        F.size("_hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_hits.items", ","), 256).alias("items_sha256"),
        _contaminated(percent).alias("contaminated"),
        F.col("_hits.items").alias("items"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", percent: int = 5, **options) -> DataFrame:
    """docs without the contaminated ones; the others stay as they are."""
    hits = with_hits(docs.select(F.struct("*").alias("_doc"), F.col(text_column).alias("_text")), benchmark, "_text", **options)
    return hits.where(~_contaminated(percent)).select("_doc.*")


def cut_words(text: str | None, places: list[int] | None) -> str | None:
    """text without the words of these numbers."""
    if text is None or places is None:
        return text
    raw, gone, out, word, inside = text.encode(), set(places), bytearray(), -1, False
    for b, mapped in zip(raw, raw.translate(LOWER_WORDS), strict=True):
        word += mapped != 32 and not inside
        inside = mapped != 32
        if not (inside and word in gone):
            out.append(b)
    return out.decode()


def cut_hits(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """docs with the hit words cut out of the texts; what stands between words stays."""
    hits = with_hits(docs.select(F.struct("*").alias("_doc"), F.col(text_column).alias("_text")), benchmark, "_text", **options)

    @F.pandas_udf("string")
    def without(text: pd.Series, hit: pd.Series) -> pd.Series:
        return pd.Series([cut_words(*x) for x in zip(text, hit, strict=True)], dtype=object)

    cut = F.when(F.col("_hits.hit").isNull(), F.col("_text")).otherwise(without("_text", "_hits.hit"))
    return hits.select(F.col("_doc").withField(text_column, cut).alias("_doc")).select("_doc.*")
