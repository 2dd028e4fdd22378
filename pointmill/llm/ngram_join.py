"""Set-similarity self-join of documents on the Jaccard index of their word n-grams.

Rare-first prefix filtering: with n-grams in one order for all, two sets similar enough
share an n-gram among the first few of each (the prefix). The order begins with n-grams that one
text alone has, so most texts have nothing to share and leave the join early:

- Equal sets form one class and are joined once, whatever their number.
- A fixed share of all n-grams, by digest, is tested: one aggregate finds those that a single class
  has. A class whose prefix they fill links with nothing. The others are suspects.
- Their sets are written once. Their other n-grams are ordered by how many suspects hold
  them, from a table of counts of fixed size, and prefixes are what is left of their length.
  N-grams that share a slot of the table count as one: that can cost time, never a link.
- Classes go to cells by the most shared n-gram of their prefix. A cell that would
  grow too large is split; a class also goes, as a guest, to each lower cell where it
  shares a prefix n-gram, and many guests are split too. So a pair meets in one task
  only, each set travels a few times at most, and no pairs are written.
- Inside a cell n-grams are ordered by the cell's own counts. Pairs from shared prefix n-grams pass
  the length, positional and suffix filters and are verified once on whole sets. A cell returns
  the number of links and one edge for each linked class.

Sets are held as 64-bit digests of n-grams, classes as a 64-bit digest.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointmill.llm.common import LOWER, Numbered, hash64, mix, parallelism, resolved, saved, union_find

#: Slots of one row of the count table; its rows are summed apart.
_SEGMENT = 1 << 14
_RANGES = 16


@dataclass(frozen=True)
class Settings:
    """n: words of an n-gram. percent: the least Jaccard index. slots: of the count table, a power of two; the filter of
    suspects has four times as many bits. cell_grams: n-grams a cell holds about."""

    n: int = 3
    percent: int = 90
    slots: int = 1 << 22
    cell_grams: int = 1_000_000

    @property
    def tested(self) -> np.uint64:
        """Digests below this are tested: nearly twice the share that a prefix takes of a set."""
        return np.uint64(min(2**64 - 1, int(2**64 * 0.018 * (100 - self.percent))))


def ngram_sets(texts: list[bytes | None], n: int, words: Numbered) -> list[np.ndarray]:
    """Distinct n-gram digests of each text, ascending; a text of fewer words is one n-gram, one of none has none."""
    split = [text.translate(LOWER).split() if text else [] for text in texts]
    sizes = np.array([len(x) for x in split])
    number = words.__getitem__
    flat = np.fromiter((h for x in split for h in map(number, x)), np.uint64, int(sizes.sum()))
    grams = flat.copy()
    with np.errstate(over="ignore"):
        for k in range(1, n):
            grams[: len(flat) - k] = mix(grams[: len(flat) - k]) + flat[k:]
        grams = mix(grams)
        out, start = [], 0
        for size in sizes.tolist():
            if size >= n:
                out.append(np.unique(grams[start : start + size - n + 1]))
            elif size:
                whole = np.uint64(size)
                for h in flat[start : start + size]:
                    whole = mix(whole) + h
                out.append(np.array([mix(whole + np.uint64(1))], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
            start += size
    return out


def _class_of(grams: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        total = mix(np.array([mix(grams ^ np.uint64(0x9E3779B97F4A7C15)).sum() + np.uint64(len(grams))], np.uint64))
    return int(total.view(np.int64)[0])


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    words = Numbered(hash64, 150_000)
    for batch in batches:
        for start in range(0, batch.num_rows, 400):  # words are Python objects: only few texts' at a time
            part = batch.slice(start, 400)
            yield part, ngram_sets(part.column("text").cast(pa.binary()).to_pylist(), n, words)


def _counted(values: Iterator[np.ndarray], slots: int) -> Iterator[pa.RecordBatch]:
    """Counts of slots as rows (segment, at, n)."""
    counts = np.zeros(slots, np.int32)
    for x in values:
        np.add.at(counts, (x & np.uint64(slots - 1)).astype(np.int64), 1)
    for k in range(slots // _SEGMENT):
        part = counts[k * _SEGMENT : (k + 1) * _SEGMENT]
        at = np.flatnonzero(part)
        if len(at):
            yield pa.RecordBatch.from_pydict({"segment": pa.array([k], pa.int32()), "at": [at.astype("<u2").tobytes()], "n": [part[at].astype("<i4").tobytes()]})


def _summed(parts: DataFrame, slots: int, pack, size: int, kind: str) -> np.ndarray:
    """The sum of all tasks' counts, each segment packed by pack into size numbers in its task. The driver receives these, however large the input."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, at, count in zip(*(batch.column(c).to_pylist() for c in ("segment", "at", "n")), strict=True):
                total = sums.setdefault(k, np.zeros(_SEGMENT, np.int64))
                total[np.frombuffer(at, "<u2")] += np.frombuffer(count, "<i4")
        packed = [pack(x).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_pydict({"segment": pa.array(list(sums), pa.int32()), "n": pa.array(packed, pa.binary())})

    out = np.zeros(slots // _SEGMENT * size, kind)
    many = parts.repartition(min(parallelism(parts.sparkSession), slots // _SEGMENT), "segment")
    for row in many.mapInArrow(add, "segment int, n binary").collect():
        out[row.segment * size : (row.segment + 1) * size] = np.frombuffer(row.n, kind)
    return out


def _logarithms(counts: np.ndarray) -> np.ndarray:
    """They keep the order well enough and take two bytes each."""
    return np.round(np.log2(1 + counts) * 1024).clip(0, 65535).astype("<u2")


def _marks(counts: np.ndarray) -> np.ndarray:
    """A bit for each count, set where it is not 0."""
    return np.packbits(counts > 0, bitorder="little")


def _least_shared(size: np.ndarray | int, percent: int):
    return (size * percent + 99) // 100


def _pairs(grams: list[np.ndarray], names: list[int], *more: np.ndarray) -> pa.RecordBatch:
    classes = np.repeat(np.array(names, np.int64), [len(x) for x in grams])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(grams).view(np.int64)), pa.array(classes), *map(pa.array, more)], ["gram", "class", "place"][: 2 + len(more)])


def classes(texts: DataFrame, settings: Settings) -> DataFrame:
    """(id, n_grams, class) of each row of (id, text); class is NULL without n-grams."""
    n, kind = settings.n, texts.schema["id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets(batches, n):
            sizes = pa.array([len(x) for x in sets], pa.int64())
            names = pa.array([_class_of(x) if len(x) else None for x in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), sizes, names], ["id", "n_grams", "class"])

    return saved(texts.mapInArrow(read, f"id {kind}, n_grams long, class long"), "ngram_classes")


def suspects(texts: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """(class, n_grams, copies, left) of the classes that can have links; left: what the grams of their own leave of the prefix's length."""
    n, percent, tested = settings.n, settings.percent, settings.tested

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Numbered(lambda _: None, 300_000)
        for _, found in _sets(batches, n):
            grams, names = [], []
            for x in found:
                if len(x) and (name := _class_of(x)) not in seen:
                    seen[name]
                    grams.append(x[: np.searchsorted(x, tested)])
                    names.append(name)
            if grams:
                yield _pairs(grams, names)

    ends = texts.mapInArrow(read, "gram long, class long").groupBy("gram").agg(F.min("class").alias("lo"), F.max("class").alias("hi"))
    own = ends.where("lo = hi").groupBy(F.col("lo").alias("class")).agg(F.count("*").alias("own"))
    known = sets.where("class IS NOT NULL").groupBy("class").agg(F.first("n_grams").alias("n_grams"), F.count("*").alias("copies"))
    prefix = F.expr(f"n_grams - (n_grams * {percent} + 99) DIV 100 + 1")
    left = (prefix - F.coalesce("own", F.lit(0))).alias("left")
    return saved(known.join(own, "class", "left").select("class", "n_grams", "copies", left).where("left > 0"), "suspects")


def _suspect_sets(texts: DataFrame, known: DataFrame, settings: Settings) -> DataFrame:
    """(class, key, grams) of rows whose class is a suspect's, and of few others; key tells rows apart."""
    n, bits = settings.n, 4 * settings.slots

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _counted((b.column("class").to_numpy().view(np.uint64) for b in batches), bits)

    marks = _summed(known.select("class").mapInArrow(names, "segment int, at binary, n binary"), bits, _marks, _SEGMENT // 8, "u1")
    held = texts.sparkSession.sparkContext.broadcast(marks)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Numbered(lambda _: None, 300_000)
        for batch, found in _sets(batches, n):
            out = []
            for k, x in enumerate(found):
                if len(x) and (name := _class_of(x)) not in seen:
                    seen[name]
                    bit = name & (bits - 1)
                    if held.value[bit >> 3] >> (bit & 7) & 1:
                        out.append((name, k, x.tobytes()))
            if out:
                which, at, grams = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(which, pa.int64()), batch.column("key").take(pa.array(at)), pa.array(grams, pa.binary())], ["class", "key", "grams"])

    keyed = texts.select(F.monotonically_increasing_id().alias("key"), "text")
    return saved(keyed.mapInArrow(read, "class long, key long, grams binary"), "suspect_sets")


def _shared_prefixes(held: DataFrame, known: DataFrame, settings: Settings) -> DataFrame:
    """Distinct (gram, class) of prefix grams that two suspects share at least."""
    slots, percent, tested = settings.slots, settings.percent, settings.tested

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _counted((np.frombuffer(b"".join(b.column("grams").to_pylist()), np.uint64) for b in batches), slots)

    counts = held.sparkSession.sparkContext.broadcast(_summed(held.mapInArrow(count, "segment int, at binary, n binary"), slots, _logarithms, _SEGMENT, "<u2"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 400):
                part = batch.slice(start, 400)
                prefixes, places = [], []
                for raw in part.column("grams").to_pylist():
                    x = np.frombuffer(raw, np.uint64)
                    seen = counts.value[(x & np.uint64(slots - 1)).astype(np.int64)]
                    size, others = len(x) - _least_shared(len(x), percent) + 1, int((x >= tested).sum())
                    # Tested grams come last. Which of them are the class's own is not known here, so all or none go along.
                    ordered = x[np.lexsort((x, seen, x < tested))]
                    prefixes.append(ordered[:size] if size <= others else ordered)
                    places.append(np.minimum(np.arange(len(prefixes[-1])), others))
                if prefixes:
                    yield _pairs(prefixes, part.column("class").to_pylist(), np.concatenate(places))

    prefixes = held.mapInArrow(read, "gram long, class long, place long")
    prefixes = prefixes.join(known.select("class", "left"), "class").where("place < left").select("gram", "class")
    prefixes = saved(prefixes, "prefixes")
    shared = prefixes.groupBy("gram").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("gram")
    return saved(prefixes.join(saved(shared, "shared_grams"), "gram").distinct(), "postings")


def _cells(postings: DataFrame, sizes: DataFrame, settings: Settings) -> DataFrame:
    """(class, cell, chunk, home): where each class must go so that each pair with a shared gram meets once."""
    most = settings.cell_grams
    frequency = postings.groupBy("gram").agg(F.count("*").alias("df"))
    hubs = postings.join(frequency, "gram").groupBy("class").agg(F.max(F.struct("df", "gram")).alias("top"))
    hubs = hubs.select("class", F.col("top.gram").alias("hub")).join(sizes, "class")
    weights = hubs.groupBy("hub").agg(F.sum("n_grams").alias("weight"))
    total = F.sum("weight").alias("total")
    buckets = max(1, -(-(weights.agg(total).first().total or 0) // most))
    heavy = F.ceil(F.col("weight") / most)
    bucket = F.pmod(F.xxhash64("hub"), F.lit(buckets))
    apart = F.lit(buckets) + F.pmod(F.xxhash64("hub", F.pmod(F.xxhash64("class", F.lit(7)), heavy)), F.lit(1 << 60))
    homes = hubs.join(weights, "hub").select("class", "n_grams", F.when(heavy > 1, apart).otherwise(bucket).alias("cell"))
    homes = saved(homes, "homes")
    placed = postings.join(homes, "class").select("gram", "class", "n_grams", "cell")
    spans = placed.groupBy("gram").agg(F.min("cell").alias("lo"), F.max("cell").alias("hi")).where("lo < hi").select("gram")
    placed = saved(placed.join(spans, "gram"), "placed")
    there = placed.select("gram", F.col("cell").alias("other")).distinct()
    guests = saved(placed.join(there, "gram").where("other < cell").selectExpr("class", "n_grams", "other AS cell").distinct(), "guests")
    chunks = guests.groupBy("cell").agg(F.ceil(F.sum("n_grams") / most).alias("chunks"))
    at_home = homes.join(chunks, "cell", "left").selectExpr(
        "class", "cell", "explode(sequence(0L, coalesce(chunks, 1L) - 1)) AS chunk", "true AS home"
    )
    away = guests.join(chunks, "cell").selectExpr("class", "cell", "pmod(xxhash64(class, 11), chunks) AS chunk", "false AS home")
    return at_home.unionAll(away)


def _suffix_counts(ranks: np.ndarray, most: int) -> np.ndarray:
    return np.bincount(ranks * _RANGES // max(1, most), minlength=_RANGES)[:_RANGES]


def cell_links(sets: list[np.ndarray], home: np.ndarray, chunk: int, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Pairs (i, j) of linked sets of one cell, an array of j for each i. Two guests never pair; two at home do in chunk 0."""
    grams, inverse, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(grams), np.int64)
    rank[np.argsort(often, kind="stable")] = np.arange(len(grams))
    sizes = np.array([len(x) for x in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    flat = rank[inverse]
    for i in range(len(sets)):
        flat[starts[i] : starts[i + 1]].sort()
    order = np.argsort(sizes, kind="stable")  # partners of a set are at least as large as it
    place = np.empty(len(sets), np.int64)
    place[order] = np.arange(len(sets))
    prefix = sizes - _least_shared(sizes, percent) + 1
    owner = np.repeat(np.arange(len(sets)), prefix)
    position = np.arange(len(owner)) - np.repeat(np.cumsum(prefix) - prefix, prefix)
    gram = flat[np.repeat(starts[:-1], prefix) + position]
    by_gram = np.lexsort((place[owner], gram))
    owner, position, gram = owner[by_gram], position[by_gram], gram[by_gram]
    first = np.searchsorted(gram, np.arange(len(grams) + 1))
    ranges = np.stack([_suffix_counts(flat[starts[i] : starts[i + 1]], len(grams)) for i in range(len(sets))])
    mark = np.zeros(len(grams), bool)
    for i in order.tolist():
        mine = flat[starts[i] : starts[i + 1]]
        others, shared_at, my_at = [], [], []
        for at, g in enumerate(mine[: prefix[i]].tolist()):
            a, b = first[g], first[g + 1]
            if b - a > 1:
                a += np.searchsorted(place[owner[a:b]], place[i], side="right")
                others.append(owner[a:b])
                shared_at.append(position[a:b])
                my_at.append(np.full(b - a, at))
        if not others:
            continue
        j, at = np.unique(np.concatenate(others), return_index=True)  # the first gram they share
        theirs, ours = np.concatenate(shared_at)[at], np.concatenate(my_at)[at]
        keep = (home[j] | home[i]) if chunk == 0 else (home[j] != home[i])
        keep &= sizes[i] * 100 >= percent * sizes[j]  # length
        need = (percent * (sizes[i] + sizes[j]) + 99 + percent) // (100 + percent)
        keep &= 1 + np.minimum(sizes[i] - ours, sizes[j] - theirs) - 1 >= need  # position
        j, need = j[keep], need[keep]
        keep = np.minimum(ranges[i], ranges[j]).sum(1) >= need  # suffix
        j = j[keep]
        if not len(j):
            continue
        mark[mine] = True
        lengths = sizes[j]
        ends = np.cumsum(lengths)
        where = np.repeat(starts[j] - (ends - lengths), lengths) + np.arange(ends[-1])
        both = np.add.reduceat(mark[flat[where]].astype(np.int64), ends - lengths)
        mark[mine] = False
        linked = j[both * 100 >= percent * (sizes[i] + lengths - both)]
        if len(linked):
            yield i, linked


def links(texts: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """(class, root, n_links): for each class with a link in a cell, one edge and its links there, copies counted."""
    percent = settings.percent
    known = suspects(texts, sets, settings)
    held = _suspect_sets(texts, known, settings)
    postings = _shared_prefixes(held, known, settings)
    known = known.join(postings.select("class").distinct(), "class", "left_semi")
    cells = _cells(postings, known.select("class", "n_grams"), settings)
    keys = held.groupBy("class").agg(F.min("key").alias("key"))
    goes = cells.groupBy("class").agg(F.collect_list(F.struct("cell", "chunk", "home")).alias("cells"))
    goes = saved(goes.join(known, "class").join(keys, "class").select("class", "key", "copies", "cells"), "goes")
    sent = held.join(goes.hint("shuffle_hash"), ["class", "key"]).select("class", "copies", "grams", F.inline("cells"))

    def join(table: pa.Table) -> pa.Table:
        names = table.column("class").to_numpy()
        found = [np.frombuffer(x, np.uint64) for x in table.column("grams").to_pylist()]
        home = table.column("home").to_numpy().astype(bool)
        copies = table.column("copies").to_numpy()
        degree = np.zeros(len(names), np.int64)
        root = np.arange(len(names))
        pending: list[tuple[np.ndarray, np.ndarray]] = []
        if len(names) > 1:
            for i, j in cell_links(found, home, table.column("chunk")[0].as_py(), percent):
                degree[i] += copies[j].sum()
                degree[j] += copies[i]
                pending.append((np.full(len(j), i), j))
            root = union_find(len(names), [tuple(map(np.concatenate, zip(*pending, strict=True)))] if pending else [])
        kept = degree > 0
        return pa.table({"class": names[kept], "root": names[root][kept], "n_links": degree[kept]})

    return saved(sent.groupBy("cell", "chunk").applyInArrow(join, "class long, root long, n_links long"), "links")


def jaccard_join(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", settings: Settings | None = None) -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id, n_links, class, representative.

    Words are split at white space (blank, tab to carriage return) after A-Z is
    lowered; the set of a text is its distinct n-grams. Texts link when the Jaccard
    index of their sets is percent at least. component_id is the smallest id reachable
    by links, itself included, n_links the other rows linked directly, representative
    whether the row is to stay when one of each component does.

    NULL and empty texts, and texts of separators only, have no n-grams and link with
    nothing: each is its own component. Rows of equal texts link, also if they repeat
    an id; all rows with the component's smallest id are representatives (drop_duplicates
    keeps one). A NULL id is a row as others, but the smallest id ignores it; a
    component of NULL ids only has component_id NULL. Other columns are ignored.
    An empty table gives an empty result.
    """
    settings = settings or Settings()
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    sets = classes(texts, settings)
    linked = links(texts, sets, settings)
    rows = resolved(sets, linked, "ngram_components")
    out = rows.select(F.col("id").alias(id_column), F.col("n_grams").alias("n_shingles"), "component_id", "n_links", "class")
    return out.withColumn("representative", F.col(id_column).eqNullSafe(F.col("component_id")))


def drop_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", settings: Settings | None = None) -> DataFrame:
    """docs with one row of each component of the join: the one with the smallest id; columns as they were.

    Rows without n-grams all stay. Rows that repeat id and text count once, those that
    repeat the id only stay where their own text's component keeps that id.
    """
    found = jaccard_join(docs, id_column, text_column, settings)
    kept = found.where("representative").groupBy(F.col(id_column).alias("_id")).agg(
        F.max(F.col("class").isNull()).alias("_lone"), F.count("*").alias("_rows")
    )
    held = docs.select(F.struct("*").alias("_doc"), F.col(id_column).alias("_key"))
    there = held.join(kept.hint("shuffle_hash"), F.col("_key").eqNullSafe(F.col("_id")))
    once = there.where("_rows = 1 OR _lone")
    again = there.where("NOT (_rows = 1 OR _lone)").groupBy("_key", F.col(f"_doc.{text_column}").alias("_text")).agg(F.first("_doc").alias("_doc"))
    return once.select("_doc.*").unionAll(again.select("_doc.*"))
