"""Ranked lexical search: every query text against all documents, by a pipeline of term owners.

The terms of the queries are dealt to a few owners, the rarest terms to the first. Documents lie in blocks
of bounded size. For each block a query is a bundle: its terms and a sparse set of accumulators (document,
score). The bundles go from owner to owner; at each, a cogroup brings them together with the owner's
postings of the same block, and the whole-number contributions of its terms are added. What the last
owner leaves is merged into the best documents of each query.

A document leaves a bundle only when the largest contributions of all terms to come cannot lift it to
the score that enough documents of its block have already: contributions are never negative, so the
result is that of scoring everything.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pointmill.llm.common import LOWER_WORDS, parallelism, saved

_TEXTS = 200
#: Stands for a NULL id within the operator, after all others.
_NO_ID = (1 << 63) - 1


@dataclass(frozen=True)
class Settings:
    """top: results of a query. owners: stages of the pipeline. block_postings, part_queries: what one cogroup holds at most, about; least_postings: a block's, below which more tasks do not get blocks of their own."""

    top: int = 10
    owners: int = 4
    block_postings: int = 250_000
    least_postings: int = 50_000
    part_queries: int = 500


def _counted(texts: DataFrame) -> DataFrame:
    """(row, id, n, term, tf) of each distinct term of (row, id, text as binary), and a row with the empty term for each text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(start, _TEXTS)
                terms, times, sizes, lengths = [], [], [], []
                for text in part.column("text").to_pylist():
                    words = text.translate(LOWER_WORDS).split() if text else []
                    found = dict.fromkeys(words, 0)
                    for word in words:
                        found[word] += 1
                    terms += [b"", *found]
                    times += [0, *found.values()]
                    sizes.append(len(found) + 1)
                    lengths.append(len(words))
                at = pa.array(np.repeat(np.arange(part.num_rows), sizes))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row").take(at), part.column("id").take(at), pa.array(lengths, pa.int64()).take(at), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())],
                    ["row", "id", "n", "term", "tf"],
                )

    return texts.mapInArrow(count, "row long, id long, n long, term string, tf long")


def _texts(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary")
    return df.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(id_column).cast("long"), F.lit(_NO_ID)).alias("id"), text.alias("text"))


def _owned(stats: DataFrame, owners: int) -> Column:
    """The owner of each term: equal shares of all postings, rare terms first; terms of like frequency are dealt by hash."""
    size = F.floor(F.log2("df")).cast("int")
    mass = {r.size: r.mass for r in stats.groupBy(size.alias("size")).agg(F.sum("df").alias("mass")).collect()}
    total, before, column = sum(mass.values()), 0, F.lit(0)
    # At most 63 sizes.
    for k in sorted(mass):
        share = (F.pmod(F.xxhash64("term"), F.lit(1000)) / 1000 * mass[k] + before) * owners / total
        column = F.when(size == k, share).otherwise(column)
        before += mass[k]
    return F.least(F.floor(column), F.lit(owners - 1)).cast("int")


def _stage(owner: int, settings: Settings) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Adds the contributions of an owner's postings to the bundles of one block."""
    top, last = settings.top, owner == settings.owners - 1

    def add(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        order = np.argsort(postings.column("term").to_numpy(), kind="stable")
        term, row, name, score = (postings.column(c).to_numpy()[order] for c in ("term", "row", "id", "score"))
        terms, firsts = np.unique(term, return_index=True)
        upto = np.append(firsts[1:], len(term))
        held = [np.concatenate([np.zeros(0, np.int64), *(v.values.to_numpy() for v in bundles.column(c) if v.is_valid)]) for c in ("rows", "ids", "scores")]
        sizes = np.array([len(v) for v in bundles.column("rows")], np.int64)
        rows, places = np.unique(np.concatenate([row, held[0]]), return_inverse=True)
        names = np.empty(len(rows), np.int64)
        names[places] = np.concatenate([name, held[1]])
        place, held_place = places[: len(row)], places[len(row) :]
        sums, at = np.zeros(len(rows), np.int64), 0
        out = []
        for wanted, size in zip(bundles.column("terms").to_pylist(), sizes, strict=True):
            touched = [held_place[at : at + size]]
            sums[touched[0]] += held[2][at : at + size]
            at += size
            for t in wanted:
                if t["owner"] == owner:
                    k = np.searchsorted(terms, t["term"])
                    if k < len(terms) and terms[k] == t["term"]:
                        touched.append(place[firsts[k] : upto[k]])
                        sums[touched[-1]] += score[firsts[k] : upto[k]]
            later = [t for t in wanted if t["owner"] > owner]
            found = np.unique(np.concatenate(touched)) if len(touched) > 1 else touched[0]
            totals = sums[found]
            sums[found] = 0
            if len(found) > top:
                enough = np.partition(totals, len(totals) - top)[len(totals) - top]
                kept = totals + sum(t["most"] for t in later) >= enough
                found, totals = found[kept], totals[kept]
            if last:
                best = np.lexsort((rows[found], names[found], -totals))[:top]
                found, totals = found[best], totals[best]
            out.append((later, rows[found], names[found], totals))
        whole = bundles.select(["block", "part", "query"])
        for k, c in enumerate(("terms", "rows", "ids", "scores")):
            whole = whole.append_column(c, pa.array([r[k] for r in out], bundles.schema.field(c).type))
        return whole

    return add


def ranked_search(
    docs: DataFrame,
    queries: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    query_id: str = "item_id",
    query_text: str = "text",
    settings: Settings | None = None,
) -> DataFrame:
    """The best documents of each row of queries: query id, rank, document id, score.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, A-Z lowered. A term's weight and a document's length
    norm are whole numbers (contract of the registered query). Equal scores are ordered by ascending document id, then by place in
    the table. Ids of documents are whole numbers; NULL ids come last and stay NULL (2^63-1 is kept for them). NULL and empty
    texts have no terms: such a document is never found and such a query finds nothing. Repeated rows are documents and queries of
    their own. Without documents or queries the result is empty; other columns are ignored.
    """
    settings = settings or Settings()
    spark = docs.sparkSession
    asked = queries.select(F.monotonically_increasing_id().alias("row"), F.col(query_id).alias("name"), F.coalesce(F.col(query_text).cast("string"), F.lit("")).cast("binary").alias("text"))
    asked = saved(asked.withColumn("id", F.lit(0).cast("long")), "search_queries")
    wanted = saved(_counted(asked.select("row", "id", "text")).where("term <> ''").select(F.col("row").alias("query"), "term"), "search_terms")
    # Written, so that its size is known: a small list is broadcast, a large one is not.
    vocabulary = saved(wanted.select("term").distinct().unionAll(spark.createDataFrame([("",)], "term string")), "search_vocabulary")
    hits = saved(_counted(_texts(docs, id_column, text_column)).join(vocabulary, "term", "left_semi"), "search_hits")

    every = hits.where("term = ''").agg(F.count_if(F.col("n") > 0).alias("n"), F.sum("n").alias("length")).first()
    n_docs, length = every.n, max(1, every.length or 0)
    norm = f"(10 + (90 * n * {n_docs}L) div {length}L)"
    # In thousandths of a thousandth; at most one million.
    postings = hits.where("term <> ''").selectExpr("term", "row", "id", f"(1000000000L * tf) div (1000L * tf + 8 * {norm}) AS share")
    stats = saved(postings.groupBy("term").agg(F.count("*").alias("df"), F.max("share").alias("most")), "search_counts")
    weight = F.floor(F.log((F.lit(2.0) * n_docs + 2) / (F.col("df") * 2.0 + 1)) * 1000)
    stats = stats.select(F.col("term").alias("word"), F.monotonically_increasing_id().alias("term"), "df", weight.alias("weight"), (weight * F.col("most")).alias("most"), _owned(stats, settings.owners).alias("owner"))
    stats = saved(stats.where("most > 0"), "search_weights")

    total, n_queries = stats.agg(F.sum("df")).first()[0] or 0, asked.count()
    blocks = max(1, min(parallelism(spark), total // settings.least_postings), -(-total // settings.block_postings))
    parts = max(1, -(-n_queries // settings.part_queries))
    listed = wanted.withColumnRenamed("term", "word").join(stats, "word").groupBy("query").agg(F.sort_array(F.collect_list(F.struct("owner", "term", "most"))).alias("terms"))
    none = F.array().cast("array<bigint>")
    bundles = listed.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int").alias("part"),
        "query",
        "terms",
        none.alias("rows"),
        none.alias("ids"),
        none.alias("scores"),
    )
    for owner in range(settings.owners):
        owned = stats.where(F.col("owner") == owner).select("word", F.col("term"), "weight")
        held = postings.withColumnRenamed("term", "word").join(owned, "word")
        held = held.select(
            F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"),
            (F.explode(F.sequence(F.lit(0), F.lit(parts - 1))) if parts > 1 else F.lit(0)).alias("part"),
            "term",
            "row",
            "id",
            (F.col("weight") * F.col("share")).alias("score"),
        ).where("score > 0")
        groups = bundles.groupBy("block", "part").cogroup(held.groupBy("block", "part"))
        bundles = groups.applyInArrow(_stage(owner, settings), bundles.schema)

    found = bundles.select("query", F.inline(F.arrays_zip("ids", "rows", "scores")))
    order = Window.partitionBy("query").orderBy(F.desc("scores"), "ids", "rows")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.top)
    named = best.join(asked.select(F.col("row").alias("query"), "name"), "query")
    return named.select(F.col("name").alias(query_id), "rank", F.when(F.col("ids") != _NO_ID, F.col("ids")).alias(id_column), F.col("scores").alias("score"))
