"""Corpus pipeline: documents in, packed training sequences out.

Each stage reads what the one before has written. run() writes each stage to the shared
scratch folder, so a lost executor costs one stage's tasks at most.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pointmill.llm import decontaminate, ngram_join, packing, quality, secret_ledger
from pointmill.llm.common import saved
from pointmill.plans.views import table
from pointmill.workspace import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; labels of the documents that are left teach it."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard index of 0.8 on five-word n-grams: the smallest doc_id."""
    return ngram_join.drop_duplicates(docs, settings=ngram_join.Settings(n=5, percent=80))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than 5 % stands in windows of benchmark items."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by the name of their kind; n_chars follows the text."""
    clean = secret_ledger.redact(docs, scratch_path(spark, "ledger"))
    return clean.selectExpr("doc_id", "text", "lang", "source", "CAST(length(text) AS BIGINT) AS n_chars")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of 2048 tokens, with their ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).drop("row")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secret_stage),
    ("packing", packing_stage),
]

#: A trained classifier and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
