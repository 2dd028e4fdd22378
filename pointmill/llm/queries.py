"""The registered queries: each operator over its whole table, with production parameters."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pointmill.llm import arc, bitpack, decontaminate, fingerprints, license_join, metric_join, ngram_join, packing, quality, ranked_search, secret_ledger, spelling, token_counts
from pointmill.plans.views import table
from pointmill.workspace import scratch_path


def op1_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_ledger.secret_scan(table(spark, sf_dir, "documents"), scratch_path(spark, "ledger")).drop("blob")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces_report(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_metric_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.range_join(table(spark, sf_dir, "embeddings"))


def op4_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_join.license_scan(table(spark, sf_dir, "documents"))


def op5_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc.round_trip(table(spark, sf_dir, "pages")).drop("url", "date")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitpack.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_join.jaccard_join(table(spark, sf_dir, "documents"), settings=ngram_join.Settings(n=3, percent=90))
    return joined.select("doc_id", "n_shingles", "component_id", "n_links")


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_report(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_ledger": op1_secret_ledger,
    "op2_packing": op2_packing,
    "op3_metric_range_join": op3_metric_range_join,
    "op4_license_join": op4_license_join,
    "op5_arc_to_warc": op5_arc_to_warc,
    "op6_token_counts": op6_token_counts,
    "op7_bit_packing": op7_bit_packing,
    "op8_quality_scores": op8_quality_scores,
    "op9_decontamination": op9_decontamination,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_fingerprints": op11_fingerprints,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_ranked_search": op13_ranked_search,
}
