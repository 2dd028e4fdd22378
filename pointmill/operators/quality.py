"""Checks of labels and predictions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointmill.schema import VOXEL


def with_class_names(df: DataFrame, classes: DataFrame, label: str = "label") -> DataFrame:
    """Add class_name from (label, class_name). Labels without a name are kept.

    No broadcast hint: Spark broadcasts the dictionary when its measured size
    is under spark.sql.autoBroadcastJoinThreshold.
    """
    names = classes.select(F.col("label").alias(label), "class_name")
    return df.join(names, label, "left")


def overlay(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """Voxels whose true and predicted labels differ. Both inputs: voxel keys and majority_label.

    Voxels of points without a place (NULL keys) match nothing. Two voxel
    tables fresh from their aggregates are already hashed on the keys, so the
    join adds no shuffle.
    """
    left = truth.select(*VOXEL, F.col("majority_label").alias("label"))
    right = predicted.select(*VOXEL, F.col("majority_label").alias("predicted"))
    return left.join(right, VOXEL).where(F.col("label") != F.col("predicted"))


def confusion(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Row counts per (label, predicted)."""
    return df.groupBy(F.col(label).alias("label"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def accuracy(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Rows, right rows and their share. Rows without a label or prediction count as wrong."""
    right = F.count_if(F.col(label) == F.col(predicted))
    return df.agg(
        F.count("*").alias("n"),
        right.alias("correct"),
        F.try_divide(right, F.count("*")).alias("accuracy"),
    )


def class_report(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Precision, recall, F1 and support per class; a share of nothing is 0.

    Rows are counted into the confusion table first, so the rest runs on one
    row per pair of classes.
    """
    hit = F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), none.alias("found"), hit.alias("hits")),
        F.struct(F.col("predicted").alias("class"), none.alias("support"), F.col("n").alias("found"), none.alias("hits")),
    )
    totals = (
        confusion(df, label, predicted)
        .select(F.inline(sides))
        .where(F.col("class").isNotNull())
        .groupBy(F.col("class").alias("label"))
        .agg(*[F.sum(c).alias(c) for c in ("support", "found", "hits")])
    )
    share = lambda part, whole: F.coalesce(F.try_divide(part, whole), F.lit(0.0))
    return totals.select(
        "label",
        share(F.col("hits"), F.col("found")).alias("precision"),
        share(F.col("hits"), F.col("support")).alias("recall"),
        share(2 * F.col("hits"), F.col("found") + F.col("support")).alias("f1"),
        "support",
    )
