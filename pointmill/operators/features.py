"""Feature preparation for the voxel classifier."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointmill.functions.columns import bucket
from pointmill.schema import VOXEL

SCALED = "_scaled"


def scale(df: DataFrame, columns: Sequence[str], fit_on: Column | None = None) -> DataFrame:
    """Add <column>_scaled, shifted and scaled to mean 0 and population deviation 1.

    The moments come from the rows where fit_on is true, all rows when it is not given. They are
    one row of a single aggregate over df itself, used as a scalar subquery, so df's own shuffle
    serves both. A column without variance becomes 0; NULL stays NULL.
    """
    fitted = lambda c: F.col(c) if fit_on is None else F.when(fit_on, F.col(c))
    moments = df.agg(
        F.struct(
            *[F.avg(fitted(c)).alias(f"{c}_mean") for c in columns],
            *[F.stddev_pop(fitted(c)).alias(f"{c}_std") for c in columns],
        )
    ).scalar()

    def scaled(c: str) -> Column:
        centred, std = F.col(c) - moments[f"{c}_mean"], moments[f"{c}_std"]
        return F.when(std > 0, centred / std).when(F.col(c).isNotNull(), F.lit(0.0))

    return df.withColumns({f"{c}{SCALED}": scaled(c) for c in columns})


def label_classes(df: DataFrame, label: str = "label") -> list[int]:
    """The distinct labels in ascending order, for what needs one column or output for each."""
    return sorted(row[0] for row in df.where(F.col(label).isNotNull()).select(label).distinct().collect())


def label_dictionary(df: DataFrame, label: str = "label", out: str = "label_index") -> DataFrame:
    """(label, label_index): the distinct labels numbered from 0 in ascending order, NULL left out. A table to keep for later data.

    Only the distinct labels, a row each, meet in one window.
    """
    distinct = df.where(F.col(label).isNotNull()).select(label).distinct()
    return distinct.withColumn(out, F.row_number().over(Window.orderBy(label)) - 1)


def encode_labels(
    df: DataFrame, labels: DataFrame | Sequence[int], label: str = "label", out: str = "label_index", of: str | None = None
) -> DataFrame:
    """Add the number of the label in labels; NULL if it is not there.

    labels: a label_dictionary, or the sorted labels themselves. of: their column in the dictionary, if not label.
    """
    if isinstance(labels, DataFrame):
        numbers = labels.select(F.col(of or label).alias("_known"), F.col(out).alias("_number"))
        return df.join(numbers, F.col(label) == F.col("_known"), "left").withColumn(out, F.col("_number")).drop("_known", "_number")
    place = F.array_position(F.array(*[F.lit(c) for c in labels]), F.col(label))
    return df.withColumn(out, F.when(place > 0, (place - 1).cast("int")))


def one_hot(df: DataFrame, classes: Sequence[int], index: str = "label_index", prefix: str = "class_") -> DataFrame:
    """Add one 0/1 column per class."""
    return df.withColumns(
        {f"{prefix}{i}": F.coalesce(F.col(index) == i, F.lit(False)).cast("int") for i in range(len(classes))}
    )


def with_split(df: DataFrame, test_share: float = 0.2, buckets: int = 10) -> DataFrame:
    """Add is_test, drawn from the voxel key: the same rows under any partitioning and on any retry."""
    return df.withColumn("is_test", bucket(*[F.col(k) for k in VOXEL], buckets) < round(test_share * buckets))


def split(df: DataFrame, test_share: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Train and test rows."""
    marked = with_split(df, test_share)
    return marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test")
