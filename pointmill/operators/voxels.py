"""Voxel aggregation.

The majority vote is taken in two stages: points are first counted per (voxel,
label), then the label rows of a voxel are merged. Both stages are plain hash
aggregates with a map-side combine, so a voxel that holds a large share of all
points reaches the shuffle as at most one row per (input task, label).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointmill.functions.columns import majority
from pointmill.operators.points import voxel_keys
from pointmill.schema import VOXEL, VOXEL_ML_FEATURES

_AVERAGED = ["intensity", "red", "green", "blue"]


def _mean(name: str) -> Column:
    return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))


def voxelize(points: DataFrame, size: float = 1.0) -> DataFrame:
    """One row per voxel: mean intensity, majority label, point count, mean colours as whole numbers."""
    partial = [f(c).alias(f"{c}_{s}") for c in _AVERAGED for f, s in ((F.sum, "sum"), (F.count, "n"))]
    votes = voxel_keys(points, size).groupBy(*VOXEL, "label").agg(F.count("*").alias("n"), *partial)
    return votes.groupBy(*VOXEL).agg(
        _mean("intensity").alias("avg_intensity"),
        majority(F.col("label"), F.col("n")).alias("majority_label"),
        F.sum("n").alias("point_count"),
        *[_mean(c).cast("int").alias(f"avg_{c}") for c in ("red", "green", "blue")],
    )


def majority_label(points: DataFrame, size: float = 1.0) -> DataFrame:
    """Majority label and point count per voxel."""
    votes = voxel_keys(points, size).groupBy(*VOXEL, "label").agg(F.count("*").alias("n"))
    return votes.groupBy(*VOXEL).agg(
        majority(F.col("label"), F.col("n")).alias("majority_label"),
        F.sum("n").alias("point_count"),
    )


def voxel_features(points: DataFrame, size: float = 1.0) -> DataFrame:
    """Mean position, intensity, brightness and colour shares per voxel.

    Sums are divided once at the end, so whole-number colour sums stay exact.
    """
    axis_id = [F.coalesce(F.col(key).cast("string"), F.lit("?")) for key in VOXEL]
    return (
        voxel_keys(points, size)
        .groupBy(*VOXEL)
        .agg(
            *[F.avg(c).alias(f"mean_{c}") for c in ("x", "y", "z", "intensity")],
            (F.avg(F.col("red") + F.col("green") + F.col("blue")) / 3).alias("mean_brightness"),
            *[(F.avg(c) / 255).alias(f"mean_{c}_norm") for c in ("blue", "green", "red")],
        )
        .select(
            F.concat_ws("_", *axis_id).alias("voxel_id"),
            "mean_x",
            "mean_y",
            "mean_z",
            "mean_intensity",
            "mean_brightness",
            "mean_blue_norm",
            "mean_green_norm",
            "mean_red_norm",
        )
    )


def ml_features(voxels: DataFrame) -> DataFrame:
    """The classifier's inputs and target. Left out: voxel_x, voxel_y, so it cannot learn places."""
    return voxels.select(*VOXEL_ML_FEATURES, "majority_label")
