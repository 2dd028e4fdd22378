"""Point-level projections and filters. All narrow: no shuffle."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointmill.functions.columns import nearest_int
from pointmill.schema import CORRUPT, PLY_PROPERTIES, POINT, POINT_OR_CORRUPT, VOXEL


def normalize_points(raw: DataFrame, mapping: Mapping[str, str] = PLY_PROPERTIES) -> DataFrame:
    """Rename raw properties and cast them to the point types; casts to int cut off fractions."""
    types = {f.name: f.dataType for f in POINT.fields}
    return raw.select(*[F.col(src).try_cast(types[dst]).alias(dst) for src, dst in mapping.items()])


def clean(points: DataFrame, label: str = "label", noise: int = 0) -> DataFrame:
    """Drop noise points. A NULL label is dropped too, as SQL `label <> 0` does."""
    return points.where(F.col(label) != noise)


def voxel_keys(points: DataFrame, size: float = 1.0) -> DataFrame:
    """Add the index of the cube, centred on a multiple of size, that holds each point.

    Coordinates with no int index (NaN, NULL, too far out) get a NULL key.
    """
    if size <= 0:
        raise ValueError("voxel size must be above 0")
    axes = {key: F.col(axis) if size == 1 else F.col(axis) / F.lit(float(size)) for key, axis in zip(VOXEL, "xyz")}
    return points.withColumns({key: nearest_int(value) for key, value in axes.items()})


def to_messages(points: DataFrame, column: str = "value") -> DataFrame:
    """Each row as one JSON text."""
    return points.select(F.to_json(F.struct("*")).alias(column))


def from_messages(messages: DataFrame, column: str = "value", keep_corrupt: bool = False) -> DataFrame:
    """Decode JSON texts to points.

    A field of the wrong type becomes NULL, a text that is no JSON becomes all
    NULL; keep_corrupt adds a column with the text of such records.
    """
    schema = POINT_OR_CORRUPT if keep_corrupt else POINT
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    point = F.from_json(F.col(column).cast("string"), schema, options)
    return messages.select(point.alias("point")).select("point.*")


def global_shift(points: DataFrame, step: float = 1000.0) -> DataFrame:
    """Move a cloud near the origin by the largest multiple of step below each axis minimum."""
    low = [(F.floor(F.min(axis) / F.lit(step)) * F.lit(step)).alias(axis) for axis in "xyz"]
    offset = points.agg(F.struct(*low)).scalar()
    return points.withColumns({axis: F.col(axis) - offset[axis] for axis in "xyz"})
