"""Schemas and fixed column names."""

from pyspark.sql import types as T

# Columns and types of points, of voxel keys and of the classifier's inputs.
POINT = T.StructType(
    [
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
        T.StructField("z", T.DoubleType()),
        T.StructField("red", T.IntegerType()),
        T.StructField("green", T.IntegerType()),
        T.StructField("blue", T.IntegerType()),
        T.StructField("intensity", T.DoubleType()),
        T.StructField("timestamp", T.DoubleType()),  # GPS seconds, not a calendar time
        T.StructField("scan_angle", T.DoubleType()),
        T.StructField("label", T.IntegerType()),
    ]
)

# Holds the raw text of a JSON record that did not parse cleanly.
CORRUPT = "_corrupt"
POINT_OR_CORRUPT = T.StructType([*POINT.fields, T.StructField(CORRUPT, T.StringType())])

# Vertex property name in a PLY file -> point column.
PLY_PROPERTIES = {
    "x": "x",
    "y": "y",
    "z": "z",
    "red": "red",
    "green": "green",
    "blue": "blue",
    "scalar_Intensity": "intensity",
    "scalar_GPSTime": "timestamp",
    "scalar_ScanAngleRank": "scan_angle",
    "scalar_Label": "label",
}

VOXEL = ["voxel_x", "voxel_y", "voxel_z"]

VOXEL_ML_FEATURES = [
    "voxel_z",
    "avg_intensity",
    "point_count",
    "avg_red",
    "avg_green",
    "avg_blue",
]
