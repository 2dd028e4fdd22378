"""Point, prediction and metric views over the given tables.

There is no point cloud among the tables, so points are a projection of
lineitem. Coordinates and intensities are multiples of 1/8, 1/16 and 1/1024:
their sums are exact in any order, so means can be compared unrounded.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointmill.operators.points import clean
from pointmill.operators.series import Slices, plan_slices, running_total
from pointmill.operators.voxels import voxel_features, voxelize
from pointmill.workspace import file_system

def point_columns(hundredths: str) -> dict[str, str]:
    """SQL of each point column; hundredths is a template that turns {} into a whole number of hundredths."""
    discount, tax = hundredths.format("l_discount"), hundredths.format("l_tax")
    return {
        "x": f"l_quantity + {discount} / 16",
        "y": f"(l_partkey % 40) + {tax} / 8",
        "z": f"(l_suppkey % 10) - 5 + {discount} / 16",
        "red": "CAST(l_partkey % 256 AS INT)",
        "green": "CAST(l_orderkey % 256 AS INT)",
        "blue": "CAST(l_suppkey % 256 AS INT)",
        "intensity": "CAST(floor(l_extendedprice) AS DOUBLE) / 1024",
        "timestamp": "CAST(l_orderkey AS DOUBLE)",
        "scan_angle": "CAST((l_orderkey % 61) - 30 AS DOUBLE)",
        "label": "l_linenumber - 1",
    }


def raw_columns(hundredths: str) -> dict[str, str]:
    """The same points as a scanner file names and types them; the label has a fraction to cut off."""
    point = point_columns(hundredths)
    return {
        **{c: point[c] for c in "xyz"},
        "red": "CAST(l_partkey % 256 AS SMALLINT)",
        "green": "CAST(l_orderkey % 256 AS SMALLINT)",
        "blue": "CAST(l_suppkey % 256 AS SMALLINT)",
        "scalar_Intensity": point["intensity"],
        "scalar_GPSTime": point["timestamp"],
        "scalar_ScanAngleRank": point["scan_angle"],
        "scalar_Label": "CAST(l_linenumber - 1 AS FLOAT) + CAST(0.25 AS FLOAT)",
    }


# Neither is negative, so this is round() without its BigDecimal.
HUNDREDTHS = "floor({} * 100 + 0.5)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS {c}" for c, e in point_columns(HUNDREDTHS).items()])


def as_raw_points(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(*[f"{e} AS {c}" for c, e in raw_columns(HUNDREDTHS).items()])


def raw_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_raw_points(table(spark, sf_dir, "lineitem"))


def clean_voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxelize(clean(points(spark, sf_dir)))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxel_features(points(spark, sf_dir))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Voxels with a label guessed from intensity by a fixed rule."""
    return clean_voxels(spark, sf_dir).selectExpr(
        "majority_label AS label", "CAST(floor(avg_intensity) % 6 + 1 AS INT) AS predicted"
    )


def metrics(spark: SparkSession, sf_dir: str, window_seconds: float) -> tuple[DataFrame, Slices]:
    """Samples of one gauge and one wrapping counter per (instance, mode), and the slices to process them with."""
    events = table(spark, sf_dir, "events")
    samples = events.selectExpr(
        "CAST(user_id % 4 AS INT) AS instance",
        "event_type AS mode",
        "event_id",
        "ts AS sample_ts",
        "CAST(round(value * 100) AS BIGINT) AS step",
        "value AS gauge",
    )
    slices = plan_slices(samples, ["instance", "mode"], "sample_ts", "event_id", back=window_seconds)
    total = running_total(samples, ["instance", "mode"], "sample_ts", "event_id", "step", "total", slices)
    return total.withColumn("counter", F.col("total") % 500000).drop("step", "total"), slices


_FILE_DTYPE = np.dtype(
    [("x", "<f8"), ("y", "<f8"), ("z", "<f8"), ("red", "u1"), ("green", "u1"), ("blue", "u1")]
    + [(name, "<f8") for name in ("scalar_Intensity", "scalar_GPSTime", "scalar_ScanAngleRank")]
    + [("scalar_Label", "<f4")]
)
_PLY_NAMES = {"f8": "double", "f4": "float", "u1": "uchar"}


_ROWS_PER_FILE = 1_000_000


def write_ply_files(raw: DataFrame, path: str, ascii: bool = False) -> None:
    """Write raw points as PLY files, binary or ascii, for the scan to read. path has a scheme.

    A task holds no more rows than go into one file, as the header wants their count.
    """
    dtype, names, rows_per_file = _FILE_DTYPE, _PLY_NAMES, _ROWS_PER_FILE
    form = "ascii" if ascii else "binary_little_endian"
    properties = "".join(f"property {names[dtype[c].str[1:]]} {c}\n" for c in dtype.names)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        files, root = file_system(path)
        files.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        held, count, number = [], 0, 0

        def flush() -> pa.RecordBatch:
            header = f"ply\nformat {form} 1.0\nelement vertex {count}\n{properties}end_header\n"
            # A retried task writes the same name again.
            with files.open_output_stream(f"{root}/part-{part:05d}-{number:05d}.ply") as out:
                out.write(header.encode())
                for rows in held:
                    text = ascii and "".join(" ".join(map(repr, row)) + "\n" for row in rows.tolist())
                    out.write(text.encode() if ascii else rows.tobytes())
            return pa.RecordBatch.from_pydict({"written": [count]})

        for batch in batches:
            rows = np.empty(batch.num_rows, dtype=dtype)
            for name in dtype.names:
                rows[name] = batch.column(name).to_numpy(zero_copy_only=False)
            held.append(rows)
            count += len(rows)
            if count >= rows_per_file:
                yield flush()
                held, count, number = [], 0, number + 1
        if held:
            yield flush()

    raw.mapInArrow(write, "written long").agg(F.sum("written")).collect()
