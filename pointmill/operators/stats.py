"""Statistics, filters and samples over point and voxel tables."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def above(df: DataFrame, column: str, threshold: float) -> DataFrame:
    return df.where(F.col(column) > threshold)


def band(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows with low <= column <= high."""
    return df.where(F.col(column).between(low, high))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.countDistinct(column).alias(f"distinct_{column}"))


def summary(df: DataFrame, column: str) -> DataFrame:
    """Minimum, maximum and mean of a column."""
    return df.agg(*[f(column).alias(f"{p}_{column}") for f, p in ((F.min, "min"), (F.max, "max"), (F.avg, "avg"))])


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("row_count"))


def first_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first n rows in a stated order: a top-n per task, then one merge.

    What is left is one partition anyway; coalesce(1) moves nothing, but keeps
    later projections from getting between the sort and the limit, which would
    turn the top-n into a full sort.
    """
    return df.orderBy(*order).limit(n).coalesce(1)


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, non-NULL rows and, for numbers, the range. One pass."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    nothing = F.lit(None).cast("double")
    aggregates = [F.count("*").alias("row_count")]
    for i, name in enumerate(df.columns):
        aggregates.append(F.count(name).alias(f"non_null_{i}"))
        if name in numeric:
            aggregates.append(F.min(name).cast("double").alias(f"min_{i}"))
            aggregates.append(F.max(name).cast("double").alias(f"max_{i}"))
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("row_count"),
            F.col(f"non_null_{i}").alias("non_null"),
            (F.col(f"min_{i}") if f.name in numeric else nothing).alias("min_value"),
            (F.col(f"max_{i}") if f.name in numeric else nothing).alias("max_value"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def counted(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """df, and an observation that holds the named counts of its rows once an action has gone through them."""
    seen = Observation()
    return df.observe(seen, *[c.alias(name) for name, c in counts.items()]), seen


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Stop on an empty input. Reads until the first row is found, not the whole input."""
    if df.isEmpty():
        raise ValueError(f"no rows in {what}")
    return df
