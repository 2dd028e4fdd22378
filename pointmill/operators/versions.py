"""Versioned tables as validity intervals.

A row belongs to versions valid_from <= v < valid_to; valid_to is NULL while
the row is current. Each change reads the table once and is narrow: no join,
no shuffle. Version numbers come from the caller, who is the only writer.

A chain of changes grows the plan, so a long-lived table is written out with
save_versions and read back with load_versions. That layout is partitioned by
the interval, which turns as-of reads into partition pruning. A save goes to a
new path; a path that is being read is never overwritten. An append needs no
save: append_saved adds a partition to what is there.
"""

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

INTERVAL = ["valid_from", "valid_to"]


def _opened(df: DataFrame, version: int) -> DataFrame:
    return df.withColumns({"valid_from": F.lit(version), "valid_to": F.lit(None).cast("int")})


def _matching(condition: Column) -> Column:
    """True for current rows where the condition is true; a NULL condition does not match."""
    return F.col("valid_to").isNull() & F.coalesce(condition, F.lit(False))


def create_version(df: DataFrame, version: int = 1) -> DataFrame:
    return _opened(df, version)


def append_version(table: DataFrame, rows: DataFrame, version: int) -> DataFrame:
    """Add rows; their columns are matched by name and cast to the table's types."""
    types = {f.name: f.dataType for f in table.schema.fields}
    typed = rows.select(*[F.col(c).cast(types[c]).alias(c) for c in rows.columns])
    return table.unionByName(_opened(typed, version))


def delete_where(table: DataFrame, condition: Column, version: int) -> DataFrame:
    """Close the current rows that match."""
    closed = F.when(_matching(condition), F.lit(version)).otherwise(F.col("valid_to"))
    return table.withColumn("valid_to", closed)


def update_where(table: DataFrame, condition: Column, sets: Mapping[str, Column], version: int) -> DataFrame:
    """Close the current rows that match and add their changed copies.

    Each matching row is turned into two by a generator, so the table is read once.
    sets names columns of the table other than the interval.
    """
    if unknown := set(sets) - (set(table.columns) - set(INTERVAL)):
        raise ValueError(f"not columns that an update can set: {', '.join(sorted(unknown))}")
    types = {f.name: f.dataType for f in table.schema.fields}
    closed = {"valid_to": F.lit(version)}
    changed = {"valid_from": F.lit(version), **sets}
    row = lambda new: F.struct(*[new.get(c, F.col(c)).cast(types[c]).alias(c) for c in table.columns])
    rows = F.when(_matching(condition), F.array(row(closed), row(changed))).otherwise(F.array(row({})))
    return table.select(F.inline(rows))


def replace_version(table: DataFrame, rows: DataFrame, version: int) -> DataFrame:
    """Put rows in place of everything current; earlier versions stay readable."""
    return append_version(delete_where(table, F.lit(True), version), rows, version)


def in_version(version: int | Column) -> Column:
    """Condition: the row belongs to the version."""
    return (F.col("valid_from") <= version) & (F.col("valid_to").isNull() | (F.col("valid_to") > version))


def as_of_version(table: DataFrame, version: int, commits: DataFrame | None = None) -> DataFrame:
    """The rows of a version. With commits, one row per version, an unknown version is an error."""
    if commits is not None and commits.where(F.col("version") == version).isEmpty():
        raise ValueError(f"no version {version}")
    return table.where(in_version(version)).drop(*INTERVAL)


def current(table: DataFrame) -> DataFrame:
    return table.where(F.col("valid_to").isNull()).drop(*INTERVAL)


def version_at(commits: DataFrame, timestamp: str | Column) -> int:
    """The latest version committed at or before a time, a text or a Column such as
    current_timestamp() - INTERVAL 5 MINUTES. commits has one row per version.
    """
    at = F.lit(timestamp).cast(commits.schema["committed_at"].dataType)
    version = commits.where(F.col("committed_at") <= at).agg(F.max("version")).first()[0]
    if version is None:
        raise ValueError(f"no version at or before {timestamp}")
    return version


def as_of_timestamp(table: DataFrame, commits: DataFrame, timestamp: str | Column) -> DataFrame:
    return as_of_version(table, version_at(commits, timestamp))


def snapshots(table: DataFrame, commits: DataFrame) -> DataFrame:
    """Every version with its parent and a summary map of records added, deleted and held.

    commits: version, operation, committed_at. The table is counted in one
    pass with a map-side combine; the running total sees one row per version.
    A version that the table holds but commits does not has no operation and time.
    """
    ends = F.array(
        F.struct(F.col("valid_from").alias("version"), F.lit(1).alias("added"), F.lit(0).alias("deleted")),
        F.struct(F.col("valid_to").alias("version"), F.lit(0).alias("added"), F.lit(1).alias("deleted")),
    )
    counts = (
        table.select(*INTERVAL)
        .groupBy(*INTERVAL)
        .agg(F.count("*").alias("n"))
        .select("n", F.inline(ends))
        .where(F.col("version").isNotNull())
        .groupBy("version")
        .agg(F.sum(F.col("added") * F.col("n")).alias("added"), F.sum(F.col("deleted") * F.col("n")).alias("deleted"))
    )
    by_version = Window.orderBy("version")
    number = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    known = commits.join(counts, "version", "full").withColumns({c: number(c) for c in ("added", "deleted")})
    total = F.sum(F.col("added") - F.col("deleted")).over(by_version)
    text = lambda c: c.cast("string")
    return known.select(
        "version",
        F.lag("version").over(by_version).alias("parent"),
        "operation",
        "committed_at",
        F.create_map(
            F.lit("added-records"), text(F.col("added")),
            F.lit("deleted-records"), text(F.col("deleted")),
            F.lit("total-records"), text(total),
        ).alias("summary"),
    )


_COMMIT = "version int, operation string, committed_at timestamp_ntz"


def record_commits(spark: SparkSession, path: str, commits: Sequence[tuple[int, str, datetime]]) -> None:
    """Add versions to the commits kept as Parquet under path: version, operation, time. Versions have one writer."""
    spark.createDataFrame(commits, _COMMIT).coalesce(1).write.mode("append").parquet(path)


def record_commit(spark: SparkSession, path: str, version: int, operation: str, committed_at: datetime) -> None:
    record_commits(spark, path, [(version, operation, committed_at)])


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_COMMIT).parquet(path)


def history(commits: DataFrame) -> DataFrame:
    """Which version became current when, oldest first."""
    return commits.select(
        F.col("committed_at").alias("made_current_at"),
        "version",
        F.lag("version").over(Window.orderBy("version")).alias("parent"),
    ).orderBy("made_current_at")


def version_log(table: DataFrame, commits: DataFrame) -> DataFrame:
    """snapshots() with the summary as columns, oldest first."""
    record = lambda name: F.col("summary")[f"{name}-records"].cast("long").alias(name)
    return (
        snapshots(table, commits)
        .select("version", "parent", "operation", "committed_at", record("added"), record("deleted"), record("total"))
        .orderBy("committed_at")
    )


def version_bounds(log: DataFrame) -> DataFrame:
    """The first and the latest version."""
    row = F.struct(*log.columns)
    ends = log.agg(F.min_by(row, "committed_at").alias("first"), F.max_by(row, "committed_at").alias("latest"))
    bound = lambda name: F.struct(F.lit(name).alias("bound"), *[F.col(name)[c].alias(c) for c in log.columns])
    return ends.select(F.inline(F.array(bound("first"), bound("latest"))))


def compare_versions(table: DataFrame, a: int, b: int) -> DataFrame:
    """Row counts of two versions and of the current table, in one pass."""
    return table.agg(
        F.count_if(in_version(a)).alias("count_a"),
        F.count_if(in_version(b)).alias("count_b"),
        F.count_if(F.col("valid_to").isNull()).alias("count_current"),
    )


def commits_path(path: str) -> str:
    """Where a saved table keeps its commits: beside its rows, hidden from who reads these."""
    return f"{path.rstrip('/')}/_commits"


def save_versions(table: DataFrame, path: str, commits: DataFrame | None = None) -> None:
    """Write the table to a new path, partitioned by the interval, and its commits beside it."""
    table.hint("rebalance", *[F.col(c) for c in INTERVAL]).write.partitionBy(*INTERVAL).parquet(path)
    if commits is not None:
        commits.select("version", "operation", F.col("committed_at").cast("timestamp_ntz")).coalesce(1).write.parquet(commits_path(path))


def append_saved(rows: DataFrame, path: str, version: int, committed_at: datetime | None = None) -> None:
    """Append to a saved table: writes the new rows only, into their own partition.

    Columns are matched by name and cast to the saved types; the saved columns must all be there and no others.
    With committed_at, the version is then added to the commits beside the table.
    """
    saved = [f for f in load_versions(rows.sparkSession, path).schema if f.name not in INTERVAL]
    if {f.name for f in saved} != set(rows.columns) or len(rows.columns) != len(saved):
        raise ValueError(f"the columns are not those of the saved table: {', '.join(rows.columns)}")
    typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in saved])
    _opened(typed, version).write.mode("append").partitionBy(*INTERVAL).parquet(path)
    if committed_at is not None:
        record_commit(rows.sparkSession, commits_path(path), version, "append", committed_at)


def saved_commits(spark: SparkSession, path: str) -> DataFrame:
    return read_commits(spark, commits_path(path))


def as_of_saved(spark: SparkSession, path: str, version: int) -> DataFrame:
    """The rows of a version of a saved table; a version that the commits beside it do not name is an error."""
    return as_of_version(load_versions(spark, path), version, saved_commits(spark, path))


def as_of_saved_timestamp(spark: SparkSession, path: str, timestamp: str | Column) -> DataFrame:
    return as_of_timestamp(load_versions(spark, path), saved_commits(spark, path), timestamp)


def load_versions(spark: SparkSession, path: str) -> DataFrame:
    table = spark.read.parquet(path)
    # While every row is current, valid_to has no value to infer its type from.
    return table.withColumns({c: F.col(c).cast("int") for c in INTERVAL})
