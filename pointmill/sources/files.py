"""File and table sources and sinks. Paths may be on any file system Spark is set up for."""

import json
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pointmill.operators.points import clean, to_messages
from pointmill.operators.stats import counted
from pointmill.schema import CORRUPT, POINT, POINT_OR_CORRUPT
from pointmill.workspace import hadoop, qualified


def read_points_json(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """JSON points with the fixed schema, so no inference pass.

    A folder written by the streaming sink is read through its commit log, so
    files of an unfinished batch are not seen; hidden files never are.
    """
    schema = POINT_OR_CORRUPT if keep_corrupt else POINT
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def clean_intake(spark: SparkSession, source: str, target: str) -> dict[str, int]:
    """Clean JSON points into Parquet, in place of target, and return how many records were read, corrupt and kept: one pass over the input.

    An input without records is an error, found by the same pass; target stays as it was then.
    """
    read = read_points_json(spark, source, keep_corrupt=True)
    read, before = counted(read, records=F.count(F.lit(1)), corrupt=F.count(CORRUPT))
    kept, after = counted(clean(read).select(*POINT.names), kept=F.count(F.lit(1)))
    staged = f"{target.rstrip('/')}.new-{uuid4().hex}"
    kept.write.parquet(staged)
    # An input without files leaves nothing to observe.
    found = {"records": 0, "corrupt": 0, "kept": 0} | before.get | after.get
    files, new = hadoop(spark, staged)
    if not found["records"]:
        files.delete(new, True)
        raise ValueError(f"no records in {source}")
    old = hadoop(spark, target)[1]
    files.delete(old, True)
    files.rename(new, old)
    return found


def read_parquet_glob(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """The files of a folder whose names match; the executors read them in parallel."""
    return spark.read.option("pathGlobFilter", glob).parquet(path)


def query_files(spark: SparkSession, select: str, path: str, fmt: str = "parquet", rest: str = "") -> DataFrame:
    """SQL straight over files: SELECT <select> FROM <fmt>.`<path>` <rest>."""
    return spark.sql(f"SELECT {select} FROM {fmt}.`{path}` {rest}")


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path, size and time of the files of a folder whose names match, hidden ones left out; no content is read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return found.select(
        F.col("path").alias("file_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("modified_at")
    )


def file_inventory(df: DataFrame) -> DataFrame:
    """The files a DataFrame reads, with size, time and row count. Hidden files are not listed."""
    return df.groupBy(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    ).agg(F.count("*").alias("row_count"))


def tree_inventory(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """The files of every dataset, a folder under root: dataset, file_path, file_size, row_count, skipped.

    Sizes come from the listing, row counts from the files' metadata, so no values are read. Hidden files of a dataset are
    shown as skipped, without a row count; those that no reader sees and that may hold unfinished rows. Folders within a
    dataset are listed with it.
    """
    root = qualified(spark, root)
    place = F.substring_index(F.substring("file_path", len(root) + 2, 1 << 30), "/", 1)
    every = {"recursiveFileLookup": "true", "pathGlobFilter": f"*.{fmt}"}
    listed = spark.read.format("binaryFile").options(**every).load(root).select("_metadata.file_path", "_metadata.file_size")
    # A column that no file has: only the number of rows is asked of each file.
    counted_rows = spark.read.schema("_none string").format(fmt).options(**every).load(root).groupBy("_metadata.file_path").agg(F.count("*").alias("row_count"))
    seen = listed.join(counted_rows.withColumnRenamed("file_path", "_counted"), F.col("file_path") == F.col("_counted"), "left")
    files, below = hadoop(spark, f"{root}/*/[._]*")
    hidden = [(f.getPath().toString(), f.getLen()) for f in files.globStatus(below) or [] if not f.isDirectory()]
    skipped = spark.createDataFrame(hidden, "file_path string, file_size long")
    # Both ways of writing a local path name the same file; only Spark's metadata escape it.
    plain = lambda path: F.regexp_replace(path, "^file:/+", "file:/")
    decoded = F.url_decode(F.replace("file_path", F.lit("+"), F.lit("%2B")))
    rows = seen.select(plain(decoded).alias("file_path"), "file_size", F.coalesce("row_count", F.lit(0).cast("long")).alias("row_count"), F.lit(False).alias("skipped"))
    rows = rows.unionAll(skipped.select(plain(F.col("file_path")), "file_size", F.lit(None).cast("long"), F.lit(True)))
    return rows.select(place.alias("dataset"), "file_path", "file_size", "row_count", "skipped")


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One file per task. Bringing everything into a single file would be a single task."""
    df.write.mode(mode).parquet(path)


def write_compacted(df: DataFrame, path: str, max_records: int, fmt: str = "parquet") -> None:
    """Rewrite with even files: AQE merges small and splits large shuffle partitions, max_records rolls files."""
    df.hint("rebalance").write.option("maxRecordsPerFile", max_records).format(fmt).save(path)


_PLAN = "_compaction"


def _finish_compaction(spark: SparkSession, path: str) -> None:
    """Put the files of a written plan in place and drop those they replace; repeating any part of it changes nothing."""
    files, plan = hadoop(spark, f"{path}/{_PLAN}/plan.json")
    if not files.exists(plan):
        return
    (text,) = [r.value for r in spark.read.text(plan.toString(), wholetext=True).collect()]
    steps = json.loads(text)
    at = lambda name: hadoop(spark, name)[1]
    for name in steps["old"]:
        files.delete(at(name), False)
    for name in steps["new"]:
        if files.exists(at(f"{path}/{_PLAN}/rows/{name}")):
            files.rename(at(f"{path}/{_PLAN}/rows/{name}"), at(f"{path}/{name}"))
    files.delete(at(f"{path}/{_PLAN}"), True)


def compact_files(spark: SparkSession, path: str, target_bytes: int, max_records: int = 0) -> None:
    """Merge the Parquet files of a folder that are smaller than target_bytes into files of about that size; the others stay.

    Small files are put together in the order of their names until a group is full, and a task rewrites a group; with
    max_records its file is rolled. The new files are complete before the first old one goes, and a run that was
    interrupted is finished by the next. Nobody may read or write the folder meanwhile. For folders without partitions.
    """
    path = qualified(spark, path).rstrip("/")
    _finish_compaction(spark, path)
    files, staging = hadoop(spark, f"{path}/{_PLAN}")
    files.delete(staging, True)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("_metadata.file_path", "_metadata.file_size")
    small = listed.where(F.col("file_size") < target_bytes)
    # One small row for each file.
    before = F.sum("file_size").over(Window.orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1))
    groups = small.select("file_path", F.floor(F.coalesce(before, F.lit(0)) / target_bytes).alias("full"))
    groups = groups.select("file_path", (F.dense_rank().over(Window.orderBy("full")) - 1).alias("group"), F.count("*").over(Window.partitionBy("full")).alias("n"))
    chosen = groups.collect()
    names = [r.file_path for r in chosen if r.n > 1]
    if not names:
        return
    table = spark.read.parquet(path)
    rows = spark.read.schema(table.schema).parquet(*names).select("*", F.col("_metadata.file_path").alias("_file"))
    # As long as the listing, which the driver holds.
    numbers = spark.createDataFrame([(r.file_path, r.group) for r in chosen if r.n > 1], "_file string, _group int")
    rows = rows.join(F.broadcast(numbers) if len(names) <= 100_000 else numbers, "_file")
    merged = rows.repartitionById(max(r.group for r in chosen) + 1, F.col("_group")).drop("_file", "_group")
    merged.write.option("maxRecordsPerFile", max_records).parquet(f"{path}/{_PLAN}/rows")
    written = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{path}/{_PLAN}/rows").select("path").collect()
    steps = json.dumps({"old": names, "new": [r.path.rpartition("/")[2] for r in written]})
    out = files.create(hadoop(spark, f"{path}/{_PLAN}/plan.tmp")[1])
    out.write(steps.encode())
    out.close()
    files.rename(hadoop(spark, f"{path}/{_PLAN}/plan.tmp")[1], hadoop(spark, f"{path}/{_PLAN}/plan.json")[1])
    _finish_compaction(spark, path)


def save_voxels(df: DataFrame, table: str, path: str | None = None, partition: str | None = "majority_label") -> None:
    """Create or replace a table, partitioned so that a filter on the label reads only its files.

    The rebalance gives each label its own tasks and splits a label that holds
    much of the table over several.
    """
    rows = df if partition is None else df.hint("rebalance", F.col(partition))
    writer = rows.write.mode("overwrite").format("parquet")
    if partition is not None:
        writer = writer.partitionBy(partition)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def append_rows(df: DataFrame, table: str) -> None:
    """Append to a table of save_voxels; columns are matched by name.

    As when the table is made, each partition gets its own tasks, so a task does not write a file for every label.
    """
    spark = df.sparkSession
    columns = spark.table(table).columns
    if set(columns) != set(df.columns) or len(columns) != len(df.columns):
        raise ValueError(f"the columns are not those of {table}: {', '.join(df.columns)}")
    partition = [F.col(c.name) for c in spark.catalog.listColumns(table) if c.isPartition]
    rows = df.select(*columns)
    (rows.hint("rebalance", *partition) if partition else rows).write.insertInto(table)


def write_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """Send each row as a JSON message. Needs Spark's Kafka package."""
    to_messages(df).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
