"""Continuous cleaning: message or file stream -> noise filter -> files."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pointmill.operators.points import clean, from_messages
from pointmill.schema import CORRUPT, POINT, POINT_OR_CORRUPT


def read_points_stream(
    spark: SparkSession,
    path: str | None = None,
    kafka: Mapping[str, str] | None = None,
    per_trigger: int | None = None,
) -> DataFrame:
    """Points, with the text of records that did not parse, from a JSON folder or a Kafka topic.

    kafka takes the source's options (kafka.bootstrap.servers, subscribe) and
    needs Spark's Kafka package; a new checkpoint starts at the earliest offset.
    per_trigger bounds a micro-batch: files of a folder, offsets of a topic.
    """
    if (path is None) == (kafka is None):
        raise ValueError("give a path or Kafka options")
    if kafka is not None:
        options = {"startingOffsets": "earliest", **kafka}
        if per_trigger:
            options["maxOffsetsPerTrigger"] = str(per_trigger)
        messages = spark.readStream.format("kafka").options(**options).load()
        return from_messages(messages, keep_corrupt=True)
    reader = spark.readStream.schema(POINT_OR_CORRUPT).option("columnNameOfCorruptRecord", CORRUPT)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.json(path)


def write_points_stream(
    points: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    fmt: str = "json",
    max_records: int | None = None,
    compression: str | None = None,
) -> StreamingQuery:
    """Append to files, a batch every interval ("5 seconds"); without one, take what is there and stop.

    The checkpoint holds the read positions, so a restart neither loses nor
    repeats rows. Files are rolled with every batch and after max_records;
    compression names a codec in place of the format's own.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = points.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    if compression:
        writer = writer.option("compression", compression)
    return writer.trigger(**trigger).start(path)


def clean_stream(points: DataFrame) -> DataFrame:
    """Filter a point stream. Unreadable records are counted as they pass, in the metrics named intake."""
    counted = points.observe(
        "intake", F.count(F.lit(1)).alias("records"), F.count(CORRUPT).alias("corrupt")
    )
    return clean(counted).select(*POINT.names)


def stream_clean(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    every: str | None = None,
    per_trigger: int | None = None,
    fmt: str = "json",
    max_records: int | None = None,
    compression: str | None = None,
) -> StreamingQuery:
    """Clean a JSON folder into another folder."""
    points = read_points_stream(spark, source, per_trigger=per_trigger)
    return write_points_stream(clean_stream(points), target, checkpoint, every, fmt, max_records, compression)


def bounded_intake(
    spark: SparkSession, source: str, target: str, checkpoint: str, per_trigger: int, max_records: int | None = None, compression: str | None = None
) -> StreamingQuery:
    """Clean a JSON folder in micro-batches of per_trigger files, each into a folder batch=<number> of the target.

    A batch that is run again after a failure has its number again and replaces what it wrote before, so no row is
    there twice. read_batches gives the rows with their batch.
    """

    def write(batch: DataFrame, number: int) -> None:
        writer = batch.write.mode("overwrite")
        if max_records:
            writer = writer.option("maxRecordsPerFile", max_records)
        if compression:
            writer = writer.option("compression", compression)
        writer.json(f"{target.rstrip('/')}/batch={number}")

    cleaned = clean_stream(read_points_stream(spark, source, per_trigger=per_trigger))
    return cleaned.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def read_batches(spark: SparkSession, target: str) -> DataFrame:
    """Points of bounded_intake, and batch, the number of the micro-batch that brought them."""
    schema = T.StructType([*POINT.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(schema).option("basePath", target).json(target)


def debug_stream(points: DataFrame, checkpoint: str | None = None, table: str | None = None) -> StreamingQuery:
    """Print each batch, or keep it in an in-memory table when one is named. For looking at small streams only."""
    writer = points.writeStream.outputMode("append")
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if table:
        return writer.format("memory").queryName(table).start()
    return writer.format("console").option("truncate", "false").start()
