"""Where jobs put the files they write for themselves, and how tasks open files."""

import re
import tempfile
from uuid import uuid4

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme: one without is on the default file system, as for Spark's own readers."""
    files, where = hadoop(spark, path)
    return files.makeQualified(where).toString()


def hadoop(spark: SparkSession, path: str):
    """Hadoop's file system of a path and the path as its own type, for what Spark's sources do not offer: renaming, deleting, hidden files."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a qualified path and the path in it, for use in tasks."""
    scheme, _, rest = uri.partition(":")
    if not rest:
        raise ValueError(f"a path with a scheme is wanted, not {uri}")
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the cluster names in spark.checkpoint.dir, with its scheme.

    Executors must all reach it, so a machine-local folder is used only on a
    local master with the setting unset. Nothing is removed here: the folder is
    the caller's to clear once the results that were read from it are no longer needed.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="pointmill-")
    return qualified(spark, f"{root.rstrip('/')}/pointmill/{name}-{uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared scratch folder and read back: its size is known, and a lost executor does not lose it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
