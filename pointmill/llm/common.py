"""What several operators of this package need."""

import hashlib
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pointmill.workspace import scratch_path

#: ASCII letters to lower case; every other byte stays, so UTF-8 stays whole.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: The same, and every ASCII byte that is no letter or digit to a space: split() then gives the words.
LOWER_WORDS = bytes(
    b if b >= 128 or chr(b).isalnum() and b not in range(65, 91) else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared scratch folder and read back: later steps neither recompute it nor lose it with an executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def dealt(files: DataFrame) -> DataFrame:
    """The rows of files (file, ...) over several tasks, as many in each: a row is small but stands for a file, so Spark must neither merge rows by size nor hash them together."""
    spark = files.sparkSession
    several = 4 * max(parallelism(spark), spark.sparkContext.defaultParallelism)
    # Only the name of each file meets the others.
    numbers = files.select("file").withColumn("_number", F.row_number().over(Window.orderBy("file")) - 1)
    tasks = max(1, min(several, files.count()))
    return files.join(numbers, "file").repartitionById(tasks, F.pmod("_number", F.lit(tasks)).cast("int")).drop("_number")


def hash64(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (multiply, shift and add)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Numbered(dict):
    """Keys to numbers; a new key gets number(key) once. Forgets all when it holds too many."""

    def __init__(self, number, limit: int = 400_000):
        super().__init__()
        self.number, self.limit = number, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        self[key] = value = self.number(key)
        return value


def union_find(n: int, pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest member of each of 0..n-1's component, linked by pairs of index arrays."""
    root = np.arange(n)
    for a, b in pairs:
        while len(a):
            ra, rb = root[a], root[b]
            low, high = np.minimum(ra, rb), np.maximum(ra, rb)
            apart = low < high
            if not apart.any():
                break
            np.minimum.at(root, high[apart], low[apart])
            while not np.array_equal(root, up := root[root]):
                root = up
            a, b = a[apart], b[apart]
    return root


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components: (vertex, component) for each end of an edge (a, b); component is the smallest vertex.

    Alternates two star contractions until nothing changes: every vertex hands its
    larger neighbours, then its smaller ones, over to the smallest it knows. Rounds
    grow with the logarithm of the longest chain. Every round is written to the
    shared folder. A vertex with many neighbours is met by a minimum with map-side
    combine and by a join whose skewed side AQE splits. Loops and NULL ends are
    ignored; a lone vertex is not returned.
    """
    apart = edges.where("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct()
    now, before = saved(apart, name), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = now.unionAll(now.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        larger = both.where("v > u").join(least, "u").selectExpr("v AS u", "m AS v").distinct()
        smallest = larger.groupBy("u").agg(F.min("v").alias("m"))
        joined = larger.join(smallest, "u")
        smaller = joined.where("v <> m").selectExpr("v AS u", "m AS v")
        now = saved(smallest.selectExpr("u", "m AS v").unionAll(smaller).distinct(), name)
    roots = now.selectExpr("v AS vertex", "v AS component").distinct()
    return roots.unionAll(now.selectExpr("u AS vertex", "v AS component"))


def resolved(rows: DataFrame, linked: DataFrame, name: str) -> DataFrame:
    """(id, class, n_links, component_id) of each of rows (id, class, ...), whose further columns stay.

    rows of one class are equal and link with each other; linked (class, root, n_links) holds links between classes, as edges and
    as numbers of rows, which add up. component_id is the smallest id of the component. A row without a class links with nothing.
    """
    groups = components(linked.selectExpr("class AS a", "root AS b"), name)
    degree = linked.groupBy("class").agg(F.sum("n_links").alias("degree"))
    each = rows.where("class IS NOT NULL").groupBy("class").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    each = each.join(degree, "class", "left").join(groups.withColumnRenamed("vertex", "class"), "class", "left")
    each = saved(each.withColumn("component", F.coalesce("component", "class")), f"{name}_classes")
    lowest = each.groupBy("component").agg(F.min("least").alias("lowest"))
    each = each.join(lowest, "component").select("class", "copies", "degree", "lowest")
    lone = F.col("class").isNull()
    joined = rows.join(each, "class", "left")
    return joined.select(
        *rows.columns,
        F.when(lone, 0).otherwise(F.coalesce("degree", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.when(lone, F.col("id")).otherwise(F.col("lowest")).alias("component_id"),
    )
