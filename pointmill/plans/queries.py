"""The registered queries: each operator over the given tables."""

from collections.abc import Callable
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointmill.operators import classifier, features as feat, network, points as pts, quality, series, stats, versions, voxels
from pointmill.plans import views
from pointmill.schema import POINT, VOXEL, VOXEL_ML_FEATURES
from pointmill.sources import files
from pointmill.sources.ply import read_ply
from pointmill.streaming import clean as cleaning
from pointmill.workspace import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

RATE_WINDOW_SECONDS = 12 * 3600

# Commits of the versioned table: version, operation, time. The steps below follow it.
COMMITS = [
    (1, "create", "2024-01-01 00:00:00"),
    (2, "append", "2024-01-01 01:00:00"),
    (3, "delete", "2024-01-01 02:00:00"),
    (4, "update", "2024-01-01 03:00:00"),
    (5, "append", "2024-01-01 04:00:00"),
]

# Written as so many files each, to be listed again.
DATASETS = {"lineitem": 4, "orders": 2, "events": 3}
SMALL_FILES = 200
INTAKE_FILES, INTAKE_PER_BATCH = 6, 2
# Each file of the intake is landed in parts by tasks that read about so many points.
LANDING_ROWS = 6_000_000
# JSON points take several times their size in the tables; so coded, landed and cleaned files take less.
JSON_CODEC = "lz4"

# Fixed values of a network that is not trained: what each input is divided by, the sizes of its layers, its classes.
NETWORK_INPUTS = dict(zip(VOXEL_ML_FEATURES, (8, 64, 16, 256, 256, 256), strict=True))
_SIZES = (len(NETWORK_INPUTS), 8, 7, 6)
NETWORK_CLASSES = [1, 2, 3, 4, 5, 6]
# Weights and biases of each layer by a rule; multiples of 1/8 and 1/4.
NETWORK = [
    ([[((7 * u + 5 * i + 3 * k) % 11 - 5) / 8 for i in range(n)] for u in range(m)], [((3 * u + k) % 7 - 3) / 4 for u in range(m)])
    for k, (n, m) in enumerate(zip(_SIZES, _SIZES[1:]))
]

# Rows that these do not tell apart are the same point.
LINE_ORDER = [f"l_{c}" for c in "orderkey linenumber partkey suppkey quantity extendedprice discount tax".split()]

# A row of decimals for a table of doubles.
NEW_VOXEL = (
    "'added' AS voxel_id, -7.5 AS mean_x, 12.25 AS mean_y, 3.0 AS mean_z, 18.75 AS mean_intensity, "
    "61.5 AS mean_brightness, 0.25 AS mean_blue_norm, 0.5 AS mean_green_norm, 0.125 AS mean_red_norm"
)


# Points

def clean_points(spark, sf_dir):
    return pts.clean(views.points(spark, sf_dir)).select(*POINT.names)


def normalize_points(spark, sf_dir):
    return pts.normalize_points(views.raw_points(spark, sf_dir))


def voxel_keys(spark, sf_dir):
    return pts.voxel_keys(views.points(spark, sf_dir)).select("x", "y", "z", *VOXEL, "label")


def voxel_keys_half(spark, sf_dir):
    return pts.voxel_keys(views.points(spark, sf_dir), 0.5).select("x", "y", "z", *VOXEL, "label")


def json_messages(spark, sf_dir):
    return pts.from_messages(pts.to_messages(views.points(spark, sf_dir)))


def global_shift(spark, sf_dir):
    return pts.global_shift(views.points(spark, sf_dir), 2.0).select("x", "y", "z", "label")


# Voxels

def voxelize(spark, sf_dir):
    return views.clean_voxels(spark, sf_dir)


def majority_label(spark, sf_dir):
    return voxels.majority_label(pts.clean(views.points(spark, sf_dir)))


def voxel_features(spark, sf_dir):
    return views.features(spark, sf_dir)


def voxel_ml_features(spark, sf_dir):
    return voxels.ml_features(views.clean_voxels(spark, sf_dir))


# Statistics and samples

def profile_points(spark, sf_dir):
    return stats.profile(views.points(spark, sf_dir))


def row_count(spark, sf_dir):
    return stats.row_count(views.points(spark, sf_dir))


def distinct_voxels(spark, sf_dir):
    return stats.distinct_count(views.features(spark, sf_dir), "voxel_id")


def intensity_stats(spark, sf_dir):
    return stats.summary(views.points(spark, sf_dir), "intensity")


def height_stats(spark, sf_dir):
    return stats.summary(views.points(spark, sf_dir), "z")


def high_intensity(spark, sf_dir):
    found = stats.above(views.features(spark, sf_dir), "mean_intensity", 20)
    return found.select("voxel_id", "mean_x", "mean_y", "mean_z", "mean_intensity")


def height_band(spark, sf_dir):
    return stats.band(views.features(spark, sf_dir), "mean_z", -1, 2).select("voxel_id", "mean_z", "mean_intensity")


def height_band_count(spark, sf_dir):
    return stats.row_count(stats.band(views.features(spark, sf_dir), "mean_z", -1, 2))


def top_voxels(spark, sf_dir):
    return stats.first_rows(views.features(spark, sf_dir), 10, F.desc("mean_intensity"), "voxel_id")


def label_distribution(spark, sf_dir):
    return stats.label_distribution(views.points(spark, sf_dir))


# Files and tables

def json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "json")
    views.points(spark, sf_dir).write.json(path)
    return files.read_points_json(spark, path)


def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    files.write_parquet(views.features(spark, sf_dir), path)
    return spark.read.parquet(path)


def sql_on_files(spark, sf_dir):
    return files.query_files(
        spark, "l_returnflag, count(*) AS total_rows", f"{sf_dir}/lineitem.parquet", rest="GROUP BY l_returnflag"
    )


def glob_scan(spark, sf_dir):
    path = scratch_path(spark, "mixed")
    voxel_table = views.clean_voxels(spark, sf_dir)
    voxel_table.write.parquet(path)
    voxel_table.write.mode("append").json(path)
    return files.read_parquet_glob(spark, path)


def _in_files(rows, number):
    """rows in so many tasks that all have some: parts of the scan put together if that gives them, else dealt out by a shuffle."""
    together = rows.coalesce(number)
    if together.groupBy(F.spark_partition_id()).count().count() == number:
        return together
    return rows.repartition(number)


def file_inventory(spark, sf_dir):
    """Files, rows and skipped files of the datasets of a folder tree, and whether every listed file has a size."""
    root = scratch_path(spark, "tree")
    for name, number in DATASETS.items():
        _in_files(views.table(spark, sf_dir, name), number).write.parquet(f"{root}/{name}")
    listed = files.tree_inventory(spark, root)
    return listed.groupBy("dataset").agg(
        F.count_if(~F.col("skipped")).alias("files"),
        F.sum("row_count").alias("row_count"),
        F.count_if("skipped").alias("skipped_files"),
        F.bool_and(F.col("skipped") | (F.col("file_size") > 0)).alias("all_sized"),
    )


def compact(spark, sf_dir):
    """The voxels after their small files were merged, with the number of files before, and whether it fell and no file holds too many rows."""
    path = scratch_path(spark, "compact")
    views.clean_voxels(spark, sf_dir).repartition(SMALL_FILES).write.parquet(path)
    files.compact_files(spark, path, target_bytes=1 << 16, max_records=500)
    rows = spark.read.parquet(path)
    after, most = files.file_inventory(rows).agg(F.count("*"), F.max("row_count")).first()
    return rows.withColumns({"files_before": F.lit(SMALL_FILES), "fewer_files": F.lit(after < SMALL_FILES), "within_limit": F.lit(most <= 500)})


def intake_counts(spark, sf_dir):
    """Records, corrupt and kept ones of an intake with a broken line for each nation, and the rows that arrived."""
    source, target = scratch_path(spark, "landing"), scratch_path(spark, "intake")
    views.points(spark, sf_dir).write.json(source)
    broken = F.concat(F.lit('{"x": 1.0, "label": "'), "n_name", F.lit('"}'))
    views.table(spark, sf_dir, "nation").select(F.when(F.col("n_nationkey") % 2 == 0, broken).otherwise(F.col("n_name"))).write.mode("append").text(source)
    found = files.clean_intake(spark, source, target)
    arrived = spark.read.parquet(target).agg(F.count("*").alias("arrived"))
    return arrived.select(*[F.lit(found[c]).cast("long").alias(c) for c in ("records", "corrupt", "kept")], "arrived")


def partitioned_table(spark, sf_dir):
    name = f"voxels_{uuid4().hex}"
    files.save_voxels(views.clean_voxels(spark, sf_dir), name, scratch_path(spark, "voxels"))
    return spark.table(name).where("majority_label IN (2, 3)")


def partitioned_table_whole(spark, sf_dir):
    name = f"voxels_{uuid4().hex}"
    files.save_voxels(views.clean_voxels(spark, sf_dir), name, scratch_path(spark, "voxels"))
    return spark.table(name)


def append_table(spark, sf_dir):
    name = f"voxels_{uuid4().hex}"
    rows = views.clean_voxels(spark, sf_dir)
    files.save_voxels(rows.where("voxel_z < 0"), name, scratch_path(spark, "voxels"))
    files.append_rows(rows.where("voxel_z >= 0"), name)
    return spark.table(name)


def ply_scan(spark, sf_dir):
    path = scratch_path(spark, "ply")
    views.write_ply_files(views.raw_points(spark, sf_dir), path)
    return pts.normalize_points(read_ply(spark, path))


def ply_scan_ascii(spark, sf_dir):
    path = scratch_path(spark, "ply")
    views.write_ply_files(views.raw_points(spark, sf_dir), path, ascii=True)
    return pts.normalize_points(read_ply(spark, path))


def ply_limit(spark, sf_dir):
    """The first points of a scan whose files hold the points in the order of their keys."""
    path = scratch_path(spark, "ply")
    ordered = views.table(spark, sf_dir, "lineitem").repartitionByRange(*LINE_ORDER).sortWithinPartitions(*LINE_ORDER)
    views.write_ply_files(views.as_raw_points(ordered), path)
    return pts.normalize_points(read_ply(spark, path, limit=5000))


def stream_clean(spark, sf_dir):
    source, target = scratch_path(spark, "landing"), scratch_path(spark, "cleaned")
    views.points(spark, sf_dir).write.json(source, compression=JSON_CODEC)
    cleaning.stream_clean(spark, source, target, scratch_path(spark, "stream"), compression=JSON_CODEC).awaitTermination()
    return files.read_points_json(spark, target)


def stream_restart(spark, sf_dir):
    """A cleaning stream that was stopped after half of the input and went on from its checkpoint, and a replay of all input with a new one."""
    source, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    resumed, replayed = scratch_path(spark, "cleaned"), scratch_path(spark, "cleaned")
    rows = views.points(spark, sf_dir)
    for half in (0, 1):
        rows.where(F.col("timestamp") % 2 == half).write.mode("append").json(source, compression=JSON_CODEC)
        cleaning.stream_clean(spark, source, resumed, checkpoint, per_trigger=4, compression=JSON_CODEC).awaitTermination()
    cleaning.stream_clean(spark, source, replayed, scratch_path(spark, "stream"), compression=JSON_CODEC).awaitTermination()
    both = [files.read_points_json(spark, path).withColumn("run", F.lit(run)) for run, path in (("resumed", resumed), ("replayed", replayed))]
    return both[0].unionAll(both[1])


def stream_bounded(spark, sf_dir):
    """Rows of each micro-batch of a cleaning stream that takes a stated number of files at a time, oldest first.

    Every file comes in as many parts as the table's size asks for, so no task reads the whole table.
    """
    source, target = scratch_path(spark, "landing"), scratch_path(spark, "batches")
    rows = views.points(spark, sf_dir)
    parts = max(1, min(-(-rows.count() // LANDING_ROWS), rows.rdd.getNumPartitions()))
    landed = spark.read.schema(POINT).json
    for k in range(INTAKE_FILES):
        mine = rows.where(F.col("timestamp") % INTAKE_FILES == k).coalesce(parts)
        mine.write.mode("append").json(source, compression=JSON_CODEC)
        # A task without rows writes no file: an empty one keeps the number of parts, which the stream counts.
        for _ in range((k + 1) * parts - len(landed(source).inputFiles())):
            mine.limit(0).coalesce(1).write.mode("append").json(source, compression=JSON_CODEC)
    cleaning.bounded_intake(
        spark, source, target, scratch_path(spark, "stream"), INTAKE_PER_BATCH * parts, compression=JSON_CODEC
    ).awaitTermination()
    return cleaning.read_batches(spark, target).groupBy("batch").agg(F.count("*").alias("row_count"), F.sum("label").alias("labels"))


# Labels

def class_names(spark, sf_dir):
    classes = views.table(spark, sf_dir, "nation").selectExpr(
        "CAST(n_nationkey AS INT) AS label", "n_name AS class_name"
    )
    named = quality.with_class_names(views.points(spark, sf_dir), classes)
    return named.groupBy("label", "class_name").agg(F.count("*").alias("row_count"))


def label_overlay(spark, sf_dir):
    """Voxels whose majority changes when noise points may vote."""
    every = voxels.majority_label(views.points(spark, sf_dir))
    return quality.overlay(voxels.majority_label(pts.clean(views.points(spark, sf_dir))), every)


def accuracy(spark, sf_dir):
    return quality.accuracy(views.predictions(spark, sf_dir))


def confusion(spark, sf_dir):
    return quality.confusion(views.predictions(spark, sf_dir))


def class_report(spark, sf_dir):
    return quality.class_report(views.predictions(spark, sf_dir))


# Versions

def commits(spark: SparkSession) -> DataFrame:
    """The commits, written as their changes would be, and read back."""
    path = scratch_path(spark, "commits")
    versions.record_commits(spark, path, [(v, operation, datetime.fromisoformat(at)) for v, operation, at in COMMITS])
    return versions.read_commits(spark, path)


def versioned(spark: SparkSession, sf_dir: str, upto: int = 5) -> DataFrame:
    """The voxel feature table after the first steps of COMMITS."""
    rows = views.features(spark, sf_dir)
    table = versions.create_version(rows)
    if upto >= 2:
        boosted = stats.first_rows(stats.above(rows, "mean_intensity", 15), 50, "voxel_id")
        boosted = boosted.withColumn("mean_intensity", F.col("mean_intensity") * 1.10)
        table = versions.append_version(table, boosted, 2)
    if upto >= 3:
        table = versions.delete_where(table, F.col("mean_intensity") < 5, 3)
    if upto >= 4:
        brighter = {"mean_brightness": F.col("mean_brightness") * 1.05}
        table = versions.update_where(table, F.col("mean_z") > 2, brighter, 4)
    if upto >= 5:
        table = versions.append_version(table, spark.sql(f"SELECT {NEW_VOXEL}"), 5)
    return table


def version_current(spark, sf_dir):
    return versions.current(versioned(spark, sf_dir))


def version_append(spark, sf_dir):
    return versions.current(versioned(spark, sf_dir, 2))


def version_delete(spark, sf_dir):
    return versions.current(versioned(spark, sf_dir, 3))


def version_update(spark, sf_dir):
    return versions.current(versioned(spark, sf_dir, 4))


def version_as_of(spark, sf_dir):
    return versions.as_of_version(versioned(spark, sf_dir), 2, commits(spark))


def version_as_of_ts(spark, sf_dir):
    return versions.as_of_timestamp(versioned(spark, sf_dir), commits(spark), "2024-01-01 02:30:00")


def version_as_of_saved(spark, sf_dir):
    path = scratch_path(spark, "versions")
    versions.save_versions(versioned(spark, sf_dir), path, commits(spark))
    return versions.as_of_saved(spark, path, 1)


def version_append_saved(spark, sf_dir):
    """A saved table after a row of other number types was appended to it."""
    path = scratch_path(spark, "versions")
    versions.save_versions(versioned(spark, sf_dir, 4), path)
    versions.append_saved(spark.sql(f"SELECT {NEW_VOXEL}"), path, 5)
    return versions.current(versions.load_versions(spark, path))


def version_history(spark, sf_dir):
    """Which versions of the table became current when, with the rows each added."""
    added = versioned(spark, sf_dir).groupBy(F.col("valid_from").alias("version")).agg(F.count("*").alias("added"))
    return versions.history(commits(spark)).join(added, "version", "left").fillna(0, "added")


def version_replace(spark, sf_dir):
    """The whole interval table after a replacement by the features of clean points."""
    rows = voxels.voxel_features(pts.clean(views.points(spark, sf_dir)))
    return versions.replace_version(versioned(spark, sf_dir), rows, 6)


def version_log(spark, sf_dir):
    return versions.version_log(versioned(spark, sf_dir), commits(spark))


def version_bounds(spark, sf_dir):
    return versions.version_bounds(version_log(spark, sf_dir))


def version_count(spark, sf_dir):
    return stats.row_count(version_log(spark, sf_dir).where("added + deleted > 0"))


def version_compare(spark, sf_dir):
    return versions.compare_versions(versioned(spark, sf_dir), 1, 5)


# Metrics

def counter_rate(spark, sf_dir):
    samples, slices = views.metrics(spark, sf_dir, RATE_WINDOW_SECONDS)
    return series.counter_rate(
        samples, ["instance", "mode"], "sample_ts", "counter", RATE_WINDOW_SECONDS, "event_id", slices
    ).select("instance", "mode", F.col("sample_ts").cast("timestamp_ntz").alias("sample_ts"), "counter", "rate")


def cpu_usage(spark, sf_dir):
    samples, slices = views.metrics(spark, sf_dir, RATE_WINDOW_SECONDS)
    usage = series.cpu_usage(
        samples, "sample_ts", "counter", RATE_WINDOW_SECONDS, idle="view", tie="event_id", slices=slices
    )
    return usage.select("instance", F.round("cpu_usage", 6).alias("cpu_usage"))


def latest_gauge(spark, sf_dir):
    samples = views.table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id % 4 AS INT) AS instance", "event_type AS mode", "event_id", "ts AS sample_ts", "value AS gauge"
    )
    return series.latest(samples, ["instance", "mode"], "sample_ts", "gauge", "event_id")


# Classifier

def _scaled(df):
    return df.select(*VOXEL, *[F.round(c, 6).alias(c) for c in classifier.INPUTS])


def scale_features(spark, sf_dir):
    return _scaled(feat.scale(views.clean_voxels(spark, sf_dir), VOXEL_ML_FEATURES))


def scale_features_train(spark, sf_dir):
    rows = feat.with_split(views.clean_voxels(spark, sf_dir))
    return _scaled(feat.scale(rows, VOXEL_ML_FEATURES, fit_on=~F.col("is_test")))


def encode_labels(spark, sf_dir):
    """Labels by a dictionary of the points' labels, which is written and kept."""
    path = scratch_path(spark, "labels")
    feat.label_dictionary(pts.clean(views.points(spark, sf_dir))).write.parquet(path)
    coded = feat.encode_labels(views.clean_voxels(spark, sf_dir), spark.read.parquet(path), "majority_label", of="label")
    return coded.select(*VOXEL, "majority_label", "label_index")


def one_hot(spark, sf_dir):
    """A column for each majority label; the list of columns has to be known, so it is fetched from the voxels."""
    rows = views.clean_voxels(spark, sf_dir)
    classes = feat.label_classes(rows, "majority_label")
    coded = feat.encode_labels(rows, classes, "majority_label")
    return feat.one_hot(coded, classes).select(*VOXEL, *[f"class_{i}" for i in range(len(classes))])


def split_voxels(spark, sf_dir):
    marked = feat.with_split(views.clean_voxels(spark, sf_dir))
    return marked.select(*VOXEL, F.col("is_test").cast("int").alias("is_test"))


def _network_rows(spark, sf_dir):
    rows = views.clean_voxels(spark, sf_dir).select(*VOXEL, "majority_label", *[(F.col(c) / d).alias(f"{c}_in") for c, d in NETWORK_INPUTS.items()])
    units = network.weight_table(spark, [network.Layer(*layer) for layer in NETWORK])
    return network.network_scores(rows, units, [f"{c}_in" for c in NETWORK_INPUTS], classes=NETWORK_CLASSES)


def network_scores(spark, sf_dir):
    """Probabilities and predicted label of every voxel by a network of fixed weights."""
    scored = _network_rows(spark, sf_dir)
    each = [F.round(F.get("probability", F.lit(k)), 6).alias(f"p{c}") for k, c in enumerate(NETWORK_CLASSES)]
    return scored.select(*VOXEL, "predicted", *each)


def network_quality(spark, sf_dir):
    """Evaluation of that network against the majority labels."""
    found = classifier.evaluate(_network_rows(spark, sf_dir), NETWORK_CLASSES)
    return found.select("n", F.round("accuracy", 9).alias("accuracy"), F.round("log_loss", 6).alias("log_loss"))


def model_reload(spark, sf_dir):
    """Every voxel, and whether a trained classifier scores it alike before it was saved and after it was read back."""
    scaled = feat.scale(views.clean_voxels(spark, sf_dir), VOXEL_ML_FEATURES)
    path, rows = scratch_path(spark, "model"), scratch_path(spark, "training")
    scaled.write.parquet(rows)
    scaled = spark.read.parquet(rows)
    model = classifier.train_classifier(scaled, hidden=(8,), max_iter=10)
    classifier.save_model(model, path)
    before = classifier.classify(model, scaled).select(*VOXEL, "majority_label", "predicted", "probability")
    after = classifier.classify(classifier.load_model(path), scaled).select(*VOXEL, F.col("predicted").alias("again"), F.col("probability").alias("probability_again"))
    alike = (F.col("predicted") == F.col("again")) & (F.col("probability") == F.col("probability_again"))
    return before.join(after, VOXEL).select(*VOXEL, "majority_label", alike.alias("alike"))


def _trained(spark, sf_dir):
    """A classifier of the training voxels and the test voxels it scored.

    Training reads its input again and again, so the voxels are written first.
    """
    path = scratch_path(spark, "training")
    feat.with_split(views.clean_voxels(spark, sf_dir)).write.parquet(path)
    rows = spark.read.parquet(path)
    scaled = feat.scale(rows, VOXEL_ML_FEATURES, fit_on=~F.col("is_test"))
    model = classifier.train_classifier(scaled.where("NOT is_test"))
    return model, classifier.classify(model, scaled.where("is_test"))


def classify_voxels(spark, sf_dir):
    """Every test voxel, and whether its predicted label is one of the training labels."""
    model, scored = _trained(spark, sf_dir)
    known = F.col("predicted").isin(classifier.model_classes(model))
    return scored.select(*VOXEL, "majority_label", known.alias("known_label"))


def model_quality(spark, sf_dir):
    """Size of the test set, and whether accuracy and loss are in their ranges; the numbers themselves rest on the solver."""
    model, scored = _trained(spark, sf_dir)
    found = classifier.evaluate(scored, classifier.model_classes(model))
    return found.select("n", F.col("accuracy").between(0, 1).alias("accuracy_in_range"), (F.col("log_loss") > 0).alias("loss_in_range"))


def log_loss(spark, sf_dir):
    """The classifier's evaluation over the fixed-rule predictions: half the probability to the predicted label, a tenth to each other."""
    classes = list(range(1, 7))
    each = [F.when(F.col("predicted") == c, 0.5).otherwise(0.1) for c in classes]
    found = classifier.evaluate(views.predictions(spark, sf_dir).withColumn("probability", F.array(*each)), classes, "label")
    return found.select("n", F.round("accuracy", 9).alias("accuracy"), F.round("log_loss", 9).alias("log_loss"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        clean_points, normalize_points, voxel_keys, voxel_keys_half, json_messages, global_shift,
        voxelize, majority_label, voxel_features, voxel_ml_features,
        profile_points, row_count, distinct_voxels, intensity_stats, height_stats, high_intensity,
        height_band, height_band_count, top_voxels, label_distribution,
        json_roundtrip, parquet_roundtrip, sql_on_files, glob_scan, file_inventory, compact,
        partitioned_table, partitioned_table_whole, append_table, ply_scan, ply_scan_ascii, ply_limit, stream_clean,
        stream_restart, stream_bounded, intake_counts,
        class_names, label_overlay, accuracy, confusion, class_report,
        version_current, version_append, version_delete, version_update, version_as_of,
        version_as_of_ts, version_as_of_saved, version_append_saved, version_history, version_replace, version_log, version_bounds,
        version_count, version_compare,
        counter_rate, cpu_usage, latest_gauge,
        scale_features, scale_features_train, encode_labels, one_hot, split_voxels,
        classify_voxels, model_quality, log_loss, network_scores, network_quality, model_reload,
    )
}
