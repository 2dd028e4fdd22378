import math

import pytest
from pyspark.sql import functions as F

from pointmill.operators import classifier, features as feat, network, quality
from pointmill.operators.points import clean
from pointmill.plans import views
from pointmill.schema import VOXEL, VOXEL_ML_FEATURES
from tests.helpers import points, rows


def test_class_names_keep_unknown_labels(spark):
    classes = spark.createDataFrame([(1, "road"), (2, "tree")], "label int, class_name string")
    named = quality.with_class_names(points(spark, {"label": 1}, {"label": 9}, {"label": None}), classes)
    assert rows(named, "label", "class_name") == [(1, "road"), (9, None), (None, None)]


def test_overlay(spark):
    schema = "voxel_x int, voxel_y int, voxel_z int, majority_label int"
    truth = spark.createDataFrame([(0, 0, 0, 1), (1, 0, 0, 2), (2, 0, 0, 3), (None, 0, 0, 1)], schema)
    guess = spark.createDataFrame([(0, 0, 0, 1), (1, 0, 0, 5), (None, 0, 0, 2)], schema)
    assert rows(quality.overlay(truth, guess)) == [(1, 0, 0, 2, 5)]


def test_reports(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (3, 2), (3, None)], "label int, predicted int")
    assert rows(quality.accuracy(df)) == [(5, 2, 0.4)]
    report = {r.label: r for r in quality.class_report(df).collect()}
    assert (report[1].precision, report[1].recall, report[1].f1) == (1.0, 0.5, pytest.approx(2 / 3))
    assert (report[2].precision, report[2].recall) == (pytest.approx(1 / 3), 1.0)
    assert (report[3].precision, report[3].recall, report[3].f1, report[3].support) == (0.0, 0.0, 0.0, 2)
    assert quality.confusion(df).agg(F.sum("n")).first()[0] == 5
    assert rows(quality.accuracy(df.where("false"))) == [(0, 0, None)]


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    out = feat.scale(df, ["a", "b"])
    assert rows(out, "a_scaled", "b_scaled") == [(-1.0, 0.0), (1.0, 0.0), (None, 0.0)]
    other = feat.scale(df, ["a"], fit_on=F.col("a") == 1)
    assert rows(other, "a_scaled") == [(0.0,), (0.0,), (None,)]


def test_scaling_uses_no_join(spark, sf_dir):
    df = feat.scale(views.clean_voxels(spark, sf_dir), VOXEL_ML_FEATURES)
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_encoding_is_by_value(spark):
    df = points(spark, {"label": 10}, {"label": 2}, {"label": 10}, {"label": None})
    classes = feat.label_classes(df)
    assert classes == [2, 10]
    coded = feat.one_hot(feat.encode_labels(df, classes), classes)
    assert rows(coded, "label", "label_index", "class_0", "class_1") == [
        (2, 0, 1, 0), (10, 1, 0, 1), (10, 1, 0, 1), (None, None, 0, 0),
    ]
    assert rows(feat.encode_labels(points(spark, {"label": 5}), classes), "label_index") == [(None,)]


def test_many_labels_are_encoded_by_a_table(spark):
    df = spark.range(3000).select((F.col("id") * 2).cast("int").alias("label"))
    coded = feat.encode_labels(df, feat.label_dictionary(df))
    assert coded.where("label_index <> label / 2").isEmpty() and coded.where("label_index IS NULL").isEmpty()
    other = feat.label_dictionary(df).withColumnRenamed("label", "kind")
    assert rows(feat.encode_labels(points(spark, {"label": 4}, {"label": 5}), other, of="kind"), "label_index") == [(2,), (None,)]


def test_fitted_scaling_reads_its_input_once(spark, sf_dir):
    df = feat.with_split(views.clean_voxels(spark, sf_dir))
    df = feat.scale(df, VOXEL_ML_FEATURES, fit_on=~F.col("is_test"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan or plan.count("FileScan") == 1


def test_split_is_stable_and_near_its_share(spark):
    df = spark.range(40000).select(
        *[(F.pmod(F.hash("id", F.lit(s)), F.lit(200)) - 100).alias(k) for s, k in enumerate(VOXEL)]
    )
    train, test = feat.split(df)
    assert train.count() + test.count() == 40000
    assert abs(test.count() / 40000 - 0.2) < 0.01
    again = feat.split(df.repartition(13))[1]
    assert test.exceptAll(again).isEmpty()
    # No plane of the grid falls to one side as a whole.
    shares = feat.with_split(df).groupBy("voxel_z").agg(F.avg(F.col("is_test").cast("int")).alias("s"))
    assert shares.where("s < 0.05 OR s > 0.45").isEmpty()


@pytest.fixture(scope="module")
def separable(spark):
    """Voxels whose label follows from height and intensity; a few features are missing."""
    df = spark.range(3000).select(
        *[(F.pmod(F.hash("id", F.lit(s)), F.lit(40)) - 20).cast("int").alias(k) for s, k in enumerate(VOXEL)],
        (F.pmod(F.hash("id", F.lit(9)), F.lit(100)) / 2).alias("avg_intensity"),
        F.lit(7).cast("long").alias("point_count"),
        *[
            F.pmod(F.hash("id", F.lit(20 + i)), F.lit(256)).cast("int").alias(f"avg_{c}")
            for i, c in enumerate(("red", "green", "blue"))
        ],
    )
    label = F.when(F.col("voxel_z") > 3, 7).when(F.col("avg_intensity") > 25, 4).otherwise(2)
    df = df.withColumn("majority_label", label)
    return df.withColumn("avg_red", F.when(F.col("avg_red") > 5, F.col("avg_red")))


def test_classifier_learns_saves_and_reloads(spark, separable, tmp_path):
    train, test = feat.split(separable)
    marked = feat.scale(feat.with_split(separable), VOXEL_ML_FEATURES, fit_on=~F.col("is_test"))
    scaled = lambda df: marked.where("is_test" if df is test else "NOT is_test")
    model = classifier.train_classifier(scaled(train), max_iter=60)
    assert classifier.model_classes(model) == [2, 4, 7]
    scored = classifier.classify(model, scaled(test))
    result = classifier.evaluate(scored, classifier.model_classes(model)).first()
    largest = test.groupBy("majority_label").count().agg(F.max("count")).first()[0] / test.count()
    assert result.n == test.count()
    assert result.accuracy > 0.9 > largest
    assert 0 < result.log_loss < 0.3
    classifier.save_model(model, str(tmp_path / "model"))
    again = classifier.classify(classifier.load_model(str(tmp_path / "model")), scaled(test))
    assert rows(again, *VOXEL, "predicted") == rows(scored, *VOXEL, "predicted")


def test_log_loss_against_hand_values(spark):
    df = spark.createDataFrame(
        [(2, 2, [0.8, 0.2]), (4, 2, [0.6, 0.4]), (9, 2, [0.5, 0.5])],
        "majority_label int, predicted int, probability array<double>",
    )
    result = classifier.evaluate(df, [2, 4]).first()
    assert result.accuracy == pytest.approx(1 / 3)
    assert result.log_loss == pytest.approx(-(math.log(0.8) + math.log(0.4) + math.log(1e-15)) / 3)


def test_registered_classifier_scores_every_test_voxel(spark, sf_dir):
    from pointmill.plans.queries import QUERIES

    voxels = views.clean_voxels(spark, sf_dir)
    assert QUERIES["classify_voxels"](spark, sf_dir).count() == feat.split(voxels)[1].count()
    assert clean(views.points(spark, sf_dir)).count() == 5126


def plain_network(x, layers, activation):
    for k, layer in enumerate(layers):
        x = [sum(a * b for a, b in zip(w, x, strict=True)) + b for w, b in zip(layer.weights, layer.bias, strict=True)]
        if k < len(layers) - 1:
            x = [max(v, 0.0) if activation == "relu" else 1 / (1 + math.exp(-v)) if v > -700 else 0.0 for v in x]
    powers = [math.exp(v - max(x)) for v in x]
    return [v / sum(powers) for v in powers]


@pytest.mark.parametrize("activation", ["relu", "sigmoid"])
def test_forward_pass_equals_plain_loops(spark, activation):
    layers = [network.Layer([[0.5, -1.0], [2.0, 0.25], [-0.5, 1.0]], [0.1, -0.2, 0.0]), network.Layer([[1.0, -1.0, 0.5], [0.0, 2.0, -3.0]], [0.5, -0.5])]
    data = [(1.0, 2.0), (-3.5, 0.0), (0.0, 1e3), (None, 1.0)]
    df = spark.createDataFrame(data, "a double, b double")
    units = network.weight_table(spark, layers).repartition(3)
    found = {r.a: r for r in network.network_scores(df, units, ["a", "b"], activation, classes=[7, 9]).collect()}
    for x in data[:3]:
        want = plain_network(x, layers, activation)
        assert found[x[0]].probability == pytest.approx(want, abs=1e-12)
        assert found[x[0]].predicted == (7 if want[0] >= want[1] else 9)
    assert (found[None].probability, found[None].predicted) == (None, None)
    with pytest.raises(ValueError, match="does not take 1 inputs"):
        network.network_scores(df, layers, ["a"])
    with pytest.raises(ValueError, match="not whole"):
        network.read_layers(units.where("layer = 0 OR unit = 1"))
    with pytest.raises(ValueError, match="no layers"):
        network.read_layers(units.where("false"))


def test_trained_model_equals_its_weight_table(spark, tmp_path):
    df = spark.range(300).select((F.col("id") % 17 / 8).alias("a"), (F.col("id") % 23 / 11).alias("b"), (F.col("id") % 3 + 4).cast("int").alias("majority_label"))
    model = classifier.train_classifier(df, ["a", "b"], hidden=(5, 4), max_iter=20)
    path = str(tmp_path / "units")
    network.weight_table(spark, network.layers_of(model)).write.parquet(path)
    by_model = {(r.a, r.b): r for r in classifier.classify(model, df, ["a", "b"]).collect()}
    by_table = network.network_scores(df, spark.read.parquet(path), ["a", "b"], "sigmoid", classifier.model_classes(model)).collect()
    for r in by_table:
        other = by_model[r.a, r.b]
        assert r.probability == pytest.approx(list(other.probability), abs=1e-9) and r.predicted == other.predicted


def test_label_dictionary_serves_later_data(spark, tmp_path):
    path = str(tmp_path / "labels")
    feat.label_dictionary(points(spark, {"label": 10}, {"label": 2}, {"label": 2}, {"label": None})).write.parquet(path)
    known = spark.read.parquet(path)
    assert rows(known) == [(2, 0), (10, 1)]
    coded = feat.encode_labels(points(spark, {"label": 10}, {"label": 3}, {"label": None}).withColumn("label_index", F.lit("clash")), known)
    assert rows(coded, "label", "label_index") == [(3, None), (10, 1), (None, None)]
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan
