import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from pointmill.functions.columns import majority
from pointmill.operators import stats, voxels
from pointmill.operators.points import clean, voxel_keys
from pointmill.plans import views
from pointmill.schema import VOXEL, VOXEL_ML_FEATURES
from tests.helpers import points, rows


def test_majority_takes_the_lowest_label_on_ties(spark):
    df = points(spark, *[{"label": v} for v in (3, 1, 1, 3, 7)])
    assert rows(voxels.voxelize(df), "majority_label", "point_count") == [(1, 5)]


def test_negative_and_extreme_labels(spark):
    low, high = -(2**31), 2**31 - 1
    df = points(spark, *[{"label": v} for v in (high, low, low, high, 0)])
    assert rows(voxels.voxelize(df), "majority_label") == [(low,)]


def test_more_than_an_int_of_votes(spark):
    votes = spark.createDataFrame([(5, 3 * 10**12), (4, 3 * 10**12), (9, 3 * 10**12 - 1)], "label int, n long")
    assert votes.agg(majority(F.col("label"), F.col("n"))).first()[0] == 4


def test_null_labels(spark):
    df = points(spark, {"label": None}, {"label": None}, {"x": 5.0, "label": None}, {"x": 5.0, "label": 2})
    assert rows(voxels.voxelize(df), "voxel_x", "majority_label", "point_count") == [(0, None, 2), (5, 2, 2)]


def test_colour_means_are_cut_not_rounded(spark):
    df = points(spark, *[{"red": r, "green": g} for r, g in ((2, -2), (3, -3), (3, -3))])
    assert rows(voxels.voxelize(df), "avg_red", "avg_green") == [(2, -2)]


def test_null_values_do_not_count_in_means(spark):
    df = points(spark, {"intensity": 4.0, "red": None}, {"intensity": None, "red": None})
    assert rows(voxels.voxelize(df), "avg_intensity", "avg_red", "point_count") == [(4.0, None, 2)]


def test_points_without_a_place_form_one_voxel(spark):
    df = points(spark, {"x": None}, {"x": float("nan")}, {"x": 1.0})
    assert rows(voxels.voxelize(df), "voxel_x", "point_count") == [(1, 1), (None, 2)]
    ids = {r.voxel_id for r in voxels.voxel_features(df).collect()}
    assert ids == {"?_0_0", "1_0_0"}


def test_against_brute_force_with_a_hot_voxel(spark):
    pick = random.Random(3)
    data = []
    for i in range(3000):
        hot = i % 3 == 0
        data.append(
            {
                "x": 0.25 if hot else pick.randrange(-40, 40) / 8,
                "y": 0.25 if hot else pick.randrange(-40, 40) / 8,
                "z": 0.25 if hot else pick.randrange(-8, 8) / 8,
                "red": pick.randrange(256),
                "intensity": pick.randrange(1000) / 16,
                "label": pick.choice([None, 0, 1, 2, 3, 4]),
            }
        )
    groups = defaultdict(list)
    near = lambda v: int(abs(v) + 0.5) * (1 if v >= 0 else -1)
    for p in data:
        groups[near(p["x"]), near(p["y"]), near(p["z"])].append(p)
    expected = set()
    for key, members in groups.items():
        count = Counter(m["label"] for m in members if m["label"] is not None)
        best = min(count, key=lambda v: (-count[v], v)) if count else None
        mean = sum(m["intensity"] for m in members) / len(members)
        expected.add((*key, mean, best, len(members), int(sum(m["red"] for m in members) / len(members))))
    df = points(spark, *data)
    columns = [*VOXEL, "avg_intensity", "majority_label", "point_count", "avg_red"]
    assert {tuple(r) for r in voxels.voxelize(df).select(*columns).collect()} == expected
    again = voxels.voxelize(df.repartition(7, "red"))
    assert {tuple(r) for r in again.select(*columns).collect()} == expected
    short = voxels.majority_label(df).select(*VOXEL, "majority_label", "point_count")
    assert {tuple(r) for r in short.collect()} == {(*e[:3], e[4], e[5]) for e in expected}


def test_point_counts_add_up(spark, sf_dir):
    cleaned = clean(views.points(spark, sf_dir))
    assert voxels.voxelize(cleaned).agg(F.sum("point_count")).first()[0] == cleaned.count()


def test_ml_features_leave_out_places(spark):
    assert voxels.ml_features(voxels.voxelize(points(spark, {}))).columns == [*VOXEL_ML_FEATURES, "majority_label"]


def test_plan_is_hash_aggregates_only(spark, sf_dir):
    plan = voxels.voxelize(clean(views.points(spark, sf_dir)))._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan and "Python" not in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_scan_reads_only_needed_columns(spark, sf_dir):
    df = voxels.majority_label(clean(views.points(spark, sf_dir)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "l_orderkey" not in plan
    assert "isnotnull(l_linenumber" in plan.split("FileScan")[1]


def test_statistics(spark):
    df = points(spark, {"x": 1.0, "label": 1}, {"x": 3.0, "label": 1}, {"x": None, "label": 2})
    assert rows(stats.summary(df, "x")) == [(1.0, 3.0, 2.0)]
    assert rows(stats.label_distribution(df)) == [(1, 2), (2, 1)]
    assert rows(stats.row_count(stats.above(df, "x", 1.0))) == [(1,)]
    assert rows(stats.row_count(stats.band(df, "x", 1.0, 3.0))) == [(2,)]
    assert rows(stats.distinct_count(df, "label")) == [(2,)]
    profile = {r.column_name: r for r in stats.profile(df).collect()}
    assert tuple(profile["x"]) == ("x", "double", 3, 2, 1.0, 3.0)
    named = stats.profile(df.withColumn("name", F.lit("a")))
    assert tuple(named.where("column_name = 'name'").first()) == ("name", "string", 3, 3, None, None)


def test_first_rows_is_a_top_n(spark, sf_dir):
    top = stats.first_rows(views.points(spark, sf_dir), 3, F.desc("intensity"))
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert top.count() == 3


def test_require_rows(spark):
    df = points(spark, {})
    assert stats.require_rows(df) is df
    try:
        stats.require_rows(df.where("false"), "landing folder")
    except ValueError as error:
        assert "landing folder" in str(error)
    else:
        raise AssertionError("an empty input passed")


def test_voxel_size(spark):
    df = points(spark, {"x": 0.9}, {"x": 1.1}, {"x": 2.6})
    assert rows(voxels.voxelize(df, 2.0), "voxel_x", "point_count") == [(0, 1), (1, 2)]
    assert rows(voxel_keys(df, 0.5), "voxel_x") == [(2,), (2,), (5,)]
