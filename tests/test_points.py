import math

from pyspark.sql import functions as F

from pointmill.functions.columns import nearest_int
from pointmill.operators import points as pts
from pointmill.schema import PLY_PROPERTIES, POINT, VOXEL
from tests.helpers import points, rows


def test_rounding_is_half_away_from_zero(spark):
    df = points(spark, *[{"x": v} for v in (0.5, -0.5, 2.5, -1.5, 0.49999999999999994)])
    assert [r[0] for r in pts.voxel_keys(df).select("voxel_x").collect()] == [1, -1, 3, -2, 0]


def test_nearest_equals_round(spark):
    df = spark.range(20000).select(((F.rand(7) - 0.5) * 4000).alias("v"))
    halves = spark.range(-4000, 4000).select((F.col("id") / 2).alias("v"))
    edges = spark.createDataFrame([(v,) for v in (2147483647.4, -2147483648.4, 1e-300, -0.0)], "v double")
    both = df.union(halves).union(edges)
    assert both.where(~nearest_int(F.col("v")).eqNullSafe(F.round("v", 0).cast("int"))).count() == 0


def test_bad_coordinates_give_null_keys(spark):
    bad = [math.nan, 5e9, None, math.inf, -math.inf, 1e300, 2147483647.5]
    df = pts.voxel_keys(points(spark, *[{"x": v} for v in bad]))
    assert [r.voxel_x for r in df.collect()] == [None] * len(bad)


def test_points_lie_within_half_a_voxel(spark):
    df = spark.range(5000).select(*[((F.rand(s) - 0.5) * 100).alias(a) for s, a in enumerate("xyz")])
    for size in (0.25, 1.0, 3.0):
        keyed = pts.voxel_keys(df, size)
        far = " OR ".join(f"abs({a} - voxel_{a} * {size}) > {size} / 2 + 1e-9" for a in "xyz")
        assert keyed.where(far).count() == 0


def test_noise_and_null_labels_are_dropped(spark):
    df = points(spark, {"label": 0}, {"label": 1}, {"label": None})
    assert rows(pts.clean(df), "label") == [(1,)]


def test_normalize_cuts_label_fractions(spark):
    raw = spark.createDataFrame(
        [(1.5, 2.0, 3.0, 200, 100, 50, 9.5, 1e9, -3.0, 7.9), (1.0, 2.0, 3.0, 0, 0, 0, 0.0, 0.0, 0.0, math.nan)],
        "x float, y float, z float, red short, green short, blue short, scalar_Intensity float, "
        "scalar_GPSTime double, scalar_ScanAngleRank float, scalar_Label float",
    )
    out = pts.normalize_points(raw)
    assert out.columns == POINT.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in POINT]
    assert [r.label for r in out.collect()] == [7, None]
    assert list(PLY_PROPERTIES.values()) == POINT.names


def test_messages_round_trip_and_corrupt_records(spark):
    df = points(spark, {"x": 1.25, "label": 3}, {"x": None, "label": None})
    assert rows(pts.from_messages(pts.to_messages(df))) == rows(df)
    bad = spark.createDataFrame([('{"x":1,"label":"bad"}',), ("not json",), ('{"x":2,"label":1}',)], "value string")
    decoded = pts.from_messages(bad, keep_corrupt=True)
    assert {(r.x, r.label, r["_corrupt"] is None) for r in decoded.collect()} == {
        (1.0, None, False), (None, None, False), (2.0, 1, True),
    }
    assert rows(pts.clean(decoded), "x", "label") == [(2.0, 1)]


def test_global_shift(spark):
    df = points(spark, {"x": 500123.5, "y": -7.0, "z": 1.0}, {"x": 500999.0, "y": 4.0, "z": 2.0})
    shifted = pts.global_shift(df, 1000.0)
    assert rows(shifted, "x", "y", "z") == [(123.5, 993.0, 1.0), (999.0, 1004.0, 2.0)]


def test_voxel_key_columns(spark):
    keyed = pts.voxel_keys(points(spark, {}))
    assert [keyed.schema[k].dataType.simpleString() for k in VOXEL] == ["int"] * 3
