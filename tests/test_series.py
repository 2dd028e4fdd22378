import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pointmill.operators import series
from tests.helpers import rows

START = datetime(2024, 1, 1)


def samples(spark, data):
    """data: (instance, mode, seconds, id, value)"""
    out = [(i, m, None if s is None else START + timedelta(seconds=s), n, v) for i, m, s, n, v in data]
    return spark.createDataFrame(out, "instance int, mode string, ts timestamp, id long, value long")


def random_data(n=900, seed=5):
    """Three series, one of them holding two thirds of the rows, with resets and ties."""
    pick = random.Random(seed)
    data, counters = [], {}
    for i in range(n):
        key = (0, "idle") if i % 3 else pick.choice([(1, "idle"), (None, "user")])
        counters[key] = 0 if pick.random() < 0.05 else counters.get(key, 0) + pick.randrange(50)
        data.append((*key, i * 7 + pick.randrange(7), i, counters[key]))
        if pick.random() < 0.1:
            data.append((*key, data[-1][2], n + i, counters[key] + 1))
    return data


def brute_rate(data, window):
    by_key = {}
    for i, m, s, n, v in data:
        kept = by_key.setdefault((i, m), {})
        if s not in kept or n > kept[s][0]:
            kept[s] = (n, v)
    out = []
    for key, kept in by_key.items():
        times = sorted(kept)
        for t in times:
            inside = [u for u in times if t - window <= u <= t]
            values = [kept[u][1] for u in inside]
            gain = sum(b if b < a else b - a for a, b in zip(values, values[1:]))
            rate = gain / (t - inside[0]) if t > inside[0] else None
            out.append((*key, START + timedelta(seconds=t), kept[t][1], rate))
    return out


KEYS = ["instance", "mode"]


@pytest.mark.parametrize("slice_seconds", [10.0, 333.0, 1e7])
def test_rate_equals_brute_force_for_any_slices(spark, slice_seconds):
    data = random_data()
    got = series.counter_rate(samples(spark, data), KEYS, "ts", "value", 400, "id", slice_seconds)
    key = lambda r: (str(r[0]), r[1], r[2])
    got, want = sorted(map(tuple, got.collect()), key=key), sorted(brute_rate(data, 400), key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for a, b in zip(got, want):
        assert (a[4] is None and b[4] is None) or abs(a[4] - b[4]) < 1e-9, (a, b)


def test_reset_counts_the_new_value(spark):
    df = samples(spark, [(1, "idle", 0, 0, 10), (1, "idle", 10, 1, 20), (1, "idle", 20, 2, 5)])
    out = series.counter_rate(df, KEYS, "ts", "value", 60).orderBy("ts").collect()
    assert [r.rate for r in out] == [None, 1.0, 0.75]


def test_window_includes_both_ends(spark):
    df = samples(spark, [(1, "idle", 0, 0, 0), (1, "idle", 60, 1, 60)])
    assert series.counter_rate(df, KEYS, "ts", "value", 60).orderBy("ts").collect()[1].rate == 1.0
    assert series.counter_rate(df, KEYS, "ts", "value", 59).orderBy("ts").collect()[1].rate is None


def test_running_total(spark):
    data = random_data(300)
    for width in (10.0, 1e7):
        got = series.running_total(samples(spark, data), KEYS, "ts", "id", "value", "total", width)
        total, want = {}, {}
        for i, m, s, n, v in sorted(data, key=lambda r: (r[2], r[3])):
            total[i, m] = total.get((i, m), 0) + v
            want[n] = total[i, m]
        assert {r.id: r.total for r in got.collect()} == want


def test_running_total_keeps_rows_without_a_time(spark):
    df = samples(spark, [(1, "a", None, 0, 5), (1, "a", 3, 1, 7)])
    got = series.running_total(df, KEYS, "ts", "id", "value", "total", 1.0)
    assert rows(got, "id", "total") == [(0, 5), (1, 12)]


def test_slices_follow_the_row_count(spark):
    df = spark.range(2_000_000).select(F.timestamp_seconds("id").alias("ts"))
    width = series.slice_seconds(df, "ts")
    assert width == pytest.approx(series._SLICE_ROWS, rel=0.01)
    stray = spark.createDataFrame([(datetime(1970, 1, 1),), (datetime(2200, 1, 1),)], "ts timestamp")
    burst = df.where("ts < '1970-01-03'").crossJoin(spark.range(2)).select("ts")
    assert series.slice_seconds(df.union(stray).union(burst), "ts") == pytest.approx(width, rel=0.3)
    assert series.slice_seconds(df.where("false"), "ts") == 1.0
    assert 0 < series.slice_seconds(stray.union(stray).limit(1), "ts") < 1


@pytest.mark.parametrize("window", [3, 90, 5000])
def test_rate_over_gaps(spark, window):
    pick = random.Random(window)
    times = sorted(pick.sample(range(200), 30) + pick.sample(range(4000, 4100), 30) + [9000, 9001])
    data = [(1, "a", s, n, pick.randrange(100)) for n, s in enumerate(times)]
    for width in (0.5, 7.0, 100.0):
        got = series.counter_rate(samples(spark, data), KEYS, "ts", "value", window, "id", width)
        assert [r.rate for r in got.orderBy("ts").collect()] == pytest.approx([r[4] for r in brute_rate(data, window)])


def test_samples_without_a_tie(spark):
    df = samples(spark, [(1, "a", 0, None, 3), (1, "a", 0, 4, 5), (1, "a", 1, None, 6)])
    assert rows(series.counter_rate(df, KEYS, "ts", "value", 9, "id"), "value", "rate") == [(5, None), (6, 1.0)]


def test_cpu_usage(spark):
    data = [(i, "idle", t * 15, i * 100 + t, t * 15 // (i + 1)) for i in (1, 2) for t in range(40)]
    data += [(1, "user", t * 15, 900 + t, t) for t in range(40)]
    out = {r.instance: r.cpu_usage for r in series.cpu_usage(samples(spark, data), "ts", "value", 300).collect()}
    assert out[1] == pytest.approx(50, abs=1) and out[2] == pytest.approx(100 - 100 / 3, abs=1)


def test_cpu_usage_averages_cores(spark):
    df = samples(spark, [(1, "idle", t * 10, t, t * 10) for t in range(5)]).withColumn("cpu", F.lit(0))
    both = df.union(df.withColumns({"cpu": F.lit(1), "value": F.col("value") / 2}))
    assert rows(series.cpu_usage(both, "ts", "value", 300, cpu=["cpu"])) == [(1, 25.0)]


def test_latest_breaks_ties_by_id(spark):
    df = samples(spark, [(1, "a", 5, 1, 10), (1, "a", 5, 2, 20), (1, "a", 4, 3, 30), (2, "a", 1, 4, 40)])
    latest = series.latest(df, KEYS, "ts", "value", "id")
    assert rows(latest, "instance", "value") == [(1, 20), (2, 40)]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def burst_data(n=1200, seed=2):
    """Half of all rows of one series in one second, a quarter at one instant, some without a time, others spread out."""
    pick = random.Random(seed)
    data, total = [], 0
    for i in range(n):
        total = 0 if pick.random() < 0.02 else total + pick.randrange(9)
        if i % 12 == 11:
            at = None
        else:
            at = [86_400.25, 86_400 + pick.randrange(10**6) / 1e6, i * 150.0, 90_000.5][i % 4]
        data.append((0 if i % 10 else 1, "idle", at, i, total))
    return data


def burst_samples(spark, data):
    return samples(spark, data).withColumn("n", F.lit(1))


@pytest.mark.parametrize("target", [20, 1])
def test_a_burst_is_cut_into_small_windows(spark, monkeypatch, target):
    monkeypatch.setattr(series, "_SLICE_ROWS", target)
    df = burst_samples(spark, burst_data())
    slices = series.plan_slices(df, KEYS, "ts", "id", back=400)
    assert slices.levels
    at = series.micros(F.col("ts"))
    for place in (at, at - 400_000_000):
        sliced = slices.of(df.withColumn("_series", F.struct(*KEYS)), place, F.col("id"))
        most = sliced.groupBy("_series", "_slice").count().agg(F.max("count")).first()[0]
        assert most <= 2 * target
        assert sliced.count() == df.count()
        # Slices follow each other: none begins before all of the one before it has ended.
        ends = [(r.s, r.low, r.high) for r in sliced.groupBy("_series", "_slice").agg(F.min(F.struct(place.alias("a"), "id")).alias("low"), F.max(F.struct(place.alias("a"), "id")).alias("high")).selectExpr("struct(_series, _slice) AS s", "low", "high").collect()]
        keyed = lambda r: (str(r[0][0]), *r[0][1])
        known = [(r[0][0], r[1], r[2]) for r in sorted(ends, key=keyed)]
        none_first = lambda p: tuple((v is not None, v or 0) for v in p)
        assert all(a[0] != b[0] or none_first(a[2]) < none_first(b[1]) for a, b in zip(known, known[1:]))


@pytest.mark.parametrize("width", [None, 1000.0, 1e7])
def test_running_total_over_a_burst(spark, monkeypatch, width):
    monkeypatch.setattr(series, "_SLICE_ROWS", 15)
    data = burst_data()
    got = series.running_total(burst_samples(spark, data), KEYS, "ts", "id", "value", "total", width)
    total, want = {}, {}
    for i, m, s, n, v in sorted(data, key=lambda r: (r[2] is not None, r[2] or 0, r[3])):
        total[i, m] = total.get((i, m), 0) + v
        want[n] = total[i, m]
    assert {r.id: r.total for r in got.collect()} == want


@pytest.mark.parametrize("window", [0.5, 400, 100_000])
def test_rate_over_a_burst(spark, monkeypatch, window):
    monkeypatch.setattr(series, "_SLICE_ROWS", 15)
    data = burst_data()
    got = series.counter_rate(burst_samples(spark, data), KEYS, "ts", "value", window, "id")
    key = lambda r: (str(r[0]), r[1], r[2])
    got, want = sorted(map(tuple, got.collect()), key=key), sorted(brute_rate([r for r in data if r[2] is not None], window), key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for a, b in zip(got, want, strict=True):
        assert (a[4] is None and b[4] is None) or a[4] == pytest.approx(b[4], rel=1e-6), (a, b)


def test_rows_at_one_place_stay_together(spark, monkeypatch):
    monkeypatch.setattr(series, "_SLICE_ROWS", 5)
    df = samples(spark, [(1, "a", 10, None, 1)] * 60 + [(1, "a", 10, 7, 2)] * 60 + [(1, "a", k, k, 1) for k in range(30)])
    got = series.running_total(df, KEYS, "ts", "id", "value", "total")
    last = got.groupBy("ts", "id").agg(F.max("total").alias("total")).orderBy("ts", "id").collect()
    assert [r.total for r in last if r.ts == START + timedelta(seconds=10)] == [70, 190, 191]
    assert series.plan_slices(df.limit(0), KEYS, "ts", "id").levels == ()
