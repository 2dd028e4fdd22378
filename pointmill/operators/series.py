"""Ordered computations over long series.

A window over a whole series would put it into one task. Instead the time axis
is cut into slices holding about _SLICE_ROWS rows each, windows run per (series,
slice), and what must cross a slice border is carried by one summary row per
slice. Slices follow the row count, so a task stays small when one series holds
most of the data. A slice that a burst fills beyond twice that number is cut
again at quantiles of its times, and one instant at quantiles of the tie.
"""

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointmill.functions.columns import micros, packed
from pointmill.workspace import written

_SLICE_ROWS = 200_000
#: Parts that an overfull slice is cut into at a time.
_CUTS = 64
_FIRST, _LAST = -(2**63), 2**63 - 1


def slice_seconds(df: DataFrame, ts: str) -> float:
    """Width of time slices that hold about _SLICE_ROWS rows. One pass over one column.

    The rows are cut into tenths by time and the middle one of their spans
    counts, so neither stray times far off nor a burst decides.
    """
    return _measure(df, ts)[1]


def _measure(df: DataFrame, ts: str) -> tuple[int, float]:
    """All rows, and the width of slices."""
    at = micros(F.col(ts))
    rows, n, marks = df.agg(F.count("*"), F.count(ts), F.percentile_approx(at, [i / 10 for i in range(11)])).first()
    if not n:
        return rows, 1.0
    spans = sorted(b - a for a, b in zip(marks, marks[1:]))
    typical = spans[5] or (marks[-1] - marks[0]) / 10
    return rows, max(typical * _SLICE_ROWS * 10 / n, 1.0) / 1e6


def _begin(at: Column, tie: Column) -> Column:
    """Where a slice begins; it also names the slice. Never NULL."""
    return F.struct(F.coalesce(at, F.lit(_FIRST)).alias("at"), F.coalesce(tie, F.lit(_FIRST)).alias("tie"))


@dataclass(frozen=True)
class Slices:
    """How series are cut: into slices of width microseconds, and further at the places each level lists.

    A level has a row (_series, _slice, _instant, _marks) for each slice of the level before it that is overfull. Marks are
    times, or ties if the slice holds one instant only.
    """

    width: int
    levels: tuple[DataFrame, ...] = ()

    def of(self, df: DataFrame, at: Column, tie: Column | None = None) -> DataFrame:
        """df, which has _series, with _slice: the place (time, tie) its slice begins at, or the time only if nothing is cut further.

        Rows without a time or a tie come first, as NULL sorts. _slice is never NULL also for Spark: the joins on it then
        infer no NULL filter, which would reach one side only and keep both sides from sharing a shuffle.
        """
        start = F.coalesce(at - F.pmod(at, F.lit(self.width)), F.lit(_FIRST))
        if not self.levels:
            return df.withColumn("_slice", start)
        known_tie = F.coalesce(tie.cast("long") if tie is not None else F.lit(None).cast("long"), F.lit(_FIRST))
        df = df.withColumns({"_slice": _begin(start, F.lit(_FIRST)), "_in_at": F.coalesce(at, F.lit(_FIRST)), "_in_tie": known_tie})
        here, instant = F.col("_in_at"), F.col("_instant")
        in_instant = F.when(here == instant, F.col("_in_tie")).when(here > instant, F.lit(_LAST)).otherwise(F.lit(_FIRST))
        place = F.when(instant.isNull(), here).otherwise(in_instant)
        for level in self.levels:
            df = df.join(level, ["_series", "_slice"], "left").withColumn("_in_place", place)
            df = df.withColumn("_passed", F.array_max(F.filter("_marks", lambda mark: mark <= F.col("_in_place"))))
            cut = F.when(instant.isNull(), _begin(F.col("_passed"), F.lit(_FIRST))).otherwise(_begin(instant, F.col("_passed")))
            df = df.withColumn("_slice", F.when(F.col("_passed").isNull(), F.col("_slice")).otherwise(cut))
            df = df.drop("_instant", "_marks", "_in_place", "_passed")
        return df.drop("_in_at", "_in_tie")


def plan_slices(df: DataFrame, keys: Sequence[str], ts: str, tie: str | None = None, seconds: float | None = None, back: float = 0) -> Slices:
    """Slices of at most about twice _SLICE_ROWS rows, for all series of df.

    tie, a whole number, orders the rows of one instant; rows that it does not tell apart stay together. With back, a window's
    length in seconds, every row counts at its own place and at the place the window before it starts. Costs a counting pass, if
    there are enough rows to fill a slice too much at all, and one pass over the rows of overfull slices for each time
    these have to be cut by a factor of 64.
    """
    if seconds is None:
        n, seconds = _measure(df, ts)
        if n * (2 if back else 1) <= 2 * _SLICE_ROWS:
            return Slices(max(1, int(seconds * 1e6)))
    slices = Slices(max(1, int(seconds * 1e6)))
    at = micros(F.col(ts))
    order = F.col(tie).cast("long") if tie else F.lit(None).cast("long")
    place = lambda at: F.struct(at.alias("_at"), order.alias("_tie"))
    places = F.array(place(at), place(at - F.lit(int(back * 1e6)))) if back else F.array(place(at))
    rows = df.select(F.struct(*keys).alias("_series"), F.inline(places))
    known_at, known_tie = (F.coalesce(c, F.lit(_FIRST)) for c in ("_at", "_tie"))
    while True:
        sliced = slices.of(rows, F.col("_at"), F.col("_tie"))
        sizes = sliced.groupBy("_series", "_slice").agg(
            F.count("*").alias("n"),
            F.min(known_at).alias("min_at"),
            F.max(known_at).alias("max_at"),
            F.min(known_tie).alias("min_tie"),
            F.max(known_tie).alias("max_tie"),
        )
        one_instant = F.col("min_at") == F.col("max_at")
        overfull = (F.col("n") > 2 * _SLICE_ROWS) & ~(one_instant & (F.col("min_tie") == F.col("max_tie")))
        if not slices.levels:
            sizes, sliced = (x.withColumn("_slice", _begin(F.col("_slice"), F.lit(_FIRST))) for x in (sizes, sliced))
        parts = F.least(F.ceil(F.col("n") / _SLICE_ROWS), F.lit(_CUTS)).alias("parts")
        heavy = written(sizes.where(overfull).select("_series", "_slice", one_instant.alias("instant"), parts), "overfull_slices")
        if heavy.isEmpty():
            return slices
        by = F.when(F.col("instant"), known_tie).otherwise(known_at)
        quantiles = F.percentile_approx(by, [k / _CUTS for k in range(1, _CUTS)])
        cut = sliced.join(heavy, ["_series", "_slice"]).groupBy("_series", "_slice", "instant", "parts").agg(F.min(known_at).alias("_at"), quantiles.alias("q"))
        # As many of the quantiles as parts are wanted: each row is compared with all marks of its slice.
        share = lambda k: F.floor(k * F.col("parts") / _CUTS)
        cut = cut.withColumn("q", F.filter("q", lambda _, k: share(k + 1) > share(k)))
        # A value that holds many rows is cut off on both sides.
        marks = F.array_union("q", F.transform("q", lambda v: F.least(v, F.lit(_LAST - 1)) + 1))
        level = cut.select("_series", "_slice", F.when(F.col("instant"), F.col("_at")).alias("_instant"), marks.alias("_marks"))
        level = written(level, "slice_cuts")
        slices = replace(slices, levels=(*slices.levels, level))


def running_total(
    df: DataFrame, keys: Sequence[str], ts: str, tie: str, value: str, out: str, slices: float | Slices | None = None
) -> DataFrame:
    """Add the sum of value over the rows of the same series up to and with this one, ordered by (ts, tie); tie is a whole number.

    slices: as planned by plan_slices for these keys, or the width in seconds to plan them with.
    """
    if not isinstance(slices, Slices):
        slices = plan_slices(df, keys, ts, tie, slices)
    # As a struct, a series with a NULL in its keys equals itself in the join below.
    sliced = slices.of(df.withColumn("_series", F.struct(*keys)), micros(F.col(ts)), F.col(tie))
    in_slice = Window.partitionBy("_series", "_slice").orderBy(ts, tie)
    earlier = Window.partitionBy("_series").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sliced.groupBy("_series", "_slice")
        .agg(F.sum(value).alias("_sum"))
        .select("_series", F.col("_slice"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    )
    inner = F.sum(value).over(in_slice.rowsBetween(Window.unboundedPreceding, 0))
    return (
        sliced.withColumn(out, inner)
        .join(carried, ["_series", "_slice"])
        .withColumn(out, F.col(out) + F.col("_before"))
        .drop("_series", "_slice", "_before")
    )


def _reset_corrected(samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Samples with `steady`, the counter plus everything lost in resets so far, and one row per slice.

    Input: _series, _slice, _at, value. The slice rows hold what resets took
    before the slice's first sample (_carried), and that sample (_at, steady).
    """
    in_slice = Window.partitionBy("_series", "_slice").orderBy("_at")
    previous = F.lag("value").over(in_slice)
    lost = F.when(F.col("value") < previous, previous).otherwise(0)
    rows = samples.withColumn("_lost", lost)

    by_slice = Window.partitionBy("_series").orderBy("_slice")
    last_before = F.lag("_last").over(by_slice)
    at_border = F.when(F.col("_first") < last_before, last_before).otherwise(0)
    slices = (
        rows.groupBy("_series", "_slice")
        .agg(
            F.min("_at").alias("_at"),
            F.min_by("value", "_at").alias("_first"),
            F.max_by("value", "_at").alias("_last"),
            F.sum("_lost").alias("_inside"),
        )
        .withColumn("_border", at_border)
        .withColumn("_carried", F.sum(F.col("_inside") + F.col("_border")).over(by_slice) - F.col("_inside"))
        .select("_series", "_slice", "_at", "_carried", (F.col("_first") + F.col("_carried")).alias("steady"))
    )
    so_far = F.sum("_lost").over(in_slice.rowsBetween(Window.unboundedPreceding, 0))
    steady = (
        rows.withColumn("_lost", so_far)
        .join(slices.select("_series", "_slice", "_carried"), ["_series", "_slice"])
        .select("_series", "_at", "value", (F.col("value") + F.col("_lost") + F.col("_carried")).alias("steady"))
    )
    return steady, slices


def _with_window_start(
    samples: DataFrame, steady: DataFrame, borders: DataFrame, window_seconds: float, slices: Slices
) -> DataFrame:
    """Add `first`, the time and steady value of the first sample in the window that ends at each sample.

    Each sample leaves a probe at the start of its window. Probes and samples
    meet in one window per (series, slice), latest first, where a probe takes
    the sample seen last; with none left in the slice it takes the first sample
    of the next slice that has one.
    """

    def row(place: Column, is_sample: bool) -> Column:
        sample = F.when(F.lit(is_sample), F.struct("_at", "steady"))
        fields = [F.col("_at"), F.col("value"), F.col("steady"), sample.alias("_sample")]
        return F.struct(place.alias("_place"), F.lit(is_sample).alias("_is_sample"), *fields)

    start = F.col("_at") - F.lit(int(window_seconds * 1e6))
    placed = steady.select("_series", F.inline(F.array(row(F.col("_at"), True), row(start, False))))
    placed = slices.of(placed, F.col("_place"))

    # At the same place the sample comes first: the window includes its start.
    latest_first = Window.partitionBy("_series", "_slice").orderBy(F.desc("_place"), F.desc("_is_sample"))
    seen = F.last("_sample", ignorenulls=True).over(latest_first.rowsBetween(Window.unboundedPreceding, 0))

    # For each slice that holds a probe, the first sample of the next slice that has one:
    # looked up among slice rows, however many slices a window spans.
    firsts = borders.select("_series", "_slice", F.struct("_at", "steady").alias("_first"))
    probed = slices.of(samples.select("_series", start.alias("_place")), F.col("_place")).select("_series", "_slice").distinct()
    later_first = Window.partitionBy("_series").orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    following = (
        probed.join(firsts, ["_series", "_slice"], "full")
        .withColumn("_next", F.last("_first", ignorenulls=True).over(later_first))
        .select("_series", "_slice", "_next")
    )
    return (
        placed.withColumn("_seen", seen)
        .where(~F.col("_is_sample"))
        .join(following, ["_series", "_slice"], "left")
        .select("_series", "_at", "value", "steady", F.coalesce("_seen", "_next").alias("first"))
    )


def counter_rate(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    window_seconds: float,
    tie: str | None = None,
    slices: float | Slices | None = None,
) -> DataFrame:
    """Rate per second of a counter at each sample, over the window that ends there.

    The rate is the increase from the first to the last sample in the window
    (both ends included) divided by the time between them; it is not
    extrapolated to the window's edges. A value below the one before it is a
    reset, after which the counter started from 0. A window with one sample has
    rate NULL. Samples of one series at the same instant count once: the one
    with the highest tie, a whole number, else the highest value. Samples
    without a time or a value are no samples. slices: as planned by plan_slices
    for these keys and window, or the width in seconds to plan them with.
    """
    if not isinstance(slices, Slices):
        slices = plan_slices(df.where(F.col(ts).isNotNull()), keys, ts, seconds=slices, back=window_seconds)
    order = F.coalesce(F.col(tie), F.lit(-(2**63))) if tie else F.col(value)
    samples = (
        df.where(F.col(ts).isNotNull() & F.col(value).isNotNull())
        .groupBy(F.struct(*keys).alias("_series"), micros(F.col(ts)).alias("_at"))
        .agg(F.max_by(value, order).alias("value"))
    )
    samples = slices.of(samples, F.col("_at"))
    increase = F.col("steady") - F.col("first")["steady"]
    elapsed = (F.col("_at") - F.col("first")["_at"]) / F.lit(1e6)
    return _with_window_start(samples, *_reset_corrected(samples), window_seconds, slices).select(
        *[F.col("_series")[k].alias(k) for k in keys],
        F.timestamp_micros("_at").alias(ts),
        F.col("value").alias(value),
        F.try_divide(increase, elapsed).alias("rate"),
    )


def _recent(df: DataFrame, keys: Sequence[str], ts: str, window_seconds: float) -> DataFrame:
    """Rows no older than window_seconds before the latest row of their series."""
    series = df.withColumn("_series", F.struct(*keys))
    latest = series.groupBy("_series").agg(F.max(micros(F.col(ts))).alias("_latest"))
    from_time = F.col("_latest") - F.lit(int(window_seconds * 1e6))
    return series.join(latest, "_series").where(micros(F.col(ts)) >= from_time).drop("_series", "_latest")


def cpu_usage(
    df: DataFrame,
    ts: str,
    value: str,
    window_seconds: float,
    idle: str = "idle",
    cpu: Sequence[str] = (),
    tie: str | None = None,
    slices: float | Slices | None = None,
) -> DataFrame:
    """Busy share of each instance in percent: 100 - 100 * mean idle rate of its series, at their latest samples.

    Series are those of (instance, mode, *cpu); slices as for counter_rate.
    """
    keys = ["instance", "mode", *cpu]
    recent = _recent(df.where(F.col("mode") == idle), keys, ts, window_seconds)
    return (
        counter_rate(recent, keys, ts, value, window_seconds, tie, slices)
        .groupBy(*keys)
        .agg(F.max_by("rate", ts).alias("rate"))
        .groupBy("instance")
        .agg((F.lit(100) - F.avg("rate") * 100).alias("cpu_usage"))
    )


def latest(df: DataFrame, keys: Sequence[str], ts: str, value: str, tie: str) -> DataFrame:
    """The latest value of each series; tie, a whole number, decides between samples of one instant."""
    return df.groupBy(*keys).agg(
        F.max(ts).alias(ts),
        F.max_by(value, packed(micros(F.col(ts)), F.col(tie))).alias(value),
    )
