"""Column expressions shared by the operators. All stay inside codegen."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The largest double below one half. Added instead of 0.5 it takes exact halves up
# (the sum rounds to the whole number) and nothing below a half with them.
_HALF = 0.49999999999999994

# Fixed values of the split hash: odd multipliers per axis, then one step of a
# multiplicative generator modulo the prime 2^31 - 1.
_AXIS_MULTIPLIERS = (73856093, 19349663, 83492791)
_PRIME = 2147483647
_STEP = 48271


def nearest_int(value: Column) -> Column:
    """round(value, 0) as an int: halves go away from zero.

    The built-in round() takes every double through BigDecimal, which costs
    about ten times as much as this. NaN, NULL and values past the int range
    give NULL instead of an ANSI error.
    """
    in_range = (value > -(2**31) - 0.5) & (value < 2**31 - 0.5)
    whole = F.when(value < 0, F.ceil(value - _HALF)).otherwise(F.floor(value + _HALF))
    return F.when(in_range, whole).cast("int")


def packed(high: Column, low: Column) -> Column:
    """One number that sorts like (high, low), both whole numbers.

    max_by over a struct makes Spark sort its whole input (a struct cannot be
    updated in a hash aggregation buffer); a decimal keeps it a HashAggregate.
    """
    return high.cast("decimal(19,0)") * F.lit(Decimal(2**64)) + low.cast("decimal(19,0)")


def majority(label: Column, votes: Column) -> Column:
    """Aggregate: the label with most votes, the lowest one on ties. NULL labels do not vote."""
    order = F.when(label.isNotNull(), packed(votes, -label.cast("long")))
    return F.max_by(label, order)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def bucket(x: Column, y: Column, z: Column, buckets: int) -> Column:
    """Bucket 0..buckets-1 of a voxel, the same under any partitioning. NULL keys count as 0."""
    mixed = sum(
        F.coalesce(axis, F.lit(0)).cast("long") * F.lit(m)
        for axis, m in zip((x, y, z), _AXIS_MULTIPLIERS)
    )
    return (F.pmod(F.pmod(mixed, F.lit(_PRIME)) * F.lit(_STEP), F.lit(_PRIME)) % F.lit(buckets)).cast("int")
