"""Interval index join: points against many overlapping intervals, without a hot key.

A join on a key and a range condition puts all intervals of the key beside all of its points: with a
hundred thousand campaigns in one category that is one task and a product.  Here the intervals are indexed
first, in buckets of their own length:

* an interval of length n lies on level ceil(log2 n), whose buckets are 2^level wide, so it touches two of
  them at most, and fills at least a quarter of those together;
* a point looks into one bucket on each level that occurs (a few tens at most, whatever the number of
  intervals), so a pair meets in exactly one place and about one meeting in four or more is a result;
* a bucket with more than ``PER_PART`` points is cut into parts: its points are dealt out by hash, its
  intervals go to each part.  Parts come from counts, so a hot bucket of any size spreads evenly.

All of it is joins and groupings on (key, level, bucket, part); results are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_PART = 100_000


def _level(length: Column) -> Column:
    """ceil(log2(length)) in integers."""
    return F.when(length <= 1, 0).otherwise(F.length(F.bin(length - 1))).cast("int")


def _bucket(value: Column, level: Column) -> Column:
    return F.call_function("shiftright", value, level)


def indexed(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """``intervals`` once for each bucket that they touch: columns ``__level`` and ``__bucket`` are added; empty ones go."""
    rows = intervals.where(F.col(end) > F.col(start)).withColumn("__level", _level(F.col(end) - F.col(start)))
    first, last = _bucket(F.col(start), F.col("__level")), _bucket(F.col(end) - 1, F.col("__level"))
    return rows.withColumn("__bucket", F.explode(F.sequence(first, last)))


def interval_join(points: DataFrame, intervals: DataFrame, key: str, at: str, start: str, end: str, per_part: int = PER_PART) -> DataFrame:
    """Pairs of ``points`` and ``intervals`` of one ``key`` with start <= at < end (long columns); the columns of both, the key once.

    Null keys, points and ends pair with nothing.  Repeated rows pair each; points equal in all columns share a part.
    """
    index = indexed(intervals, start, end)
    # One row; its list has a number for each level, 64 at most.
    levels = index.agg(F.collect_set("__level").alias("__levels"))
    spread = points.where(F.col(key).isNotNull() & F.col(at).isNotNull()).crossJoin(F.broadcast(levels)).withColumn("__level", F.explode("__levels")).drop("__levels")
    spread = spread.withColumn("__bucket", _bucket(F.col(at), F.col("__level")))
    place = [key, "__level", "__bucket"]
    # Buckets that hold points and intervals, with the number of their parts; those with a single part need no row.
    parts = spread.join(index.select(*place).distinct(), place, "left_semi").groupBy(*place).agg(F.ceil(F.count("*") / per_part).cast("int").alias("__parts")).where("__parts > 1")
    spread = spread.join(parts, place, "left").withColumn("__part", F.when(F.col("__parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*points.columns), F.col("__parts"))).cast("int"))
    index = index.join(parts, place, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__parts"), F.lit(1)) - 1)))
    met = spread.drop("__parts").join(index.drop("__parts"), [*place, "__part"])
    return met.where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).select(key, *[c for c in points.columns if c != key], *[c for c in intervals.columns if c != key])


def days(date: Column) -> Column:
    """A date as a number of days."""
    return F.unix_date(date).cast("long")
