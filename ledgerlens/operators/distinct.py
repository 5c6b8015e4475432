"""Distinct counts from mergeable sketches, with an exact path beside them.

A distinct count of a month can't be summed from its days; a sketch can be merged.  ``sketches`` keeps one
HyperLogLog sketch for each finest key (a day, or a day and a slicer), and any coarser question (a month, a
state, a rolling 30 days) unions the few sketches that it covers, without reading the facts again.

The standard error of a sketch of 2^k registers is 1.04 / sqrt(2^k): 1.6 % at k = 12, the default, and 0.8 %
at k = 14.  ``bound`` is four of them.  Small counts are kept exactly by the sketch.

Where the count must be exact, ``exact`` keeps the distinct (key, value) pairs instead.  They merge as well,
at the price of a row for each pair.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REGISTERS = 12


def bound(registers: int = REGISTERS) -> float:
    """Four standard errors, as a share of the count."""
    return 4 * 1.04 / math.sqrt(1 << registers)


def sketches(df: DataFrame, keys: Sequence[str], value: str, registers: int = REGISTERS) -> DataFrame:
    """A row for each combination of ``keys``, with the sketch of the distinct non-null values of ``value``."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, registers).alias("sketch"))


def merged(kept: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Coarser sketches: unions by ``keys`` (all in one without keys)."""
    return kept.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimate(sketch: str | Column = "sketch") -> Column:
    return F.hll_sketch_estimate(sketch)


def rolling(kept: DataFrame, day: str, window_days: int) -> DataFrame:
    """For each day of ``kept``, the sketch of that day and the ``window_days - 1`` before: each day's sketch goes to the days that cover it."""
    reach = F.sequence(F.col(day), F.date_add(day, window_days - 1))
    spread = kept.select(F.explode(reach).alias(day), "sketch")
    return merged(spread.join(kept.select(day).distinct(), day, "left_semi"), [day])


def exact(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The distinct (keys, value) pairs; count rows for the keys, or take ``exact`` again for coarser ones."""
    return df.select(*keys, value).where(F.col(value).isNotNull()).distinct()


def counts(pairs: DataFrame, keys: Sequence[str], value: str, name: str = "n") -> DataFrame:
    """Exact distinct counts by coarser ``keys`` from the pairs of ``exact``: two groupings, no expansion."""
    return exact(pairs, keys, value).groupBy(*keys).agg(F.count("*").alias(name))


def stickiness(kept: DataFrame, day: str, month: Column) -> DataFrame:
    """month, mau, avg_dau and stickiness_pct from daily sketches alone: monthly users are unions, daily ones estimates."""
    daily = kept.withColumn("month", month).withColumn("dau", estimate())
    g = daily.groupBy("month").agg(estimate(F.hll_union_agg("sketch")).alias("mau"), F.avg("dau").alias("avg_dau"))
    return g.withColumn("stickiness_pct", 100 * F.col("avg_dau") / F.col("mau"))
