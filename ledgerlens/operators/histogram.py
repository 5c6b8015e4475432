"""Equal-width histograms (numpy.histogram semantics) as one aggregation.

The range comes from scalar subqueries (min / max), the bin is a Catalyst
expression, and only ``bins`` rows reach the result; the last bin is closed
on the right like numpy's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bin_index(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """1..bins; the maximum value falls into the last bin."""
    raw = F.floor((v - lo) * F.lit(float(bins)) / (hi - lo)) + 1
    return F.when(hi == lo, F.lit(1)).otherwise(F.least(raw, F.lit(bins))).cast("int")


def width_bucket_counts(df: DataFrame, col: str | Column, bins: int = 60,
                        lo: Column | None = None, hi: Column | None = None) -> DataFrame:
    """(bin, bin_start, bin_end, count) for an equal-width histogram of ``col``."""
    v = (F.col(col) if isinstance(col, str) else col).cast("double")
    vals = df.select(v.alias("__v")).where(F.col("__v").isNotNull())
    lo = lo if lo is not None else vals.agg(F.min("__v")).scalar()
    hi = hi if hi is not None else vals.agg(F.max("__v")).scalar()
    b = vals.select(bin_index(F.col("__v"), lo, hi, bins).alias("bin"))
    g = b.groupBy("bin").agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    width = (hi - lo) / F.lit(float(bins))
    return g.select("bin",
                    F.round(lo + (F.col("bin") - 1) * width, 6).alias("bin_start"),
                    F.round(lo + F.col("bin") * width, 6).alias("bin_end"),
                    "count").orderBy("bin")
