"""Sliding frames and lags over a global order, without a single partition.

``avg(x) OVER (ORDER BY t ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)`` plans one task for all rows.  Here the
rows are numbered by G1 (frozen ranges), cut into blocks of consecutive numbers, and each block gets a halo:
the last rows of the block before and the first of the block after, as many as the frame reaches.  A window
inside each block then sees exactly the rows that the plain window sees, in the same order, so even sums of
doubles agree to the last bit.  Only the halo is copied: (preceding + following) rows for each block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.ranking import Key, global_rank

BLOCK = 100_000


def sliding(df: DataFrame, keys: Sequence[Key], frames: dict[str, Column], preceding: int, following: int = 0, block: int = BLOCK,
            partitions: int | None = None) -> DataFrame:
    """Add ``frames`` (name -> aggregate) over the rows from ``preceding`` before to ``following`` after, in the order of ``keys``.

    The keys must be a total order (end with a unique id).  A negative ``following`` ends the frame before the row.
    """
    block = max(block, preceding, following, 1)
    numbered = global_rank(df, keys, partitions=partitions, rank_col="__at")
    place = F.call_function("div", F.col("__at") - 1, F.lit(block))
    inside = (F.col("__at") - 1) % block
    # The block of a row, and those of its neighbours whose frames reach it.
    to = F.array_compact(F.array(place, F.when(inside >= block - max(preceding, 0), place + 1), F.when((inside < max(following, 0)) & (place > 0), place - 1)))
    dealt = numbered.withColumn("__block", F.explode(to)).withColumn("__own", place == F.col("__block"))
    window = Window.partitionBy("__block").orderBy("__at").rowsBetween(-preceding, following)
    out = dealt.select("*", *[agg.over(window).alias(name) for name, agg in frames.items()])
    return out.where("__own").select(*df.columns, *frames)


def global_lag(df: DataFrame, keys: Sequence[Key], column: str, offset: int = 1, out: str = "lag", block: int = BLOCK, partitions: int | None = None) -> DataFrame:
    """Add the value of ``column`` ``offset`` rows before (null for the first rows; after, if negative)."""
    before, after = (offset, -offset)
    return sliding(df, keys, {out: F.first(column)}, before, after, block, partitions)
