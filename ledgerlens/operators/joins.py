"""Fact-to-dimension joins with an explicit broadcast policy.

A dimension is broadcast only when its row count has a proven bound (a
fixed-size dimension such as the 12 devices, or a one-row scalar).  Every
other dimension is left to the optimizer: ``autoBroadcastJoinThreshold``
checks the estimated size at plan time and AQE re-checks the measured shuffle
size at run time, converting to a broadcast hash join only when it is small
and otherwise keeping the sort-merge join.  A customers or merchants table
that grows with the data therefore never gets forced into executor memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Broadcast without a size check only below this proven row bound.
MAX_PROVEN_BROADCAST_ROWS = 100_000


def join_dim(fact: DataFrame, dim: DataFrame, on: str | list[str], how: str = "inner",
             proven_rows: int | None = None) -> DataFrame:
    """N:1 equi-join of ``fact`` to ``dim`` on key column(s) ``on``.

    ``proven_rows``: a static bound (fixed-size dimension) allows a broadcast;
    otherwise the optimizer (and AQE at run time) decides by size.
    """
    if proven_rows is not None and proven_rows <= MAX_PROVEN_BROADCAST_ROWS:
        dim = F.broadcast(dim)
    return fact.join(dim, on=on, how=how)


def with_proven_key(dim: DataFrame, key: str) -> DataFrame:
    """``dim`` grouped by ``key`` if no key repeats, else as it is.

    Grouped, it is known to match a row once at most: the optimizer then drops a left join
    whose columns nobody reads, and with it the shuffle of the fact.  Null keys match nothing.
    """
    keyed = dim.where(F.col(key).isNotNull())
    if not keyed.groupBy(key).count().where("count > 1").isEmpty():
        return dim
    return keyed.groupBy(key).agg(*[F.first(c).alias(c) for c in dim.columns if c != key]).select(*dim.columns)
