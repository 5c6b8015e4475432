"""Global ordered windows without a single partition (G1).

``Window.orderBy(...)`` with no ``partitionBy`` plans ``Exchange
SinglePartition``: every row goes to one task.  That is fine for months or
states and a wall for customers, merchants or distinct amounts.

One path for all sizes:

1. deal the rows out by range of the sort keys (Spark samples the bounds);
   a unique id among the keys splits a hot key value over several ranges;
2. freeze the ranges once with a reliable ``checkpoint``, so the totals and
   the ranking see the same rows in the same range;
3. number rows and accumulate sums inside each range;
4. add the counts and sums of the earlier ranges: a table with one row for
   each range (no more than shuffle partitions), which is broadcast.

The result equals the plain global window for ``row_number`` and running
sums; NTILE, qcut, RANK and exact quantiles follow from them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class Key:
    """One sort key: column name, direction and null placement."""

    col: str
    ascending: bool = True
    nulls_first: bool | None = None   # default: SQL / Spark rule (first if ascending)

    @property
    def nulls_go_first(self) -> bool:
        return self.ascending if self.nulls_first is None else self.nulls_first


def _encode(df: DataFrame, keys: Sequence[Key]) -> tuple[DataFrame, list[str]]:
    """Turn every key into ascending, null-free columns __k0, __k1, ..."""
    cols, names = [], []
    for i, k in enumerate(keys):
        dtype = df.schema[k.col].dataType
        c = F.col(k.col)
        null_rank = F.when(c.isNull(), 0 if k.nulls_go_first else 2).otherwise(1)
        if isinstance(dtype, T.StringType):
            if not k.ascending:
                raise ValueError("descending order is supported on numeric keys only")
            value = F.coalesce(c, F.lit(""))
        elif isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            if not k.ascending:
                raise ValueError("descending order is supported on numeric keys only")
            value = c
        else:
            value = F.coalesce(c if k.ascending else -c, F.lit(0).cast(dtype))
        cols += [null_rank.alias(f"__n{i}"), value.alias(f"__k{i}")]
        names += [f"__n{i}", f"__k{i}"]
    return df.select("*", *cols), names


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the session's checkpoint folder (lineage cut)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _ranges(df: DataFrame, order: Sequence[Column], partitions: int | None) -> DataFrame:
    """``df`` in frozen ranges of ``order``; ``__b`` numbers them in order."""
    n = [partitions] if partitions else []
    return materialize(df.repartitionByRange(*n, *order).withColumn("__b", F.spark_partition_id()))


def global_rank(df: DataFrame, keys: Sequence[Key], sum_cols: Sequence[str] = (), partitions: int | None = None,
                rank_col: str = "__rn", total_col: str = "__n") -> DataFrame:
    """Add the global 1-based row number (and running sums ``__cum_<c>``) under ``keys``.

    ``keys`` must form a total order (end with a unique id) for the result to
    be deterministic; ``total_col`` receives the row count of the whole frame.
    """
    enc, names = _encode(df, keys)
    order = [F.col(c) for c in names]
    dealt = _ranges(enc, order, partitions)
    w = Window.partitionBy("__b").orderBy(*order)
    wr = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = dealt.select("*", F.row_number().over(w).alias("__lr"), *[F.sum(c).over(wr).alias(f"__lc_{c}") for c in sum_cols])
    tot = dealt.groupBy("__b").agg(F.count(F.lit(1)).alias("__bc"), *[F.sum(c).alias(f"__bs_{c}") for c in sum_cols])
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(
        "__b",
        F.coalesce(F.sum("__bc").over(before), F.lit(0)).alias("__off"),
        *[F.sum(f"__bs_{c}").over(before).alias(f"__os_{c}") for c in sum_cols],
        F.sum("__bc").over(Window.partitionBy()).alias(total_col),
    )
    out = local.join(F.broadcast(offs), "__b")  # a row for each range
    return out.select(*df.columns, total_col, (F.col("__off") + F.col("__lr")).cast("long").alias(rank_col),
                      *[(F.coalesce(F.col(f"__os_{c}"), F.lit(0)) + F.col(f"__lc_{c}")).alias(f"__cum_{c}") for c in sum_cols])


def ntile_from_rank(rank: Column, n: Column, k: int) -> Column:
    """SQL NTILE(k): the first (n mod k) buckets get one extra row."""
    q = F.call_function("div", n, F.lit(k))
    m = n % k
    big = m * (q + 1)
    return F.when(rank <= big, F.call_function("div", rank - 1, q + 1) + 1) \
        .otherwise(m + F.call_function("div", rank - 1 - big, F.greatest(q, F.lit(1))) + 1).cast("int")


def qcut_from_rank(rank: Column, n: Column, k: int) -> Column:
    """pandas qcut(rank(method='first'), k) bin (1-based): greatest(1, ceil(k(r-1)/(n-1)))."""
    num = (rank - 1) * k
    den = n - 1
    ceil_div = F.call_function("div", num + den - 1, F.greatest(den, F.lit(1)))
    return F.when(n <= 1, F.lit(1)).otherwise(F.greatest(F.lit(1), ceil_div)).cast("int")


def tile_scores(df: DataFrame, specs: dict[str, tuple[Sequence[Key], Callable[[Column, Column], Column]]],
                partitions: int | None = None) -> DataFrame:
    """Add a tile number for each of ``specs``: name -> (keys, tile of row number and row count).

    Each ranking reads ``df`` (checkpoint it first) and leaves only the least
    key of each tile; one pass over ``df`` then compares every row with
    these few keys.
    """
    out = df
    for name, (keys, tile) in specs.items():
        columns = list(dict.fromkeys(k.col for k in keys))
        ranked = global_rank(df.select(*columns), keys, partitions=partitions)
        enc, names = _encode(ranked, keys)
        key = F.struct(*names)
        tiles = enc.groupBy(tile(F.col("__rn"), F.col("__n")).alias("tile")).agg(F.min(key).alias("least"))
        bounds = tiles.agg(F.collect_list(F.struct("least", "tile")).alias("__bounds"))  # a row, one entry for each tile
        plain = out.columns
        enc, names = _encode(out.crossJoin(F.broadcast(bounds)), keys)
        key = F.struct(*names)
        reached = F.array_max(F.filter("__bounds", lambda x: x["least"] <= key))["tile"]
        out = enc.select(*plain, reached.alias(name))
    return out


def sql_rank(df: DataFrame, key: str, ascending: bool, out: str = "rank", partitions: int | None = None) -> DataFrame:
    """SQL RANK() over the whole frame: 1 + rows with a strictly better key.

    Rows are ranked inside their range.  A hot value may fill several ranges;
    where it starts is known from the first and the last value of each range.
    """
    enc, names = _encode(df, [Key(key, ascending)])
    value = F.struct(*names)
    dealt = _ranges(enc, [*[F.col(c) for c in names], F.xxhash64(*df.columns)], partitions)
    local = dealt.withColumn("__lr", F.rank().over(Window.partitionBy("__b").orderBy(*names)))
    ranges = local.groupBy("__b").agg(F.count(F.lit(1)).alias("__bc"), F.min(value).alias("__first"), F.max(F.struct(value.alias("v"), "__lr")).alias("__last"))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("__off", F.coalesce(F.sum("__bc").over(before), F.lit(0)))
    start = Window.partitionBy("v")
    ends = ranges.select("__b", F.explode(F.array(
        F.struct(F.col("__first").alias("v"), (F.col("__off") + 1).alias("at")), F.struct(F.col("__last.v").alias("v"), (F.col("__off") + F.col("__last.__lr")).alias("at")))).alias("e"))
    ends = ends.select("__b", "e.*").withColumn("__start", F.min("at").over(start))
    firsts = ranges.select("__b", F.col("__first").alias("v"), "__off").join(ends.select("__b", "v", "__start").distinct(), ["__b", "v"])
    ranked = local.join(F.broadcast(firsts), "__b")  # a row for each range
    rank = F.when(value == F.col("v"), F.col("__start")).otherwise(F.col("__off") + F.col("__lr"))
    return ranked.select(*df.columns, rank.cast("bigint").alias(out))


def _entries_below(array: str, field: str, x: Column, most: int) -> Column:
    """How many entries of a sorted array of structs, ``most`` at most, have a ``field`` under ``x``: a binary search."""
    powers = F.array(*[F.lit(1 << k) for k in reversed(range(most.bit_length()))])
    return F.aggregate(powers, F.lit(0), lambda n, p: n + F.when(F.coalesce(F.get(array, n + p - 1)[field] < x, F.lit(False)), p).otherwise(F.lit(0)))


def quantiles(df: DataFrame, value: Column, probs: Sequence[float], by: str | None = None, partitions: int | None = None,
              times: Column | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles: one row (for each ``by``) with an array ``q`` in the order of ``probs``.

    ``times`` tells how often a row's value occurs (1 at least; once if it is left out).  Equal values are counted first (map-side), running counts come from G1,
    and only the two values around each position leave their range, so no
    task holds a map of all values.  Null values are left out.
    """
    group = F.col(by) if by else F.lit(0)
    values = df.select(group.alias("g"), value.cast("double").alias("v"), *([] if times is None else [times.alias("c")])).where(F.col("v").isNotNull())
    counts = values.groupBy("g", "v").agg((F.count(F.lit(1)) if times is None else F.sum("c")).alias("c"))
    ranked = global_rank(counts, [Key("g"), Key("v")], sum_cols=["c"], partitions=partitions)
    sizes = ranked.groupBy("g").agg(F.sum("c").alias("n"), F.min(F.col("__cum_c") - F.col("c")).alias("skip")).withColumnRenamed("g", "h")
    # The wanted positions are sorted once for each group; each value looks its own up in the sorted array.
    spots = F.flatten(F.transform(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)]), lambda x: F.array(
        F.struct(F.floor(x["p"] * (F.col("n") - 1)).alias("at"), x["i"].alias("i"), F.lit(0).alias("up")),
        F.struct(F.ceil(x["p"] * (F.col("n") - 1)).alias("at"), x["i"].alias("i"), F.lit(1).alias("up")))))
    sizes = sizes.withColumn("spots", F.sort_array(spots))
    rows = ranked.join(sizes, F.col("g").eqNullSafe(F.col("h"))) if by else ranked.crossJoin(F.broadcast(sizes))  # without groups, one row
    upto = F.col("__cum_c") - F.col("skip")
    first, after = (_entries_below("spots", "at", x, 2 * len(probs)) for x in (upto - F.col("c"), upto))
    found = rows.select("g", "n", "v", "spots", first.alias("first"), after.alias("after")).where("after > first")
    hits = found.select("g", "n", "v", F.explode(F.slice("spots", F.col("first") + 1, F.col("after") - F.col("first"))).alias("s")).select("g", "n", "v", "s.*")
    prob = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("i") + 1)
    ends = hits.groupBy("g", "i").agg(F.max(F.when(F.col("up") == 0, F.col("v"))).alias("lo"), F.max(F.when(F.col("up") == 1, F.col("v"))).alias("hi"), F.max("n").alias("n"))
    part = prob * (F.col("n") - 1) - F.floor(prob * (F.col("n") - 1))
    each = ends.select("g", "i", (F.col("lo") + (F.col("hi") - F.col("lo")) * part).alias("x"))
    out = each.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("q")).select(F.col("g").alias(by or "__all"), F.col("q.x").alias("q"))
    return out if by else out.select("q")
