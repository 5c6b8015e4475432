"""Sets of months as 64-bit words.

One grouping leaves a row for each entity, with a bit for every month in which it was active; partial sets
merge map-side with ``bit_or``.  Any later question about months (was it active k months after signing up,
in how many months, in which first) is a shift on that row: no offset list needs a further shuffle.

The words cover the months from ``FIRST`` on, ``WORDS`` times 64 of them; a date outside raises an error
rather than being left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST = 1970 * 12   # January 1970, in months
WORDS = 13          # to April 2039


def month_number(date: Column) -> Column:
    """Months since January 1970."""
    return F.year(date) * 12 + F.month(date) - 1 - FIRST


def month_sets(df: DataFrame, key: str, date: Column) -> DataFrame:
    """key, months: an array of words with a bit for each month that has a row."""
    at = month_number(date)
    inside = F.when((at >= 0) & (at < 64 * WORDS), at).when(at.isNotNull(), F.raise_error(F.lit("month outside the set's words")).cast("int"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__at") % 64)
    words = [F.bit_or(F.when(F.floor(F.col("__at") / 64) == w, bit)).alias(f"w{w}") for w in range(WORDS)]
    g = df.select(key, inside.cast("int").alias("__at")).groupBy(key).agg(*words)
    return g.select(key, F.array(*[F.coalesce(F.col(f"w{w}"), F.lit(0).cast("long")) for w in range(WORDS)]).alias("months"))


def active(months: Column, at: Column) -> Column:
    """Whether the month numbered ``at`` is in the set; months outside its words aren't."""
    word = F.call_function("div", at, F.lit(64)).cast("int")
    inside = (at >= 0) & (at < 64 * WORDS)
    return F.when(inside, F.call_function("shiftrightunsigned", F.get(months, word), (at % 64).cast("int")).bitwiseAND(F.lit(1).cast("long"))).otherwise(0).cast("long")


def count(months: Column) -> Column:
    """How many months are in the set."""
    return F.aggregate(months, F.lit(0), lambda total, word: total + F.bit_count(word))
