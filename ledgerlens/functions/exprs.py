"""Column expressions shared by every plan.

Everything here is a built-in Catalyst expression, so it stays inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# Fixed values that must equal the reference's definitions.
# --------------------------------------------------------------------------
VALID_STATUSES = ("SUCCESS", "FAILED", "PENDING")
HIGH_VALUE_QUANTILE = 0.90
INACTIVE_DAYS = 90
# SQL / DAX ticket bands: lower bound inclusive.
SQL_BAND_EDGES = (200, 500, 1000, 3000, 10000)
# pandas ticket bands: (0, 200], (200, 500] ... upper bound inclusive.
PANDAS_BAND_EDGES = (200, 500, 1000, 3000, 10000)
# Day parts by hour, upper bound inclusive: Night <= 5, Morning <= 11,
# Afternoon <= 16, Evening <= 20, LateEve <= 23.
DAYPARTS = (("Night", 5), ("Morning", 11), ("Afternoon", 16), ("Evening", 20), ("LateEve", 23))
# Age bands of the demographic query: <25, <35, <45, <55, else.
AGE_EDGES = (25, 35, 45, 55)
AGE_LABELS = ("18-24", "25-34", "35-44", "45-54", "55+")
# Day names by SQL weekday code 0 = Sunday.
SQL_DOW_NAMES = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")
# Monday-first full day names (pandas order).
WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
# RFM segments, first match wins; default "Needs Attention".
SEG_CHAMPIONS = "Champions"
SEG_PROMISING = "Promising / New"
SEG_AT_RISK = "At Risk (was loyal)"
SEG_HIBERNATING = "Hibernating / Churned"
SEG_DEFAULT = "Needs Attention"
COUNTRY = "India"


# --------------------------------------------------------------------------
# Status and money
# --------------------------------------------------------------------------
def is_success(status: Column | str = "status") -> Column:
    return (F.col(status) if isinstance(status, str) else status) == F.lit("SUCCESS")


def is_failed(status: Column | str = "status") -> Column:
    return (F.col(status) if isinstance(status, str) else status) == F.lit("FAILED")


def success_flag(status: str = "status") -> Column:
    return F.when(is_success(status), 1).otherwise(0)


def failed_flag(status: str = "status") -> Column:
    return F.when(is_failed(status), 1).otherwise(0)


# Money is aggregated in integer minor units (cents / paise, ``long``): Spark
# sums a decimal(18,2) in a decimal(28,2) buffer held as BigInteger bytes,
# while a long sum stays in the fixed-width fast path.  The total becomes an
# exact decimal(28,2) once per group.
CENTS = {"amount": "amount_cents", "revenue": "revenue_cents"}


def money_sum(cents: Column | str) -> Column:
    """SUM of a money column given in cents, returned as an exact decimal(28,2)."""
    c = F.col(cents) if isinstance(cents, str) else cents
    # Two long sums, of millions and of the rest, hold 10^12 rows of 10^16 units without overflow.
    part = F.lit(1_000_000)
    high, low = F.sum(F.call_function("div", c, part)), F.sum(c % part)
    return ((high.cast("decimal(20,0)") * part + low.cast("decimal(20,0)")).cast("decimal(30,0)") / F.lit(100)).cast("decimal(28,2)")


def sum_success(x: Column | str, status: str = "status") -> Column:
    """SUM(CASE WHEN status='SUCCESS' THEN x END): null for a group without a success.

    ``"amount"`` and ``"revenue"`` are summed through their cents columns.
    """
    if isinstance(x, str) and x in CENTS:
        return money_sum(F.when(is_success(status), F.col(CENTS[x])))
    x = F.col(x) if isinstance(x, str) else x
    return F.sum(F.when(is_success(status), x))


def count_success(status: str = "status") -> Column:
    return F.count_if(is_success(status))


def count_failed(status: str = "status") -> Column:
    return F.count_if(is_failed(status))


def commission(amount: Column | str = "amount", rate: Column | str = "commission_rate") -> Column:
    """ROUND(amount * rate, 2), exact, in the declared width of money and rates."""
    a = F.col(amount) if isinstance(amount, str) else amount
    r = F.col(rate) if isinstance(rate, str) else rate
    return F.round(a.cast("decimal(18,2)") * r.cast("decimal(6,4)"), 2).cast("decimal(18,2)")


def half_up_div(num: Column, den: int) -> Column:
    """Integer num / den rounded half away from zero (den even, positive)."""
    half = den // 2
    return F.when(num >= 0, F.call_function("div", num + half, F.lit(den))) \
        .otherwise(-F.call_function("div", -num + half, F.lit(den)))


def revenue_cents_expr(amount_cents: str = "amount_cents", rate_bp: str = "commission_bp",
                       status: str = "status") -> Column:
    """Revenue in cents: ROUND(amount x rate, 2) on SUCCESS rows, else 0 (exact integers)."""
    return F.when(is_success(status), half_up_div(F.col(amount_cents) * F.col(rate_bp), 10_000)) \
        .otherwise(F.lit(0).cast("long"))


def revenue_expr(amount: str = "amount", rate: str = "commission_rate",
                 status: str = "status") -> Column:
    """Commission on SUCCESS rows, rounded per row to 2 places (decimal, exact)."""
    return F.when(is_success(status), commission(amount, rate)) \
        .otherwise(F.lit(0).cast("decimal(18,2)"))


# --------------------------------------------------------------------------
# Exact rounding of ratios
# --------------------------------------------------------------------------
def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def round_ratio(num: Column, den: Column, digits: int = 2, scale: int = 1) -> Column:
    """ROUND(scale * num / den, digits), half away from zero, as a double.

    ``num`` and ``den`` must be exact (integers or decimals with at most 6
    places).  The quotient is formed with exact decimal integer division, so
    the result does not depend on float rounding or on the summation order;
    a zero denominator gives null, like SQL.
    """
    factor = scale * 10 ** digits
    a = num.cast("decimal(38,6)") * F.lit(factor)
    b = den.cast("decimal(38,6)")
    q = _div(F.abs(a) * 2 + F.abs(b), F.abs(b) * 2)
    signed = F.when((a < 0) != (b < 0), -q).otherwise(q)
    return F.when(b == 0, F.lit(None).cast("double")) \
        .otherwise(signed.cast("double") / F.lit(float(10 ** digits)))


def round_ratio_even(num: Column, den: Column, digits: int) -> Column:
    """num / den of counts rounded to ``digits``, half to even (numpy's rule), as a double; exact in integers."""
    scaled, den = num.cast("decimal(38,0)") * F.lit(10 ** digits), den.cast("decimal(38,0)")
    whole = _div(scaled, den).cast("decimal(38,0)")
    twice = (scaled - whole * den) * 2
    up = (twice > den) | ((twice == den) & (whole % 2 == 1))
    return F.when(den == 0, F.lit(None).cast("double")).otherwise((whole + up.cast("int")).cast("double") / F.lit(float(10 ** digits)))


def round_money(x: Column, digits: int = 0) -> Column:
    """ROUND of an exact decimal sum, returned as double."""
    return F.round(x, digits).cast("double")


def pct_of_total(x: Column, digits: int = 2) -> Column:
    """100 * x / SUM(x) OVER () on an aggregated frame (x exact)."""
    from pyspark.sql import Window
    return round_ratio(x, F.sum(x).over(Window.partitionBy()), digits, 100)


# --------------------------------------------------------------------------
# Bands and labels
# --------------------------------------------------------------------------
def _short_amount(x: float) -> str:
    """200 -> '200', 1000 -> '1k', 10000 -> '10k'."""
    x = int(x) if float(x).is_integer() else x
    if isinstance(x, int) and x >= 1000 and x % 1000 == 0:
        return f"{x // 1000}k"
    return str(x)


def sql_band_labels(edges: Sequence[float]) -> list[str]:
    """'a. <200', 'b. 200-500', ..., 'f. 10k+' built from the edges."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    labels = [f"{letters[0]}. <{_short_amount(edges[0])}"]
    for i in range(1, len(edges)):
        labels.append(f"{letters[i]}. {_short_amount(edges[i - 1])}-{_short_amount(edges[i])}")
    labels.append(f"{letters[len(edges)]}. {_short_amount(edges[-1])}+")
    return labels


def pandas_band_labels(edges: Sequence[float]) -> list[str]:
    """'<200', '200-500', ..., '10k+'."""
    return [lab.split(". ", 1)[1] for lab in sql_band_labels(edges)]


def sql_ticket_band(amount: str = "amount", edges: Sequence[float] = SQL_BAND_EDGES) -> Column:
    """CASE WHEN amount < e1 ... (lower bound inclusive)."""
    labels = sql_band_labels(edges)
    expr = None
    for edge, label in zip(edges, labels):
        cond = F.col(amount) < F.lit(edge)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(labels[-1])


def pandas_ticket_band(amount: str = "amount", edges: Sequence[float] = PANDAS_BAND_EDGES) -> Column:
    """pd.cut(amount, [0, e1, ..., inf]): (lo, hi], null for amount <= 0."""
    labels = pandas_band_labels(edges)
    expr = F.when(F.col(amount) <= 0, F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        expr = expr.when(F.col(amount) <= F.lit(edge), label)
    return expr.otherwise(labels[-1])


def daypart(hour: str = "txn_hour") -> Column:
    expr = None
    for label, upper in DAYPARTS:
        cond = F.col(hour) <= upper
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def age_band(age: str = "customer_age") -> Column:
    expr = None
    for edge, label in zip(AGE_EDGES, AGE_LABELS):
        cond = F.col(age) < edge
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(AGE_LABELS[-1])


def sql_day_name(dow: str = "txn_dow") -> Column:
    expr = None
    for i, name in enumerate(SQL_DOW_NAMES):
        expr = F.when(F.col(dow) == i, name) if expr is None else expr.when(F.col(dow) == i, name)
    return expr


def rfm_segment(r: str = "r_score", f: str = "f_score") -> Column:
    r, f = F.col(r), F.col(f)
    return (F.when((r >= 4) & (f >= 4), SEG_CHAMPIONS)
            .when((r >= 4) & (f < 4), SEG_PROMISING)
            .when((r <= 2) & (f >= 4), SEG_AT_RISK)
            .when((r <= 2) & (f < 3), SEG_HIBERNATING)
            .otherwise(SEG_DEFAULT))


# --------------------------------------------------------------------------
# Time
# --------------------------------------------------------------------------
MICROS_PER_DAY = 86_400_000_000


def whole_days_between(start: Column, end: Column) -> Column:
    """Floor of (end - start) in days, from microseconds (timedelta.days)."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return F.floor(micros / F.lit(MICROS_PER_DAY)).cast("long")


def year_month(ts: Column | str) -> Column:
    """'yyyy-MM' text from integer date parts (no per-row date formatter)."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.concat(F.year(t).cast("string"), F.lit("-"), F.lpad(F.month(t).cast("string"), 2, "0"))


def sql_dow(ts: str = "txn_timestamp") -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(F.col(ts)) - 1


def iso_weekday(ts: str) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(F.col(ts))
