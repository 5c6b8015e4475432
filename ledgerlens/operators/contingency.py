"""Contingency tables and the chi-square test of independence.

The table is built long (row key, column key, count) by one ``groupBy``.
The statistic needs no grid of all (row, column) pairs:

* without correction, Σ (O − E)² / E = Σ O² / E − n, and an absent pair has
  O = 0, so summing over the present pairs is enough;
* with Yates' correction (2 x 2, SciPy's default for dof = 1) every cell
  has the same |O − E| = d, so the statistic is
  max(d − 0.5, 0)² · n · (Σ 1/row totals) · (Σ 1/column totals).

Row and column totals are small aggregates joined back to the long table;
only the final p-value is a closed formula on one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import dist


def long_table(df: DataFrame, row: str | Column, col: str | Column) -> DataFrame:
    """(r, c, observed) for every present pair; null keys are left out (like crosstab)."""
    r = F.col(row) if isinstance(row, str) else row
    c = F.col(col) if isinstance(col, str) else col
    return df.select(r.cast("string").alias("r"), c.cast("string").alias("c")) \
        .where(F.col("r").isNotNull() & F.col("c").isNotNull()) \
        .groupBy("r", "c").agg(F.count(F.lit(1)).alias("observed"))


def pivot_table(df: DataFrame, row: str, col: str, values: Sequence[str]) -> DataFrame:
    """Crosstab with listed column values, zeros filled."""
    return df.where(F.col(row).isNotNull()).groupBy(row).pivot(col, list(values)) \
        .agg(F.count(F.lit(1)).cast("bigint")).fillna(0).orderBy(row)


def chi_square_stat(table: DataFrame, yates: bool | None = None) -> DataFrame:
    """One row: chi2, dof, n, k_rows, k_cols, cramers_v.

    ``yates=None`` applies the continuity correction only when dof == 1.
    """
    total = lambda *by: F.sum("observed").over(Window.partitionBy(*by)).cast("double")
    cells = table.select(
        F.col("observed").cast("double").alias("o"), total("r").alias("rt"), total("c").alias("ct"), total().alias("t"),
        F.row_number().over(Window.partitionBy("r").orderBy("c")).alias("nth_c"), F.row_number().over(Window.partitionBy("c").orderBy("r")).alias("nth_r"))
    cells = cells.withColumn("e", F.col("rt") * F.col("ct") / F.col("t"))
    sums = cells.agg(
        F.sum(F.col("o") * F.col("o") / F.col("e")).alias("s_o2_e"), F.max(F.abs(F.col("o") - F.col("e"))).alias("d"), F.max("t").alias("t"),
        # Each row and column of the table once.
        F.count_if(F.col("nth_c") == 1).alias("kr"), F.count_if(F.col("nth_r") == 1).alias("kc"),
        F.sum(F.when(F.col("nth_c") == 1, 1.0 / F.col("rt"))).alias("inv_r"), F.sum(F.when(F.col("nth_r") == 1, 1.0 / F.col("ct"))).alias("inv_c"))
    n, kr, kc, inv_r, inv_c = (F.col(c) for c in ("t", "kr", "kc", "inv_r", "inv_c"))
    dof = (kr - 1) * (kc - 1)
    plain = F.col("s_o2_e") - n.cast("double")
    corr = F.greatest(F.col("d") - 0.5, F.lit(0.0))
    yates_stat = corr * corr * n.cast("double") * inv_r * inv_c
    use_yates = (dof == 1) if yates is None else F.lit(bool(yates))
    out = sums.select(
        F.when(use_yates, yates_stat).otherwise(plain).alias("chi2"),
        dof.cast("bigint").alias("dof"),
        n.cast("bigint").alias("n"),
        kr.cast("int").alias("k_rows"),
        kc.cast("int").alias("k_cols"),
    )
    v = F.sqrt(F.col("chi2") / (F.col("n") * (F.least("k_rows", "k_cols") - 1)))
    return out.withColumn("cramers_v", v)


def with_p_value(stat: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Append the chi-square tail p-value and the decision at alpha."""
    def fn(batches):
        for pdf in batches:
            pdf["p_value"] = [dist.chi2_sf(float(x), float(k)) if k and k > 0 else float("nan")
                              for x, k in zip(pdf["chi2"], pdf["dof"])]
            pdf["reject_h0"] = pdf["p_value"] < alpha
            yield pdf
    schema = T.StructType(list(stat.schema.fields) + [T.StructField("p_value", T.DoubleType()),
                                                      T.StructField("reject_h0", T.BooleanType())])
    return stat.mapInPandas(fn, schema)
