"""Adapter: the driver's TPC-H-like tables -> the payments star schema.

Every column is a deterministic Catalyst expression over the source tables,
so the payments tables grow with the inputs and every filter / projection of
a downstream query is pushed into the parquet scans.

Two facts are exposed:

* fact ``"A"`` (long history): ``lineitem`` joined to ``orders``; used for
  monthly trends, rankings, cohorts, RFM, regions and statistics.
* fact ``"B"`` (time of day): ``events``; used for hour, weekday and daily
  questions.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.joins import MAX_PROVEN_BROADCAST_ROWS
from ledgerlens.sources import schemas as S

SOURCE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")

# Declared schemas of the driver tables: reads skip the footer-inference job.
SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# --------------------------------------------------------------------------
# Fixed values of the fixture (FIXTURES.md part 2).
# --------------------------------------------------------------------------
# Commission rate per merchant category (p_type).
COMMISSION_BY_CATEGORY = (
    ("ECONOMY", "0.0040"),
    ("SMALL", "0.0100"),
    ("MEDIUM", "0.0120"),
    ("STANDARD", "0.0150"),
    ("LARGE", "0.0180"),
    ("PROMO", "0.0250"),
)
# l_returnflag -> status.
RETURNFLAG_STATUS = (("A", "SUCCESS"), ("R", "FAILED"), ("N", "PENDING"))
# l_linestatus -> device OS.
LINESTATUS_OS = (("F", "Android"), ("O", "iOS"))
DEVICE_VERSIONS = 6          # line numbers 1..6 have a device; 7 has none
NO_DEVICE_LINENUMBER = 7
#: Rows of fact A that a partition holds on average, however many there are: what a task sorts doesn't grow with the input.
ROWS_A_PARTITION = 250_000
#: So few partitions, or less, are left to the session and AQE: they are small in all.
FEW_PARTITIONS = 32
#: The source table that bounds each dimension's rows.
DIM_SOURCES = {"merchants": "part", "customers": "customer", "banks": "supplier"}
#: What ``transaction_id`` of fact A is made of.
ROW_KEY = ("__order", "__line")
REGISTRATION_EPOCH = dt.date(1993, 1, 1)
REGISTRATION_STEP = 37
REGISTRATION_SPAN = 1900
AGE_BASE, AGE_SPAN = 18, 53
CITIES_PER_STATE = 4
MERCHANT_STATES = 25
MERCHANT_CITIES_PER_STATE = 3
# Campaigns: one per category, two-month windows.
# (id, name, target category, start, end, cashback rate, cap, attach rate)
CAMPAIGN_ROWS = (
    ("CMP001", "Economy Spring Saver", "ECONOMY", "1996-03-01", "1996-04-30", "0.0500", "500.00", 0.50),
    ("CMP002", "Small Basket Boost", "SMALL", "1997-01-01", "1997-02-28", "0.0300", "1000.00", 0.45),
    ("CMP003", "Medium Festive Offer", "MEDIUM", "1997-09-01", "1997-10-31", "0.0800", "2000.00", 0.55),
    ("CMP004", "Standard Summer Cashback", "STANDARD", "1998-05-01", "1998-06-30", "0.1000", "2500.00", 0.60),
    ("CMP005", "Large Ticket Rewards", "LARGE", "1999-02-01", "1999-03-31", "0.1200", "5000.00", 0.65),
    ("CMP006", "Promo Monsoon Deal", "PROMO", "2000-06-01", "2000-07-31", "0.0600", "1500.00", 0.50),
)


def _map(col, pairs, default=None):
    expr = None
    for k, v in pairs:
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def device_id_expr(status_code, line_no):
    """'F-3' style device key; null for line number 7 (no device)."""
    return F.when(line_no == NO_DEVICE_LINENUMBER, F.lit(None).cast("string")) \
        .otherwise(F.concat_ws("-", status_code, line_no.cast("string")))


def merchant_rules(key, category):
    """The columns of a merchant that follow from its key and category."""
    state = F.concat(F.lit("NATION_"), (key % MERCHANT_STATES).cast("string"))
    rate = _map(category, COMMISSION_BY_CATEGORY)
    return {
        "state": state,
        "city": F.concat_ws("_", state, (key % MERCHANT_CITIES_PER_STATE).cast("string")),
        "commission_rate": rate.cast(S.RATE),
        # the same rate in basis points (1e-4), for integer revenue arithmetic
        "commission_bp": F.round(rate.cast("double") * 10_000).cast("long"),
    }


@dataclass
class Tables:
    """Lazily built payments tables over one scale-factor directory."""

    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    # ---- raw driver tables ------------------------------------------------
    def src(self, name: str) -> DataFrame:
        key = ("src", name)
        if key not in self._cache:
            reader = self.spark.read
            if name in SOURCE_SCHEMAS:
                reader = reader.schema(SOURCE_SCHEMAS[name])
            self._cache[key] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[key]

    def _memo(self, key, build):
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]

    # ---- dimensions ---------------------------------------------------------
    @property
    def customers(self) -> DataFrame:
        def build():
            c = self.src("customer")
            n = self.src("nation").select("n_nationkey", "n_name")
            n_suppliers = self.src("supplier").agg(F.count(F.lit(1))).scalar()
            key = F.col("c_custkey")
            # nation has a fixed 25 rows: a proven bound for broadcasting.
            j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "inner")
            return j.select(
                key.alias("customer_id"),
                F.col("c_name").alias("customer_name"),
                (F.lit(AGE_BASE) + key % AGE_SPAN).cast("int").alias("age"),
                F.col("c_mktsegment").alias("gender"),
                F.concat_ws("_", F.col("n_name"), (key % CITIES_PER_STATE).cast("string")).alias("city"),
                F.col("n_name").alias("state"),
                F.date_add(F.lit(REGISTRATION_EPOCH),
                           ((key * REGISTRATION_STEP) % REGISTRATION_SPAN).cast("int")).alias("registration_date"),
                (key % n_suppliers).alias("primary_bank_id"),
                device_id_expr(F.when(key % 2 == 0, "F").otherwise("O"),
                               (key % DEVICE_VERSIONS + 1).cast("int")).alias("device_id"),
            )
        return self._memo("customers", build)

    @property
    def merchants(self) -> DataFrame:
        def build():
            p = self.src("part")
            rules = merchant_rules(F.col("p_partkey"), F.col("p_type"))
            return p.select(
                F.col("p_partkey").alias("merchant_id"),
                F.col("p_name").alias("merchant_name"),
                F.col("p_type").alias("category"),
                rules["city"].alias("city"),
                rules["state"].alias("state"),
                rules["commission_rate"].alias("commission_rate"),
                F.col("p_retailprice").alias("popularity"),
                rules["commission_bp"].alias("commission_bp"),
            )
        return self._memo("merchants", build)

    @property
    def banks(self) -> DataFrame:
        def build():
            s = self.src("supplier")
            n = self.src("nation").select("n_nationkey", "n_regionkey")
            r = self.src("region").select("r_regionkey", "r_name")
            # nation (25) and region (5) rows are fixed: proven broadcast bounds.
            j = (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "inner")
                  .join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"), "inner"))
            return j.select(
                F.col("s_suppkey").alias("bank_id"),
                F.col("s_name").alias("bank_name"),
                F.col("r_name").alias("bank_type"),
                F.col("s_acctbal").alias("market_share"),
                (F.lit(Decimal("0.05")) + (F.col("s_suppkey") % 10) * F.lit(Decimal("0.01")))
                .cast("double").alias("base_failure_rate"),
            )
        return self._memo("banks", build)

    @property
    def devices(self) -> DataFrame:
        """Devices are the (line status, line number 1..6) pairs: 12 rows by rule."""
        def build():
            idx = F.col("id")
            status_code = F.when(idx < DEVICE_VERSIONS, F.lit(LINESTATUS_OS[0][0])).otherwise(LINESTATUS_OS[1][0])
            version = (idx % DEVICE_VERSIONS + 1).cast("int")
            return self.spark.range(0, 2 * DEVICE_VERSIONS, numPartitions=1).select(
                F.concat_ws("-", status_code, version.cast("string")).alias("device_id"),
                _map(status_code, LINESTATUS_OS).alias("os_name"),
                version.cast("string").alias("os_version"),
                F.lit(None).cast("string").alias("device_model"),
            )
        return self._memo("devices", build)

    @property
    def campaigns(self) -> DataFrame:
        def build():
            rows = [(cid, name, cat, dt.date.fromisoformat(s), dt.date.fromisoformat(e),
                     Decimal(rate), Decimal(cap), attach)
                    for cid, name, cat, s, e, rate, cap, attach in CAMPAIGN_ROWS]
            return self.spark.createDataFrame(rows, S.CAMPAIGNS)
        return self._memo("campaigns", build)

    # ---- facts ------------------------------------------------------------
    def _rows(self, name: str) -> int:
        """Rows of a source table, counted from the files' footers."""
        return self._memo(("rows", name), lambda: self.src(name).count())

    def dealt(self, df: DataFrame, key: str) -> DataFrame:
        """``df`` dealt out by ``key`` into as many partitions as fact A has lines for.

        Spark raises the number to the session's shuffle partitions, if these are more.
        """
        n = -(-self._rows("lineitem") // ROWS_A_PARTITION)
        return df.repartition(n, key) if n > FEW_PARTITIONS else df

    def _is_small(self, name: str) -> bool:
        """Whether the rows of a dimension, at most those of its source table, may be broadcast."""
        return self._rows(DIM_SOURCES[name]) <= MAX_PROVEN_BROADCAST_ROWS

    def _with_dim(self, df: DataFrame, key: str, name: str, dim: DataFrame, how: str) -> DataFrame:
        """``df`` joined to dimension ``name`` by ``key``.

        A small one is broadcast.  Else, beyond few lines, the rows of ``df`` stream past a hashed part of the dimension:
        they are not sorted, so neither many rows nor a hot key spills, and a part holds no more as the input grows.
        """
        own = dim.columns[0]
        if self._is_small(name):
            dim = F.broadcast(dim)
        elif self.dealt(df, key) is not df:
            df, dim = self.dealt(df, key), self.dealt(dim, own).hint("shuffle_hash")
        dim = dim.withColumnRenamed(own, f"__{name}")
        return df.join(dim, F.col(key) == F.col(f"__{name}"), how).drop(f"__{name}")

    @property
    def transactions_a(self) -> DataFrame:
        return self._memo("txn_a", lambda: self.fact_a().drop(*ROW_KEY))

    def fact_a(self, merchants: DataFrame | None = None, customers: DataFrame | None = None,
               banks: DataFrame | None = None, how: str = "inner") -> DataFrame:
        """Fact A with ``ROW_KEY``, which names a row as ``transaction_id`` does and by whose first column the rows are dealt.

        ``banks``, ``merchants`` and ``customers`` (key first) are joined, ``how`` tells, where the rows are few
        or narrow: to the lines before they meet their orders, and to the orders; small ones after the last shuffle.
        """
        li = self.src("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
        o = self.src("orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
        more = [c for dim in (merchants, customers, banks) if dim is not None for c in dim.columns[1:]]
        dims = {n: (k, d) for n, k, d in (("banks", "l_suppkey", banks), ("merchants", "l_partkey", merchants), ("customers", "o_custkey", customers)) if d is not None}
        late = [n for n in dims if self._is_small(n)]
        for n, (k, d) in dims.items():
            if n in late:
                continue
            if n == "customers":
                o = self._with_dim(o, k, n, d, how)
            else:
                li = self._with_dim(li, k, n, d, how)
        # Both grow with the input: shuffled at every size, so that what is moved grows in step, into partitions
        # of one size, so that neither this sort nor a later one within them (C2) outgrows a task and spills.
        j = self.dealt(li, "l_orderkey").join(self.dealt(o, "o_orderkey").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"), "inner")
        for n in late:
            j = self._with_dim(j, dims[n][0], n, dims[n][1], how)
        status = _map(F.col("l_returnflag"), RETURNFLAG_STATUS)
        return j.select(
            *[F.col(c).alias(k) for c, k in zip(("l_orderkey", "l_linenumber"), ROW_KEY, strict=True)],
            F.concat_ws("-", F.col("l_orderkey").cast("string"),
                        F.col("l_linenumber").cast("string")).alias("transaction_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_partkey").alias("merchant_id"),
            F.col("l_suppkey").alias("bank_id"),
            device_id_expr(F.col("l_linestatus"), F.col("l_linenumber")).alias("device_id"),
            F.col("l_extendedprice").cast(S.MONEY).alias("amount"),
            F.round(F.col("l_extendedprice") * 100).cast("long").alias("amount_cents"),
            status.alias("status"),
            F.when(status == "FAILED", F.col("o_orderpriority")).alias("failure_reason"),
            F.col("o_orderstatus").alias("payment_mode"),
            F.col("l_shipdate").cast("timestamp_ntz").alias("txn_timestamp"),
            *more,
        )

    @property
    def transactions_b(self) -> DataFrame:
        def build():
            e = self.src("events")
            n_parts = self.src("part").agg(F.count(F.lit(1))).scalar()
            n_suppliers = self.src("supplier").agg(F.count(F.lit(1))).scalar()
            eid = F.col("event_id")
            status = (F.when(F.col("event_type") == "error", "FAILED")
                      .when(F.col("event_type") == "signup", "PENDING")
                      .otherwise("SUCCESS"))
            reason = (F.get_json_object("props", "$.k").cast("int") % 5).cast("string")
            return e.select(
                eid.cast("string").alias("transaction_id"),
                F.col("user_id").alias("customer_id"),
                (eid % n_parts).alias("merchant_id"),
                (eid % n_suppliers).alias("bank_id"),
                device_id_expr(F.when(eid % 2 == 0, "F").otherwise("O"),
                               (eid % 7 + 1).cast("int")).alias("device_id"),
                F.col("value").cast(S.MONEY).alias("amount"),
                F.round(F.col("value") * 100).cast("long").alias("amount_cents"),
                status.alias("status"),
                F.when(status == "FAILED", reason).alias("failure_reason"),
                F.col("event_type").alias("payment_mode"),
                F.col("ts").cast("timestamp_ntz").alias("txn_timestamp"),
            )
        return self._memo("txn_b", build)

    def transactions(self, fact: str = "A") -> DataFrame:
        return self.transactions_a if fact.upper() == "A" else self.transactions_b


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir.rstrip("/"))
