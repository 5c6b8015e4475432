"""Explicit schemas of the payments star schema (no inference anywhere).

Keys are text in the files (fixed: CUST00001, ...); the adapter's tables have numbers of their own.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(6, 4)

BANKS = T.StructType([
    T.StructField("bank_id", T.StringType(), False),
    T.StructField("bank_name", T.StringType()),
    T.StructField("bank_type", T.StringType()),
    T.StructField("market_share", T.DoubleType()),
    T.StructField("base_failure_rate", T.DoubleType()),
])

DEVICES = T.StructType([
    T.StructField("device_id", T.StringType(), False),
    T.StructField("os_name", T.StringType()),
    T.StructField("os_version", T.StringType()),
    T.StructField("device_model", T.StringType()),
])

MERCHANTS = T.StructType([
    T.StructField("merchant_id", T.StringType(), False),
    T.StructField("merchant_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("commission_rate", RATE),
    T.StructField("popularity", T.DoubleType()),
])

CAMPAIGNS = T.StructType([
    T.StructField("campaign_id", T.StringType(), False),
    T.StructField("campaign_name", T.StringType()),
    T.StructField("target_category", T.StringType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("end_date", T.DateType()),
    T.StructField("cashback_rate", RATE),
    T.StructField("max_cashback", MONEY),
    T.StructField("attach_rate", T.DoubleType()),
])

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("customer_name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("registration_date", T.DateType()),
    T.StructField("primary_bank_id", T.StringType()),
    T.StructField("device_id", T.StringType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("bank_id", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("amount", MONEY),
    T.StructField("status", T.StringType()),
    T.StructField("failure_reason", T.StringType()),
    T.StructField("payment_mode", T.StringType()),
    T.StructField("txn_timestamp", T.TimestampNTZType()),
])

CASHBACK = T.StructType([
    T.StructField("cashback_id", T.StringType(), False),
    T.StructField("transaction_id", T.StringType()),
    T.StructField("campaign_id", T.StringType()),
    T.StructField("cashback_amount", MONEY),
    T.StructField("cashback_date", T.DateType()),
])

# Raw layer: amount and timestamp stay text so the cleaner can count bad values.
RAW_TRANSACTIONS = T.StructType([
    f if f.name not in ("amount", "txn_timestamp") else T.StructField(f.name, T.StringType())
    for f in TRANSACTIONS.fields
])

TABLES = {
    "banks": BANKS,
    "devices": DEVICES,
    "merchants": MERCHANTS,
    "campaigns": CAMPAIGNS,
    "customers": CUSTOMERS,
    "transactions": TRANSACTIONS,
    "cashback": CASHBACK,
}

# Parent tables first, so a foreign key always finds its parent when loading.
LOAD_ORDER = ("banks", "devices", "merchants", "campaigns", "customers",
              "transactions", "cashback")

# Foreign keys (child table, child column, parent table, parent column).
FOREIGN_KEYS = (
    ("customers", "primary_bank_id", "banks", "bank_id"),
    ("customers", "device_id", "devices", "device_id"),
    ("transactions", "customer_id", "customers", "customer_id"),
    ("transactions", "merchant_id", "merchants", "merchant_id"),
    ("transactions", "bank_id", "banks", "bank_id"),
    ("transactions", "device_id", "devices", "device_id"),
    ("cashback", "transaction_id", "transactions", "transaction_id"),
    ("cashback", "campaign_id", "campaigns", "campaign_id"),
)
