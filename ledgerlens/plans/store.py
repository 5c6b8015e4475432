"""Materialised star schema: the enriched facts and feature tables, written once.

The reference builds its database and BI export once and serves every
dashboard query from the flattened fact.  Here the same tables are written
as parquet under the session's checkpoint folder (the shared, reliable
location a cluster names in ``spark.checkpoint.dir``), keyed by the input
snapshot (all source files, with size and modification time) and a
layout version.  Queries then scan one table with month partition pruning
instead of re-running the fact-to-dimension joins; a lost executor only
re-reads files.  The wide tables are written by ``catalog.build_store`` only:
a query that finds none plans from the sources and moves the columns that it
reads, so no query writes all columns for others.  ``LEDGERLENS_STORE=0`` turns
the store off (every query recomputes from the sources).
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.session import ensure_checkpoint_dir

LAYOUT_VERSION = "v1"
# Tables this application wrote successfully, with their schemas.  The
# checkpoint folder is per application, so a path recorded here is complete.
_SCHEMAS: dict = {}


def enabled() -> bool:
    return os.environ.get("LEDGERLENS_STORE", "1") != "0"


def _snapshot(spark: SparkSession, paths: Sequence[str]) -> str:
    """A name for the present state of the inputs: every file of each path, with size and time where the path is local."""
    h = hashlib.sha1(LAYOUT_VERSION.encode())
    for p in sorted(paths):
        for f in sorted(spark.read.schema("unread int").parquet(p).inputFiles()):  # lists files, opens none
            h.update(f.encode())
            local = unquote(urlparse(f).path)
            if f.startswith("file:") and os.path.exists(local):
                st = os.stat(local)
                h.update(f":{st.st_size}:{st.st_mtime_ns}".encode())
    return h.hexdigest()[:16]


def materialized(spark: SparkSession, name: str, sources: Sequence[str], build: Callable[[], DataFrame],
                 partition_by: str | None = None, write: bool = True) -> DataFrame:
    """Read ``name`` for this input snapshot; if absent, write it first, or without ``write`` plan it from the sources."""
    if not enabled():
        return build()
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/ledgerlens-store/{_snapshot(spark, sources)}/{name}"
    if path not in _SCHEMAS:
        if not write:
            return build()
        df = build()
        if partition_by:
            # Gathered by month, with large months split and small ones joined by AQE: few files each.
            df = df.hint("rebalance", partition_by)
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(path)
        _SCHEMAS[path] = (df.schema, df.columns)
    schema, columns = _SCHEMAS[path]
    # Read back with the writer's schema: same types and order, no discovery job.
    return spark.read.schema(schema).parquet(path).select(*columns)


def kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below the shared folder and read back, for a query that reads the same columns several times."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
