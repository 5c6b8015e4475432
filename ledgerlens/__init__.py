"""ledgerlens: payments analytics expressed as Spark DataFrame / SQL plans.

Layout
------
sources/    schemas, the adapter from the driver tables, loaders and sinks
functions/  shared Column expressions, exact rounding, distribution tails
operators/  reusable DataFrame recipes (global rank / ntile, dimension joins,
            shares, histograms, contingency tables)
plans/      the analytics themselves: views, quality, KPI queries, features,
            measures, visuals, statistics, cashback
streaming/  incremental (Structured Streaming) load of raw transaction files
oracle/     DuckDB SQL text for every query that plain SQL can express
"""

from ledgerlens.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
