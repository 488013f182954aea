"""Parameters and helpers that the registered queries share; the SQL in
``plans.oracle`` uses the same values."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sources.tables import table

# Query parameters (not reference values).
AS_OF = "2024-01-31 00:00:00"          # "now" of every batch query
STATE_CUTOFF = "2024-01-21 00:00:00"   # events before: stored state; after: new batch
REFRESH_INTERVAL = 86400               # seconds
FRESH_INTERVAL = 3 * 86400             # seconds
SCAN_DAY = "19980101"
SNAPSHOT_OLD_END = "2001-01-01 00:00:00"  # earlier snapshot: orders placed before
PURGE_BEFORE = "1996-01-01 00:00:00"      # later snapshot: fulfilled orders before are archived
SCAN_PREFIX = "199801"
CDC_BATCH = 1000
# per-event-type reference values for imputation ('error' has none)
EVENT_REF_VALUES = {"view": 10.0, "click": 20.0, "purchase": 30.0, "signup": 40.0}
STORE_TABLES = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey",
    "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey",
    "lineitem": "l_orderkey", "events": "event_id", "documents": "doc_id",
    "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id",
    "labels": "doc_id", "conversations": "conv_id",
}


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


def _t(spark, sf, name):
    return table(spark, sf, name)


def _scratch(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
