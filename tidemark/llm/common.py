"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir

# A small table is only hinted as a broadcast after its rows were counted.
BROADCAST_ROWS = 10_000
BROADCAST_KEYS = 1_000_000  # rows of a hash or id and little else


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads the written files, it does
    not recompute what came before.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a materialised table as a broadcast if it has at most ``limit``
    rows; a larger one is left to the planner (shuffled join)."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def whole_text(col: str = "text"):
    """The text with null read as empty."""
    return F.coalesce(F.col(col), F.lit(""))
