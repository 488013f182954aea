"""Parquet table access for the star-schema and text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table; column pruning and filters reach the Parquet scan.  The
    files are listed anew each time, so files that were added are read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register every table as a temp view of the same name."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)

