"""Catalog and DDL: databases, external delimited tables with day
partitions, create-if-absent tables and key-prefix validation.

Statements are re-runnable: every CREATE / ADD PARTITION uses IF NOT
EXISTS, every DROP uses IF EXISTS.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?$")


def _ident(name: str) -> str:
    if not _NAME.match(name):
        raise ValueError(f"bad identifier {name!r}")
    return name


def _lit(v: str) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, name: str, use: bool = True) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(name)}")
    if use:
        spark.sql(f"USE {_ident(name)}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_ident(name)}")


def create_delimited_table(spark: SparkSession, name: str, columns: str, location: str,
                           partition_cols: str | None = None, sep: str = ",",
                           header: bool = True) -> None:
    """External delimited-text table (e.g. ``ds`` day partitions) at
    ``location``; the header line of every file is skipped."""
    part = f"PARTITIONED BY ({partition_cols})" if partition_cols else ""
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {_ident(name)} ({columns})
        USING csv OPTIONS (header '{str(header).lower()}', sep {_lit(sep)})
        {part} LOCATION {_lit(location)}""")


def add_partition(spark: SparkSession, table: str, spec: dict) -> None:
    """Register a partition (no error when it exists)."""
    s = ", ".join(f"{_ident(k)}={_lit(v)}" for k, v in spec.items())
    spark.sql(f"ALTER TABLE {_ident(table)} ADD IF NOT EXISTS PARTITION ({s})")


def drop_partition(spark: SparkSession, table: str, spec: dict) -> None:
    s = ", ".join(f"{_ident(k)}={_lit(v)}" for k, v in spec.items())
    spark.sql(f"ALTER TABLE {_ident(table)} DROP IF EXISTS PARTITION ({s})")


def create_table_if_absent(spark: SparkSession, name: str, schema_df: DataFrame,
                           fmt: str = "parquet", partition_cols=None) -> bool:
    """Create an empty table with the frame's schema when absent; returns
    True when it was created."""
    if spark.catalog.tableExists(name):
        return False
    w = schema_df.limit(0).write.format(fmt)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.saveAsTable(name)
    return True


def show_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def check_key_prefix(columns, key_cols) -> None:
    """Key columns must be the leading columns, in order (a sorted-key table
    rejects any other layout)."""
    columns, key_cols = list(columns), list(key_cols)
    if columns[:len(key_cols)] != key_cols:
        raise ValueError(f"key columns {key_cols} must lead the schema, got {columns[:len(key_cols)]}")


def engine_version(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT version() AS version")
