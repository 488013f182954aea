"""JDBC sources: partitioned table reads, catalog listing and the
incremental change-log read after a cursor.

Connection settings always come from the caller (never from code)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, url: str, table: str, options: dict | None = None,
               partition_column: str | None = None, lower_bound: int | None = None,
               upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Read a table or ``(subquery) alias``.  With ``partition_column`` the
    read is split into ``num_partitions`` parallel range queries."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column)
              .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
              .option("numPartitions", str(num_partitions or 4)))
    return r.load()


def catalog_tables(spark: SparkSession, url: str, schema: str | None = None,
                   options: dict | None = None, catalog_view: str = "information_schema.tables",
                   schema_col: str = "table_schema") -> DataFrame:
    """Tables of one schema from the database catalog view (the equality
    filter is pushed to the database)."""
    df = read_table(spark, url, catalog_view, options)
    return df.where(F.col(schema_col) == schema) if schema else df


def changes_after(spark: SparkSession, url: str, table: str, cursor: int,
                  id_col: str = "change_id", options: dict | None = None,
                  upper: int | None = None, num_partitions: int = 1) -> DataFrame:
    """Change rows with ``id > cursor`` in id order.

    The predicate is pushed into the database query.  When ``upper`` is
    known the read is split into id ranges across ``num_partitions``
    tasks.
    """
    df = read_table(spark, url, table, options,
                    partition_column=id_col if upper is not None and num_partitions > 1 else None,
                    lower_bound=cursor + 1, upper_bound=upper, num_partitions=num_partitions)
    return df.where(F.col(id_col) > F.lit(cursor)).orderBy(id_col)


def max_id(spark: SparkSession, url: str, table: str, id_col: str = "change_id",
           options: dict | None = None) -> int | None:
    """Largest id of a table, answered by the database (one row)."""
    quoted = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(id_col)
    return read_table(spark, url, f"(SELECT MAX({quoted}) AS m FROM {table}) t", options).first()[0]


def changes_between(spark: SparkSession, url: str, table: str, cursor: int, upper: int,
                    id_col: str = "change_id", options: dict | None = None,
                    num_partitions: int = 8) -> DataFrame:
    """Change rows with ``cursor < id <= upper`` in ``num_partitions`` range
    queries; both bounds are pushed into them."""
    df = read_table(spark, url, table, options, id_col, cursor + 1, upper + 1, num_partitions)
    return df.where((F.col(id_col) > F.lit(cursor)) & (F.col(id_col) <= F.lit(upper)))
