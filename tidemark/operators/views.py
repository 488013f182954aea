"""Grouped reports kept up to date from change rows.

A report of counts and sums is maintained by retraction: a change takes its
old image off the groups it was in and adds its new one.  Every batch of
changes is reduced to one partial row a touched group and written in a folder
of its number, so its cost follows the batch, not the report, and a batch that
is applied again replaces its own folder.  The report is the sum of the
partial rows; a group whose count has fallen to 0 is no longer in it.
:func:`compact` folds the oldest batches into a base; what was folded is
named by the base and not read again, so a late repeat of such a batch counts
nothing twice either.

Only counts and sums can be taken back; a minimum or maximum cannot.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.sinks import writers

COUNT = "n_rows"


def signed_images(changes: DataFrame, row_schema: str) -> DataFrame:
    """One row per image of a change with its columns and ``_sign``: -1 for
    what the change takes off (U, D), +1 for what it adds (I, U).  An image
    that is missing or not JSON gives no row."""
    old = F.when(F.col("operation") != fixed.OP_INSERT, F.from_json("old_data", row_schema))
    new = F.when(F.col("operation") != fixed.OP_DELETE, F.from_json("new_data", row_schema))
    both = F.array(F.struct(F.lit(-1).alias("sign"), old.alias("row")), F.struct(F.lit(1).alias("sign"), new.alias("row")))
    usable = F.filter(both, lambda x: x["row"].isNotNull())
    return changes.select(F.explode(usable).alias("x")).select(F.col("x.sign").alias("_sign"), "x.row.*")


def partial_groups(signed: DataFrame, keys: list[str], sums: Mapping[str, Column]) -> DataFrame:
    """``signed`` rows (columns and ``_sign``) as one row a group: ``n_rows``
    and the named sums, which must be integers or decimals to be exact."""
    total = [F.sum(F.col("_sign") * c).alias(name) for name, c in sums.items()]
    return signed.groupBy(*keys).agg(F.sum(F.col("_sign").cast("bigint")).alias(COUNT), *total)


def _base(path: str) -> str:
    return f"{path.rstrip('/')}/base"


def _batches(path: str) -> str:
    return f"{path.rstrip('/')}/batches"


def folded_to(spark: SparkSession, path: str) -> int:
    """Number of the last batch in the base, -1 without one."""
    upto = writers.current_version(spark, _base(path))
    return -1 if upto is None else upto


def apply_partial(partial: DataFrame, path: str, batch: int) -> None:
    """Write the partial rows of batch number ``batch`` (from 0 on)."""
    partial.write.mode("overwrite").parquet(f"{_batches(path)}/batch={int(batch)}")


def _added(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in df.columns if c not in keys])


def read_groups(spark: SparkSession, path: str, keys: list[str], upto: int | None = None) -> DataFrame:
    """The groups after all batches (or those up to ``upto``)."""
    done = folded_to(spark, path)
    rows = spark.read.parquet(_batches(path)).where(F.col("batch") > done)
    if upto is not None:
        rows = rows.where(F.col("batch") <= upto)
    rows = rows.drop("batch")
    if done >= 0:
        rows = spark.read.parquet(writers.version_path(_base(path), done)).select(*rows.columns).unionByName(rows)
    return _added(rows, keys).where(F.col(COUNT) != 0)


def compact(spark: SparkSession, path: str, keys: list[str], upto: int) -> None:
    """Fold the batches up to ``upto`` into the base, which a commit names.
    A failure before the commit leaves the old base in use."""
    if upto <= folded_to(spark, path):
        return
    read_groups(spark, path, keys, upto).write.mode("overwrite").parquet(writers.version_path(_base(path), upto))
    writers.commit_version(spark, _base(path), upto)
