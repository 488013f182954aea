"""Types of JSON payloads: merged schema, typed columns, drift report."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import jsonx


def merged_type(df: DataFrame, payload_col: str) -> str | None:
    """The type that all payloads fit, e.g. ``OBJECT<a: BIGINT, b: STRING>``:
    numbers widen, fields of unlike types become VARIANT.  Merged by the
    executors; None without a payload that is JSON."""
    return df.agg(F.schema_of_variant_agg(jsonx.json_value(payload_col)).alias("t")).first()["t"]


def struct_ddl(merged: str) -> str:
    """A merged type as the type of a column; a field that is always null is
    text."""
    return re.sub(r"\bVOID\b", "STRING", re.sub(r"\bOBJECT<", "STRUCT<", merged))


def typed_payload(df: DataFrame, payload_col: str, out: str = "payload", merged: str | None = None) -> DataFrame:
    """``df`` with the payload as a struct of the merged type (or of
    ``merged``, of an earlier run); a payload that does not fit is null."""
    merged = merged or merged_type(df, payload_col)
    if merged is None or not merged.startswith("OBJECT<") or merged == "OBJECT<>":
        return df.withColumn(out, F.lit(None).cast("struct<>"))
    return df.withColumn(out, F.try_variant_get(jsonx.json_value(payload_col), "$", struct_ddl(merged)))


def drift_report(df: DataFrame, payload_col: str, source_cols=()) -> DataFrame:
    """Per source and top-level field the types that occur (``kind``: the
    type without its precision or fields), their rows, and ``drifts``: whether
    the field has more than one, null aside."""
    fields = df.select(*source_cols, F.explode(jsonx.payload_map(payload_col)).alias("field", "value"))
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    per = (fields.groupBy(*source_cols, "field", F.coalesce(kind, F.lit("VOID")).alias("kind"))
                 .agg(F.count(F.lit(1)).alias("n_rows")))
    kinds = per.groupBy(*source_cols, "field").agg(F.count_if(F.col("kind") != "VOID").alias("_kinds"))
    return (per.join(kinds, [*source_cols, "field"]).withColumn("drifts", F.col("_kinds") > 1).drop("_kinds"))
