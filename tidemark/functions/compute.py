"""Evaluate an expensive column once.

Catalyst inlines a projected expression into every later reference: a
filter pushed below the projection, and each consumer of the column,
re-evaluate it (two regular-expression passes over a whole document, or
a JSON parse, per use).  Emitting the value through a one-element
generator makes it an attribute the optimizer cannot inline, so it is
computed exactly once per row while the rest of the plan is unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """``df`` plus column ``name`` = ``expr``, evaluated once per row."""
    keep = [c for c in df.columns if c != name]
    return df.select(*keep, F.explode(F.array(expr)).alias(name))


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_table(spark, rows, schema: str) -> DataFrame:
    """A small fixed table as an inline ``VALUES`` relation inside the plan
    (one statement, not shipped row by row from Python): Spark knows its
    exact size, so its own broadcast threshold decides how joins against
    it are planned.  ``schema`` is ``"name type, ..."`` with simple types."""
    fields = [f.strip().split(None, 1) for f in schema.split(",")]
    names = [f"c{i}" for i in range(len(fields))]
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    select = ", ".join(f"CAST({n} AS {t}) AS {name}" for n, (name, t) in zip(names, fields))
    return spark.sql(f"SELECT {select} FROM VALUES {values} AS t({', '.join(names)})")
