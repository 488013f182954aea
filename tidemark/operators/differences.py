"""Where do two copies of a table differ: a hash tree over key ranges.

Both copies are summed per range of the key (rows, and an exact sum of a hash
of each row).  Ranges that agree are done with; those that differ are cut into
``FANOUT`` smaller ones and only they are read again, with their bounds as
filters that reach the files, until a range holds few keys.  The rows of the
last unequal ranges are then compared key by key.

Copies that are ordered by the key (or written in key order) are read again
only where they differ, as row groups carry the bounds of their keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FANOUT = 64         # parts of a range
LEAF_KEYS = 1024    # a range of so many keys is not cut again
PUSHED = 128        # ranges written as filters; the nearest ones are merged beyond


def _marked(df: DataFrame) -> Column:
    columns = [F.to_json(c) if t.startswith("map") else F.col(f"`{c}`") for c, t in df.dtypes]
    return F.xxhash64(*columns, *[c.isNull() for c in columns]).cast("decimal(38,0)")


def _summed(df: DataFrame, part: Column) -> DataFrame:
    return df.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.sum(_marked(df)).alias("h"))


def _unequal(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    a, b = left.select(on, F.struct("n", "h").alias("a")), right.select(on, F.struct("n", "h").alias("b"))
    return a.join(b, on, "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))


def _within(df: DataFrame, key: str, parts: list[int], low: int, width: int) -> DataFrame:
    """Rows whose key lies in one of the ranges; neighbours as one range."""
    runs = []
    for p in sorted(parts):
        if runs and runs[-1][1] == p:
            runs[-1][1] = p + 1
        else:
            runs.append([p, p + 1])
    # beyond PUSHED runs the narrowest gaps are read along
    while len(runs) > PUSHED:
        i = min(range(len(runs) - 1), key=lambda i: runs[i + 1][0] - runs[i][1])
        runs[i:i + 2] = [[runs[i][0], runs[i + 1][1]]]
    of = [(F.col(key) >= low + a * width) & (F.col(key) < low + b * width) for a, b in runs]
    return df.where(reduce(lambda x, y: x | y, of))


def differing_keys(source: DataFrame, copy: DataFrame, key: str, fanout: int = FANOUT, leaf_keys: int = LEAF_KEYS,
                   levels: list | None = None) -> DataFrame:
    """Keys whose rows differ: ``key``, ``difference`` (``missing`` in the
    copy, ``added`` there, ``changed``).  The key is an integer; a null key is
    a key as well, and rows that repeat a key are compared as a whole.
    ``levels`` gets, per level, (width of a range, unequal ranges).

    The lists on the driver hold range numbers, at most ``fanout`` for each
    unequal range of the level before; when more than half of all ranges are
    unequal the copies are compared key by key at once, so a copy that differs
    everywhere does not lengthen them.
    """
    copy = copy.select(*source.columns)
    ends = source.select(key).unionByName(copy.select(key)).agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    none = F.col(key).isNull()
    a, b = source.where(~none), copy.where(~none)
    if ends["low"] is not None:
        low, width, known = ends["low"], ends["high"] - ends["low"] + 1, [0]
        while width > leaf_keys:
            width = -(-width // fanout)
            part = F.expr(f"(`{key}` - {low}) div {width}")
            unequal = _unequal(_summed(a, part), _summed(b, part), "part")
            # the ranges come from at most PUSHED unequal ones: a bounded list
            numbers = [r["part"] for r in unequal.select("part").limit(PUSHED * fanout + 1).collect()]
            if levels is not None:
                levels.append((width, len(numbers)))
            if len(numbers) > PUSHED * fanout or 2 * len(numbers) > fanout * len(known) + 1:
                break  # differences nearly everywhere
            if not numbers:
                a, b = a.limit(0), b.limit(0)
                break
            known = numbers
            a, b = (_within(df.where(~none), key, numbers, low, width) for df in (source, copy))
    a, b = a.unionByName(source.where(none)), b.unionByName(copy.where(none))
    by_key = F.struct(F.col(key).alias("key"))  # a null key is joined like any other
    own = _unequal(_summed(a, by_key), _summed(b, by_key), "part")
    what = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "added").otherwise("changed")
    return own.select(F.col("part.key").alias("key"), what.alias("difference"))
