"""Column-expression builders for text, keys and time.

All builders return ``pyspark.sql.Column`` objects made of built-in
functions, so they stay inside whole-stage codegen (no Python UDF).
"""

from __future__ import annotations

import re

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import fixed

# Java's \w and \s are ASCII-only; these classes reproduce the Unicode
# meaning of "word character" and "whitespace" used by the text cleaner.
UNICODE_SPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"
# Characters kept by the cleaner: letters, digits, '_', whitespace, '-', '.'.
CLEAN_DROP_PATTERN = r"[^\p{L}\p{N}_" + UNICODE_SPACE + r"\-.]+"
SPACE_RUN_PATTERN = "[" + UNICODE_SPACE + "]+"
EDGE_SPACE_PATTERN = "^[" + UNICODE_SPACE + "]+|[" + UNICODE_SPACE + "]+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.regexp_replace(_c(c), EDGE_SPACE_PATTERN, "")


def clean_text(c) -> Column:
    """Drop characters outside the kept set, collapse whitespace runs to one
    space and strip.  NULL becomes ''."""
    x = F.regexp_replace(F.coalesce(_c(c), F.lit("")), CLEAN_DROP_PATTERN, "")
    x = F.regexp_replace(x, SPACE_RUN_PATTERN, " ")
    return F.trim(x)


def any_keyword(c, keywords) -> Column:
    """1 when any keyword occurs in the text, else 0."""
    cond = reduce(lambda a, b: a | b, [F.contains(_c(c), F.lit(k)) for k in keywords])
    return F.when(cond, 1).otherwise(0)


def present(c) -> Column:
    """Value counts as present when non-null, non-empty and not the unknown marker."""
    v = F.coalesce(_c(c), F.lit(""))
    return (v != "") & (v != fixed.UNKNOWN)


def or_empty(c) -> Column:
    return F.when(present(c), _c(c)).otherwise(F.lit(""))


def day_key(ts) -> Column:
    """Day text yyyyMMdd of a timestamp."""
    return F.date_format(_c(ts), "yyyyMMdd")


def row_key(*parts) -> Column:
    """Row key made of parts joined with '_'."""
    return F.concat_ws("_", *[_c(p).cast("string") for p in parts])


def parse_time(c, fmt: str = fixed.TIME_TEXT_FORMAT) -> Column:
    """Lenient timestamp parse; unparsable text gives NULL."""
    return F.try_to_timestamp(_c(c), F.lit(fmt))


def time_text(c, fmt: str = fixed.TIME_TEXT_FORMAT) -> Column:
    return F.date_format(_c(c), fmt)


def seconds_between(earlier, later) -> Column:
    """Elapsed seconds (with microseconds) from ``earlier`` to ``later``.
    Wall-clock difference for local (NTZ) timestamps, so the session time
    zone and its daylight-saving shifts do not change the result."""
    return F.timestamp_diff("MICROSECOND", _c(earlier), _c(later)) / F.lit(1_000_000)


def hash_unit(key, modulus: int) -> Column:
    """Deterministic integer in [0, modulus) derived from md5 of the key.

    Used wherever a reproducible pseudo-random choice is needed; it is the
    same for every run, partitioning and engine.
    """
    h = F.conv(F.substring(F.md5(_c(key).cast("string")), 1, 6), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(modulus))


def chat_text(instruction, output, style: str = "train") -> Column:
    """Chat text for an (instruction, output) pair in one of three styles."""
    templates = {"train": fixed.CHAT_TRAIN, "plain": fixed.CHAT_PLAIN, "prompt": fixed.CHAT_PROMPT}
    if style not in templates:
        raise ValueError(f"unknown chat style {style!r}")
    values = {"instruction": _c(instruction), "output": _c(output)}
    parts = re.split(r"\{(\w+)\}", templates[style])  # literal, name, literal, ...
    return F.concat(*[values[x] if i % 2 else F.lit(x) for i, x in enumerate(parts)])


def extract_response(c) -> Column:
    """Text after the last assistant marker and before the first end marker,
    stripped; text without the marker is only stripped."""
    x = _c(c)
    after = F.substring_index(x, fixed.ASSISTANT_MARKER, -1)
    cut = F.when(F.contains(after, F.lit(fixed.IM_END)),
                 F.substring_index(after, fixed.IM_END, 1)).otherwise(after)
    picked = F.when(F.contains(x, F.lit(fixed.ASSISTANT_MARKER)), cut).otherwise(x)
    return strip_ws(picked)
