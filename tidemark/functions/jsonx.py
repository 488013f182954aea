"""JSON column expressions for change events.

A change row carries a row image as JSON text whose columns are not known
in advance.  The payload is handled as ``map<string, variant>`` so that
any field types (numbers, nested objects, explicit nulls) survive the
round trip without a schema.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import fixed

PAYLOAD_TYPE = "map<string,variant>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def payload_map(c) -> Column:
    """Parse JSON text to a field map.

    NULL when the text is NULL, blank, JSON ``null``, not an object, or
    malformed - exactly the cases where a change has no usable row image.
    """
    return F.from_json(F.nullif(_c(c), F.lit("")), PAYLOAD_TYPE)


def json_value(c) -> Column:
    """JSON text parsed to a variant, or NULL when NULL/empty (kept as-is)."""
    return F.try_parse_json(F.nullif(_c(c), F.lit("")))


def malformed_text(c) -> Column:
    """The text itself when it is not blank and not JSON, else NULL."""
    return F.when((F.coalesce(F.trim(_c(c)), F.lit("")) != "") & json_value(c).isNull(), _c(c))


def change_envelope(change_id="change_id", table_name="table_name",
                    record_id="record_id", operation="operation",
                    change_time="change_time", old_data="old_data",
                    new_data="new_data") -> Column:
    """One JSON document per change row.

    The row images are embedded as parsed JSON and omitted when NULL or
    empty (``to_json`` drops NULL fields); text that is not JSON is kept as
    it is under ``old_data_raw`` / ``new_data_raw``.
    """
    return F.to_json(F.struct(
        _c(change_id).cast("bigint").alias("change_id"),
        _c(table_name).alias("table_name"),
        _c(record_id).cast("bigint").alias("record_id"),
        _c(operation).alias("operation"),
        _c(change_time).cast("string").alias("change_time"),
        json_value(old_data).alias("old_data"),
        json_value(new_data).alias("new_data"),
        malformed_text(old_data).alias("old_data_raw"),
        malformed_text(new_data).alias("new_data_raw"),
    ))


def _variant_map(pairs) -> Column:
    """``map<string, variant>`` from (name, Column) pairs; NULL values are
    left out, as ``to_json`` leaves out NULL struct fields."""
    m = F.create_map(*[x for name, c in pairs for x in (F.lit(name), c.cast("variant"))])
    return F.map_filter(m, lambda k, v: v.isNotNull())


def flatten_change(change_id="change_id", table_name="table_name",
                   operation="operation", new_data="new_data",
                   envelope=None, cdc_time=None, record_id="record_id",
                   change_time="change_time", old_data="old_data",
                   source_db: str = fixed.SOURCE_DB) -> Column:
    """Flattened change document (JSON text).

    * row image present and a JSON object: its fields plus the metadata
      fields; metadata overwrites payload fields of the same name;
    * otherwise (deletes, JSON null, non-object): the envelope plus
      ``source_db``, ``cdc_time`` and ``data_format = 'original'``; an image
      that is not JSON stays in it as raw text.

    The envelope is built from the change columns unless ``envelope``
    (JSON text of an already-built envelope) is given.  ``cdc_time``
    defaults to ``current_timestamp()``.  Only the payload is parsed; the
    metadata is cast straight to variant values.
    """
    cdc_time = F.current_timestamp() if cdc_time is None else _c(cdc_time)
    cdc_text = F.date_format(cdc_time, fixed.TIME_TEXT_FORMAT)
    payload = payload_map(new_data)
    meta = _variant_map([
        ("source_db", F.lit(source_db)),
        ("cdc_time", cdc_text),
        ("original_change_id", _c(change_id).cast("bigint")),
        ("original_operation", _c(operation)),
        ("original_table_name", _c(table_name)),
    ])
    meta_names = F.array(*[F.lit(n) for n in fixed.CHANGE_META_FIELDS])
    flattened = F.to_json(F.map_concat(
        F.map_filter(payload, lambda k, v: ~F.array_contains(meta_names, k)), meta))

    if envelope is None:
        env_map = _variant_map([
            ("change_id", _c(change_id).cast("bigint")),
            ("table_name", _c(table_name)),
            ("record_id", _c(record_id).cast("bigint")),
            ("operation", _c(operation)),
            ("change_time", _c(change_time).cast("string")),
            ("old_data", json_value(old_data)),
            ("new_data", json_value(new_data)),
            ("old_data_raw", malformed_text(old_data)),
            ("new_data_raw", malformed_text(new_data)),
        ])
    else:
        env_map = F.from_json(_c(envelope), PAYLOAD_TYPE)
    extra = _variant_map([
        ("source_db", F.lit(source_db)),
        ("cdc_time", cdc_text),
        ("data_format", F.lit(fixed.PASS_THROUGH_FORMAT)),
    ])
    extra_names = F.array(F.lit("source_db"), F.lit("cdc_time"), F.lit("data_format"))
    passed = F.to_json(F.map_concat(
        F.map_filter(env_map, lambda k, v: ~F.array_contains(extra_names, k)), extra))
    return F.when(payload.isNotNull(), flattened).otherwise(passed)
