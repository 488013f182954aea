"""Independent SQL (DuckDB dialect) for every registered query.

Each statement recomputes the query's result from the raw tables with
plain SQL: joins, window functions, CASE, regular expressions.  Literal
dimensions and vocabularies are rendered from ``functions.fixed`` so
both sides use the same fixed values.
"""

from __future__ import annotations

from tidemark.functions import fixed
from tidemark.plans import queries as Q
from tidemark.plans import upkeep as U

# RE2 spellings of the Unicode classes used by the Spark side.
RE2_SPACE = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}"
RE2_CLEAN_DROP = r"[^\p{L}\p{N}_" + RE2_SPACE + r"\-.]+"
RE2_SPACE_RUN = "[" + RE2_SPACE + "]+"
RE2_EDGE = "^[" + RE2_SPACE + "]+|[" + RE2_SPACE + "]+$"

TS_FMT = "'%Y-%m-%d %H:%M:%S'"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, {_q(RE2_EDGE)}, '', 'g')"


def _clean(x: str) -> str:
    inner = f"regexp_replace(coalesce({x}, ''), {_q(RE2_CLEAN_DROP)}, '', 'g')"
    return f"trim(regexp_replace({inner}, {_q(RE2_SPACE_RUN)}, ' ', 'g'))"


def _ts(s: str) -> str:
    return f"TIMESTAMP '{s}'"


def _address_values() -> str:
    rows = ", ".join(f"({i}, {', '.join(_q(v) for v in r)})" for i, r in enumerate(fixed.ADDRESS_ROWS))
    return f"(VALUES {rows}) d(addr_idx, address, province, city, district, street)"


CLEANED_ADDRESSES = f"""
addr AS (
  SELECT c_custkey, d.address || CAST(c_custkey AS VARCHAR) || '号' AS address,
         d.province, d.city, d.district, d.street
  FROM customer JOIN {_address_values()} ON c_custkey % 10 = d.addr_idx),
cleaned AS (
  SELECT * FROM (SELECT *, {_clean('address')} AS cleaned_address FROM addr
                 WHERE address IS NOT NULL AND address <> '')
  WHERE length(cleaned_address) >= {fixed.MIN_ADDRESS_LEN})"""


def _present(c: str) -> str:
    return f"coalesce({c}, '') NOT IN ('', {_q(fixed.UNKNOWN)})"


def _or_empty(c: str) -> str:
    return f"(CASE WHEN {_present(c)} THEN {c} ELSE '' END)"


RULE_PAIRS = f"""
rule_pairs AS (
  SELECT DISTINCT instruction, output, original_address, province, city, district, street FROM (
    SELECT {_q(fixed.Q_PROVINCE)} || cleaned_address AS instruction,
           {_q(fixed.A_PREFIX)} || province || {_q(fixed.A_PROVINCE_SUFFIX)} AS output,
           cleaned_address AS original_address, province, city, district, street
    FROM cleaned WHERE {_present('province')}
    UNION ALL
    SELECT {_q(fixed.Q_CITY)} || cleaned_address, {_q(fixed.A_PREFIX)} || city,
           cleaned_address, province, city, district, street
    FROM cleaned WHERE {_present('city')}
    UNION ALL
    SELECT {_q(fixed.Q_DISTRICT)} || cleaned_address, {_q(fixed.A_PREFIX)} || district,
           cleaned_address, province, city, district, street
    FROM cleaned WHERE {_present('district')}
    UNION ALL
    SELECT {_q(fixed.Q_STANDARD)} || cleaned_address, {_q(fixed.A_STANDARD)} || std,
           cleaned_address, province, city, district, street
    FROM (SELECT *, {_strip(_or_empty('province') + ' || ' + _or_empty('city') + ' || ' + _or_empty('district') + ' || ' + _or_empty('street'))} AS std
          FROM cleaned) WHERE std <> ''))"""


def _drop(x: str, part: str) -> str:
    return f"(CASE WHEN {part} <> '' THEN replace({x}, {part}, '') ELSE {x} END)"


_detail = "cleaned_address"
for _p in ["p", "c", "d", "s"]:
    _detail = _drop(_detail, _p)

COMPONENTS = f"""
comp0 AS (
  SELECT c_custkey, cleaned_address,
         regexp_extract(cleaned_address, {_q(fixed.PROVINCE_PATTERN)}, 1) AS p,
         regexp_extract(cleaned_address, {_q(fixed.CITY_PATTERN)}, 1) AS c,
         regexp_extract(cleaned_address, {_q(fixed.DISTRICT_PATTERN)}, 1) AS d,
         regexp_extract(cleaned_address, {_q(fixed.STREET_PATTERN)}, 1) AS s
  FROM cleaned),
comp AS (SELECT *, {_detail} AS detail FROM comp0)"""


def _vocab_map() -> str:
    return "MAP {" + ", ".join(f"{_q(k)}: {v}" for k, v in fixed.VOCAB.items()) + "}"


def _inverse_vocab_map() -> str:
    return "MAP {" + ", ".join(f"{v}: {_q(k)}" for k, v in fixed.VOCAB.items()) + "}"


ENCODED = f"""
chat_t AS (
  SELECT instruction, output,
         '<|im_start|>user ' || instruction || ' <|im_end|> <|im_start|>assistant ' || output || ' <|im_end|>' AS txt
  FROM rule_pairs),
words AS (
  SELECT instruction, output,
         list_filter(string_split_regex(
           {_strip("replace(replace(txt, '<|im_start|>', ' <|im_start|> '), '<|im_end|>', ' <|im_end|> ')")},
           {_q(RE2_SPACE_RUN)}), lambda x: x <> '') AS ws
  FROM chat_t),
coded AS (
  SELECT instruction, output,
         flatten(list_transform(ws, lambda w:
             CASE WHEN map_contains({_vocab_map()}, w) THEN [{_vocab_map()}[w]]
                  ELSE list_transform(string_split(w, ''), lambda ch: coalesce({_vocab_map()}[ch], {fixed.UNK_ID})) END)) AS all_ids
  FROM words),
encoded AS (
  SELECT instruction, output, all_ids, list_resize(all_ids, {fixed.MAX_LENGTH}, {fixed.PAD_ID}) AS ids
  FROM coded)"""


def _region_case(c: str) -> str:
    whens = " ".join(f"WHEN {c} IN ({', '.join(_q(p) for p in ps)}) THEN {_q(r)}"
                     for r, ps in fixed.REGION_PROVINCES.items())
    return f"CASE {whens} ELSE {_q(fixed.DEFAULT_REGION)} END"


def _temp_case(c: str) -> str:
    whens = " ".join(f"WHEN {_q(r)} THEN {_q(lo + '-' + hi)}" for r, (lo, hi) in fixed.TEMP_RANGES.items())
    lo, hi = fixed.DEFAULT_TEMP_RANGE
    return f"CASE {c} {whens} ELSE {_q(lo + '-' + hi)} END"


CHANGELOG = """
c AS (
  SELECT event_id, user_id, props,
         CASE WHEN event_type = 'signup' THEN 'I' WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op
  FROM events),
p AS (SELECT *, op <> 'D' AND json_valid(props) AND json_type(props) = 'OBJECT' AS has_payload FROM c)"""

META_LIST = "[" + ", ".join(_q(m) for m in fixed.CHANGE_META_FIELDS) + "]"

STATE_CUT = _ts(Q.STATE_CUTOFF)
AS_OF = _ts(Q.AS_OF)

LATEST_STATE = f"""
st AS (
  SELECT user_id, event_type, event_id, ts, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
    FROM events WHERE ts < {STATE_CUT}) WHERE rn = 1),
bt AS (SELECT user_id, event_type, event_id, ts, value FROM events WHERE ts >= {STATE_CUT})"""

DUE = f"""
k AS (SELECT DISTINCT user_id, event_type FROM events),
l AS (SELECT user_id, event_type, max(ts) AS last_seen FROM events WHERE ts < {STATE_CUT} GROUP BY 1, 2),
r AS (
  SELECT k.user_id, k.event_type, l.last_seen,
         CASE WHEN l.last_seen IS NULL THEN 'new'
              WHEN epoch_us({STATE_CUT}) - epoch_us(l.last_seen) >= {Q.REFRESH_INTERVAL} * CAST(1000000 AS BIGINT) THEN 'stale'
              ELSE 'fresh' END AS reason
  FROM k LEFT JOIN l ON k.user_id = l.user_id AND k.event_type = l.event_type)"""

_ref_rows = ", ".join(f"({_q(k)}, CAST({v} AS DOUBLE))" for k, v in Q.EVENT_REF_VALUES.items())
_scale = 10 ** fixed.RANDOM_RATE_DECIMALS
_span = int(round((fixed.RANDOM_RATE_HIGH - fixed.RANDOM_RATE_LOW) * _scale))
IMPUTED = f"""
m AS (SELECT event_id, event_type, user_id, ts, CASE WHEN event_id % 10 <> 0 THEN value END AS value FROM events),
ref AS (SELECT * FROM (VALUES {_ref_rows}) t(event_type, ref_value)),
imp AS (
  SELECT m.event_id, m.event_type, m.user_id, m.ts,
         coalesce(nullif(m.value, 0.0), ref.ref_value,
                  {fixed.RANDOM_RATE_LOW} + CAST(('0x' || substr(md5(CAST(m.event_id AS VARCHAR)), 1, 6))::BIGINT % {_span} AS DOUBLE) / CAST({_scale} AS DOUBLE)) AS value,
         nullif(m.value, 0.0) IS NULL AS is_fallback,
         CASE WHEN nullif(m.value, 0.0) IS NULL THEN {_q(fixed.FALLBACK_SOURCE)} END AS source
  FROM m LEFT JOIN ref ON m.event_type = ref.event_type)"""

CHAT_JOIN = """
FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'"""


def _dq_rows():
    li, o, p = "lineitem", "orders", "part"
    return [
        (li, "null_orderkey", "SELECT count_if(l_orderkey IS NULL) FROM lineitem"),
        (li, "null_partkey", "SELECT count_if(l_partkey IS NULL) FROM lineitem"),
        (li, "null_shipdate", "SELECT count_if(l_shipdate IS NULL) FROM lineitem"),
        (li, "bad_quantity", "SELECT count_if(l_quantity <= 0) FROM lineitem"),
        (li, "bad_discount", "SELECT count_if(l_discount < 0 OR l_discount > 1) FROM lineitem"),
        (li, "bad_tax", "SELECT count_if(l_tax < 0 OR l_tax > 1) FROM lineitem"),
        (li, "dup_key", "SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM lineitem "
                        "WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY l_orderkey, l_linenumber)"),
        (o, "null_custkey", "SELECT count_if(o_custkey IS NULL) FROM orders"),
        (o, "bad_totalprice", "SELECT count_if(o_totalprice < 0) FROM orders"),
        (o, "dup_key", "SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM orders WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey)"),
        (p, "bad_retailprice", "SELECT count_if(p_retailprice <= 0) FROM part"),
        (p, "dup_key", "SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM part WHERE p_partkey IS NOT NULL GROUP BY p_partkey)"),
        (li, "orphan_order", "SELECT count(*) FROM lineitem WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)"),
        (li, "orphan_part", "SELECT count(*) FROM lineitem WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey)"),
        (o, "orphan_customer", "SELECT count(*) FROM orders WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)"),
    ]


LATEST = f"""
SELECT user_id, event_type, event_id, value, strftime(ts, {TS_FMT}) AS ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""

SQL = {
    "sink_state_upsert": LATEST,
    "sink_bucketed_state": LATEST,

    "sink_kv_partitioned": f"""
SELECT strftime(o_orderdate, '%Y%m%d') || '_' || CAST(o_orderkey AS VARCHAR) AS rowkey, o_orderkey,
       CASE WHEN strftime(o_orderdate, '%Y%m%d') = '{Q.SCAN_DAY}' THEN 1.5 ELSE o_totalprice END AS o_totalprice
FROM orders""",

    "sink_cell_versions": f"""
SELECT rowkey, CAST(version AS INTEGER) AS version, event_id, value FROM (
  SELECT CAST(user_id AS VARCHAR) || '_' || event_type AS rowkey, event_id, value,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS version
  FROM events) WHERE version <= {fixed.KV_MAX_VERSIONS}""",

    "sink_day_bucketed": """
SELECT strftime(ts, '%Y-%m-%d') AS ds, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1""",

    "corpus_round_trip": f"""
SELECT u.conv_id, md5('<|im_start|>user' || chr(10) || u.text || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10))
         AS prompt_md5, md5(a.text) AS output_md5, '' AS input
{CHAT_JOIN}""",

    "state_round_trip": f"""
SELECT user_id, event_type, strftime(max(ts), {TS_FMT}) AS last_update FROM events GROUP BY 1, 2""",

    "delimited_table": """
SELECT c_custkey, c_name, c_acctbal, CAST(c_nationkey AS INTEGER) AS ds FROM customer""",

    "append_log": "SELECT 2 * count(*) AS lines FROM conversations",

    "view_star": "SELECT * FROM customer",

    "changelog_chain": f"""
WITH o AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice,
         o_orderdate < TIMESTAMP '{Q.SNAPSHOT_OLD_END}' AS in_old,
         NOT (o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '{Q.PURGE_BEFORE}') AS in_new,
         CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS new_price
  FROM orders),
d AS (
  SELECT *, CASE WHEN NOT in_old THEN 'I' WHEN NOT in_new THEN 'D' ELSE 'U' END AS operation FROM o
  WHERE (in_old OR in_new) AND NOT (in_old AND in_new AND o_orderstatus <> 'O'))
SELECT row_number() OVER (ORDER BY o_orderkey) AS change_id, o_orderkey AS id, operation,
       CASE WHEN operation = 'D' THEN o_totalprice ELSE new_price END AS price
FROM d""",

    "apply_changelog": """
SELECT user_id AS record_id, event_id AS change_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1 AND event_type <> 'error'""",

    "status_counts": """
SELECT o_orderstatus AS status, count(*) AS count FROM orders GROUP BY o_orderstatus""",

    "partition_scan": f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y%m%d') AS partition_date,
       strftime(o_orderdate, '%Y%m%d') || '_' || CAST(o_orderkey AS VARCHAR) AS rowkey
FROM orders WHERE strftime(o_orderdate, '%Y%m%d') = '{Q.SCAN_DAY}'
ORDER BY o_orderkey LIMIT 5""",

    "rowkey_prefix_scan": f"""
SELECT rowkey, o_orderkey, o_orderstatus, o_totalprice FROM (
  SELECT strftime(o_orderdate, '%Y%m%d') || '_' || CAST(o_orderkey AS VARCHAR) AS rowkey, * FROM orders)
WHERE starts_with(rowkey, '{Q.SCAN_PREFIX}')""",

    "kv_mapped_view": f"""
SELECT 'order_' || CAST(o_orderkey AS VARCHAR) AS rowkey, CAST(o_orderkey AS VARCHAR) AS order_id,
       strftime(o_orderdate, {TS_FMT}) AS create_time,
       CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS amount,
       o_orderstatus AS status, strftime(o_orderdate, '%Y%m%d') AS partition_date
FROM orders""",

    "kv_versions_top3": f"""
SELECT rowkey, CAST(version AS INTEGER) AS version, event_id, value, ts FROM (
  SELECT CAST(user_id AS VARCHAR) || '_' || event_type AS rowkey, event_id, value,
         strftime(ts, {TS_FMT}) AS ts,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS version
  FROM events) WHERE version <= {fixed.KV_MAX_VERSIONS}""",

    "cursor_read": f"""
SELECT event_id, user_id, event_type, value, strftime(ts, {TS_FMT}) AS ts FROM events
WHERE event_id > (SELECT max(event_id) FROM events WHERE ts < {STATE_CUT})
ORDER BY event_id""",

    "cdc_flatten": f"""
WITH {CHANGELOG}
SELECT event_id AS change_id, {_q(fixed.SOURCE_DB)} AS source_db, '{Q.AS_OF}' AS cdc_time,
       CASE WHEN NOT has_payload THEN {_q(fixed.PASS_THROUGH_FORMAT)} END AS data_format,
       CASE WHEN has_payload THEN op END AS original_operation,
       CASE WHEN has_payload THEN 'events' END AS original_table_name,
       CASE WHEN has_payload THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
       CASE WHEN NOT has_payload THEN CAST(user_id AS INTEGER) END AS record_id,
       CASE WHEN NOT has_payload AND op <> 'I' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS old_k,
       CAST(CASE WHEN has_payload
                 THEN len(list_filter(json_keys(props), lambda x: NOT list_contains({META_LIST}, x))) + 5
                 ELSE 5 + (CASE WHEN op <> 'I' AND json_valid(props) THEN 1 ELSE 0 END)
                        + (CASE WHEN op <> 'D' AND json_valid(props) THEN 1 ELSE 0 END) + 3 END AS INTEGER) AS n_fields
FROM p""",

    "cdc_envelope": f"""
WITH {CHANGELOG}
SELECT event_id AS change_id, op AS operation, CAST(user_id AS INTEGER) AS record_id, 'events' AS table_name,
       op <> 'I' AS has_old, op <> 'D' AS has_new,
       CAST(5 + (CASE WHEN op <> 'I' THEN 1 ELSE 0 END) + (CASE WHEN op <> 'D' THEN 1 ELSE 0 END) AS INTEGER) AS n_fields
FROM p""",

    "snapshot_diff": f"""
WITH o AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate < {_ts(Q.SNAPSHOT_OLD_END)}),
n AS (SELECT o_orderkey, o_orderstatus,
             CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
      FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderdate < {_ts(Q.PURGE_BEFORE)}))
SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey,
       CASE WHEN o.o_orderkey IS NULL THEN 'I' WHEN n.o_orderkey IS NULL THEN 'D' ELSE 'U' END AS operation,
       o.o_totalprice AS old_price, n.o_totalprice AS new_price
FROM o FULL OUTER JOIN n ON o.o_orderkey = n.o_orderkey
WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL
   OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus OR o.o_totalprice IS DISTINCT FROM n.o_totalprice""",

    "cdc_batch_metrics": f"""
SELECT batch_no, batch_rows, last_id,
       CAST(sum(batch_rows) OVER (ORDER BY batch_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_rows
FROM (SELECT event_id // {Q.CDC_BATCH} AS batch_no, count(*) AS batch_rows, max(event_id) AS last_id
      FROM events GROUP BY 1)""",

    "lenient_load": f"""
WITH r AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) END AS amount,
         CASE WHEN o_orderkey % 19 = 0 THEN '2024-13-45 99:99:99' ELSE strftime(o_orderdate, {TS_FMT}) END AS order_time,
         CASE WHEN o_orderkey % 23 <> 0 THEN 'sqlserver' END AS source_db,
         CASE WHEN o_orderkey % 29 <> 0 THEN o_orderdate END AS cdc_time
  FROM orders)
SELECT o_orderkey, TRY_CAST(amount AS BIGINT) AS amount_cents,
       strftime(try_strptime(order_time, {TS_FMT}), {TS_FMT}) AS order_time,
       coalesce(source_db, {_q(fixed.SOURCE_DB)}) AS source_db,
       strftime(coalesce(cdc_time, {AS_OF}), {TS_FMT}) AS cdc_time
FROM r""",

    "retention_window": f"""
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_events, count(DISTINCT user_id) AS n_users
FROM events
WHERE ts >= CAST(CAST({AS_OF} AS DATE) - INTERVAL {fixed.RETENTION_DAYS_BEFORE} DAY AS TIMESTAMP)
  AND ts < CAST(CAST({AS_OF} AS DATE) + INTERVAL {fixed.RETENTION_DAYS_AFTER + 1} DAY AS TIMESTAMP)
GROUP BY 1""",

    "multi_source_union": """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS segment, 'customer' AS source_db FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 'supplier' FROM supplier""",

    "upsert_latest": f"""
WITH {LATEST_STATE},
u AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC, src DESC) AS rn
  FROM (SELECT *, 0 AS src FROM st UNION ALL SELECT *, 1 AS src FROM bt))
SELECT user_id, event_type, event_id, value, strftime(ts, {TS_FMT}) AS ts,
       CASE WHEN src = 1 THEN 'batch' ELSE 'state' END AS origin
FROM u WHERE rn = 1""",

    "upsert_accounting": f"""
WITH sk AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts < {STATE_CUT}),
bk AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts >= {STATE_CUT})
SELECT (SELECT count(*) FROM bk JOIN sk ON bk.user_id = sk.user_id AND bk.event_type = sk.event_type) AS updated,
       (SELECT count(*) FROM bk WHERE NOT EXISTS (
          SELECT 1 FROM sk WHERE bk.user_id = sk.user_id AND bk.event_type = sk.event_type)) AS inserted,
       (SELECT count(*) FROM (SELECT * FROM sk UNION SELECT * FROM bk)) AS total""",

    "due_keys": f"""
WITH {DUE}
SELECT user_id, event_type, strftime(last_seen, {TS_FMT}) AS last_seen, reason, reason <> 'fresh' AS due FROM r""",

    "cycle_counts": f"""
WITH {DUE}
SELECT count(*) AS n_keys, CAST(count_if(reason <> 'fresh') AS BIGINT) AS n_due,
       CAST(count_if(reason = 'fresh') AS BIGINT) AS n_skipped, CAST(count_if(reason = 'new') AS BIGINT) AS n_new,
       CAST(count_if(reason <> 'fresh') AS BIGINT) AS records, count(*) AS succeeded
FROM r""",

    "fallback_impute": f"""
WITH {IMPUTED}
SELECT event_id, event_type, value, is_fallback, source FROM imp""",

    "change_projection": f"""
SELECT event_id, event_type, TRY_CAST(json_extract(props, '$.k') AS DOUBLE) AS exchange_rate,
       strftime(ts, {TS_FMT}) AS timestamp, '{Q.AS_OF}' AS update_time, false AS is_fallback
FROM events""",

    "state_stats": f"""
WITH {IMPUTED},
s AS (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM imp)
      WHERE rn = 1)
SELECT count(*) AS total_records, count(*) AS covered_keys,
       CAST(count_if(is_fallback) AS BIGINT) AS fallback_records,
       CAST(count_if(epoch_us({AS_OF}) - epoch_us(ts) <= {Q.FRESH_INTERVAL} * CAST(1000000 AS BIGINT)) AS BIGINT) AS fresh_records,
       round(count(*) / ((SELECT count(DISTINCT user_id) FROM events) * (SELECT count(DISTINCT event_type) FROM events)), 4) AS coverage
FROM s""",

    "success_rate": """
SELECT user_id, count(*) AS total, CAST(count_if(event_type = 'error') AS BIGINT) AS failed,
       round(coalesce(CAST(count(*) - count_if(event_type = 'error') AS DOUBLE) * 100.0 / nullif(count(*), 0), 0.0), 4) AS success_rate
FROM events GROUP BY user_id""",

    "pair_expansion": """
SELECT doc_id, base, CAST(item_pos AS INTEGER) AS item_pos, CAST(target_chars AS INTEGER) AS target_chars FROM (
  SELECT doc_id, lang AS base, unnest(generate_series(0, len(arr) - 1)) AS item_pos,
         unnest(list_transform(arr, lambda x: length(x))) AS target_chars
  FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS arr FROM documents WHERE text IS NOT NULL))""",

    "nonblank_lines": f"""
SELECT lang, count(*) AS lines FROM (
  SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL)
WHERE {_strip('line')} <> ''
GROUP BY lang""",

    "region_derive": f"""
WITH a AS (SELECT c_custkey, d.province FROM customer JOIN {_address_values()} ON c_custkey % 10 = d.addr_idx),
r AS (SELECT c_custkey, province, {_region_case('province')} AS region FROM a)
SELECT c_custkey, province, region, {_temp_case('region')} AS temperature FROM r""",

    "clean_text": f"""
WITH c AS (SELECT doc_id, {_clean('text')} AS cleaned FROM documents WHERE text IS NOT NULL AND text <> '')
SELECT doc_id, CAST(length(cleaned) AS INTEGER) AS n_chars_clean, md5(cleaned) AS clean_md5
FROM c WHERE length(cleaned) >= {fixed.MIN_ADDRESS_LEN}""",

    "address_features": f"""
WITH {CLEANED_ADDRESSES}
SELECT c_custkey,
       CASE WHEN {' OR '.join(f"contains(cleaned_address, {_q(k)})" for k in fixed.PROVINCE_KEYWORDS)} THEN 1 ELSE 0 END AS has_province,
       CASE WHEN {' OR '.join(f"contains(cleaned_address, {_q(k)})" for k in fixed.CITY_KEYWORDS)} THEN 1 ELSE 0 END AS has_city,
       CASE WHEN {' OR '.join(f"contains(cleaned_address, {_q(k)})" for k in fixed.DISTRICT_KEYWORDS)} THEN 1 ELSE 0 END AS has_district,
       CASE WHEN {' OR '.join(f"contains(cleaned_address, {_q(k)})" for k in fixed.STREET_KEYWORDS)} THEN 1 ELSE 0 END AS has_street,
       CAST(length(cleaned_address) AS INTEGER) AS address_length,
       CAST(length({_strip('cleaned_address')}) AS INTEGER) AS word_count
FROM cleaned""",

    "qa_pairs_rule": f"""
WITH {CLEANED_ADDRESSES}, {RULE_PAIRS}
SELECT * FROM rule_pairs""",

    "address_components": f"""
WITH {CLEANED_ADDRESSES}, {COMPONENTS}
SELECT c_custkey, p AS province, c AS city, d AS district, s AS street, detail FROM comp""",

    "qa_pairs_regex": f"""
WITH {CLEANED_ADDRESSES}, {COMPONENTS},
b AS (SELECT *, {_strip('p || c || d || s || detail')} AS base FROM comp),
pairs AS (
  SELECT {_q(fixed.Q_PROVINCE)} || base AS instruction,
         CASE WHEN p <> '' THEN {_q(fixed.A_PREFIX)} || p ELSE {_q(fixed.A_NO_PROVINCE)} END AS output,
         base AS original_address FROM b
  UNION ALL
  SELECT {_q(fixed.Q_CITY)} || base,
         CASE WHEN c <> '' THEN {_q(fixed.A_PREFIX)} || c ELSE {_q(fixed.A_NO_CITY)} END, base FROM b
  UNION ALL
  SELECT {_q(fixed.Q_STANDARD)} || base, {_strip(_q(fixed.A_STANDARD) + ' || p || c || d || s || detail')}, base FROM b)
SELECT DISTINCT instruction, '' AS input, output, original_address FROM pairs
WHERE NOT contains(output, {_q(fixed.NOT_SURE)})""",

    "chat_text": f"""
SELECT u.conv_id, u.turn,
       '<|im_start|>user ' || u.text || ' <|im_end|> <|im_start|>assistant ' || a.text || ' <|im_end|>' AS chat
{CHAT_JOIN}""",

    "chat_plain": f"""
SELECT u.conv_id, u.turn, '用户: ' || u.text || chr(10) || '助手: ' || a.text AS chat
{CHAT_JOIN}""",

    "response_extract": f"""
WITH g AS (
  SELECT u.conv_id, u.turn,
         '<|im_start|>user' || chr(10) || u.text || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)
           || a.text || '<|im_end|>' AS generated
  {CHAT_JOIN}),
s AS (SELECT *, string_split(generated, '<|im_start|>assistant' || chr(10)) AS parts FROM g),
t AS (SELECT conv_id, turn,
             CASE WHEN contains(generated, '<|im_start|>assistant' || chr(10))
                  THEN (CASE WHEN contains(parts[-1], '<|im_end|>') THEN split_part(parts[-1], '<|im_end|>', 1)
                             ELSE parts[-1] END)
                  ELSE generated END AS r
      FROM s)
SELECT conv_id, turn, {_strip('r')} AS response FROM t""",

    "encode_tokens": f"""
WITH {CLEANED_ADDRESSES}, {RULE_PAIRS}, {ENCODED}
SELECT instruction, output, array_to_string(ids, ',') AS input_ids,
       CAST(len(all_ids) AS INTEGER) AS n_tokens,
       CAST(len(ids) AS INTEGER) AS mask_len, true AS labels_match
FROM encoded""",

    "decode_tokens": f"""
WITH {CLEANED_ADDRESSES}, {RULE_PAIRS}, {ENCODED}
SELECT instruction, output,
       array_to_string(list_transform(ids, lambda i: coalesce({_inverse_vocab_map()}[i], {_q(fixed.UNK_TOKEN)})), ' ') AS decoded
FROM encoded""",

    "encode_conversations": f"""
WITH chat_t AS (
  SELECT u.conv_id, u.turn,
         '<|im_start|>user ' || u.text || ' <|im_end|> <|im_start|>assistant ' || a.text || ' <|im_end|>' AS txt
  {CHAT_JOIN}),
words AS (
  SELECT conv_id, turn,
         list_filter(string_split_regex(
           {_strip("replace(replace(txt, '<|im_start|>', ' <|im_start|> '), '<|im_end|>', ' <|im_end|> ')")},
           {_q(RE2_SPACE_RUN)}), lambda x: x <> '') AS ws
  FROM chat_t),
coded AS (
  SELECT conv_id, turn, flatten(list_transform(ws, lambda w:
             CASE WHEN map_contains({_vocab_map()}, w) THEN [{_vocab_map()}[w]]
                  ELSE list_transform(string_split(w, ''), lambda ch: coalesce({_vocab_map()}[ch], {fixed.UNK_ID})) END)) AS ids
  FROM words)
SELECT conv_id, turn, CAST(len(ids) AS INTEGER) AS n_tokens, md5(array_to_string(ids, ',')) AS ids_md5 FROM coded""",

    "hash_split": f"""
SELECT doc_id, CASE WHEN ('0x' || substr(md5('{fixed.SPLIT_SEED}:' || CAST(doc_id AS VARCHAR)), 1, 6))::BIGINT % 100
                         < {fixed.EVAL_PERCENT} THEN 'eval' ELSE 'train' END AS split
FROM documents""",

    "reconcile_tables": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, "
        f"CAST(sum(CAST({k} AS DECIMAL(38,0))) AS VARCHAR) AS key_sum FROM {t}"
        for t, k in Q.STORE_TABLES.items()),

    "reconcile_contents": """
WITH first AS (SELECT min(o_orderkey) AS k FROM orders),
t AS (
  SELECT 'changed' AS table_name, count(*) AS source_rows, count(*) AS copy_rows,
         CAST(sum(CAST(o_orderkey AS DECIMAL(38,0))) AS VARCHAR) AS source_key_sum,
         CAST(sum(CAST(o_orderkey AS DECIMAL(38,0))) AS VARCHAR) AS copy_key_sum, false AS in_sync FROM orders
  UNION ALL
  SELECT 'equal', count(*), count(*), CAST(sum(CAST(o_orderkey AS DECIMAL(38,0))) AS VARCHAR),
         CAST(sum(CAST(o_orderkey AS DECIMAL(38,0))) AS VARCHAR), true FROM orders
  UNION ALL
  SELECT 'missing', count(*), count_if(o_orderkey <> k), CAST(sum(CAST(o_orderkey AS DECIMAL(38,0))) AS VARCHAR),
         CAST(sum(CASE WHEN o_orderkey <> k THEN CAST(o_orderkey AS DECIMAL(38,0)) END) AS VARCHAR), false
  FROM orders, first)
SELECT * FROM t""",

    "basket_affinity": """
WITH op AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
top AS (SELECT l_partkey AS top FROM lineitem GROUP BY l_partkey ORDER BY sum(l_quantity) DESC, l_partkey ASC LIMIT 1),
tor AS (SELECT l_orderkey FROM op WHERE l_partkey = (SELECT top FROM top)),
n AS (SELECT count(DISTINCT l_orderkey) AS n_orders FROM op),
nt AS (SELECT count(*) AS n_top FROM tor),
co AS (SELECT l_partkey, count(*) AS co_orders FROM op
       WHERE l_orderkey IN (SELECT l_orderkey FROM tor) AND l_partkey <> (SELECT top FROM top) GROUP BY 1),
pp AS (SELECT l_partkey, count(*) AS part_orders FROM op GROUP BY 1)
SELECT co.l_partkey, co_orders,
       round(co_orders / n_orders, 6) AS support,
       round(co_orders / n_top, 6) AS confidence,
       round((co_orders / n_top) / (part_orders / n_orders), 6) AS lift
FROM co JOIN pp ON co.l_partkey = pp.l_partkey, n, nt""",

    "new_product_trend": """
WITH m AS (SELECT l_partkey, CAST(year(l_shipdate) * 12 + month(l_shipdate) - 1 AS INTEGER) AS ym,
                  CAST(sum(CAST(l_quantity AS DECIMAL(18,6))) AS DOUBLE) AS qty
           FROM lineitem GROUP BY 1, 2),
x AS (SELECT *, ym - min(ym) OVER (PARTITION BY l_partkey) AS month_no FROM m)
SELECT l_partkey, CAST(month_no AS INTEGER) AS month_no, qty,
       CAST(lag(month_no) OVER w AS INTEGER) AS prev_month_no, lag(qty) OVER w AS prev_qty,
       CASE WHEN lag(qty) OVER w > 0 THEN round((qty - lag(qty) OVER w) / lag(qty) OVER w, 4) END AS growth,
       printf('%04d-%02d', CAST(ym // 12 AS INTEGER), CAST(ym % 12 + 1 AS INTEGER)) AS month
FROM x WINDOW w AS (PARTITION BY l_partkey ORDER BY ym)""",

    "report_rollup": """
SELECT r_name, n_name, o_orderstatus, count(*) AS n_orders,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents,
       CAST(grouping(r_name) + grouping(n_name) + grouping(o_orderstatus) AS INTEGER) AS level
FROM orders JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey
GROUP BY ROLLUP (r_name, n_name, o_orderstatus)""",

    "dq_checks": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{c}' AS check_name, CAST(({s}) AS BIGINT) AS n_bad"
        for t, c, s in _dq_rows()),

    "report_from_changes": f"""
WITH o AS (
  SELECT o_custkey,
         CASE WHEN o_orderstatus = 'P' AND o_orderkey % 11 = 0 THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
         CAST(round((CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END) * 100) AS BIGINT) AS cents
  FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '{Q.PURGE_BEFORE}'))
SELECT r_name, n_name, o_orderstatus, count(*) AS n_orders, CAST(sum(cents) AS BIGINT) AS total_cents,
       CAST((r_name IS NULL)::INT + (n_name IS NULL)::INT + (o_orderstatus IS NULL)::INT AS INTEGER) AS level
FROM o JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
GROUP BY ROLLUP (r_name, n_name, o_orderstatus)""",

    "topic_load": f"""
WITH c AS (SELECT CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS operation,
                  CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_id + 1 AS change_id FROM events)
SELECT operation, '{Q.AS_OF[:10]}' AS ds, count(*) AS n,
       CAST(sum(CASE WHEN operation <> 'D' THEN k END) AS BIGINT) AS k_sum,
       max(CASE WHEN operation <> 'D' THEN change_id END) AS last_id, (SELECT count(*) FROM c) AS n_counted
FROM c GROUP BY operation""",

    "refresh_cycles": f"""
WITH p AS (SELECT b, t, row_number() OVER (ORDER BY b, t) - 1 AS pair
           FROM (VALUES {', '.join(f"('{b}', '{t}')" for b, ts in fixed.CURRENCY_PAIRS.items() for t in ts)}) AS v(b, t)),
ref AS (SELECT * FROM (VALUES {', '.join(f"('{b}', '{t}', {r})" for b, m in fixed.FALLBACK_RATES.items() for t, r in m.items())}) AS v(b, t, r)),
f AS (SELECT p.b, p.t, ts,
             CASE WHEN NOT (event_type = 'error' OR (ts < TIMESTAMP '{U.CYCLES[0]}' AND p.pair % 6 = 2)) THEN value END AS rate
      FROM events JOIN p ON event_id % 18 = p.pair),
c AS (SELECT * FROM (VALUES (TIMESTAMP '1900-01-01', TIMESTAMP '{U.CYCLES[0]}'),
        (TIMESTAMP '{U.CYCLES[1]}', TIMESTAMP '{U.CYCLES[2]}'), (TIMESTAMP '{U.CYCLES[2]}', TIMESTAMP '{U.CYCLES[3]}')) AS v(lo, hi)),
g AS (SELECT c.hi, p.b, p.t, f.rate,
             row_number() OVER (PARTITION BY c.hi, p.b, p.t ORDER BY coalesce(f.rate <> 0, false) DESC, f.ts DESC NULLS LAST,
                                f.rate DESC NULLS LAST) AS k
      FROM c CROSS JOIN p LEFT JOIN f ON f.b = p.b AND f.t = p.t AND f.ts >= c.lo AND f.ts < c.hi)
SELECT g.b AS base_currency, g.t AS target_currency,
       round(CASE WHEN coalesce(g.rate, 0) <> 0 THEN g.rate ELSE ref.r END, 6) AS exchange_rate,
       strftime(hi, {TS_FMT}) AS update_time, coalesce(g.rate, 0) = 0 AS is_fallback
FROM g LEFT JOIN ref ON ref.b = g.b AND ref.t = g.t WHERE k = 1""",

    "preview_orders": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",

    "catalog_statements": """
SELECT true AS made, false AS made_again, 1::BIGINT AS databases, count(*) AS n_rows, CAST(sum(c_custkey) AS BIGINT) AS key_sum,
       true AS has_version, false AS left_behind FROM customer""",

    "stream_counters": f"""
SELECT strftime(date_trunc('day', ts), {TS_FMT}) AS window_start,
       CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS operation,
       count(*) AS changes, max(event_id) + 1 AS last_id
FROM events GROUP BY 1, 2""",

    "stream_change_table": """
SELECT CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS operation, count(*) AS n,
       CAST(sum(event_id + 1) AS BIGINT) AS id_sum, min(event_id) + 1 AS first_id, max(event_id) + 1 AS last_id,
       count(CASE WHEN event_type <> 'signup' THEN props END) AS n_old,
       count(CASE WHEN event_type <> 'error' THEN props END) AS n_new
FROM events GROUP BY 1""",

    "copy_differences": """
WITH e AS (SELECT min(o_orderkey) AS low, max(o_orderkey) - min(o_orderkey) + 1 AS width FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey - low >= width - width // 500 THEN 'missing' ELSE 'changed' END AS difference
FROM orders, e
WHERE o_orderkey - low >= width - width // 500
   OR (o_orderkey - low >= width // 4 AND o_orderkey - low < width // 4 + width // 200 AND o_orderkey % 3 = 0)
UNION ALL
SELECT o_orderkey + width, 'added' FROM orders, e WHERE o_orderkey - low < width // 1000 + 1""",

    "bucketed_join": """
SELECT l_orderkey, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
       max(o_totalprice) AS o_totalprice, max(o_orderstatus) AS o_orderstatus
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey""",

    "point_reads": f"""
SELECT asked, strftime(o_orderdate, '%Y%m%d') || '_' || CAST(o_orderkey AS VARCHAR) AS rowkey, o_orderkey, o_totalprice
FROM (SELECT 'few' AS asked, * FROM orders WHERE o_orderkey < {U.FEW_KEYS}
      UNION ALL SELECT 'many', * FROM orders WHERE o_orderkey % 3 = 0)""",

    "pruned_days": """
SELECT strftime(ts, '%Y-%m-%d') AS ds, CAST(isodow(ts) - 1 AS INTEGER) AS weekday, count(*) AS n_events,
       count(DISTINCT user_id) AS n_users
FROM events WHERE isodow(ts) >= 6 GROUP BY 1, 2""",

    "cells_as_of": f"""
WITH c AS (SELECT CAST(user_id AS VARCHAR) || '_' || event_type AS rowkey, ts, event_id, value FROM events),
q AS (SELECT rowkey, t AS as_of FROM (SELECT DISTINCT rowkey FROM c),
        (SELECT unnest([{', '.join(f"TIMESTAMP '{t}'" for t in U.AS_OF_TIMES)}]) AS t)),
r AS (SELECT q.rowkey, q.as_of, event_id, value, ts,
             row_number() OVER (PARTITION BY q.rowkey, q.as_of ORDER BY ts DESC NULLS LAST, event_id DESC) AS k
      FROM q LEFT JOIN c ON c.rowkey = q.rowkey AND c.ts <= q.as_of)
SELECT rowkey, strftime(as_of, {TS_FMT}) AS as_of, event_id, value, strftime(ts, {TS_FMT}) AS ts FROM r WHERE k = 1""",

    "payload_drift": """
WITH f AS (
  SELECT 'events' AS source, 'k' AS field, 'BIGINT' AS kind FROM events WHERE json_extract(props, '$.k') IS NOT NULL
  UNION ALL SELECT 'orders', 'o_orderkey', 'BIGINT' FROM orders
  UNION ALL SELECT 'orders', 'price', CASE WHEN o_orderstatus = 'P' THEN 'STRING' ELSE 'DECIMAL' END FROM orders
  UNION ALL SELECT 'orders', 'priority', 'STRING' FROM orders WHERE o_orderstatus = 'O'),
g AS (SELECT source, field, kind, count(*) AS n_rows FROM f GROUP BY ALL)
SELECT source, field, kind, n_rows, count(*) OVER (PARTITION BY source, field) > 1 AS drifts FROM g""",

    "payload_typed": """
SELECT 'orders' AS source, o_orderkey AS id, NULL::BIGINT AS k, o_orderkey,
       CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS priority, round(o_totalprice, 2) AS price FROM orders
UNION ALL
SELECT 'events', event_id, CAST(json_extract(props, '$.k') AS BIGINT), NULL, NULL, NULL FROM events""",

    "sketch_coverage": """
SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, count(*) AS n_rows, count(DISTINCT user_id) AS n_users,
       true AS within_bound
FROM events GROUP BY 1""",

    "exact_split": f"""
WITH n AS (SELECT count(*) AS n, count(*) * {fixed.EVAL_PERCENT} // 100 AS e FROM documents)
SELECT 'eval' AS split, e AS n, e AS n_ids FROM n UNION ALL SELECT 'train', n - e, n - e FROM n""",
}
