"""Queries of this subpackage over the test tables, and DuckDB SQL for
those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (ann, bpe, exact_dedup, hard_negatives, langid, line_dedup, mixing, ngram_join, phrases,
                          quality, substrings, token_counts, warc)
from tidemark.llm.common import shared_path

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.token_counts(_read(spark, sf, "documents"), public_tokenizers.path(TOKENIZER),
                                     public_tokenizers.PATTERN, limit=512)


def grade() -> Column:
    """The graded rating of ``labels``: 0 toxic, 1 of low quality, 2 good."""
    return F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)


GRADES, GOOD = 3, 2


def op2_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = _read(spark, sf, "documents")
    model = quality.fit(docs, _read(spark, sf, "labels"), grade(), GRADES)
    rated = quality.rate(docs.select("doc_id", "text"), model, GOOD)
    return rated.select("row.doc_id", "expected_grade", F.col("tail").alias("tail_probability"), "kept")


def op3_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.round_trip(_read(spark, sf, "documents"), public_tokenizers.path(RANKS),
                          public_tokenizers.PATTERN)


def op4_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = _read(spark, sf, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    net = langid.fit(docs.where(~held_out))
    return langid.identify(docs, net).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_read(spark, sf, "documents"))


def op6_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return ann.nearest(_read(spark, sf, "embeddings"), F.col("id") % 20 == 0, k=20)


def op7_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = line_dedup.drop_recurring(_read(spark, sf, "documents").select("doc_id", "text"),
                                    long_docs=line_dedup.LONG_DOCS)
    return out.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"),
                      F.sha2("text", 256).alias("text_sha256"))


def op8_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write(warc.with_revisits(_read(spark, sf, "pages"), least=0), path)
    records = warc.read(spark, path, "record_id string, record_type string, refers_to string, "
                                     "payload_bytes long, payload_digest string")
    return records.select(warc.id_of("record_id").alias("page_id"), "payload_bytes", "payload_digest",
                          "record_type", warc.id_of("refers_to").alias("refers_to"))


def op9_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.groups(_read(spark, sf, "documents"), n=3, percent=90)


def op10_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.duplicate_groups(_read(spark, sf, "documents"), keep="largest")


def op11_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(_read(spark, sf, "documents"))


def op12_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = substrings.drop_repeats(_read(spark, sf, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_read(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_quality": op2_quality,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_language_id": op4_language_id,
    "op5_mixing": op5_mixing,
    "op6_nearest": op6_nearest,
    "op7_line_dedup": op7_line_dedup,
    "op8_warc": op8_warc,
    "op9_ngram_join": op9_ngram_join,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_phrases": op11_phrases,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_hard_negatives": op13_hard_negatives,
}

SQL = {
    "op5_mixing": r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, md5(text), '')), 1, 12))::BIGINT AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, 3 * source_size AS cap,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
               WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s),
o AS (SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER p, 0) AS rest,
             sum(w) OVER () - coalesce(sum(w) OVER p, 0) AS rest_w
      FROM w WINDOW p AS (ORDER BY cap::DOUBLE / w, source NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT rest::DOUBLE AS rest, rest_w FROM o WHERE cap * rest_w > rest * w
      ORDER BY cap::DOUBLE / w LIMIT 1),
t AS (SELECT w.source, source_size,
             coalesce(least(cap::DOUBLE, f.rest * w / f.rest_w), cap::DOUBLE) AS target
      FROM w LEFT JOIN f ON true),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
g AS (SELECT source, h, sum(size)::BIGINT AS m FROM d GROUP BY source, h),
u AS (SELECT source, h, sum(m) OVER (PARTITION BY source ORDER BY h) AS upto FROM g),
e AS (SELECT b.source, source_size, target, epochs, target - epochs * source_size AS budget,
             coalesce(max(upto) FILTER (upto <= target - epochs * source_size), 0) AS used,
             min(h) FILTER (upto > target - epochs * source_size) AS edge,
             min(upto) FILTER (upto > target - epochs * source_size) AS edge_upto
      FROM b JOIN u ON b.source IS NOT DISTINCT FROM u.source
      GROUP BY b.source, source_size, target, epochs)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN edge IS NULL OR h < edge
                              OR (h = edge AND edge_upto - budget < budget - used)
                         THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
""",
    "op8_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex,
             min(page_id) OVER (PARTITION BY payload) AS first FROM p),
b AS (SELECT *, list_transform(range(0, 8), lambda i: ('0x' || substr(hex, (1 + 5 * i)::INT, 5))::BIGINT) AS part FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(part, lambda v:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 15) & 31)::INT + 1, 1) ||
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 10) & 31)::INT + 1, 1) ||
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 5) & 31)::INT + 1, 1) ||
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v & 31)::INT + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
""",
    "op10_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
""",
    "op11_phrases": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest([1, 2, 3, 4]) AS k))),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
often AS (SELECT * FROM counts WHERE f >= 30),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM often WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, j, p.f AS l, r.f AS r,
         (2000000::HUGEINT * c.a // (p.f + r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) c
  JOIN often p ON p.lang = c.lang AND p.phrase = array_to_string(list_slice(c.w, 1, j), ' ')
  JOIN often r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(c.w, j + 1, c.k), ' ')),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM cuts) WHERE o = 1),
inner_phrases AS (
  SELECT lang, a AS around, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM cand))),
gone AS (SELECT DISTINCT b.lang, b.phrase FROM best b
         JOIN inner_phrases i ON b.lang = i.lang AND b.phrase = i.phrase AND 100 * i.around >= 80 * b.a),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score
  FROM best ANTI JOIN gone USING (lang, phrase))
SELECT lang, rank::INT AS rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
""",
    "op12_substring_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
windows AS (SELECT row, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS h
            FROM (SELECT row, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
again AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY h) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT row, i + j AS pos FROM again, (SELECT unnest(range(0, 35)) AS j)),
words AS (SELECT row, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
kept AS (SELECT row, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n FROM words ANTI JOIN gone USING (row, pos) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(kept.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (row)
""",
    "op13_hard_negatives": """
WITH r AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.id AS anchor, a.label = b.label AS same, b.id, list_inner_product(a.v, b.v)::BIGINT AS score
      FROM r a JOIN r b ON a.id % 50 = 0 AND a.id <> b.id),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS k FROM s WHERE same) WHERE k <= 5),
n AS (SELECT p.anchor, p.id AS positive, p.score AS ps, s.id, s.score,
             row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id) AS k
      FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor AS anchor_id, positive AS positive_id, k::INT AS rank, id AS negative_id, ps AS positive_score, score AS negative_score
FROM n WHERE k <= 3
""",
}
