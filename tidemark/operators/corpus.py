"""Address corpus preparation: cleaning, features, component extraction
and question/answer pair generation.

Each step is a DataFrame transformation built from native expressions;
pair generation builds an array of structs per row and explodes it (the
table-function equivalent).  Rows are dealt out before anything is
de-duplicated, so that no task holds all distinct rows of what it read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.functions import text as T
from tidemark.functions.compute import literal_table, with_computed


def address_dimension(spark) -> DataFrame:
    """The fixed 10-row address dimension with its position ``addr_idx``."""
    rows = [(i, *r) for i, r in enumerate(fixed.ADDRESS_ROWS)]
    return literal_table(
        spark, rows, "addr_idx int, address string, province string, city string, district string, street string")


def clean_addresses(df: DataFrame, col: str = "address", out: str = "cleaned_address",
                    min_len: int = fixed.MIN_ADDRESS_LEN) -> DataFrame:
    """Drop NULL/empty input, clean the text, keep cleaned length >= min_len."""
    kept = df.where(F.col(col).isNotNull() & (F.col(col) != ""))
    return with_computed(kept, out, T.clean_text(col)).where(F.length(out) >= min_len)


def address_features(df: DataFrame, col: str = "cleaned_address") -> DataFrame:
    """Keyword-presence flags and lengths.

    ``word_count`` is the length of the stripped text (a character count,
    kept as is for compatibility with the existing corpus files).
    """
    return df.select(
        "*",
        T.any_keyword(col, fixed.PROVINCE_KEYWORDS).alias("has_province"),
        T.any_keyword(col, fixed.CITY_KEYWORDS).alias("has_city"),
        T.any_keyword(col, fixed.DISTRICT_KEYWORDS).alias("has_district"),
        T.any_keyword(col, fixed.STREET_KEYWORDS).alias("has_street"),
        F.length(col).alias("address_length"),
        F.length(T.strip_ws(col)).alias("word_count"),
    )


def _pair(cond, instruction, output):
    s = F.struct(instruction.alias("instruction"), output.alias("output"))
    return F.when(cond, s) if cond is not None else s


def _dealt(df: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of ``df``, dealt out by their values and the task that read
    them.  A following ``distinct`` holds the rows of one share instead of
    those of a whole input split; rows that are frequent are in several
    shares and shrink there before they meet."""
    rows = df.select(*columns, F.spark_partition_id().alias("_task"))
    return rows.repartition(*columns, "_task").select(*columns)


def qa_pairs_rule(df: DataFrame, address: str = "cleaned_address",
                  province: str = "province", city: str = "city",
                  district: str = "district", street: str = "street") -> DataFrame:
    """Up to four pairs per address from its known components, de-duplicated
    over (instruction, output, original_address, components).  All pairs
    follow from address and components, which are part of the result, so
    these are de-duplicated before the pairs are made; within one row, pairs
    can only be equal when the address is NULL."""
    a = F.col(address)
    key = (address, province, city, district, street)
    standard = T.strip_ws(F.concat(T.or_empty(province), T.or_empty(city),
                                   T.or_empty(district), T.or_empty(street)))
    pairs = F.array(
        _pair(T.present(province), F.concat(F.lit(fixed.Q_PROVINCE), a),
              F.concat(F.lit(fixed.A_PREFIX), F.col(province), F.lit(fixed.A_PROVINCE_SUFFIX))),
        _pair(T.present(city), F.concat(F.lit(fixed.Q_CITY), a),
              F.concat(F.lit(fixed.A_PREFIX), F.col(city))),
        _pair(T.present(district), F.concat(F.lit(fixed.Q_DISTRICT), a),
              F.concat(F.lit(fixed.A_PREFIX), F.col(district))),
        _pair(standard != "", F.concat(F.lit(fixed.Q_STANDARD), a),
              F.concat(F.lit(fixed.A_STANDARD), standard)),
    )
    pairs = F.array_distinct(F.filter(pairs, lambda p: p.isNotNull()))
    return (_dealt(df, *key).distinct()
            .select(F.explode(pairs).alias("pair"), a.alias("original_address"),
                    province, city, district, street)
            .select(F.col("pair.instruction").alias("instruction"),
                    F.col("pair.output").alias("output"),
                    "original_address", province, city, district, street))


def address_components(df: DataFrame, col: str = "cleaned_address") -> DataFrame:
    """Province, city, district and street found by pattern search on the
    whole address ('' when absent), and the residual detail: the address
    with every occurrence of each found component removed, in order."""
    x = F.col(col)
    prov = F.regexp_extract(x, fixed.PROVINCE_PATTERN, 1)
    city = F.regexp_extract(x, fixed.CITY_PATTERN, 1)
    dist = F.regexp_extract(x, fixed.DISTRICT_PATTERN, 1)
    street = F.regexp_extract(x, fixed.STREET_PATTERN, 1)
    out = df.select("*", prov.alias("c_province"), city.alias("c_city"),
                    dist.alias("c_district"), street.alias("c_street"))
    detail = F.col(col)
    for part in ["c_province", "c_city", "c_district", "c_street"]:
        detail = F.when(F.col(part) != "", F.replace(detail, F.col(part))).otherwise(detail)
    return out.withColumn("c_detail", detail)


def qa_pairs_regex(df: DataFrame, col: str = "cleaned_address") -> DataFrame:
    """Three pairs per address from the pattern-found components; pairs whose
    answer is 'cannot determine' are dropped; de-duplicated on
    (instruction, output).  ``original_address`` is a function of the
    instruction (the instruction is the question text followed by it), so
    one row per (instruction, output) is one per question, address and
    output: these are de-duplicated, and the instruction is written out
    afterwards."""
    comp = address_components(df, col)
    parts = [F.col(c) for c in ("c_province", "c_city", "c_district", "c_street", "c_detail")]
    found = comp.select(T.strip_ws(F.concat(*parts)).alias("original_address"), "c_province", "c_city",
                        T.strip_ws(F.concat(F.lit(fixed.A_STANDARD), *parts)).alias("_standard"))
    questions = [fixed.Q_PROVINCE, fixed.Q_CITY, fixed.Q_STANDARD]
    outputs = [
        F.when(F.col("c_province") != "", F.concat(F.lit(fixed.A_PREFIX), "c_province"))
         .otherwise(F.lit(fixed.A_NO_PROVINCE)),
        F.when(F.col("c_city") != "", F.concat(F.lit(fixed.A_PREFIX), "c_city"))
         .otherwise(F.lit(fixed.A_NO_CITY)),
        F.col("_standard"),
    ]
    pairs = (_dealt(found, *found.columns)
             .select(F.posexplode(F.array(*outputs)).alias("_question", "output"), "original_address")
             .where(~F.contains(F.col("output"), F.lit(fixed.NOT_SURE)))
             .distinct())
    question = F.element_at(F.array(*[F.lit(q) for q in questions]), F.col("_question") + 1)
    return pairs.select(F.concat(question, "original_address").alias("instruction"),
                        F.lit("").alias("input"), "output", "original_address")


def training_records(pairs: DataFrame) -> DataFrame:
    """Corpus record shape: instruction, input = '', output, original_address."""
    return pairs.select("instruction", F.lit("").alias("input"), "output", "original_address")


def chat_turns(conv: DataFrame, style: str = "train") -> DataFrame:
    """Pair each user turn with the assistant turn that directly follows it
    and render the chat text.

    The pairing is an equi-join on (conv_id, turn + 1), so one very long
    conversation is spread over many tasks instead of one window partition.
    """
    users = conv.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("instruction"))
    bots = conv.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output"))
    pairs = users.join(bots, ["conv_id", "turn"])
    return pairs.select("conv_id", "turn", "instruction", "output",
                        T.chat_text("instruction", "output", style).alias("chat"))


def responses(df: DataFrame, col: str = "chat") -> DataFrame:
    """Assistant reply extracted from generated chat text."""
    return df.withColumn("response", T.extract_response(col))
