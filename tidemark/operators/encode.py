"""Corpus-to-tensor preparation: encode pairs to fixed-length id arrays,
decode, and a deterministic train/eval split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.functions import text as T
from tidemark.functions import tokens as K


def encode_pairs(pairs: DataFrame, max_length: int, instruction: str = "instruction",
                 output: str = "output", keep=()) -> DataFrame:
    """input_ids / labels / attention_mask for each pair, rendered with the
    training chat template, at the caller's ``max_length``; ``n_tokens`` is
    the number of ids before they are cut or padded.  Input columns other
    than ``keep`` are dropped (batched map with column removal)."""
    ids = K.token_ids(T.chat_text(instruction, output, "train"))
    return (pairs.select(*keep, ids.alias("_ids"))
                 .select(*keep, F.size("_ids").alias("n_tokens"),
                         K.pad_truncate("_ids", max_length).alias("input_ids"))
                 .withColumn("labels", F.col("input_ids"))
                 .withColumn("attention_mask", K.attention_mask("input_ids")))


def decode_ids(df: DataFrame, ids: str = "input_ids", out: str = "decoded") -> DataFrame:
    return df.withColumn(out, K.decode(ids))


def split_bucket(key) -> F.Column:
    """Bucket 0..99 from the key and the fixed seed."""
    k = F.concat(F.lit(str(fixed.SPLIT_SEED)), F.lit(":"), (F.col(key) if isinstance(key, str) else key).cast("string"))
    return T.hash_unit(k, 100)


def train_eval_split(df: DataFrame, key: str, eval_percent: int = fixed.EVAL_PERCENT,
                     duplicate_all: bool = False) -> DataFrame:
    """Rows labelled 'train' / 'eval' by a hash of the key (stable under any
    partitioning, unlike ``randomSplit``).  With ``duplicate_all``, the
    caller's choice for a handful of rows, every row is in both sets."""
    if duplicate_all:
        return df.withColumn("split", F.explode(F.array(F.lit("train"), F.lit("eval"))))
    return df.withColumn("split", F.when(split_bucket(key) < eval_percent, "eval").otherwise("train"))


HASH_BITS, STEP_BITS = 96, 12
TIED = 1_000_000    # equal rows that a task writes


def exact_split(df: DataFrame, key: str, eval_percent: int = fixed.EVAL_PERCENT, seed: int = fixed.SPLIT_SEED) -> DataFrame:
    """Rows labelled 'train' / 'eval' with exactly
    ``floor(rows * eval_percent / 100)`` in 'eval', the same on every run.

    Rows are ordered by a 96-bit hash of seed, key and then the whole row.
    The hash of the last 'eval' row is found by histograms: 4096 buckets of
    its leading bits, then only the bucket in which the count is reached is
    counted by the next bits, and so on; no row is sorted.  Rows with the very
    same hash are equal rows; of those at the boundary as many are 'eval' as
    are still missing, counted and dealt out as a number.
    """
    names = df.columns
    parts = F.concat_ws("\x1f", F.lit(str(seed)), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("\x00")))
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in names]), {"ignoreNullFields": "false"})
    digits = F.concat(F.substring(F.md5(parts), 1, 12), F.substring(F.md5(F.concat(parts, whole)), 1, 12))
    rows = df.withColumn("_h", digits)
    total = rows.count()
    left, prefix = total * eval_percent // 100, ""
    hit = rows
    for used in range(0, HASH_BITS // 4, STEP_BITS // 4):
        bucket = F.substring("_h", used + 1, STEP_BITS // 4)
        counts = sorted(hit.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect())  # at most 4096
        for b, n in counts:
            if n > left:
                prefix += b
                break
            left -= n
        else:
            prefix = None  # all rows are 'eval'
            break
        hit = hit.where(F.col("_h").startswith(prefix))
    if prefix is None:
        return df.withColumn("split", F.lit("eval"))
    label = F.when(F.col("_h") < prefix, "eval").when(F.col("_h") > prefix, "train")
    clear = rows.where(F.col("_h") != prefix).withColumn("split", label)
    # equal rows: one of them, repeated; the first ``left`` are 'eval'
    tied = rows.where(F.col("_h") == prefix).withColumn("split", F.lit("train"))
    if left:
        block = F.explode(F.sequence(F.lit(0), F.lit((n - 1) // TIED).cast("long")))
        number = F.explode(F.sequence(F.col("_b") * TIED + 1, F.least((F.col("_b") + 1) * TIED, F.lit(n))))
        tied = (tied.limit(1).withColumn("_b", block).repartition("_b").withColumn("_i", number)
                    .withColumn("split", F.when(F.col("_i") <= left, "eval").otherwise("train")))
    return clear.select(*names, "split").unionByName(tied.select(*names, "split"))
