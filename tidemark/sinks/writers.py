"""Sinks: topic-style JSON records, keyed state stored as committed
versions, day-partitioned bucketed tables, corpus JSON, append logs and
console preview.

Keyed state is never overwritten in place: each upsert writes a new
version directory and then commits it by adding one small commit file.
Readers take the highest committed version, so a failed or repeated job
never leaves a half-written state visible, and re-running a batch gives
the same next state (idempotent keyed write).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidemark.functions import fixed
from tidemark.operators import state as S
from tidemark.session import checkpoint_dir
from tidemark.sources.catalog import check_key_prefix


# --- records as JSON values (topic sink) ----------------------------------------

def as_topic_records(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """One JSON string per record in ``value`` (plus ``key`` when given) -
    the shape a message-topic sink takes."""
    cols = [F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")]
    if key_col:
        cols.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*cols)


def topic_writer(df: DataFrame, fmt: str = "kafka", options: dict | None = None,
                 checkpoint: str | None = None, trigger: str | None = None):
    """Configured ``DataStreamWriter`` for a streaming frame of records.
    ``fmt='kafka'`` needs the connector on the classpath; ``json`` / ``memory``
    work everywhere."""
    w = df.writeStream.format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(processingTime=trigger)
    return w


# --- committed state versions -------------------------------------------------------

def _read_if_there(read):
    """``read()``, or None where its path does not exist yet; any other
    failure is the caller's."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _commits(base: str) -> str:
    return f"{base.rstrip('/')}/_commits"


def current_version(spark: SparkSession, base: str) -> int | None:
    """Highest committed version number, or None when nothing is committed."""
    commits = _read_if_there(lambda: spark.read.text(_commits(base)))
    if commits is None:
        return None
    return commits.agg(F.max(F.col("value").cast("bigint"))).first()[0]


def version_path(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/v={version}"


def read_state(spark: SparkSession, base: str, schema: str | None = None) -> DataFrame | None:
    v = current_version(spark, base)
    if v is None:
        return None if schema is None else spark.createDataFrame([], schema)
    return spark.read.parquet(version_path(base, v))


def commit_state(spark: SparkSession, df: DataFrame, base: str) -> int:
    """Write ``df`` as the next version, then commit it.

    One writer per ``base`` (a streaming query or a scheduled job).  A
    failed attempt leaves an uncommitted version directory that the next
    attempt overwrites; readers only see committed versions.  Because the
    new version is a written table, it also cuts the lineage of iterative
    state updates."""
    cur = current_version(spark, base)
    nxt = 0 if cur is None else cur + 1
    df.write.mode("overwrite").parquet(version_path(base, nxt))
    commit_version(spark, base, nxt)
    return nxt


def commit_version(spark: SparkSession, base: str, version: int) -> None:
    """Make a written version the current one."""
    spark.createDataFrame([(str(version),)], "value string").coalesce(1).write.mode("append").text(_commits(base))


def commit_with(spark: SparkSession, df: DataFrame, base: str, logs: dict) -> int:
    """Write ``logs`` (path -> frame) under ``state_version=<next>``, then
    commit ``df`` as that version.

    A failure before the commit leaves the old version current, and the
    next attempt writes the same folders again; so no log record is lost or
    doubled, whichever step failed."""
    cur = current_version(spark, base)
    nxt = 0 if cur is None else cur + 1
    for path, log in logs.items():
        log.write.mode("overwrite").json(f"{path.rstrip('/')}/state_version={nxt}")
    return commit_state(spark, df, base)


def upsert_state(spark: SparkSession, batch: DataFrame, base: str, keys, order_cols,
                 origin_col: str | None = None) -> int:
    """Keyed upsert of ``batch`` into the committed state at ``base``
    (last write wins by ``order_cols``); returns the new version."""
    cur = read_state(spark, base)
    stored = batch.limit(0) if cur is None else cur.select(*batch.columns)
    return commit_state(spark, S.upsert(stored, batch, keys, order_cols, origin_col), base)


def upsert_partitioned_state(spark: SparkSession, batch: DataFrame, path: str, keys, order_cols,
                             buckets: int = 64) -> None:
    """Keyed upsert that rewrites only the key buckets a batch touches.

    The state table is partitioned by ``_bucket = pmod(xxhash64(keys),
    buckets)``; the number of buckets is written next to it once and another
    one is refused later.  Each upsert reads just the touched buckets (their
    ids, at most ``buckets`` integers, are a static partition filter),
    merges the batch in (last write wins), checkpoints the merged buckets
    and swaps them in with dynamic partition overwrite - cost follows the
    batch, not the whole state, and a repeated batch gives the same state.
    Use a bucket count large enough that one bucket fits a task comfortably.
    """
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)

    def merge(stored: DataFrame | None, new: DataFrame, keys: list[str]) -> DataFrame:
        if stored is None:
            return S.latest_per_key(new, keys, order_cols)
        return S.upsert(stored, new, keys, order_cols, origin_col=None)

    _merge_buckets(spark, batch, path, keys, buckets, merge)


def _merge_buckets(spark: SparkSession, batch: DataFrame, path: str, keys, buckets: int, merge) -> None:
    """Rewrite the buckets that ``batch`` touches with ``merge(stored rows
    without further columns, batch, keys with the bucket)``."""
    checkpoint_dir(spark)
    keys = [keys] if isinstance(keys, str) else list(keys)
    meta = f"{path.rstrip('/')}/_buckets"
    said = _read_if_there(lambda: spark.read.text(meta))
    if said is None:
        spark.createDataFrame([(str(buckets),)], "value string").coalesce(1).write.mode("overwrite").text(meta)
    elif int(said.first()[0]) != buckets:
        raise ValueError(f"the state at {path} has {said.first()[0]} buckets, not {buckets}")
    b = batch.withColumn("_bucket", F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int"))
    cur = _read_if_there(lambda: spark.read.parquet(path))
    if cur is None:
        merged = merge(None, b, [*keys, "_bucket"])
    else:
        # the batch is computed once; its bucket ids become a static filter
        b = b.checkpoint()
        touched = [r[0] for r in b.select("_bucket").distinct().collect()]
        merged = merge(cur.where(F.col("_bucket").isin(touched)).select(*b.columns), b, [*keys, "_bucket"]).checkpoint()
    (merged.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("_bucket").parquet(path))


def drop_old_versions(spark: SparkSession, base: str, keep: int = 2) -> list[int]:
    """Remove all but the newest ``keep`` committed versions; returns the
    removed ones.  Call it when no reader holds an older version."""
    now = current_version(spark, base)
    return [v for v in range(0 if now is None else max(0, now - keep + 1)) if remove(spark, version_path(base, v))]


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder of ours; False where there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def keep_cell_versions(spark: SparkSession, batch: DataFrame, path: str, key_cols, version_col: str,
                       n: int = fixed.KV_MAX_VERSIONS, tie_col: str | None = None, buckets: int = 64) -> None:
    """Versioned-cell store: add the batch, keep the newest ``n`` versions
    per cell.  Only the key buckets that the batch touches are read and
    rewritten, as for :func:`upsert_partitioned_state`.  A version that is
    written again replaces itself, so a repeated batch changes nothing."""
    from tidemark.operators.kv import keep_versions
    key_cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    more = [version_col] + ([tie_col] if tie_col else [])

    def merge(stored: DataFrame | None, new: DataFrame, keys: list[str]) -> DataFrame:
        every = S.upsert(new.limit(0) if stored is None else stored, new, keys + more, [version_col], origin_col=None)
        return keep_versions(every, keys, version_col, n, tie_col)

    _merge_buckets(spark, batch, path, key_cols, buckets, merge)


# --- key-ordered KV files ---------------------------------------------------------------

def write_kv_partitioned(spark: SparkSession, df: DataFrame, path: str, key: str = "rowkey",
                         partition_col: str = "partition_date", files_per_day: int = 1,
                         order_cols=None, bloom_keys: int | None = None) -> None:
    """Partition-prefixed key-value upsert: one directory per day, rows
    range-partitioned and sorted by row key so each file holds one
    contiguous key range (Parquet min/max statistics then skip row groups
    on key-prefix scans).

    A row replaces the stored row of the same key; the other rows of its
    day stay.  Of rows of one key in a batch the one with the greatest
    ``order_cols`` counts (the last put), ties and a batch without order by
    the greatest values of its other columns.  Days that the batch does not
    touch are neither read nor written, and a repeated batch gives the same
    files' contents.  With ``bloom_keys`` (distinct keys of a file, about)
    the files get a Bloom filter on the key, for :func:`kv.multi_get`.
    """
    checkpoint_dir(spark)
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols or [])
    rest = [c for c, t in df.dtypes if c not in (partition_col, key, *order_cols) and "map<" not in t and "variant" not in t]
    new = df
    if order_cols + rest:
        new = S.latest_per_key(df, [partition_col, key], order_cols + rest).select(*df.columns)
    new = (new if order_cols + rest else df.dropDuplicates([partition_col, key])).checkpoint()
    days = [r[0] for r in new.select(partition_col).distinct().collect()]  # names only
    cur = _read_if_there(lambda: spark.read.parquet(path))
    merged = new
    if cur is not None:
        old = cur.withColumn(partition_col, F.col(partition_col).cast(new.schema[partition_col].dataType))
        old = old.where(F.col(partition_col).isin(days)).join(new.select(partition_col, key), [partition_col, key],
                                                              "left_anti")
        merged = old.select(*new.columns).unionByName(new).checkpoint()
    ordered = (merged.repartitionByRange(max(1, len(days) * files_per_day), partition_col, key)
                     .sortWithinPartitions(partition_col, key))
    out = ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if bloom_keys:
        out = (out.option(f"parquet.bloom.filter.enabled#{key}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{key}", str(bloom_keys)))
    out.partitionBy(partition_col).parquet(path)


def read_kv_prefix(spark: SparkSession, path: str, prefix: str, key: str = "rowkey",
                   partition_col: str = "partition_date") -> DataFrame:
    """Rows whose row key starts with a yyyyMMdd[...] prefix: the day part
    prunes partitions, the key range reaches the Parquet scan."""
    df = spark.read.parquet(path)
    day = prefix[:8]
    cond = F.col(key).startswith(prefix)
    if len(day) == 8:
        cond = (F.col(partition_col).cast("string") == day) & cond
    return df.where(cond)


# --- day-partitioned bucketed table --------------------------------------------------

def write_day_bucketed(df: DataFrame, table: str, day_col: str = "ds", bucket_col: str = "id",
                       sort_cols=("id", "cdc_time"), n_buckets: int = fixed.TABLE_BUCKETS,
                       mode: str = "append", fmt: str = "parquet") -> None:
    """Append into a table partitioned by day, hash-bucketed and sorted on
    its key prefix.  Later joins / aggregations on the bucket column read
    it without a shuffle.  Duplicate keys are allowed (append-only).  Rows
    are dealt out by day and bucket first, so there is one file of each."""
    check_key_prefix([c for c in df.columns if c != day_col], list(sort_cols))
    (df.repartition(day_col, F.pmod(F.hash(bucket_col), F.lit(n_buckets)))
       .write.format(fmt).mode(mode).partitionBy(day_col)
       .bucketBy(n_buckets, bucket_col).sortBy(*sort_cols).saveAsTable(table))


def write_bucketed(df: DataFrame, table: str, path: str, bucket_col: str, n_buckets: int = fixed.TABLE_BUCKETS,
                   fmt: str = "parquet") -> None:
    """A table of files in ``path``, hash-bucketed and sorted by
    ``bucket_col``, one file a bucket.  Tables of the same buckets are joined
    and grouped on that column without a shuffle."""
    (df.repartition(n_buckets, bucket_col).write.format(fmt).mode("overwrite").bucketBy(n_buckets, bucket_col)
       .sortBy(bucket_col).option("path", path).saveAsTable(table))


def replace_batch(spark: SparkSession, df: DataFrame, table: str, batch_id: int, day_col: str = "ds",
                  bucket_col: str = "id", sort_cols=("id", "cdc_time"),
                  n_buckets: int = fixed.TABLE_BUCKETS, fmt: str = "parquet", path: str | None = None) -> None:
    """Write one batch (column ``batch_id``) into a table partitioned by
    batch and day; what an earlier attempt of the batch wrote is replaced,
    other batches stay.  ``path`` puts the files of a new table there instead
    of in the warehouse."""
    if not spark.catalog.tableExists(table):
        check_key_prefix([c for c in df.columns if c not in (day_col, "batch_id")], list(sort_cols))
        new = (spark.createDataFrame([], df.schema).write.format(fmt).partitionBy("batch_id", day_col)
                    .bucketBy(n_buckets, bucket_col).sortBy(*sort_cols))
        (new.option("path", path) if path else new).saveAsTable(table)
    # the batch's earlier rows go first; if this attempt fails the next one
    # starts here again
    if path:  # dropping a partition leaves the files of a table with a path
        remove(spark, f"{path.rstrip('/')}/batch_id={int(batch_id)}")
    for (spec,) in spark.sql(f"SHOW PARTITIONS {table} PARTITION (batch_id={int(batch_id)})").collect():
        day = dict(p.split("=", 1) for p in spec.split("/"))[day_col]  # names of days only
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (batch_id={int(batch_id)}, {day_col}='{day}')")
    columns = [c for c in spark.table(table).columns]
    (df.select(*columns).repartition(day_col, F.pmod(F.hash(bucket_col), F.lit(n_buckets)))
       .write.mode("append").insertInto(table))


def expire_day_partitions(spark: SparkSession, table: str, as_of_day: str, day_col: str = "ds",
                          days_before: int = fixed.RETENTION_DAYS_BEFORE,
                          days_after: int = fixed.RETENTION_DAYS_AFTER) -> list:
    """Drop day partitions outside [as_of - before, as_of + after].

    Only partition names (one per day) are listed on the driver, never rows.
    """
    import datetime as dt
    day0 = dt.date.fromisoformat(as_of_day)
    lo, hi = day0 - dt.timedelta(days=days_before), day0 + dt.timedelta(days=days_after)
    dropped = []
    for (spec,) in spark.sql(f"SHOW PARTITIONS {table}").collect():
        value = dict(p.split("=", 1) for p in spec.split("/"))[day_col]
        d = dt.date.fromisoformat(value)
        if d < lo or d > hi:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({day_col}='{value}')")
            dropped.append(value)
    return dropped


# --- files -------------------------------------------------------------------------

def write_corpus(df: DataFrame, path: str) -> None:
    """Corpus records (instruction, input = '', output, original_address) as
    UTF-8 JSON lines; written by the executors, nothing goes to the driver."""
    (df.select("instruction", F.lit("").alias("input"), "output", "original_address")
       .write.mode("overwrite").json(path))


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` rows for display (``show``); the limit is the feature."""
    return df.limit(n)
