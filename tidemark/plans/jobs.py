"""End-to-end batch jobs: read -> transform -> write, each one lazy plan
finished by its writes (no driver collect).  The streaming counterparts
live in ``tidemark.streaming``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.operators import corpus, encode, refresh
from tidemark.sinks import writers
from tidemark.sources import files


def address_corpus(df: DataFrame, generator: str = "rule") -> DataFrame:
    """Question/answer corpus from an address frame.

    ``rule``: needs address + province/city/district/street columns and
    produces up to four pairs per address; ``regex``: needs only the
    address and finds the components by pattern."""
    cleaned = corpus.clean_addresses(df)
    if generator == "rule":
        return corpus.training_records(corpus.qa_pairs_rule(cleaned))
    if generator == "regex":
        return corpus.qa_pairs_regex(cleaned)
    raise ValueError(f"unknown generator {generator!r}")


def address_corpus_job(spark: SparkSession, input_path: str, output_path: str,
                       generator: str = "regex") -> None:
    """Load addresses (.json array or .csv), build the corpus, write it as
    JSON records (instruction, input, output, original_address)."""
    schema = None if generator == "rule" else "address string"
    src = files.load_records(spark, input_path, schema)
    writers.write_corpus(address_corpus(src, generator), output_path)


def encode_corpus_job(spark: SparkSession, corpus_path: str, output_path: str,
                      key: str = "instruction", max_length: int = fixed.MAX_LENGTH,
                      duplicate_all: bool = False) -> None:
    """Corpus JSON -> train/eval split -> fixed-length ids, labels and mask,
    written as Parquet partitioned by split."""
    pairs = spark.read.schema("instruction string, input string, output string, original_address string").json(corpus_path)
    split = encode.train_eval_split(pairs, key, duplicate_all=duplicate_all)
    enc = encode.encode_pairs(split, max_length, keep=("split", "instruction", "output"))
    enc.write.mode("overwrite").partitionBy("split").parquet(output_path)


def rate_refresh_job(spark: SparkSession, state_base: str, snapshot_path: str, changes_path: str,
                     interval_seconds: float, as_of=None, incremental: bool = True) -> int:
    """One refresh cycle in batch: committed rate state + landed fetch
    results -> new committed state version, appended change records.
    Returns the new state version."""
    # one "now" for both writes (current_timestamp() would be evaluated
    # separately by the state write and the change-log write)
    if as_of is None:
        import datetime as dt
        as_of = F.lit(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)).cast("timestamp_ntz")
    now = as_of
    state = writers.read_state(spark, state_base, refresh.RATE_STATE_SCHEMA)
    snap = spark.read.schema(refresh.RATE_SNAPSHOT_SCHEMA).json(snapshot_path)
    out = refresh.refresh_rates(spark, state, snap, now, interval_seconds, incremental)
    return writers.commit_with(spark, out["new_state"], state_base, {changes_path: out["changes"]})


def poll_changes_job(spark: SparkSession, url: str, table: str, out_path: str, cursor_path: str,
                     options: dict | None = None, id_col: str = "change_id",
                     num_partitions: int = 8, source_db: str = fixed.SOURCE_DB) -> tuple[int, int]:
    """One poll of a change-log table: rows after the committed cursor up to
    the largest id there is now, read in ``num_partitions`` id ranges,
    flattened and written; the cursor is committed last.

    Returns (cursor before, cursor now).  The rows lie in a folder named by
    the cursor they start from, which a repeated poll overwrites, so a
    failure between the two writes neither loses nor doubles a change.
    """
    from tidemark.operators import changelog
    from tidemark.sources import jdbc

    done = writers.read_state(spark, cursor_path, "cursor bigint")
    row = done.first()
    cursor = 0 if row is None else row[0]
    upper = jdbc.max_id(spark, url, table, id_col, options)
    if upper is None or upper <= cursor:
        return cursor, cursor
    changes = jdbc.changes_between(spark, url, table, cursor, upper, id_col, options, num_partitions)
    flat = changelog.flatten(changes, source_db=source_db).select(id_col, F.col("doc").alias("value"))
    flat.write.mode("overwrite").json(f"{out_path.rstrip('/')}/after={cursor}")
    writers.commit_state(spark, spark.createDataFrame([(upper,)], "cursor bigint"), cursor_path)
    return cursor, upper


def sync_tables(spark: SparkSession, url: str, tables: dict, target_dir: str,
                options: dict | None = None, mode: str = "overwrite") -> DataFrame:
    """Copy database tables to Parquet and reconcile them.

    ``tables`` maps table name -> {"key": column, and optionally
    "partition_column", "lower_bound", "upper_bound", "num_partitions"}
    for a parallel read.  Each table is copied by its own distributed job
    (only the table list is iterated on the driver); the returned frame
    holds, per table, row counts and key checksums of source and copy and
    whether they and the contents agree.
    """
    from tidemark.operators import analytics
    from tidemark.sources import jdbc

    sources, copies = {}, {}
    for name, spec in tables.items():
        src = jdbc.read_table(spark, url, name, options, spec.get("partition_column"),
                              spec.get("lower_bound"), spec.get("upper_bound"), spec.get("num_partitions"))
        path = f"{target_dir.rstrip('/')}/{name.lower()}"
        src.write.mode(mode).parquet(path)
        sources[name] = (src, spec["key"])
        copies[name] = (spark.read.parquet(path), spec["key"])
    return analytics.compare_copies(sources, copies)
