"""Structured Streaming jobs for the change stream.

* read change rows landed as files (or from a topic) with checkpointed
  offsets - a restarted query resumes after the last committed batch;
* flatten them with the same column expression the batch path uses;
* publish flattened documents to a topic/file sink, or load them per
  micro-batch into a day-partitioned bucketed table with per-batch
  counters;
* keep a keyed "latest value" state up to date per micro-batch;
* run the repeated rate-refresh cycle against the committed state.

A replayed micro-batch replaces what its first attempt wrote: loaded rows,
quarantined rows and counters lie in folders of their batch id, which are
overwritten; change records and counters of a refresh lie in folders of the
state version they lead to, and are written before that version is
committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.operators import changelog
from tidemark.operators.state import latest_per_key
from tidemark.sinks import writers
from tidemark.sources.catalog import check_key_prefix


def changelog_stream(spark: SparkSession, path: str, fmt: str = "json",
                     schema: str = changelog.CHANGELOG_SCHEMA,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Change rows from files landing in ``path`` (explicit schema, no
    inference)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def topic_stream(spark: SparkSession, servers: str, topic: str, schema: str,
                 max_offsets: int | None = None, options: dict | None = None) -> DataFrame:
    """JSON messages from a topic, matched to ``schema`` columns by name;
    bad fields become NULL (lenient).  Without ``max_offsets`` a batch takes
    all that has arrived.  Needs the Kafka connector jar."""
    r = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if max_offsets:
        r = r.option("maxOffsetsPerTrigger", max_offsets)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    raw = r.load()
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*")


def flatten_stream(changes: DataFrame, source_db: str = fixed.SOURCE_DB) -> DataFrame:
    """Stateless: adds the flattened document ``doc`` (cdc_time = processing
    time of the micro-batch)."""
    return changelog.flatten(changes, cdc_time=None, source_db=source_db)


def publish(flat: DataFrame, fmt: str, checkpoint: str, path: str | None = None,
            options: dict | None = None, trigger: str | None = fixed.POLL_INTERVAL,
            available_now: bool = False, query_name: str | None = None):
    """Start the query writing one JSON document per change (``value``).
    Per-batch row count and last change id are observed in the same pass
    and reported in ``query.lastProgress['observedMetrics']['changes']``."""
    out = (flat.observe("changes", F.count(F.lit(1)).alias("rows"), F.max("change_id").alias("last_change_id"))
               .select(F.col("doc").alias("value")))
    w = writers.topic_writer(out, fmt, options, checkpoint, None if available_now else trigger)
    if available_now:
        w = w.trigger(availableNow=True)
    if query_name:
        w = w.queryName(query_name)
    return w.start(path) if path else w.start()


def _typed_from_docs(batch: DataFrame, target_schema: str) -> DataFrame:
    """Flattened documents matched to the target columns by name; fields
    that do not fit their type become NULL, rows are kept."""
    return batch.select(F.from_json("doc", target_schema).alias("r"), "change_id").select("r.*", "change_id")


def load_batches(flat: DataFrame, table: str, metrics_path: str, checkpoint: str,
                 target_schema: str, key_col: str = "id", time_col: str = "cdc_time",
                 day_col: str = "ds", n_buckets: int = fixed.TABLE_BUCKETS,
                 trigger: str | None = fixed.LOAD_TRIGGER, available_now: bool = False,
                 quarantine_path: str | None = None, defaults: dict | None = None, path: str | None = None):
    """Micro-batch load of flattened changes into a table partitioned by
    batch and day and bucketed, plus one counter row per batch
    (batch_id, rows, last change id) under ``metrics_path``.

    ``target_schema`` lists the table columns (key column first, then the
    time column: the key prefix the table is sorted on); ``defaults`` fills
    columns that are NULL or missing.  A repeated batch replaces its rows.  With
    ``quarantine_path``, change rows whose non-blank row image is not valid
    JSON are appended there instead of being loaded.  ``path`` puts the files
    of a new table there instead of in the warehouse.
    """
    cols = [c.strip().split(" ")[0] for c in target_schema.split(",")]
    check_key_prefix(cols, [key_col, time_col])

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if quarantine_path:
            # unparsable row images are kept aside; the rest is loaded
            (changelog.malformed_changes(batch).drop("doc").write.mode("overwrite")
                .json(f"{quarantine_path.rstrip('/')}/batch_id={batch_id}"))
            batch = changelog.well_formed_changes(batch)
        typed = changelog.with_defaults(_typed_from_docs(batch, target_schema), defaults or {})
        typed = typed.withColumn(time_col, F.coalesce(F.col(time_col).cast("timestamp"), F.current_timestamp()))
        # counters are observed while the rows are written: one pass
        obs = Observation(f"load_batch_{batch_id}")
        observed = typed.observe(obs, F.count(F.lit(1)).alias("rows"),
                                 F.max("change_id").alias("last_change_id"))
        rows = observed.select(*cols, F.date_format(time_col, fixed.DATE_TEXT_FORMAT).alias(day_col),
                               F.lit(batch_id).cast("bigint").alias("batch_id"))
        writers.replace_batch(spark, rows, table, batch_id, day_col, key_col, (key_col, time_col), n_buckets,
                              path=path)
        got = obs.get
        (spark.createDataFrame([(got["rows"], got["last_change_id"])], "rows bigint, last_change_id bigint")
              .coalesce(1).write.mode("overwrite").json(f"{metrics_path.rstrip('/')}/batch_id={batch_id}"))

    w = flat.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def unique_changes(changes: DataFrame, delay: str = "2 days", id_col: str = "change_id",
                   time_col: str = "change_time") -> DataFrame:
    """Each change once, however often it is delivered: its id is kept in the
    state store until ``delay`` has passed in event time, and what arrives
    later than that is behind the watermark and left out.  ``delay`` must
    cover how far out of order changes arrive for the first time."""
    return changes.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([id_col])


def change_counters(unique: DataFrame, every: str = "1 day", group_cols=("table_name", "operation"),
                    id_col: str = "change_id", time_col: str = "change_time") -> DataFrame:
    """Streaming counters of the change time's windows: changes and last id.
    A window leaves the state store when the watermark has passed it."""
    w = F.window(time_col, every)
    return (unique.groupBy(w.alias("w"), *group_cols)
                  .agg(F.count(F.lit(1)).alias("changes"), F.max(id_col).alias("last_id"))
                  .select(F.col("w.start").alias("window_start"), *group_cols, "changes", "last_id"))


def keep_counters(counters: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                  available_now: bool = False):
    """Write the counters that each micro-batch has changed in a folder of its
    number; a batch that is repeated replaces its own."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    w = counters.writeStream.outputMode("update").foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def read_counters(spark: SparkSession, path: str, group_cols=("table_name", "operation")) -> DataFrame:
    """The last state of every window's counters."""
    return latest_per_key(spark.read.parquet(path), ["window_start", *group_cols], "batch").drop("batch")


def land_batches(changes: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                 trigger: str | None = None):
    """Write the changes of each micro-batch in a folder of its number."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    w = changes.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def batch_counters(spark: SparkSession, metrics_path: str) -> DataFrame:
    """Per-batch counters with the running total (a replayed batch has one row)."""
    m = spark.read.json(metrics_path)
    return changelog.running_total(m, "batch_id", "rows", out="cumulative_rows")


def maintain_latest(updates: DataFrame, state_base: str, keys, order_cols, checkpoint: str,
                    trigger: str | None = None, available_now: bool = False,
                    buckets: int | None = None):
    """Keep the keyed latest-value state current: each micro-batch is
    upserted into the committed state versions, or - with ``buckets`` -
    into a bucket-partitioned state where only touched buckets are
    rewritten (replaying a batch gives the same state either way)."""
    keys = list(keys)
    order_cols = list(order_cols)

    def handle(batch: DataFrame, batch_id: int) -> None:
        if buckets:
            writers.upsert_partitioned_state(batch.sparkSession, batch, state_base, keys, order_cols, buckets)
        else:
            writers.upsert_state(batch.sparkSession, batch, state_base, keys, order_cols)

    w = updates.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def refresh_stream(snapshots: DataFrame, state_base: str, changes_path: str, counts_path: str,
                   checkpoint: str, interval_seconds: float, as_of=None,
                   trigger: str | None = None, available_now: bool = False):
    """Repeated refresh cycle: every micro-batch of landed fetch results
    (base_currency, target_currency, rate) runs one refresh against the
    committed rate state - due filter, fallback imputation, keyed upsert -
    writes the change records and the cycle counters under the number of the
    next state version and commits that version last.

    ``as_of`` fixes "now" (tests); by default each batch uses its start time.
    """
    import datetime as dt

    from tidemark.operators import refresh

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now = as_of if as_of is not None else F.lit(
            dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)).cast("timestamp_ntz")
        state = writers.read_state(spark, state_base, refresh.RATE_STATE_SCHEMA)
        out = refresh.refresh_rates(spark, state, batch, now, interval_seconds)
        counts = out["counts"].withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        writers.commit_with(spark, out["new_state"], state_base,
                            {changes_path: out["changes"], counts_path: counts})

    w = snapshots.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()
