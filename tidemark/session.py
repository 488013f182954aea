"""Session construction and cluster-shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package assumes.  The time zone is pinned so
# that timestamp text and day boundaries do not depend on the host.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Post-shuffle partitions are merged up to the advisory size (64 MB) at
    # scale; on small inputs keep enough partitions for CPU-heavy row work.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256KB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "tidemark", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` and ``shuffle_partitions`` are only set when given, so a
    cluster submission keeps whatever the launcher configured.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is;
    without it this fails, as a folder of one machine would lose offsets and
    intermediate tables.  Only in local mode (tests) an unset one becomes a
    private folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back:
    what follows reads the files and does not compute ``df`` again, also
    when an executor is lost."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """Checkpoint location for a named streaming query under the shared
    ``spark.checkpoint.dir`` (offsets and commits survive driver restarts
    as long as that folder is on shared storage)."""
    return os.path.join(checkpoint_dir(spark), "streams", name)


def scaled_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a cluster run sized from the input volume.

    * initial shuffle partitions: enough for ``target_partition_bytes`` of
      shuffled input per partition (at least 3 per core); AQE then merges
      small ones back to the advisory size, so over-provisioning is cheap;
    * scan splits and the advisory post-shuffle size match that target, so
      a task's working set stays well inside executor memory and spills
      rather than fails;
    * a partition is treated as skewed above 5x the median and 1 GB, and
      split by AQE's skew-join handling.
    E.g. 100 TB on 8 000 cores -> 409 600 initial shuffle partitions.
    """
    partitions = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
