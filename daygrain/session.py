"""Session construction and the shared folder used to cut lineage.

Library code never invents a storage location: anything that must be
written (materialised layers, CSV round trips, checkpoints) goes below the
folder the cluster names in ``spark.checkpoint.dir``.  Tests and the local
bench set that value themselves when it is unset.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings every job of this library relies on: adaptive execution for
# runtime re-planning (partition coalescing, skew-join splitting, join
# strategy switch), ANSI semantics like the reference engine, and UTC so
# that date parts never depend on the JVM zone.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "daygrain",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's base settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # getOrCreate() returns an existing session untouched; apply the
    # runtime-settable SQL options again so the behaviour is the same.
    for key, value in settings.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    return spark


MB = 1 << 20


def scale_conf(input_bytes: int, total_cores: int, split_mb: int = 512, shuffle_mb: int = 256) -> dict[str, str]:
    """Partition settings for a cluster run, sized from the scanned volume.

    * scan splits of ``split_mb`` (100 TB / 512 MB = ~200k scan tasks, ~25
      waves on 8,000 cores), so each task's partial-aggregation hash map
      stays small and a lost executor costs seconds of rework;
    * initial shuffle partitions: enough for ``shuffle_mb`` per reducer if
      a tenth of the input survived map-side aggregation (the (day, value)
      dedupes are the widest shuffles here), never fewer than 2x the cores;
      adaptive execution then coalesces small partitions and splits skewed
      ones towards ``shuffle_mb``.
    """
    shuffle_parts = max(2 * total_cores, input_bytes // 10 // (shuffle_mb * MB))
    return {
        "spark.sql.files.maxPartitionBytes": f"{split_mb}m",
        "spark.sql.shuffle.partitions": str(int(shuffle_parts)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{shuffle_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * shuffle_mb}m",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16m",
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and intermediate tables.

    On a local-mode session without the setting (tests, a laptop) a fresh
    temporary folder is configured; on a cluster the setting is required.
    """
    value = spark.conf.get(CHECKPOINT_CONF, None)
    if not value and spark.sparkContext.master.startswith("local"):
        value = ensure_shared_dir(spark, tempfile.mkdtemp(prefix="daygrain-shared-"))
    if not value:
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; point it at a folder every executor "
            "can reach (HDFS, object store) before writing intermediate tables"
        )
    return value.rstrip("/")


def ensure_shared_dir(spark: SparkSession, default: str) -> str:
    """Use the configured shared folder, or ``default`` when none is set.

    Only tests and local runs pass a default; on a cluster the setting is
    expected to be present already and is never overwritten.
    """
    value = spark.conf.get(CHECKPOINT_CONF, None)
    if not value:
        spark.conf.set(CHECKPOINT_CONF, default)
        value = default
    spark.sparkContext.setCheckpointDir(value)
    return value.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, how: str = "checkpoint") -> DataFrame:
    """Truncate the plan of ``df`` in a way that survives executor loss.

    ``checkpoint`` writes to the shared checkpoint folder (reliable, unlike
    a local checkpoint); ``table`` writes Parquet below the same folder and
    reads it back, which also gives later stages file statistics.
    """
    spark = df.sparkSession
    if how == "checkpoint":
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
        return df.checkpoint(eager=True)
    if how == "table":
        path = scratch_path(spark, "table")
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    raise ValueError(f"unknown lineage cut {how!r}")
