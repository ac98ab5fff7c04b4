"""Session defaults and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on: UTC dates, last-key-wins JSON objects,
# run-time re-planning (skewed joins are split, small partitions merged), files that long
# texts are packed well in, and few pages at a time in a Python worker, as they may be long.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "250",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def pin(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench; makes a shared folder if none is named."""
    spark = pin(
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hiregrain")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    if not _named_dir(spark):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hiregrain-"))
    return spark


def _named_dir(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it."""
    named = _named_dir(spark)
    if not named:
        raise RuntimeError("name a folder that all executors reach in spark.checkpoint.dir")
    return named


def cut(df: DataFrame) -> DataFrame:
    """Store ``df`` reliably and restart its lineage from the stored copy."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
