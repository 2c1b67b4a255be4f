"""Session settings the package relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

REQUIRED = {
    # Last of a repeated JSON key wins, also inside nested objects.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Packed bytes per batch sent to the inflate function; they grow several times in it.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 * 1024 * 1024),
    # Keyed state of streams: on local disk with changelogs in the checkpoint, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Sessions of a hot key are merged before the shuffle.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, memory: str = "8g", partitions: int = 8) -> SparkSession:
    """Small session for tests and the bench."""
    return configure(
        SparkSession.builder.master(f"local[{cores}]")
        .appName("eventloom")
        .config("spark.ui.enabled", "false")
        # Call sites of Column operations are not recorded: large plans build faster.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .getOrCreate()
    )


#: Rows that one task takes of an input that is spread.
ROWS_PER_TASK = 50_000


def spread(df: DataFrame) -> DataFrame:
    """Input over all cores, in tasks of ``ROWS_PER_TASK`` rows at most, when it arrives in fewer partitions.

    Partitions of files are cut by compressed bytes: a few megabytes may hold millions of rows, and those of
    one row group come in one task. So the rows are counted (of Parquet files, from their footers).
    """
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_PER_TASK))
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor sees, named by ``spark.checkpoint.dir``.

    A machine-local folder is used only in local mode, where nothing else is set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return os.path.join(tempfile.gettempdir(), "eventloom-shared")
