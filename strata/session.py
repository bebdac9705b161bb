"""Session construction and the shared checkpoint folder.

On a cluster the session is built by the platform and ``spark.checkpoint.dir``
names a shared folder; ``checkpoint_dir`` only reads it.  A local default is set
only when the setting is absent (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  Shuffle partitions stay at a cluster-sized
# default; AQE coalesces them at run time, so small inputs do not pay for it.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Parquet scan splits: 128 MB keeps each task's input well inside executor memory.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # On a shared cluster AQE merges shuffle partitions up to this size rather
    # than keeping every core busy, so a generous partition count costs little
    # (local sessions keep Spark's parallelism-first default; see build_session).
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # Checkpoint files of collected DataFrames are removed from the shared folder.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 * 1024 * 1024,
                           floor: int = 200) -> int:
    """A starting shuffle-partition count for an input size: about one partition
    per ``target_bytes`` of input, which AQE then coalesces where the shuffle is
    smaller (100 TB -> about 400k).  Set it on a cluster session as
    ``spark.sql.shuffle.partitions``."""
    return max(floor, -(-input_bytes // target_bytes))


def build_session(master: str | None = None, app: str = "strata",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # Local mode: the driver JVM is the only executor, and with small inputs
        # merging shuffles down to the advisory size would leave one task per
        # stage, so keep at least one partition per core.
        conf["spark.driver.memory"] = "12g"
        conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised tables.

    Read from ``spark.checkpoint.dir``.  Where it is unset, a local session gets a
    temporary folder of its own; on a cluster that is an error, for each executor
    would write to its own disk.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        existing = spark.sparkContext.getCheckpointDir()
        if existing:
            return existing
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="strata-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


# Folders under the checkpoint folder that hold an application's written tables.
WRITTEN = ("tables", "exports", "llm")


def application_folder(spark: SparkSession, kind: str) -> str:
    """Where this application writes its tables of a kind: a folder of its own under the shared one."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{kind}/{spark.sparkContext.applicationId}"


def clean(spark: SparkSession) -> list[str]:
    """Remove what this application has written into the shared folder without a path of
    its own, once its results are read; returns the folders that were there."""
    gone = []
    for kind in WRITTEN:
        folder = application_folder(spark, kind)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True):
            gone.append(folder)
    return gone


def stop(spark: SparkSession) -> None:
    """The end of an application: its written tables go, then the session."""
    clean(spark)
    spark.stop()


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` into the shared folder (set up on first use): cuts the
    lineage so later readers, and recomputation after a lost executor, read
    the written copy."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
