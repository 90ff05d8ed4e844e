"""Session construction and cluster-safe helpers (checkpointing, size-checked broadcast)."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest lexicon / lookup table that may be broadcast or inlined as a literal set.
DEFAULT_BROADCAST_ROWS = 200_000

# Shuffle files go when the query that wrote them ends, not when the driver next collects its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(master: str | None = None, app: str = "dailywire", shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    Local runs get a small shuffle width (2 x cores unless given). On a cluster the width comes
    from the cluster configuration; when it is left at Spark's default, AQE starts from a wide
    initial partition count sized from the executors' cores and coalesces to ~256 MB partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Arrow batches to Python workers: raw pages can be large, keep a batch well under memory
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("DAILYWIRE_DRIVER_MEMORY", "16g"))
        # long texts: keep input splits small so a few huge documents spread out
        .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        cpus = os.environ.get("BENCH_CPUS")
        parts = shuffle_partitions or (2 * int(cpus) if cpus else 2 * sc.defaultParallelism)
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    elif shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    elif spark.conf.get("spark.sql.shuffle.partitions") == "200":
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(2000, 4 * sc.defaultParallelism)))
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(256 * 1024 * 1024))
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for checkpoints and stage tables, setting one only for local runs.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; a machine-local temporary
    folder is used only when the master is local.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext on the client
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        conf_dir = conf_dir or sc.getConf().get("spark.checkpoint.dir", None)
        if conf_dir:
            sc.setCheckpointDir(conf_dir)
            return sc.getCheckpointDir()
        master = sc.master
    else:
        if conf_dir:
            return conf_dir
        master = spark.conf.get("spark.master", "")
    if master.startswith("local"):
        local = tempfile.mkdtemp(prefix="dailywire-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(local)
            return sc.getCheckpointDir()
        return local
    raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) before running on a cluster")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage with a Parquet stage table written under the shared checkpoint folder.

    One job writes the table (``Dataset.checkpoint`` would run the plan twice: once to count and
    once more to save the unpersisted RDD); the read-back is columnar and survives executor loss.
    Never ``localCheckpoint``.
    """
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"stage-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.parquet(path)


class StageTable:
    """A stage table of a loop: its job's shuffle files are deleted when it is written, and the table itself by ``drop``."""

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        self.path = os.path.join(ensure_checkpoint_dir(self.spark), f"stage-{uuid.uuid4().hex}")
        with shuffles_freed(self.spark):
            df.write.parquet(self.path)
        self.table = self.spark.read.parquet(self.path)

    def drop(self) -> None:
        """Delete the table; nothing may read it any more."""
        jvm = getattr(self.spark, "_jvm", None)
        if jvm is not None:  # Spark Connect: the table stays
            path = jvm.org.apache.hadoop.fs.Path(self.path)
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession):
    """Queries that end within it leave no shuffle files behind."""
    try:
        before = spark.conf.get(FREE_SHUFFLES)
    except Exception:  # noqa: BLE001 - a Spark version without it
        before = None
    if before is not None:
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is not None:
            spark.conf.set(FREE_SHUFFLES, before)


def fits(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; reads at most ``max_rows + 1`` rows."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only behind a checked row bound; otherwise leave the join to a shuffle."""
    return F.broadcast(df) if fits(df, max_rows) else df
