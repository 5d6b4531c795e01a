"""Session helpers: a tuned local session for tests/bench and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "wordmill") -> SparkSession:
    """A local session with the settings this library is tuned for.

    On a cluster use the cluster's session; the settings that matter there are
    AQE (coalescing, skew joins, runtime broadcast) and a shared
    ``spark.checkpoint.dir``.
    """
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, setting a scratch one only in local mode.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    scratch = tempfile.mkdtemp(prefix="wordmill-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


#: Rows of a table of words, and bytes of its strings, that may be broadcast once they are counted.
BROADCAST_ROWS, BROADCAST_BYTES = 1 << 19, 1 << 24

#: Lets the shuffle files of a query go when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def may_broadcast(spark: SparkSession, rows: int, chars: int = 0) -> bool:
    """Whether a counted table is small enough to broadcast, and the session has not turned broadcasts off."""
    off = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")
    return not off and rows <= BROADCAST_ROWS and chars <= BROADCAST_BYTES


def cut_lineage(df: DataFrame, name: str = "stage", **options: str) -> DataFrame:
    """Write ``df`` as parquet under the session's checkpoint directory and read it back.

    A stage boundary like the files between the original's steps: later
    consumers read columnar files (pruning, pushdown, exact sizes for AQE)
    instead of recomputing the lineage, and a lost executor costs a re-read,
    not a recompute.  The folder is the shared ``spark.checkpoint.dir`` on a
    cluster.  What was shuffled for the table is of no use once it is written, so its
    shuffle files go then, not when the driver happens to collect its garbage.  ``options``
    are the writer's.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.mode("overwrite").options(**options).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = df.sparkSession.read.parquet(path)
    out._cut = path  # noqa: SLF001  (for drop_cut)
    return out


def drop_cut(*tables: DataFrame) -> None:
    """Remove tables of :func:`cut_lineage` that no later result reads."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._cut)  # noqa: SLF001
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)  # noqa: SLF001
