"""Session helpers.

The library never builds its own cluster configuration: callers pass a
``SparkSession``.  ``local_session`` exists for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "clipmart") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is.
    Only when it is unset and the master is local (tests) a private folder is
    created and registered, so lineage cuts and streaming checkpoints still
    have a home; a cluster without the setting is an error, as its executors
    would each write to a disk of their own.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="clipmart-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the context
        return root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (never a machine-local tmp)."""
    return os.path.join(ensure_checkpoint_dir(spark).rstrip("/"), *parts)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there; a storage error is raised, not taken for no."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def spread(df, min_partitions: int | None = None):
    """Round-robin an input that arrives in fewer scan splits than the
    cluster has cores (e.g. one large row group), so per-row work (JSON,
    regex, hashing) runs in parallel.  Inputs that already have enough
    splits (the normal case at scale) are returned untouched, without a
    shuffle.  Only the partition count of the physical plan is read; no
    job runs."""
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - Spark Connect has no RDD view: leave as is
        return df
    return df.repartition(target) if parts < target else df


MAX_BROADCAST_ROWS = 2_000_000


def bounded_broadcast(df, max_rows: int = MAX_BROADCAST_ROWS):
    """Broadcast ``df`` only after counting it; past the bound it stays a
    normal (AQE skew-aware) shuffle side."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.count() <= max_rows else df


def materialize(df):
    """Materialise a table that several later steps read (a layer boundary:
    Silver, a Gold fact).  Written as Parquet under the shared
    ``spark.checkpoint.dir`` and read back: it survives executor loss and cuts
    the lineage as a checkpoint does, and readers take only the columns and
    row groups they need and know its size, which a checkpoint's rows can't
    tell them."""
    import uuid

    path = scratch_path(df.sparkSession, "materialized", uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
