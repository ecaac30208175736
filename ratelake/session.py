"""Session-level helpers: shared scratch locations and test sessions.

The library never owns the session. Jobs receive a ``SparkSession`` and read
where they may write intermediate data from it: ``spark.checkpoint.dir`` names
a folder on shared storage (HDFS / object store) on a cluster. Only when that
setting is missing (unit tests, a laptop) do we create a local folder and set
it, so the same code path works in both places; anywhere else it is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SCRATCH_SUBDIR = "ratelake-scratch"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Unset on a cluster it is an error, as no local folder would do. A session
    with a local master (tests, a laptop) gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    # (The core setting cannot change at run time; the context's folder can.)
    local = tempfile.mkdtemp(prefix="ratelake-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return (spark.sparkContext.getCheckpointDir() or local).rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint()`` has a directory to write to."""
    root = checkpoint_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared scratch root (never reused)."""
    return f"{checkpoint_root(spark)}/{_SCRATCH_SUBDIR}/{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`scratch_path`, once nothing reads it any more."""
    if f"/{_SCRATCH_SUBDIR}/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def cut_lineage(df: DataFrame, enabled: bool) -> DataFrame:
    """Eager, reliable checkpoint (never ``localCheckpoint``) when asked for.

    Checkpoint files live on the shared checkpoint dir, so a lost executor does
    not force recomputation of the stages before the cut.
    """
    if not enabled:
        return df
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def local_session(app: str = "ratelake", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """Session used by tests and ``bench.py``: UI off, AQE on, UTC clock."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Wide projections: the JVM does not compile methods beyond this size.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark
