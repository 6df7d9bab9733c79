"""Session helpers: building a session for tests/bench and reliable checkpoints.

Library code never invents storage on a cluster.  Lineage is cut with
``DataFrame.checkpoint()`` into the shared folder named by
``spark.checkpoint.dir``; only a local-mode session (tests, bench) may get a
fresh scratch folder when that setting is absent.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_SCRATCH: list[tuple[SparkSession, str]] = []


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tablekit") -> SparkSession:
    """Session used by tests and the bench (local mode, UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # small local inputs: split files finer so every core gets a task
        # (a cluster keeps its own, larger setting)
        .config("spark.sql.files.maxPartitionBytes", str(4 << 20))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # remove reliable checkpoint files once their frames are garbage
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    Uses ``spark.checkpoint.dir`` when the cluster names one.  When it is
    unset, a local-mode session (tests) gets a fresh folder; any other
    master must name a shared folder, so we refuse rather than write to a
    machine-local path that other executors cannot see.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="tablekit-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir()
    raise RuntimeError(
        f"{CHECKPOINT_CONF} is not set; point it at a shared folder (HDFS/S3/...) "
        "so checkpoints survive executor loss")


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Eager, reliable checkpoint (never ``localCheckpoint``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint folder, deleted when the
    application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{label}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(_delete_scratch)
    _SCRATCH.append((spark, path))
    return path


def _delete_scratch() -> None:
    for spark, path in _SCRATCH:
        try:
            jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
        except Exception:  # the session may be gone already; its folder then goes with it
            return


def materialize(df: DataFrame, label: str = "frame") -> DataFrame:
    """Write once as parquet into the shared folder and read back.  Unlike a
    checkpoint, the planner knows the size of what it reads: a small frame is
    then broadcast instead of shuffling the large side of a join."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
