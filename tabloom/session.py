"""Session and shared-storage helpers.

Everything in the library runs on whatever ``SparkSession`` the caller
passes.  ``local_session`` only exists for tests, the bench and the
examples; on a cluster the session comes from ``spark-submit``.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tabloom") -> SparkSession:
    """A local session with the settings the library assumes.

    AQE on (runtime coalescing and skew-join splitting), UTC session time,
    ANSI mode left at the Spark 4 default, UI off (no port is opened).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TABLOOM_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    The folder named by ``spark.checkpoint.dir`` (or one already set on the
    context) is used as is.  When nothing is configured, a local session (tests)
    gets a fresh folder; on a cluster, whose machines share no folder of their own,
    it raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tabloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_STAGE_PATHS: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (never machine-local
    on a cluster, because the checkpoint folder is the cluster's)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _STAGE_PATHS.append(path)
    return path


def stage_paths() -> list[str]:
    """Paths handed out by ``scratch_path`` in this process (stage tables,
    written CSVs, run logs and models of the registered queries).  Lazy
    frames may still read them, so remove them only after results are
    saved."""
    return list(_STAGE_PATHS)


def cut_lineage(df, name: str = "stage", **options):
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    return a frame reading it back.

    Used for fitted tables (category maps, value counts) and for inputs that
    several jobs re-read: the lineage is cut, the data is computed once (a
    plain ``checkpoint(eager=True)`` computes it twice), a lost executor
    only re-reads files, and later reads get column pruning and filter
    pushdown, which a checkpointed RDD does not offer.  ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    return spark.read.parquet(path)


_SPLITS = threading.Lock()
_SPLITS_BEFORE: list[str] = []      # the setting outside, once per user inside


@contextlib.contextmanager
def small_splits(spark: SparkSession, most: int) -> Iterator[None]:
    """Files are read in splits of up to ``most`` bytes inside: for jobs whose rows cost
    far more than their bytes, so that all cores have a share of them.  The setting is the
    session's; the last of several threads inside restores it."""
    key = "spark.sql.files.maxPartitionBytes"
    with _SPLITS:
        _SPLITS_BEFORE.append(_SPLITS_BEFORE[0] if _SPLITS_BEFORE else spark.conf.get(key))
        spark.conf.set(key, str(most))
    try:
        yield
    finally:
        with _SPLITS:
            old = _SPLITS_BEFORE.pop()
            if not _SPLITS_BEFORE:
                spark.conf.set(key, old)


class Stages:
    """Stage tables of one operator run, and their removal.

    ``write`` puts a frame into the shared checkpoint folder and reads it
    back (see ``cut_lineage``); ``drop`` deletes the table behind a frame as
    soon as no later job reads it, so that the shared folder holds only what
    is still needed.  Tables that a returned lazy frame reads are simply not
    dropped.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._held: dict[int, tuple[DataFrame, str]] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._held[id(out)] = (out, path)
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            _, path = self._held.pop(id(df), (None, None))
            if path:
                drop_path(self.spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's file system layer."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).delete(target, True)
    if path in _STAGE_PATHS:
        _STAGE_PATHS.remove(path)
