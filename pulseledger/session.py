"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

# What to do with a relation that several others read.
Share = Callable[[DataFrame, str], DataFrame]

# Runtime SQL settings the relations rely on. Time zone: days and months are
# UTC days and months. Skew join: a hot anonymous id or account is split at
# run time. Session-window merge: partial merge before the streaming shuffle.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a session; leaves cluster sizing alone."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and bench.py."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pulseledger")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # A run of all relations compiles more than the default 100 stages.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SQL_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    Only a local-mode session may fall back to a temporary folder, because
    there driver and executors are one process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="pulseledger-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote under the shared folder; relations
    that read it, such as staged events of a build, stop working."""
    root = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For relations with several readers: a written table survives the loss of
    executors and is read with column pruning and filter push-down.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` has written and nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def side_by_side(*steps: Callable[[], object]) -> list:
    """Run steps that do not need each other at the same time, so that the jobs
    of one fill the gaps of another; their results in order."""
    with ThreadPoolExecutor(max_workers=max(1, len(steps))) as pool:
        return [pending.result() for pending in [pool.submit(step) for step in steps]]


def keep_lazy(df: DataFrame, name: str) -> DataFrame:
    """Share nothing: every reader computes the relation for itself."""
    return df
