"""Session helpers: a test session, cutting lineage, and scratch folders."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shelfdiff")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def _shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: the cluster's spark.checkpoint.dir."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None)
    if configured:
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = os.environ.get("SHELFDIFF_LOCAL_ROOT")
    if not root:
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        os.environ["SHELFDIFF_LOCAL_ROOT"] = root
    return root


#: Folders of the open scopes of this driver, the innermost last.
_SCOPES: list[str] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Checkpoints and scratch tables made inside are deleted at the end, whether it went well or not.

    Put it around a step that writes its result to a table of its own: data frames from inside that are not yet
    written have nothing to read from afterwards. Scopes may be nested.
    """
    sc = spark.sparkContext
    folder = f"{_shared_root(spark).rstrip('/')}/scope-{uuid.uuid4().hex}"
    before = sc.getCheckpointDir()
    sc.setCheckpointDir(folder)
    _SCOPES.append(folder)
    try:
        yield folder
    finally:
        _SCOPES.remove(folder)
        # Spark hands back the folder it made for itself inside the one that was set
        sc.setCheckpointDir(before.rsplit("/", 1)[0] if before else _shared_root(spark))
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions inside go when each action is done, not when the driver collects its garbage.

    For frames made inside, whose result is stored: nobody reads their shuffles again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so a lost executor costs a re-read and not a re-run."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(_shared_root(df.sparkSession))
    with _shuffles_freed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def by_shuffle(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the data: both sides are sorted and merged, nothing goes through the driver.

    File sizes of packed Parquet, and the estimates a checkpoint keeps from it, are far below the rows in memory, so
    left alone Spark broadcasts tables of hundreds of MB.
    """
    return df.hint("merge")


def dealt(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` in as many parts as a shuffle has, by ``columns``: for steps with much work on a table of few splits."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a table written and read back."""
    root = _SCOPES[-1] if _SCOPES else _shared_root(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_scratch(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as it is read from ``path`` after it was written there."""
    with _shuffles_freed(df.sparkSession):
        df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_table(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written to a scratch table and read from there: for what many steps read, a few columns each."""
    return write_scratch(df, scratch_path(df.sparkSession, name), by)
