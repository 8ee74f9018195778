"""Session settings and the shared work folder."""

from __future__ import annotations

import logging
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

Result = TypeVar("Result")

_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def local_session(cores: int | str = "*", memory: str = "12g", **conf: str) -> SparkSession:
    """A session on this machine, for tests and the benchmark.

    On a cluster the submitting job brings its own session; nothing in the
    package depends on the settings made here.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tagloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        # Looking up the calling line of every column expression slows planning.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster shares among its executors."""
    root = (
        _run_folder.get()
        or spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
    )
    if not root:
        # local-cluster has executors of its own, local and local[...] don't
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-")
    return f"{root.rstrip('/')}/tagloom-{uuid.uuid4().hex}"


@contextmanager
def one_work_folder(spark: SparkSession) -> Iterator[str]:
    """All work folders inside the block lie below one, which can be removed when
    what was built from them has been stored."""
    folder = work_folder(spark)
    log.info("staging below %s", folder)
    token = _run_folder.set(folder)
    try:
        yield folder
    finally:
        _run_folder.reset(token)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder through its own file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


# Spark then removes an action's shuffle files at its end, not when the driver's garbage is collected.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written inside the block leaves no shuffle files behind.

    Meant for frames that are written once. One made inside, run again as it is, would have
    to compute its shuffles anew; a frame selected from it later on keeps them as usual.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the work folder and read back.

    Cuts the lineage, and lets the planner see the true size: a set that turned
    out small is then broadcast under ``spark.sql.autoBroadcastJoinThreshold``
    and a big one is shuffled, without a hint.
    """
    path = work_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(
    spark: SparkSession, jobs: Iterable[Callable[[], Result]], at_once: int = 8
) -> list[Result]:
    """Results of jobs that do not need one another, submitted together: the
    tasks of small ones fill the gaps that big ones leave."""
    with ThreadPoolExecutor(at_once) as pool:
        running = [
            pool.submit(copy_context().run, inheritable_thread_target(spark)(job)) for job in jobs
        ]
        return [job.result() for job in running]
