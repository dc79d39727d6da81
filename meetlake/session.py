"""Session settings the jobs rely on, and the shared folder for files between stages."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a batch of pages sent to Python is held in memory whole
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders `staged` wrote in the innermost block of `released`.
_held: ContextVar[list[str] | None] = ContextVar("held", default=None)


def tune(spark: SparkSession) -> SparkSession:
    for name, value in _RUNTIME.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path all executors can reach, under `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="meetlake-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Set the checkpoint folder where the session names none (local tests)."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "checkpoint"))


def staged(rows: DataFrame, purpose: str) -> DataFrame:
    """Rows written to the shared folder and read back.

    Used where several plans start from one costly frame: it is computed once, a lost
    executor costs a file read only, and Spark plans with the true size.
    """
    spark = rows.sparkSession
    path = shared_folder(spark, purpose)
    held = _held.get()
    if held is not None:
        held.append(path)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Frames `staged` in this block are deleted at its end; what is made of them must be written
    by then."""
    paths: list[str] = []
    token = _held.set(paths)
    try:
        yield
    finally:
        _held.reset(token)
        for path in paths:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def shuffles_released(*sessions: SparkSession) -> Iterator[None]:
    """Shuffle files of a query in this block go when it ends, and not when the driver happens to
    collect its garbage. For frames that are run once."""
    before = [(s, s.conf.get(_CLEANUP, None)) for s in sessions]
    for session in sessions:
        session.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        for session, value in before:
            session.conf.unset(_CLEANUP) if value is None else session.conf.set(_CLEANUP, value)


def at_once(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Results of steps that do not need each other, run on threads of their own: while one waits
    for its last task or for the driver, the cores work on another. Fails if one of them does."""
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        thread = inheritable_thread_target(spark)  # takes on the job group, tags and properties
        runs = [pool.submit(copy_context().run, thread(step)) for step in steps]
    return [run.result() for run in runs]


def estimated_bytes(frame: DataFrame) -> int | None:
    """Catalyst's upper estimate of a frame's size, None where it cannot be asked."""
    try:
        stats = frame._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except AttributeError:  # no local JVM, as over Spark Connect
        return None
