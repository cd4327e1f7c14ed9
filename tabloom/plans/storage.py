"""Cut points of a plan, kept in the folder every executor can reach."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

#: Lets the shuffle files of a query go as soon as it has ended, not when the driver next collects garbage.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: (session, path) of the scratch that is still there, by owner: innermost blocks last, the process first.
_PROCESS: list[tuple[SparkSession, str]] = []
_OWNERS: ContextVar[tuple[list, ...]] = ContextVar("owners", default=(_PROCESS,))
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tabloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str, *, outlive: bool = False) -> str:
    """A fresh path below the shared folder. It belongs to the ``scratch`` block around, or to the
    process; with ``outlive`` to what is around that block."""
    path = f"{shared_dir(spark).rstrip('/')}/tabloom/{name}-{uuid.uuid4().hex}"
    owners = _OWNERS.get()
    owners[max(0, len(owners) - 1 - outlive)].append((spark, path))
    return path


def _delete(some: list[tuple[SparkSession, str]]) -> None:
    for spark, path in some:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch() -> Iterator[None]:
    """Scratch made within the block is deleted at its end, also when it fails.

    Nothing lazy that reads it may leave the block: what is needed later is written with ``outlive``.
    """
    own: list[tuple[SparkSession, str]] = []
    before = _OWNERS.set((*_OWNERS.get(), own))
    try:
        yield
    finally:
        _OWNERS.reset(before)
        _delete(own)


def release() -> None:
    """Delete all scratch that the process still owns. It also happens at the end of the process."""
    some = _PROCESS[:]
    _PROCESS.clear()
    _delete(some)


def _at_exit() -> None:
    try:
        release()
    except (Py4JError, OSError):  # the JVM has ended before; its scratch stays, as after a crash
        pass


atexit.register(_at_exit)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the lineage ends in files that outlive any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str = "table", *, outlive: bool = False) -> DataFrame:
    """Write once as Parquet and read back; later readers prune columns and rows.

    The shuffles that lead to the table are freed once it is there. ``outlive`` as in ``scratch_path``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name, outlive=outlive)
    before = spark.conf.get(_FREE_SHUFFLES)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)
    table = spark.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing reads any more."""
    for table in tables:
        path = _PATHS.pop(table)
        for owned in _OWNERS.get():
            gone = [entry for entry in owned if entry[1] == path]
            _delete(gone)
            owned[:] = [entry for entry in owned if entry[1] != path]


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a few files out over all cores before costly per-row work.

    A table of at least as many files as cores is left as it is, so only small inputs move.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < len(df.inputFiles()) < cores else df
