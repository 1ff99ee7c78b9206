"""Tables that cut lineage, in the folder that the driver and every executor share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Paths of :func:`written` that are still there, for :func:`discard_all`.
_ALIVE: set[str] = set()
#: Paths of :func:`written` since the innermost :func:`steps` began.
_MADE: ContextVar[set[str] | None] = ContextVar("made", default=None)
#: Deletes the shuffle files of a query when it ends; otherwise they stay until the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a folder of this machine serves a local session; a cluster has none that its
    executors share, so there the setting is asked for.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and every executor share")
        folder = tempfile.mkdtemp(prefix="scarmap-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses, to be deleted by :func:`discard_all`."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _ALIVE.add(path)
    return path


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Unlike a local checkpoint, the copy outlives any executor, and later plans start from its
    columns and statistics rather than from the whole lineage.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    if (made := _MADE.get()) is not None:
        made.add(path)
    with shuffles_deleted(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scarmap_path = path
    return out


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Queries that begin and end inside leave no shuffle files, where Spark can do so."""
    before = spark.conf.get(_CLEANUP, None)
    if before is None and not spark.conf.isModifiable(_CLEANUP):
        yield
        return
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


@contextmanager
def steps(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables of :func:`written` that are made inside, by whatever is called there, are deleted at
    the end, but for those given to the function that this yields."""
    made: set[str] = set()
    outer, token = _MADE.get(), _MADE.set(made)

    def kept(df: DataFrame) -> DataFrame:
        made.discard(df._scarmap_path)
        if outer is not None:
            outer.add(df._scarmap_path)
        return df

    try:
        yield kept
    finally:
        _MADE.reset(token)
        for path in made & _ALIVE:
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
    _ALIVE.discard(path)


def discard(*frames: DataFrame | None) -> None:
    """Delete tables of :func:`written` that nothing reads any more."""
    for df in frames:
        if (path := getattr(df, "_scarmap_path", None)) is not None:
            delete_folder(df.sparkSession, path)


def discard_all(spark: SparkSession) -> None:
    """Delete every table that this process has written to the shared folder and that is still
    there. Results of queries are lazy and read such tables: call this once they are stored."""
    for path in list(_ALIVE):
        delete_folder(spark, path)


def put_in_place(spark: SparkSession, made: str, at: str) -> None:
    """Let the folder ``made`` take the place of ``at``, which may be there. Renames only, so that no
    reader sees a mixture; on a store whose renames are copies the change takes as long as these."""
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (made, at))
    fs = old.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{at}.old-{uuid.uuid4().hex}")
    there = fs.exists(old)
    if there and not fs.rename(old, aside) or not fs.rename(new, old):
        raise OSError(f"{made} could not be put at {at}")
    if there:
        fs.delete(aside, True)
