"""Session helpers shared by tests, the bench and the pipeline."""

from __future__ import annotations

import contextvars
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "gazetta") -> SparkSession:
    """A local session configured the way the tests and the bench expect.

    On a cluster the session is created by the launcher; the library only reads
    its settings (see ``checkpoint_dir``).
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # No broadcast from plan-time size *estimates* (they undercount exploded
        # rows); AQE still broadcasts a side whose measured size is small, and
        # the library hints broadcasts only after a row-count check.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("GAZETTA_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names it; only when it is unset on a *local* master (tests,
    the bench) do we pick a fresh scratch folder of our own. A machine-local
    folder is useless to a cluster's executors, so there an unset setting is
    an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
        current = tempfile.mkdtemp(prefix="gazetta-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    # Once an application: every further call would start another sub-folder,
    # and the cleaner would look for old checkpoints in the newest only.
    context = spark.sparkContext
    if not (context.getCheckpointDir() or "").startswith(_uri(current)):
        context.setCheckpointDir(current)
    return current


_stored: dict[str, list[str]] = {}
_folder: contextvars.ContextVar[str | None] = contextvars.ContextVar("stored_in", default=None)


@contextmanager
def stored_in(folder: str) -> Iterator[None]:
    """Within, ``stored`` writes under ``folder`` (on shared storage), which is
    the caller's to delete."""
    token = _folder.set(folder)
    try:
        yield
    finally:
        _folder.reset(token)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    that copy: several passes see the same rows, read only the columns they
    need, and nothing is recomputed after a lost executor. The copy stays until
    ``clear_stored`` (or, within ``stored_in``, until the caller deletes it)."""
    spark = df.sparkSession
    folder = _folder.get()
    path = f"{(folder or checkpoint_dir(spark)).rstrip('/')}/stored-{name}-{uuid.uuid4().hex}"
    if folder is None:
        _stored.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_paths(spark: SparkSession) -> list[str]:
    """The folders that ``stored`` wrote in this application."""
    return list(_stored.get(spark.sparkContext.applicationId, []))


def clear_stored(spark: SparkSession, keep: list[str] | None = None) -> int:
    """Delete the folders that ``stored`` wrote in this application, but for
    those in ``keep``; frames over them can't be read any more. Returns how many."""
    mine = _stored.get(spark.sparkContext.applicationId, [])
    gone = [p for p in mine if p not in (keep or [])]
    for path in gone:
        delete_path(spark, path)
        mine.remove(path)
    return len(gone)


def _uri(path: str) -> str:
    """The path as Spark reports it."""
    return path if ":" in path.split("/")[0] else "file:" + path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever store the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in store.listStatus(folder)) if store.exists(folder) else []


def modified(spark: SparkSession, path: str) -> int:
    """When a file or folder was last changed."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).getModificationTime()
