"""Session helpers: a configured local session for tests/bench, and the
shared checkpoint folder read from the session."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ratingflow") -> SparkSession:
    """Session for tests and the bench.  On a cluster, build the session
    with spark-submit settings instead; the plans do not depend on these."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and derived tables.

    A directory already set on the context counts first, then the setting
    ``spark.checkpoint.dir``.  With neither, a fresh local folder is picked
    for a local master only: on a cluster executors would not share it."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server side owns the context
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share") from None
        return path
    held = _CHOSEN.get(sc.applicationId)
    if held and held[1] == sc.getCheckpointDir():
        return held[0]
    path = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = sc.master
        if not (master == "local" or re.match(r"local\[", master)):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="ratingflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    _CHOSEN[sc.applicationId] = (path, sc.getCheckpointDir())
    return path


#: per application: the folder chosen, and the context's directory then (the
#: context appends a folder of its own to what it is given)
_CHOSEN: dict[str, tuple[str, str]] = {}


#: application folders that are deleted when the driver ends
_REGISTERED: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for derived tables.  What
    is left in this application's folder goes when the driver ends."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    own = f"{base}/ratingflow/{spark.sparkContext.applicationId}"
    if own not in _REGISTERED:
        fs, target = _file_system(spark, own)
        fs.mkdirs(target)
        fs.deleteOnExit(target)
        _REGISTERED.add(own)
    return f"{own}/{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``scratch_path`` once nothing reads it."""
    if f"{ensure_checkpoint_dir(spark).rstrip('/')}/ratingflow/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    remove(spark, path)


def _file_system(spark: SparkSession, path: str) -> tuple:
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(sc._jsc.hadoopConfiguration()), target


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system Spark knows; none if it is missing."""
    fs, target = _file_system(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(target)) if fs.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if there is one."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


_FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of DataFrames made within go as soon as a run of them
    ends, not when the driver next collects its memory.  One that runs again
    makes its files again, so what is read twice is checkpointed."""
    before = spark.conf.get(_FREES, None)
    spark.conf.set(_FREES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREES) if before is None else spark.conf.set(_FREES, before)


def frees_shuffles(fn: Callable) -> Callable:
    """``fn(spark, ...)`` within ``freed_shuffles``."""
    @wraps(fn)
    def run(spark: SparkSession, *args, **kwargs):
        with freed_shuffles(spark):
            return fn(spark, *args, **kwargs)
    return run


def set_time_zone(spark: SparkSession, tz: str) -> None:
    if spark.conf.get("spark.sql.session.timeZone") != tz:
        spark.conf.set("spark.sql.session.timeZone", tz)


__all__ = ["local_session", "children", "ensure_checkpoint_dir", "freed_shuffles", "frees_shuffles", "remove", "remove_scratch", "scratch_path",
           "set_time_zone"]
