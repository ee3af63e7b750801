"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_own_dirs: dict[str, str] = {}
_scopes = threading.local()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the engine's results depend on.

    Hours, weekdays and day boundaries are taken in UTC, so the session zone is fixed. Skewed joins are split even where a
    later step would reuse the partitioning: that step shuffles again, but no task gets a hot key whole.
    Everything else (shuffle partitions, memory, adaptive execution) stays as the cluster set it.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Several joins in a row use one key, the subject; a hot subject's partition must be split all the same.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables, visible to every executor.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset a local folder is made, once per application,
    but only if the executors are on this machine (tests, a laptop); elsewhere it is an error.
    """
    configured = spark.conf.get(_CHECKPOINT_KEY, None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{_CHECKPOINT_KEY} must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own_dirs:
            _own_dirs[app] = tempfile.mkdtemp(prefix="scoreloom-")
        configured = _own_dirs[app]
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table; never reused, so retries cannot mix versions."""
    app = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/scoreloom/{app}/{name}-{uuid.uuid4().hex[:12]}"
    scope = getattr(_scopes, "paths", None)
    if scope is not None:
        scope.append(path)
    return path


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that this thread makes inside are removed at the end, when nothing reads them any more (a micro-batch's, for one)."""
    before, _scopes.paths = getattr(_scopes, "paths", None), []
    try:
        yield
    finally:
        made, _scopes.paths = _scopes.paths, before
        for path in made:
            remove(spark, path)


@contextmanager
def lasting_tables() -> Iterator[None]:
    """Inside, tables stay, also within :func:`scratch_tables`."""
    before, _scopes.paths = getattr(_scopes, "paths", None), None
    try:
        yield
    finally:
        _scopes.paths = before


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_tables(spark: SparkSession) -> None:
    """Remove this application's intermediate tables. Call it when no result that reads them is needed any more."""
    remove(spark, f"{shared_dir(spark)}/scoreloom/{spark.sparkContext.applicationId}")
