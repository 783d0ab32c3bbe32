"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

# Settings a job over very large tables wants; all can be overridden by spark-submit.
DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # one customer or product may own a third of the lines
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # prefer splitting a hot join key over saving one shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # keep deep pages out of the in-memory top-k heap
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
}


def build_session(app: str = "lakesales", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="lakesales-")


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as ``spark.checkpoint.dir`` names it.

    Only where driver and tasks are one process a folder of this machine stands in for it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _own_dir()


@cache
def _session_dir(shared: str, application: str) -> str:
    """One folder a session below the shared one; the file system deletes it when the driver ends."""
    base = f"{shared}/lakesales-{application}-{uuid.uuid4().hex}"
    spark = SparkSession.getActiveSession()
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return base


_passing = threading.local()


@contextmanager
def passing_scratch(spark: SparkSession) -> Iterator[None]:
    """What this thread's operators write to scratch paths inside goes at the end: for work that is repeated, such as
    a micro-batch, whose tables would else pile up until the driver ends."""
    outer, _passing.paths = getattr(_passing, "paths", None), []
    try:
        yield
    finally:
        made, _passing.paths = _passing.paths, outer
        for base in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(base)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table of this session, see ``passing_scratch``."""
    base = f"{_session_dir(shared_dir(spark), spark.sparkContext.applicationId)}/{uuid.uuid4().hex}"
    if getattr(_passing, "paths", None) is not None:
        _passing.paths.append(base)
    return f"{base}/{name}"
