"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Whether a query's shuffle files go when it ends.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the operators are planned for.

    AQE stays on: it coalesces small shuffle partitions, turns a sort-merge
    join into a broadcast join when the measured side is small, and splits
    the partition of a hot join key over several tasks. Recording the call
    site of every Column is off: it doubles the time to build a plan.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def dealt(spark: SparkSession) -> int:
    """Partitions of an exchange that AQE must not merge: those whose rows grow in the tasks behind it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of whatever is written inside go as soon as it is written.

    Spark keeps them else until the driver's garbage collector finds the
    query, so the exchanges of all steps may lie on disk at once. For steps
    that store their rows and never run the same DataFrame again.
    """
    before = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(FILE_CLEANUP) if before is None else spark.conf.set(FILE_CLEANUP, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, else one below the session's warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in a folder of this application (see ``clear_scratch``)."""
    return f"{_scratch(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application stored on the way, once its results have been used.

    A result may read such files when it is evaluated, so nothing is removed
    before: whoever owns the session calls this at its end.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{spark.sparkContext.applicationId}"
