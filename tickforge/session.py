"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "tickforge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution; ``conf`` overrides any key."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # Call sites cost several round trips to the JVM per column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Naive timestamps are read as UTC everywhere in this package."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names.

    A temporary folder is used only where none is named, as in local tests.
    """
    context = spark.sparkContext
    named = context.getCheckpointDir()
    if named:
        return named
    named = context.getConf().get("spark.checkpoint.dir")
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        named = tempfile.mkdtemp(prefix="tickforge-checkpoint-")
    context.setCheckpointDir(named)
    return named


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, each job's shuffle files go when it ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    known = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if known is None else spark.conf.set(key, known)
