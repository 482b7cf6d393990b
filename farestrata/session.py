"""Session set-up for scripts and tests; on a cluster the submitted settings win."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from threading import Lock

from pyspark.sql import SparkSession


def build(app: str = "farestrata", master: str | None = None, **conf: str) -> SparkSession:
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        # the JVM never compiles methods above 8000 bytes of bytecode; let Spark split such stages instead
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    A folder of our own is made only where the session names none, as in local tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="farestrata-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


_held: dict[tuple[str, str], int] = {}
_lock = Lock()


@contextmanager
def held(spark: SparkSession, name: str, value: object, default: str) -> Iterator[None]:
    """The session has this ``value`` meanwhile, whichever of its threads ends first. A setting of the user stays."""
    key = spark._jsparkSession.sessionUUID(), name
    with _lock:
        ours = key in _held or spark.conf.get(name, default) == default
        if ours:
            _held[key] = _held.get(key, 0) + 1
            spark.conf.set(name, value)
    try:
        yield
    finally:
        with _lock:
            if ours:
                _held[key] -= 1
                if not _held[key]:
                    del _held[key]
                    spark.conf.unset(name)


def tidy(spark: SparkSession) -> AbstractContextManager[None]:
    """What is written or collected meanwhile removes its shuffle files when it ends.

    Else they stay until the driver happens to collect its garbage, so a job of many writes holds those of all of them. Frames that
    run here must be built here, and not be asked for again afterwards.
    """
    return held(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true", "false")
