"""Session defaults and the shared folder jobs may write intermediate tables to."""

from __future__ import annotations

import atexit
import contextlib
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **options: str) -> SparkSession:
    """Return a session with UTC, ANSI and adaptive execution; ``options`` win over the defaults.

    Keyword names use ``__`` for the dots, e.g. ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = SESSION_DEFAULTS | {name.replace("__", "."): value for name, value in options.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextlib.contextmanager
def session_settings(spark: SparkSession, settings: Mapping[str, object]) -> Iterator[None]:
    """Runtime settings for the jobs started inside the block; the previous values come back after it."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


_made: list[str] = []


@functools.lru_cache(maxsize=None)
def _local_base() -> str:
    """A folder of this process, for local masters; it goes when the process ends."""
    base = tempfile.mkdtemp(prefix="tidemark-", dir="/tmp")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``. A machine-local folder is only
    used when the setting is absent and the master is local, as in tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_base()
    folder = f"{base.rstrip('/')}/tidemark/{purpose}-{uuid.uuid4().hex}"
    _made.append(folder)
    return folder


def remove_shared_folders(spark: SparkSession) -> int:
    """Delete all folders made so far and return their number; call it when results are written.

    Frames returned by operators may still read such a folder until they are written themselves.
    """
    count = len(_made)
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return count
