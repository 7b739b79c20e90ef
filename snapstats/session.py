"""Session set-up and the shared scratch folder.  Nothing runs at import."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
RELEASE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_lock = threading.Lock()
_releasing: dict[str, tuple[int, str]] = {}


def build_session(app: str = "snapstats", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume (UTC stamps, adaptive plans, ANSI).

    Shuffle width is left to adaptive coalescing; ``conf`` overrides anything, with ``__`` for dots.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder is used in local mode only: on a cluster a folder of one
    machine is not visible to the other executors, so that case is an error.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="snapstats-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query of this session go when it ends, not when the driver collects its garbage.

    A job of several writes then holds the files of those that run, instead of all.  Files that are asked for once more
    are made again.  Threads may overlap: the session's own setting is back when the last has left.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        inside, before = _releasing.get(session, (0, ""))
        if not inside:
            before = spark.conf.get(RELEASE_SHUFFLES, "false")
            spark.conf.set(RELEASE_SHUFFLES, "true")
        _releasing[session] = inside + 1, before
    try:
        yield
    finally:
        with _lock:
            inside, before = _releasing[session]
            if inside > 1:
                _releasing[session] = inside - 1, before
            else:
                del _releasing[session]
                spark.conf.set(RELEASE_SHUFFLES, before)
