"""Session settings and shared scratch space."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


#: Scratch of one driver process lies below a folder of its own.
_RUN = uuid.uuid4().hex[:12]


@lru_cache(maxsize=1)
def _local_scratch() -> str:
    folder = tempfile.mkdtemp(prefix="tabprep-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary folder only where none is set."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_scratch()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch root; nothing is created yet."""
    return f"{scratch_root(spark)}/tabprep/{_RUN}/{label}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession) -> bool:
    """Delete all scratch of this driver process; call it once nothing reads its results any more."""
    from .sources.files import FileSystem

    return FileSystem(spark).delete(f"{scratch_root(spark)}/tabprep/{_RUN}")


def build_session(app: str = "tabprep", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on; cluster settings come from the submitter."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
