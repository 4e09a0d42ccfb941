"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

from refrain.files import remove

SESSION_DEFAULTS = {
    # Adaptive execution merges small partitions, switches to broadcast joins
    # on measured sizes and splits skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM does not compile methods beyond this size; rather let Spark
    # generate several smaller ones for wide projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Lets two datasets be published side by side.
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "refrain", master: str | None = None, **conf: str
) -> SparkSession:
    """A session with the defaults above; ``conf`` entries win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session may do without it; there a fresh temporary folder is
    made once, set, and removed when the process ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder that all executors share"
        )
    folder = tempfile.mkdtemp(prefix="refrain-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_scope: ContextVar[list[str] | None] = ContextVar("scratch folders", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, never used before."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    folders = _scope.get()
    if folders is not None:
        folders.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the scratch folders that are made meanwhile, also after a failure."""
    folders: list[str] = []
    before = _scope.set(folders)
    try:
        yield
    finally:
        _scope.reset(before)
        for folder in folders:
            remove(spark, folder)
