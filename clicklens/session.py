"""Session construction and shared-folder helpers.

On a cluster the session is built by the launcher; library code only reads
its settings. ``build_session`` is for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "clicklens") -> SparkSession:
    master = master or os.environ.get("CLICKLENS_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CLICKLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.parquet.compression.codec", "snappy")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster sets this to a shared file system (Spark applies it to the
    context at start-up). Only when it is unset in a local run (as in tests) do
    we pick a fresh local folder; on any other master that raises. The context's
    folder is set once: each ``setCheckpointDir`` call would open a new sub-folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="clicklens-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", configured)
        except Exception:  # noqa: BLE001 - a locked conf still gets the context folder below
            pass
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SCOPES: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder, in the innermost :func:`scratch_scope`."""
    base = _SCOPES[-1] if _SCOPES else ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Scratch tables written inside are deleted at its end, also when the job fails.

    Frames that read them must be written or collected before that.
    """
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scope-{uuid.uuid4().hex[:12]}"
    _SCOPES.append(path)
    try:
        yield path
    finally:
        _SCOPES.remove(path)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
