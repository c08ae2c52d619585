"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# UTC keeps event_date stable whatever zone the cluster runs in. AQE sizes the
# post-shuffle partitions, turns measured-small join sides into broadcasts and
# splits skewed join partitions. RocksDB keeps streaming state off the heap. Call sites of
# column expressions, for error messages, would double the time that plans take to build.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "pulselake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory every executor can reach.

    It lies under ``spark.checkpoint.dir`` where the cluster names one. Only a
    local-mode session without that setting falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        base = tempfile.mkdtemp(prefix="pulselake-")
    return f"{base.rstrip('/')}/pulselake/{label}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a directory on whatever file system it is on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def side_by_side(*steps: Callable[[], object]) -> list:
    """Run independent jobs at the same time, so that small ones do not wait for one another; their
    results in order. The first failure is raised once all have ended."""
    with ThreadPoolExecutor(max_workers=8) as pool:
        running = [pool.submit(step) for step in steps]
    return [r.result() for r in running]
