"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

# Runtime settings every job here relies on. Results depend on the first two
# (UTC calendar fields, partition values kept as the contract declares them);
# the rest let adaptive execution coalesce small partitions and split hot ones.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime options on a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "lakestar", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or get) a session; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return apply_runtime_conf(builder.getOrCreate())


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of a write go as soon as it is done, not when the driver collects its garbage."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder on storage that every executor sees.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session
    may leave that unset; then one new temporary folder serves the process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_scratch()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder that nothing reads any more, on whatever storage it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
