"""Session settings and scratch space shared by jobs, tests and the bench."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the jobs are designed around. On a cluster, pass them with
# spark-submit; nothing below depends on the number of executors.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a skewed join partition even if that adds a shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Stream state on local disk with incremental uploads, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "12g",
                  app: str = "recoflow") -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_scratch: list[str] = []
_rounds = threading.local()             # ``paths``: scratch paths of the round that this thread is in
CLEANUP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path for intermediate tables, in the folder that ``spark.checkpoint.dir`` names.

    Without that setting a single-machine session gets one temporary folder,
    removed at exit; on a cluster it is an error, since executors would write to
    their own disks.
    """
    path = f"{_base(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    if getattr(_rounds, "paths", None) is not None:
        _rounds.paths.append(path)
    return path


def _base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _local_scratch:
            _local_scratch.append(tempfile.mkdtemp(prefix="recoflow-"))
            atexit.register(shutil.rmtree, _local_scratch[0], ignore_errors=True)
        base = _local_scratch[0]
    return base.rstrip("/")


@contextlib.contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]):
    """Session settings for what is run inside; those before are put back."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def materialize(df, label: str = "table", by: Sequence[str] = ()):
    """Write ``df`` once to shared scratch space and read it back.

    Cuts the lineage with a reliable copy, so that losing an executor never
    means recomputing the upstream plan; its shuffle files are removed when it is written.
    ``by`` names columns whose values get folders of their own.
    """
    path = scratch_dir(df.sparkSession, label)
    with settings(df.sparkSession, CLEANUP):
        df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_rounds(spark: SparkSession, rounds: int, part: Callable[[int], DataFrame], label: str = "rounds") -> DataFrame:
    """The rows of ``part`` of 0 to ``rounds`` - 1, computed one after the other and written to scratch space:
    what a round shuffles or keeps there is removed before the next."""
    path, schema = scratch_dir(spark, label), None
    for r in range(rounds):
        outer, _rounds.paths = getattr(_rounds, "paths", None), []
        try:
            rows = part(r)
            schema = rows.schema
            with settings(spark, CLEANUP):
                rows.write.mode("append").parquet(path)
        finally:
            paths, _rounds.paths = _rounds.paths, outer
            for made in paths:
                to_path = spark._jvm.org.apache.hadoop.fs.Path(made)
                to_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(to_path, True)
    return spark.read.schema(schema).parquet(path)


def round_is(r: int, rounds: int, *columns: str) -> Column:
    """Whether a row belongs to round ``r`` by the hash of ``columns``."""
    return F.pmod(F.xxhash64(*columns), F.lit(rounds)) == r
