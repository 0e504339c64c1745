"""Session settings and the shared scratch folder for staged tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark.

    On a cluster the caller brings its own session; no operator depends on these settings.
    """
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("passagework")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a fresh temporary folder, kept in the session's
    settings so that later calls agree. On a cluster a missing folder is an error, because a
    machine-local path would be invisible to the other executors.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    key = "spark.passagework.localScratch"
    root = spark.conf.get(key, None)
    if not root:
        root = tempfile.mkdtemp(prefix="passagework-")
        spark.conf.set(key, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; never reused, so no run reads another run's files."""
    return f"{scratch_root(spark)}/passagework/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, and safe from lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)
