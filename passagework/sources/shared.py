"""Parquet folders on shared storage, read batch by batch inside Python tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder Spark wrote and the folder's path in it."""
    path = re.sub(r"^s3[an]://", "s3://", re.sub(r"^file:/+", "/", path))
    return pafs.FileSystem.from_uri(path)


def readable(path: str) -> bool:
    """Whether Python can open the folder; some stores are open to Spark's readers only."""
    try:
        fs, inner = opened(path)
        return fs.get_file_info(inner).type == pafs.FileType.Directory
    except (OSError, ValueError, NotImplementedError, pa.ArrowException):
        return False


@dataclass(frozen=True)
class SharedParquet:
    """A written folder that every task can stream through, holding one batch at a time."""

    path: str

    def batches(self, columns: list[str], rows: int) -> Iterator[pa.RecordBatch]:
        fs, inner = opened(self.path)
        found = fs.get_file_info(pafs.FileSelector(inner))
        for name in sorted(f.path for f in found if f.base_name.endswith(".parquet") and f.base_name[0] not in "._"):
            with fs.open_input_file(name) as file:
                yield from pq.ParquetFile(file).iter_batches(rows, columns=columns)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote, wherever Spark can write."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
