"""Intermediate tables, written where every executor can read them back.

The cluster names its shared folder in ``spark.checkpoint.dir`` or by
``SparkContext.setCheckpointDir``. Only a plain local session may do without: it uses a
temporary folder. Elsewhere executors would write to their own disks, so an unset folder is an error.
"""

import atexit
import contextlib
import functools
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

from candlewick.sources import folders


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="candlewick-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


_made: set[str] = set()


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path (not created yet) below the shared folder."""
    folder = f"{shared_folder(spark).rstrip('/')}/candlewick/{label}-{uuid.uuid4().hex}"
    _made.add(folder)
    return folder


def clean_up(spark: SparkSession) -> None:
    """Remove the folders this process made, once no frame built on them is needed."""
    for folder in list(_made):
        _remove(spark, folder)


def _remove(spark: SparkSession, folder: str) -> None:
    folders.delete(spark, folder)
    _made.discard(folder)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    Cuts the lineage: lost executors recompute nothing before this point. The
    planner also sees the real size of the table, so it broadcasts it only
    below ``spark.sql.autoBroadcastJoinThreshold``. The table stays until
    :func:`clean_up`, as results built on it are lazy; a job that ends with a
    write uses :func:`temporary_tables`.
    """
    return _written_to(df, new_folder(df.sparkSession, label))


@contextlib.contextmanager
def temporary_tables(spark: SparkSession, label: str) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """As :func:`written`, for tables that are removed when the block ends.

    After a failure they stay, as they may hold the only complete copy of what
    was being rewritten.
    """
    folder = new_folder(spark, label)
    _made.discard(folder)
    yield lambda df, name: _written_to(df, f"{folder}/{name}")
    _remove(spark, folder)


def _written_to(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
