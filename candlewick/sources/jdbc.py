"""JDBC reads and writes.

A write is at-least-once: a task that is lost after it committed is run again.
Readers of an appended table should apply ``unique_bars``.
"""

from typing import Literal, NamedTuple

from pyspark.sql import DataFrame, SparkSession


class ReadRange(NamedTuple):
    """How a table is divided for a parallel read: equal strides of one column."""

    column: str
    lower: str
    upper: str
    parts: int


def read_options(url: str, table: str, divide: ReadRange | None = None, **options: str) -> dict[str, str]:
    """Options of a table read. Timestamps come back zone-free."""
    chosen = {"url": url, "dbtable": table, "preferTimestampNTZ": "true"}
    if divide is not None:
        chosen |= {
            "partitionColumn": divide.column,
            "lowerBound": str(divide.lower),
            "upperBound": str(divide.upper),
            "numPartitions": str(divide.parts),
        }
    return chosen | options


def read_jdbc(
    spark: SparkSession, url: str, table: str, divide: ReadRange | None = None, **options: str
) -> DataFrame:
    """A whole table. Without ``divide`` one task reads it, which suits small tables only."""
    return spark.read.format("jdbc").options(**read_options(url, table, divide, **options)).load()


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: Literal["append", "overwrite"] = "append", **options: str
) -> None:
    """Write a frame to a table; further options (``createTableOptions``, ``truncate``,
    ``numPartitions``, ``batchsize``, ...) are passed through."""
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode(mode).save()
