"""Surrogate keys, and the star form of the bar table."""

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.schema import VALUE_COLUMNS
from candlewick.sources import folders
from candlewick.workspace import written


UNKNOWN = 0
"""Key of facts that name no member."""


def numbered(values: DataFrame, column: str, key: str, after: int = 0, tasks: int = 64) -> DataFrame:
    """Number the distinct values of ``column`` ``after`` + 1, + 2, ... in their order.

    Values are dealt out by range, whatever their names have in common, ranked within a
    range, and each range starts where those before it end. Only the sizes of
    the ranges pass through one task.
    """
    distinct = values.select(column).where(F.col(column).isNotNull()).distinct()
    ranges = written(distinct.repartitionByRange(tasks, column).withColumn("place_range", F.spark_partition_id()), "ranges")
    earlier = Window.orderBy("place_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.groupBy("place_range")
        .agg(F.count("*").alias("members"))
        .select("place_range", F.coalesce(F.sum("members").over(earlier), F.lit(0)).alias("offset"))
    )
    within = F.row_number().over(Window.partitionBy("place_range").orderBy(column))
    return (
        ranges.withColumn("place", within)
        .join(offsets, "place_range")
        .select((F.col("offset") + F.col("place") + after).alias(key), column)
    )


def symbol_dim(bars: DataFrame) -> DataFrame:
    """``(symbol_key, symbol_name)``, numbered in name order."""
    return numbered(bars, "symbol_name", "symbol_key")


def stable_symbol_dim(bars: DataFrame) -> DataFrame:
    """Symbols with keys that need no stored table: hashes of the names, which are negative half the time."""
    return (
        bars.select("symbol_name")
        .where(F.col("symbol_name").isNotNull())
        .distinct()
        .select(F.xxhash64("symbol_name").alias("symbol_key"), "symbol_name")
    )


def extended(stored: DataFrame, bars: DataFrame) -> DataFrame:
    """The symbols of ``bars`` that ``stored`` lacks, numbered in name order after its largest key.

    A key, once given, stays.
    """
    largest = stored.agg(F.coalesce(F.max("symbol_key"), F.lit(UNKNOWN)).alias("k")).first().k
    new = bars.select("symbol_name").distinct().join(stored, "symbol_name", "left_anti")
    return numbered(new, "symbol_name", "symbol_key", largest)


def extend_symbol_table(bars: DataFrame, path: str) -> DataFrame:
    """Append the new symbols of ``bars`` to the stored dimension and read it back. Extensions of one table take turns."""
    spark = bars.sparkSession
    schema = "symbol_key bigint, symbol_name string"
    stored = spark.read.schema(schema).parquet(path) if folders.exists(spark, path) else spark.createDataFrame([], schema)
    extended(stored, bars).select(F.col("symbol_key").cast("bigint"), "symbol_name").write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def timeseries_dim(bars: DataFrame) -> DataFrame:
    return numbered(bars, "timeseries_name", "timeseries_key")


def with_symbol_key(df: DataFrame, symbols: DataFrame) -> DataFrame:
    """Put the surrogate key first; rows of symbols without one get that of the unknown member."""
    known = df.join(symbols.select("symbol_key", "symbol_name"), "symbol_name", "left")
    return known.select(F.coalesce("symbol_key", F.lit(UNKNOWN)).alias("symbol_key"), *df.columns)


class StarSchema(NamedTuple):
    symbols: DataFrame
    timeseries: DataFrame
    facts: DataFrame


def star_schema(bars: DataFrame) -> StarSchema:
    """Bars as facts keyed by two dimensions; a bar without a symbol or timeframe has the unknown member's key.

    Both dimensions come from one list of the pairs in use. They are written first, so the planner knows their size: small
    ones are broadcast and the bars are not shuffled, larger ones are joined by
    shuffle with run-time splitting of hot symbols.
    """
    named = written(bars.select("symbol_name", "timeseries_name").distinct(), "named")
    symbols = written(symbol_dim(named), "symbols")
    series = written(timeseries_dim(named), "timeseries")
    key = lambda name: F.coalesce(name, F.lit(UNKNOWN)).alias(name)
    facts = (
        bars.join(symbols, "symbol_name", "left")
        .join(series, "timeseries_name", "left")
        .select(key("symbol_key"), key("timeseries_key"), "timestamp", *VALUE_COLUMNS)
    )
    return StarSchema(_with_unknown(symbols), _with_unknown(series), facts)


def _with_unknown(dimension: DataFrame) -> DataFrame:
    """The dimension and its unknown member, which has no name."""
    key, name = dimension.columns
    return dimension.union(dimension.sparkSession.range(1).select(F.lit(UNKNOWN).alias(key), F.lit(None).cast("string").alias(name)))
