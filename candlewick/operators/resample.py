"""Coarser bars from finer ones."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.calendar import trade_date
from candlewick.schema import BAR_COLUMNS, DAILY

# The vendor's intraday intervals, as window lengths.
INTERVALS = {
    "1min": "1 minute",
    "5min": "5 minutes",
    "15min": "15 minutes",
    "30min": "30 minutes",
    "60min": "60 minutes",
}


def _minutes() -> Column:
    """Length of a bar's interval in minutes; null where it is no intraday bar."""
    known = F.create_map(*[F.lit(x) for name, length in INTERVALS.items() for x in (name, int(length.split()[0]))])
    return known[F.col("timeseries_name")]


def _rolled_up(bars: DataFrame, timeframe: str, start: Column, most: int) -> DataFrame:
    """Of the bars with intervals up to ``most`` minutes; a new bar made of several intervals is an error.

    Order columns are plain timestamps, so this stays a hash aggregate; it is
    combined before the shuffle, which carries one row per bar and task.
    """
    sources = bars.withColumn("source_minutes", _minutes()).where(F.col("source_minutes") <= most)
    mixed = F.raise_error(F.lit(f"bars of several intervals can't be rolled up to {timeframe} together"))
    one_source = F.when(F.col("least") == F.col("largest"), F.lit(timeframe)).otherwise(mixed.cast("string"))
    return (
        sources.groupBy("symbol_name", start.alias("bar_start"))
        .agg(
            F.min_by("open", "timestamp").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "timestamp").alias("close"),
            F.sum("volume").alias("volume"),
            F.min("source_minutes").alias("least"),
            F.max("source_minutes").alias("largest"),
        )
        .withColumn("timeseries_name", one_source)
        .withColumnRenamed("bar_start", "timestamp")
        .select(BAR_COLUMNS)
    )


def resample(bars: DataFrame, interval: str) -> DataFrame:
    """Bars of ``interval`` (a key of INTERVALS), stamped with their start, from finer intraday bars.

    Daily and coarser bars in the frame take no part.
    """
    return _rolled_up(bars, interval, F.window("timestamp", INTERVALS[interval]).start, int(INTERVALS[interval].split()[0]))


def daily_from_intraday(bars: DataFrame) -> DataFrame:
    """Daily bars, stamped with midnight, from the intraday bars of the frame."""
    dated = bars.where(F.col("timestamp").isNotNull())
    return _rolled_up(dated, DAILY, trade_date().cast("timestamp_ntz"), 24 * 60)
