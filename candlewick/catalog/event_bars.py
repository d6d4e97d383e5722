"""Bars derived from the ``events`` table: each event is a trade of its type.

``event_type`` is the symbol, ``value`` the price, ``props.k`` the size.
"""

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.calendar import as_date, midnight
from candlewick.schema import BAR_COLUMNS, DAILY, INTRADAY, PRICE


def ticks(spark: SparkSession, sf_dir: str, day: date | str | None = None) -> DataFrame:
    """Trades, of one day if given; that range is pushed to the Parquet scan."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    if day is not None:
        following = as_date(day) + timedelta(days=1)
        events = events.where((F.col("ts") >= midnight(day)) & (F.col("ts") < midnight(following)))
    return events.where(F.col("ts").isNotNull()).select(
        F.col("event_type").alias("symbol_name"),
        "ts",
        "event_id",
        F.col("value").cast(PRICE).alias("px"),
        F.get_json_object("props", "$.k").cast("bigint").alias("sz"),
    )


def _ohlcv() -> list:
    order = F.struct("ts", "event_id")
    return [
        F.min_by("px", order).alias("open"),
        F.max("px").alias("high"),
        F.min("px").alias("low"),
        F.max_by("px", order).alias("close"),
        F.sum("sz").alias("volume"),
    ]


def intraday_bars(spark: SparkSession, sf_dir: str, day: date | str | None = None) -> DataFrame:
    """1-minute bars."""
    minute = F.window("ts", "1 minute").start.alias("timestamp")
    bars = ticks(spark, sf_dir, day).groupBy("symbol_name", minute).agg(*_ohlcv())
    return bars.withColumn("timeseries_name", F.lit(INTRADAY)).select(BAR_COLUMNS)


def daily_bars(spark: SparkSession, sf_dir: str, day: date | str | None = None) -> DataFrame:
    """Daily bars."""
    midnight_of = F.to_date("ts").cast("timestamp_ntz").alias("timestamp")
    bars = ticks(spark, sf_dir, day).groupBy("symbol_name", midnight_of).agg(*_ohlcv())
    return bars.withColumn("timeseries_name", F.lit(DAILY)).select(BAR_COLUMNS)


def all_bars(spark: SparkSession, sf_dir: str, day: date | str | None = None) -> DataFrame:
    """Both timeframes from one scan and one shuffle, by grouping sets."""
    timed = ticks(spark, sf_dir, day).withColumns(
        {"minute": F.window("ts", "1 minute").start, "midnight": F.to_date("ts").cast("timestamp_ntz")}
    )
    keys = ["symbol_name", "midnight", "minute"]
    bars = timed.groupingSets([keys, keys[:2]], *keys).agg(*_ohlcv(), F.grouping("minute").alias("whole_day"))
    whole_day = F.col("whole_day") == 1
    return bars.withColumns(
        {
            "timeseries_name": F.when(whole_day, DAILY).otherwise(INTRADAY),
            "timestamp": F.when(whole_day, F.col("midnight")).otherwise(F.col("minute")),
        }
    ).select(BAR_COLUMNS)
