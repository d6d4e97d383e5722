"""Grouped extremes of bars. All are plain aggregates, combined before the shuffle."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.calendar import trade_date
from candlewick.schema import DAILY


def max_volume(intraday: DataFrame, *extra_keys: str) -> DataFrame:
    """The largest volume of each symbol."""
    return intraday.groupBy("symbol_name", *extra_keys).agg(F.max("volume").alias("volume"))


def first_timestamp(bars: DataFrame, *extra_keys: str) -> DataFrame:
    """The earliest timestamp of each symbol."""
    return bars.groupBy("symbol_name", *extra_keys).agg(F.min("timestamp").alias("first_timestamp"))


def min_date(bars: DataFrame) -> DataFrame:
    """The earliest date as a one-row frame; missing timestamps do not count."""
    return bars.agg(F.to_date(F.min("timestamp")).alias("min_date"))


def since_first_intraday(daily: DataFrame, intraday: DataFrame, today: Column) -> DataFrame:
    """Daily bars from the first intraday date to ``today``, both included."""
    first = min_date(intraday).scalar()
    return daily.where(trade_date().between(first, today))


def earliest_where_largest(value: Column, ts: Column | None = None) -> Column:
    """Aggregate: the earliest timestamp at which ``value`` is at its largest.

    Rows without a value do not take part.
    """
    ts = F.col("timestamp") if ts is None else ts
    return F.min(F.when(value.isNotNull(), F.struct((-value).alias("v"), ts.alias("ts"))))["ts"]


def intraday_extremes(intraday: DataFrame) -> DataFrame:
    """Per symbol and day, the earliest bar of the largest volume, the highest and the
    lowest price among the day's own intraday bars (no daily bar is needed, and any in the frame takes no part)."""
    if "timeseries_name" in intraday.columns:
        intraday = intraday.where(F.col("timeseries_name") != DAILY)
    return intraday.groupBy(trade_date().alias("trade_date"), "symbol_name").agg(
        earliest_where_largest(F.col("volume")).alias("timestamp_with_max_volume"),
        earliest_where_largest(F.col("high")).alias("timestamp_with_max_high"),
        earliest_where_largest(-F.col("low")).alias("timestamp_with_min_low"),
    )
