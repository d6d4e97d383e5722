"""The last-day mart: one row per ticker and day."""

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.calendar import on_day, trade_date
from candlewick.functions.prices import daily_volatility, pct_change_from_open
from candlewick.operators.aggregates import earliest_where_largest
from candlewick.operators.bars import of_timeframe, project_daily
from candlewick.operators.dimensions import with_symbol_key
from candlewick.operators.lookups import Match, max_high_time, max_volume_time, min_low_time
from candlewick.schema import DAILY, INTRADAY, MART_COLUMNS, TIMEFRAMES


def daily_marts(bars: DataFrame, match: Match = "keyed") -> DataFrame:
    """The mart of every day in ``bars``: ``trade_date`` and the mart columns.

    A symbol is left out of a day when its daily bar is missing or when no
    1-minute bar shows the daily bar's high, or its low.
    """
    return _keyed(bars) if match == "keyed" else _by_value(bars)


def last_day_mart(bars: DataFrame, day: date | str, match: Match = "keyed") -> DataFrame:
    """The mart of one day; a day without bars gives an empty mart."""
    return daily_marts(on_day(bars, day), match).select(MART_COLUMNS)


def full_mart(mart: DataFrame, symbols: DataFrame) -> DataFrame:
    """The mart with the surrogate key of ``symbols`` first and the change from the open last."""
    return with_symbol_key(mart.withColumn("pct_change_from_open", pct_change_from_open()), symbols)


def _keyed(bars: DataFrame) -> DataFrame:
    """One scan, one shuffle, no join.

    A window puts the daily bar next to the day's 1-minute bars and the group-by
    reuses its distribution. Bars are unique by key (the loads and
    ``unique_bars`` see to it), so a group holds a symbol's single day: at most
    1,440 one-minute bars and one daily bar, whatever share of the table the
    symbol has. Daily columns of 1-minute rows are nulled before the shuffle.
    """
    is_daily = F.col("timeseries_name") == DAILY
    rows = bars.where(F.col("timeseries_name").isin(*TIMEFRAMES) & F.col("timestamp").isNotNull()).select(
        trade_date().alias("trade_date"),
        "symbol_name",
        F.when(~is_daily, F.col("timestamp")).alias("timestamp"),
        F.when(~is_daily, F.col("volume")).alias("volume"),
        "high",
        "low",
        *[F.when(is_daily, F.col(c)).alias(f"daily_{c}") for c in ("volume", "open", "close")],
        F.when(is_daily, F.col("high")).alias("daily_high"),
        F.when(is_daily, F.col("low")).alias("daily_low"),
    )
    day = Window.partitionBy("trade_date", "symbol_name")
    seen = rows.withColumns(
        {
            "at_high": F.when(F.col("high") == F.max("daily_high").over(day), F.col("timestamp")),
            "at_low": F.when(F.col("low") == F.min("daily_low").over(day), F.col("timestamp")),
        }
    )
    marts = seen.groupBy("trade_date", "symbol_name").agg(
        *[F.max(f"daily_{c}").alias(f"daily_{c}") for c in ("volume", "open", "close")],
        earliest_where_largest(F.col("volume")).alias("timestamp_with_max_volume"),
        F.min("at_high").alias("timestamp_with_max_high"),
        F.min("at_low").alias("timestamp_with_min_low"),
    )
    found = (
        F.col("timestamp_with_max_volume").isNotNull()
        & F.col("timestamp_with_max_high").isNotNull()
        & F.col("timestamp_with_min_low").isNotNull()
    )
    return (
        marts.where(found)
        .withColumn("daily_volatility", daily_volatility())
        .select("trade_date", *MART_COLUMNS)
    )


def _by_value(bars: DataFrame) -> DataFrame:
    """Matching by value crosses symbols, so it stays a set of joins on reduced sides."""
    daily = of_timeframe(bars, DAILY).withColumn("trade_date", trade_date())
    intraday = of_timeframe(bars, INTRADAY)
    result = project_daily(daily, "trade_date").withColumn("daily_volatility", daily_volatility())
    for times in (
        max_volume_time(intraday, "value"),
        max_high_time(intraday, daily, "value"),
        min_low_time(intraday, daily, "value"),
    ):
        result = result.join(times, ["trade_date", "symbol_name"])
    return result.select("trade_date", *MART_COLUMNS)
