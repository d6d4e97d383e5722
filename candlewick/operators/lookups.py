"""Extremum lookups: when did an intraday bar show a given value?

``match="value"`` compares values only, so a bar of one ticker may match the
target of another; ``match="keyed"`` compares within a ticker. Like a right
join, a target that no bar shows leaves a row with a NULL symbol.
"""

from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.calendar import trade_date
from candlewick.operators.aggregates import earliest_where_largest, max_volume
from candlewick.schema import DAILY
from candlewick.workspace import written

Match = Literal["keyed", "value"]


def first_match(intraday: DataFrame, targets: DataFrame, value: str, match: Match, name: str) -> DataFrame:
    """Per day and bar symbol, the earliest timestamp of a bar whose ``value`` is a target's.

    Targets are few, a row per symbol and day, so they come first: their distinct values are
    written, which tells the planner their size. Bars meet them before they are grouped. That
    join shuffles the bars once at most, and not at all while the targets can be
    broadcast; being an inner join, it can be split where a value is hot. What is left
    combines before its shuffle to a row per target and symbol, and the targets without any
    are found against that. Daily bars among ``intraday`` take no part.
    """
    keys = ["trade_date", value] + (["symbol_name"] if match == "keyed" else [])
    dated = targets if "trade_date" in targets.columns else targets.withColumn("trade_date", trade_date())
    wanted = written(dated.select(keys).distinct(), "targets")
    bars = _no_daily(intraday).select(trade_date().alias("trade_date"), "symbol_name", value, "timestamp")
    side = wanted.select(*[F.col(k).alias(f"wanted_{k}") for k in keys])
    same = [bars[k] == side[f"wanted_{k}"] for k in keys]
    hits = bars.join(side, same).groupBy("trade_date", value, "symbol_name").agg(F.min("timestamp").alias(name))
    found = hits.alias("hits")
    wanted = wanted.alias("wanted")
    return (
        wanted.join(found, [F.col(f"wanted.{k}") == F.col(f"hits.{k}") for k in keys], "left")
        .groupBy("wanted.trade_date", "hits.symbol_name")
        .agg(F.min(name).alias(name))
    )


def _no_daily(bars: DataFrame) -> DataFrame:
    return bars.where(F.col("timeseries_name") != DAILY) if "timeseries_name" in bars.columns else bars


def max_volume_time(intraday: DataFrame, match: Match) -> DataFrame:
    """When a bar first showed a day's largest 1-minute volume.

    Within a symbol this is one aggregate of the bars, without a join.
    """
    name = "timestamp_with_max_volume"
    dated = _no_daily(intraday).withColumn("trade_date", trade_date())
    if match == "value":
        return first_match(intraday, max_volume(dated, "trade_date"), "volume", match, name)
    times = dated.groupBy("trade_date", "symbol_name").agg(earliest_where_largest(F.col("volume")).alias(name))
    usable = F.col(name).isNotNull() & F.col("symbol_name").isNotNull()
    reported = times.select("trade_date", F.when(usable, F.col("symbol_name")).alias("symbol_name"), F.when(usable, F.col(name)).alias(name))
    return reported.where("trade_date is not null").groupBy("trade_date", "symbol_name").agg(F.min(name).alias(name))


def max_high_time(intraday: DataFrame, daily: DataFrame, match: Match) -> DataFrame:
    """When a bar first showed the high of a daily bar."""
    return first_match(intraday, daily, "high", match, "timestamp_with_max_high")


def min_low_time(intraday: DataFrame, daily: DataFrame, match: Match) -> DataFrame:
    """When a bar first showed the low of a daily bar."""
    return first_match(intraday, daily, "low", match, "timestamp_with_min_low")
