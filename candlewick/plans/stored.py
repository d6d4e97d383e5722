"""Questions to a stored core table that read no more of it than they need."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.operators.bars import latest_bars
from candlewick.schema import BAR_COLUMNS, INTRADAY
from candlewick.sources.core_table import read_core, read_core_days, series_counts
from candlewick.workspace import written

SERIES = ["symbol_name", "timeseries_name"]


def latest_from_core(spark: SparkSession, path: str, count: int = 100) -> DataFrame:
    """The newest ``count`` bars of each symbol and timeframe, as :func:`latest_bars` has them.

    The counts of bars per day say on which day, going back from the newest, a series has
    its ``count`` bars. Only folders of such days or later ones are read, a day for the series that need
    it; a symbol with old bars only has its old days read for it alone. What remains of a series is ``count`` bars and one day at most.
    """
    newer = F.sum("bars").over(Window.partitionBy(*SERIES).orderBy(F.col("trade_date").desc()).rowsBetween(Window.unboundedPreceding, -1))
    needed = written(series_counts(spark, path).where("bars > 0").withColumn("newer", F.coalesce(newer, F.lit(0))).where(F.col("newer") < count).drop("newer", "bars"), "needed-days")
    days = sorted(r["trade_date"] for r in needed.select("trade_date").distinct().collect())
    bars = read_core_days(spark, path, days).join(needed, [*SERIES, "trade_date"], "left_semi")
    return latest_bars(bars.select(BAR_COLUMNS), count, slices=1)


def min_date_from_core(spark: SparkSession, path: str, timeframe: str = INTRADAY) -> DataFrame:
    """The earliest day with bars of ``timeframe`` as a one-row frame, from the counts per day; no bar is read."""
    return series_counts(spark, path).where((F.col("timeseries_name") == timeframe) & (F.col("bars") > 0)).agg(F.min("trade_date").alias("min_date"))


def symbols_from_core(spark: SparkSession, path: str, names: Iterable[str]) -> DataFrame:
    """Stored bars of some symbols. The names reach the scan, which skips row groups without any of them."""
    return read_core(spark, path).where(F.col("symbol_name").isin(list(names)))
