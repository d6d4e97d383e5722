"""Row-level operators on bars: timeframes, unions, uniqueness, ordering, top rows."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.schema import BAR_COLUMNS, BAR_KEY, LANDING, VALUE_COLUMNS


def of_timeframe(bars: DataFrame, timeframe: str) -> DataFrame:
    return bars.where(F.col("timeseries_name") == timeframe)


def with_names(bars: DataFrame, symbol: str, timeframe: str) -> DataFrame:
    """Tag the bars of one file with its symbol and timeframe."""
    return bars.withColumns({"symbol_name": F.lit(symbol), "timeseries_name": F.lit(timeframe)})


def union_bars(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all frames, duplicates kept, columns matched by name."""
    for other in others:
        first = first.unionByName(other)
    return first


def unique_bars(bars: DataFrame, keep_landing: bool = False) -> DataFrame:
    """One bar per (symbol, timeframe, timestamp).

    Of several, the one of the latest load date wins, then the one landed last, then the one
    with the largest values, so the choice is the same on every run. This is an
    aggregate: copies are combined before the shuffle, however many there are.
    """
    order = [c for c in LANDING.fieldNames() if c in bars.columns]
    best = F.max(F.struct(*order, *VALUE_COLUMNS)).alias("best")
    kept = [*VALUE_COLUMNS, *(order if keep_landing else [])]
    chosen = bars.groupBy(BAR_KEY).agg(best).select(*BAR_KEY, *[f"best.{c}" for c in kept])
    return chosen.select(*BAR_COLUMNS, *(order if keep_landing else []))


def symbol_list(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """A list of tickers as a frame whose small size the planner can see."""
    return spark.range(1).select(F.explode(F.lit(list(names)).cast("array<string>")).alias("symbol_name"))


def followed_symbols(bars: DataFrame, symbols: DataFrame) -> DataFrame:
    """Bars of the registered tickers.

    No broadcast is forced: the planner broadcasts the list when its size allows,
    and otherwise joins by shuffle with run-time splitting of hot symbols.
    """
    return bars.join(symbols.select("symbol_name"), "symbol_name", "left_semi")


def project_daily(daily: DataFrame, *extra: str) -> DataFrame:
    """The mart's view of a daily bar."""
    return daily.select(
        *extra,
        "symbol_name",
        F.col("volume").alias("daily_volume"),
        F.col("open").alias("daily_open"),
        F.col("close").alias("daily_close"),
    )


def ordered_bars(bars: DataFrame) -> DataFrame:
    """Presentation order: newest first, then by symbol."""
    return bars.orderBy(F.col("timestamp").desc(), F.col("symbol_name").asc())


def first_bar(bars: DataFrame) -> DataFrame:
    """The earliest bar (bars without a timestamp last)."""
    return bars.orderBy(F.col("timestamp").asc_nulls_last(), "symbol_name", "timeseries_name").limit(1)


def latest_bars(bars: DataFrame, count: int = 100, slices: int = 32) -> DataFrame:
    """The newest ``count`` bars of each symbol and timeframe.

    Ranking runs in two rounds. The first ranks within slices of a symbol, so a
    hot symbol is spread over many tasks; the second sees at most
    ``slices * count`` rows of a symbol. One slice (for bars that are known to be few a symbol) means one round.
    """
    newest = [F.col("timestamp").desc(), *[F.col(c).desc() for c in VALUE_COLUMNS]]
    series = ["symbol_name", "timeseries_name"]
    if slices > 1:
        sliced = bars.withColumn("slice", F.pmod(F.xxhash64("timestamp", *VALUE_COLUMNS), F.lit(slices)))
        bars = _top(sliced, count, [*series, "slice"], newest).drop("slice")
    return _top(bars, count, series, newest)


def _top(bars: DataFrame, count: int, keys: list, order: list) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return bars.withColumn("rank", rank).where(F.col("rank") <= count).drop("rank")
