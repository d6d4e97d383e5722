"""The loads: raw layer to core table, in full or for one day."""

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.calendar import as_date, on_day
from candlewick.operators.aggregates import since_first_intraday
from candlewick.operators.bars import followed_symbols, of_timeframe, union_bars, unique_bars
from candlewick.plans.landings import ledger_of, record_landings
from candlewick.schema import DAILY, INTRADAY
from candlewick.sources.core_table import merge_bars, merge_unique_bars
from candlewick.sources.payloads import screened, screened_payloads
from candlewick.sources.raw_layer import scan_payloads, scan_raw_layer
from candlewick.workspace import temporary_tables

LOAD = "load"
"""The writer of what a batch load refuses."""


def quarantine_of(core: str) -> str:
    """Where refused lines go unless a load names a place: beside the core table."""
    return f"{core.rstrip('/')}_quarantine"


def refused_folder(quarantine: str, load_date: date | str, written_by: str) -> str:
    """Loads and streams share one layout: folders by load date, and within by writer."""
    return f"{quarantine.rstrip('/')}/load_date={as_date(load_date)}/written_by={written_by}"


def landed_bars(
    spark: SparkSession,
    raw: str,
    load_date: date | str,
    quarantine: str,
    kept_as: Callable[[DataFrame, str], DataFrame],
    symbols: DataFrame | None = None,
) -> DataFrame:
    """The bars landed on ``load_date``, as CSV lines or JSON payloads, for the followed ``symbols`` if given.

    The text is parsed once, into tables that the bars and the refused rows are split
    from. Refused rows replace those that an earlier load of the same date has left
    in ``quarantine``, also when there are none any more. The state of every file goes to the
    ledger of landings beside the quarantine.
    """
    landed, payloads = scan_raw_layer(spark, raw, load_date), scan_payloads(spark, raw, load_date)
    if symbols is not None:
        landed, payloads = followed_symbols(landed, symbols), followed_symbols(payloads, symbols)
    bars, refused = screened(kept_as(landed, "landed"))
    if payloads.inputFiles():
        more, more_refused = screened_payloads(payloads)
        bars, refused = bars.unionByName(kept_as(more, "payload-bars")), refused.unionByName(more_refused, allowMissingColumns=True)
    refused.write.mode("overwrite").parquet(refused_folder(quarantine, load_date, LOAD))
    bars, refused = (df.withColumn("load_date", F.lit(as_date(load_date))) for df in (bars, refused))
    record_landings(bars, refused, ledger_of(quarantine), LOAD)
    return bars


def initial_bars(landed: DataFrame, today: date | str) -> DataFrame:
    """All bars but the daily ones, and these from the first 1-minute bar up to ``today``."""
    daily = since_first_intraday(of_timeframe(landed, DAILY), of_timeframe(landed, INTRADAY), F.lit(as_date(today)))
    return union_bars(landed.where(F.col("timeseries_name") != DAILY), daily)


def delta_bars(landed: DataFrame, day: date | str) -> DataFrame:
    """The bars of all timeframes for one day."""
    return on_day(landed, day)


def initial_load(
    spark: SparkSession,
    raw: str,
    core: str,
    load_date: date | str,
    symbols: DataFrame | None = None,
    quarantine: str | None = None,
) -> None:
    """Load everything landed on ``load_date``, which is also the last day taken.

    Daily bars are trimmed to the span of the 1-minute bars, so daily bars alone are an error.
    """
    with temporary_tables(spark, "load") as kept_as:
        found = landed_bars(spark, raw, load_date, quarantine or quarantine_of(core), kept_as, symbols)
        bars = kept_as(unique_bars(found, keep_landing=True), "unique")
        if of_timeframe(bars, INTRADAY).isEmpty() and not bars.isEmpty():
            raise ValueError(f"no {INTRADAY} bars were landed on {load_date}: nothing says where to trim the daily ones")
        merge_unique_bars(initial_bars(bars, load_date), core)


def delta_load(
    spark: SparkSession,
    raw: str,
    core: str,
    load_date: date | str,
    day: date | str,
    symbols: DataFrame | None = None,
    quarantine: str | None = None,
) -> None:
    """Load only ``day`` from what was landed on ``load_date``. Repeating it changes nothing."""
    with temporary_tables(spark, "load") as kept_as:
        found = landed_bars(spark, raw, load_date, quarantine or quarantine_of(core), kept_as, symbols)
        merge_bars(delta_bars(found, day), core)
