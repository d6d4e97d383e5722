"""Coarser bars kept beside the core table and brought up to date by changed days.

A rollup lies within the table, as a table of the same layout. When days of bars are put in place
they are noted for every kept rollup before they can be seen; a refresh makes the noted days anew and then takes the
notes off. A refresh that is cut off leaves its notes, and making a day twice gives the same. Intervals divide a day, so
no coarser bar spans two.
"""

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from candlewick.functions.calendar import as_date
from candlewick.operators.resample import INTERVALS, resample
from candlewick.operators.bars import of_timeframe
from candlewick.schema import BAR_COLUMNS, INTRADAY
from candlewick.sources import folders
from candlewick.sources.core_table import CHANGED, read_core, read_core_days, replace_days, rollup_folder, settle, stored_days, kept_rollups

BARS = "bars"


def keep_rollup(spark: SparkSession, core: str, interval: str) -> None:
    """Keep coarser bars of ``interval`` from now on; the first refresh makes them of all days there are."""
    if interval not in INTERVALS:
        raise ValueError(f"no interval {interval}")
    folder = f"{rollup_folder(core, interval)}/{CHANGED}"
    if interval not in kept_rollups(spark, core):
        # Days loaded from here on note themselves; the others are noted now.
        folders.make(spark, folder)
        for day in stored_days(spark, core):
            folders.mark(spark, f"{folder}/{day}")


def changed_since_refresh(spark: SparkSession, core: str, interval: str) -> list[date]:
    return [as_date(day) for day in folders.children(spark, f"{rollup_folder(core, interval)}/{CHANGED}")]


def refresh_rollups(spark: SparkSession, core: str) -> dict[str, list[date]]:
    """Bring all kept rollups up to date from their 1-minute bars; only changed days are read and written. The days are given."""
    settle(spark, core)
    done = {}
    for interval in kept_rollups(spark, core):
        folder, days = rollup_folder(core, interval), changed_since_refresh(spark, core, interval)
        done[interval] = days
        settle(spark, f"{folder}/{BARS}")
        if days:
            replace_days(resample(of_timeframe(read_core_days(spark, core, days), INTRADAY), interval), f"{folder}/{BARS}")
        for day in days:
            folders.delete(spark, f"{folder}/{CHANGED}/{day}")
    return done


def read_rollup(spark: SparkSession, core: str, interval: str, first: date | str | None = None, last: date | str | None = None) -> DataFrame:
    """The kept bars of ``interval``."""
    return read_core(spark, f"{rollup_folder(core, interval)}/{BARS}", first, last).select(BAR_COLUMNS)
