"""Which months of intraday bars should be there, and which are missing."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.calendar import as_date


def backfill_grid(symbols: DataFrame, as_of: date | str, months: int = 6) -> DataFrame:
    """``(symbol_name, month)`` for the last ``months`` calendar months, newest first."""
    newest = F.lit(as_date(as_of).replace(day=1))
    back = F.explode(F.sequence(newest, F.add_months(newest, 1 - months), F.expr("interval -1 month")))
    return symbols.select("symbol_name", back.alias("first_day")).select(
        "symbol_name", F.date_format("first_day", "yyyy-MM").alias("month")
    )


def landed_months(intraday: DataFrame) -> DataFrame:
    """``(symbol_name, month)`` pairs for which bars are there."""
    return (
        intraday.where(F.col("timestamp").isNotNull())
        .select("symbol_name", F.date_format(F.to_date("timestamp"), "yyyy-MM").alias("month"))
        .distinct()
    )


def missing_months(grid: DataFrame, intraday: DataFrame) -> DataFrame:
    """The part of the grid without any bar."""
    return grid.join(landed_months(intraday), ["symbol_name", "month"], "left_anti")
