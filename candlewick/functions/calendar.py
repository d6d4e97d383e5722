"""Trading-day arithmetic on zone-free timestamps.

Every function takes its day as a parameter; none reads the clock, so a query
gives the same result whenever it runs.
"""

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_date(day: date | str) -> date:
    return day if isinstance(day, date) else date.fromisoformat(day)


def previous_local_day(instant: str | datetime, zone: str) -> date:
    """The day before the one that it is in ``zone`` at ``instant``; an instant without an offset is in UTC."""
    at = datetime.fromisoformat(instant) if isinstance(instant, str) else instant
    at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    return at.astimezone(ZoneInfo(zone)).date() - timedelta(days=1)


def midnight(day: date | str) -> Column:
    """The zone-free timestamp at which ``day`` starts."""
    return F.lit(as_date(day)).cast("timestamp_ntz")


def trade_date(ts: Column | str = "timestamp") -> Column:
    return F.to_date(ts)


def month_key(ts: Column | str = "timestamp") -> Column:
    """The month of ``ts`` as an integer such as 202401."""
    return F.year(ts) * 100 + F.month(ts)


def with_partition_columns(bars: DataFrame) -> DataFrame:
    return bars.withColumns({"yyyymm": month_key(), "trade_date": trade_date()})


def between_days(df: DataFrame, first: date | str, last: date | str) -> DataFrame:
    """Rows of ``first`` to ``last``, both included.

    The half-open timestamp range reaches Parquet and JDBC scans. Where the
    frame carries the core table's partition columns the same range is put on
    them, since a predicate on ``timestamp`` alone prunes no folder.
    """
    first, last = as_date(first), as_date(last)
    kept = df.where(
        (F.col("timestamp") >= midnight(first))
        & (F.col("timestamp") < midnight(last + timedelta(days=1)))
    )
    if "yyyymm" in df.columns:
        months = [d.year * 100 + d.month for d in (first, last)]
        kept = kept.where(F.col("yyyymm").between(*months))
    if "trade_date" in df.columns:
        kept = kept.where(F.col("trade_date").between(F.lit(first), F.lit(last)))
    return kept


def on_day(df: DataFrame, day: date | str) -> DataFrame:
    return between_days(df, day, day)


def month_slice(df: DataFrame, month: str) -> DataFrame:
    """Rows of one ``YYYY-MM`` month."""
    first = date.fromisoformat(f"{month}-01")
    following = (first + timedelta(days=31)).replace(day=1)
    return between_days(df, first, following - timedelta(days=1))


def trailing_days(df: DataFrame, as_of: date | str, days: int = 30) -> DataFrame:
    """Rows from ``days`` days before ``as_of`` up to the end of ``as_of``."""
    as_of = as_date(as_of)
    return between_days(df, as_of - timedelta(days=days), as_of)


def local_date(instant: Column | str, zone: str, days_back: int = 0) -> Column:
    """The date in ``zone`` at a zone-free UTC ``instant``, ``days_back`` days earlier."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(instant) if isinstance(instant, str) else instant)
    return F.date_sub(F.to_date(local), days_back)
