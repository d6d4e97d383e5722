"""Price-change measures. Operands become doubles first; a zero divisor gives NULL."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _double(price: str) -> Column:
    return F.col(price).cast("double")


def daily_volatility(open_: str = "daily_open", close: str = "daily_close") -> Column:
    """Open-to-close change in percent of the **close**."""
    return 100 - F.try_divide(_double(open_) * 100, _double(close))


def pct_change_from_open(open_: str = "daily_open", close: str = "daily_close") -> Column:
    """Open-to-close change in percent of the **open**."""
    return F.try_divide((_double(close) - _double(open_)) * 100, _double(open_))
