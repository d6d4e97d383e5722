"""Column names and types shared by every layer.

Timestamps are zone-free exchange wall-clock values and prices are exact
decimals: day edges do not move with the session time zone, and equality on
prices is meaningful.
"""

from pyspark.sql import types as T

# The two timeframes that are landed and loaded.
DAILY = "daily"
INTRADAY = "1min"
TIMEFRAMES = (DAILY, INTRADAY)

# The tickers followed by default.
DEFAULT_SYMBOLS = ("TSLA", "AAPL", "NVDA", "AMD", "GOOG")

# Texts by which the vendor's service refuses a request, and asks to slow down.
ERROR_MARKER = "Error Message"
THROTTLE_MARKER = "Thank you for using Alpha Vantage!"

PRICE = T.DecimalType(18, 4)

# A landed CSV file, in file order (CSV columns bind by position).
RAW_BAR = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("open", PRICE),
        T.StructField("high", PRICE),
        T.StructField("low", PRICE),
        T.StructField("close", PRICE),
        T.StructField("volume", T.LongType()),
    ]
)

CORE_BAR = T.StructType(
    [
        T.StructField("symbol_name", T.StringType()),
        T.StructField("timeseries_name", T.StringType()),
        *RAW_BAR.fields,
    ]
)

# When a stored bar was landed: the later one of two wins, whichever is loaded last.
LANDING = T.StructType([T.StructField("load_date", T.DateType()), T.StructField("landed_at", T.TimestampType())])

# The stored table adds the landing and the columns it is partitioned by.
CORE_TABLE = T.StructType(
    [
        *CORE_BAR.fields,
        *LANDING.fields,
        T.StructField("yyyymm", T.IntegerType()),
        T.StructField("trade_date", T.DateType()),
    ]
)

VALUE_COLUMNS = ["open", "high", "low", "close", "volume"]
BAR_COLUMNS = CORE_BAR.fieldNames()
BAR_KEY = ["symbol_name", "timeseries_name", "timestamp"]

MART_COLUMNS = [
    "symbol_name",
    "daily_volume",
    "daily_open",
    "daily_close",
    "daily_volatility",
    "timestamp_with_max_volume",
    "timestamp_with_max_high",
    "timestamp_with_min_low",
]
