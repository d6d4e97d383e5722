"""What was landed and what came of it: a ledger of files, and the list of what is to be fetched again.

A load notes the state of every file it has read: ``ok`` if it had bars, else ``error``,
``throttled`` or ``malformed``. What counts is the last state of a slice, which is a symbol and
timeframe and the month that the file's name begins with, if it does.
"""

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators.backfill import backfill_grid, missing_months
from candlewick.schema import INTRADAY
from candlewick.sources.payloads import ERROR, MALFORMED, OK, THROTTLED
from candlewick.sources.raw_layer import LANDED_AT, SOURCE_FILE, folder_value

MISSING = "missing"
FILE = ["load_date", "symbol_name", "timeseries_name", SOURCE_FILE, LANDED_AT]
LEDGER = T.StructType(
    [
        T.StructField("symbol_name", T.StringType()),
        T.StructField("timeseries_name", T.StringType()),
        T.StructField(SOURCE_FILE, T.StringType()),
        T.StructField(LANDED_AT, T.TimestampType()),
        T.StructField("month", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("load_date", T.DateType()),
        T.StructField("written_by", T.StringType()),
    ]
)


def ledger_of(quarantine: str) -> str:
    return f"{quarantine.rstrip('/')}_landings"


def record_landings(bars: DataFrame, refused: DataFrame, ledger: str, written_by: str) -> None:
    """Note the state of every file that rows came from, in place of what the same writer has noted for the date.

    A file refused whole has its reason as its state; of the others one with any bar is ``ok``.
    """
    path = F.col(SOURCE_FILE)
    files = bars.select("load_date", SOURCE_FILE, LANDED_AT, F.lit(OK).alias("state")).unionByName(refused.select("load_date", SOURCE_FILE, LANDED_AT, F.col("payload_class").alias("state")))
    states = files.groupBy("load_date", SOURCE_FILE, LANDED_AT).agg(*[F.bool_or(F.col("state") == s).alias(s) for s in (ERROR, THROTTLED, OK)])
    state = F.when(F.col(ERROR), ERROR).when(F.col(THROTTLED), THROTTLED).when(F.col(OK), OK).otherwise(MALFORMED)
    named = states.select(
        # A payload may hold other series than its folder says; the folder is what was asked for.
        folder_value(path, 3, "symbol_name=").alias("symbol_name"),
        folder_value(path, 2, "timeseries_name=").alias("timeseries_name"),
        SOURCE_FILE,
        LANDED_AT,
        F.nullif(F.regexp_extract(F.substring_index(path, "/", -1), r"^(\d{4}-\d{2})_", 1), F.lit("")).alias("month"),
        state.alias("state"),
        "load_date",
        F.lit(written_by).alias("written_by"),
    )
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_date", "written_by").parquet(ledger)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def open_refusals(ledger: DataFrame) -> DataFrame:
    """``symbol_name``, ``timeseries_name``, ``month``, ``load_date``, ``state`` of the slices whose last file was no good.

    The last file is that of the latest load date, then the one landed last; of files landed at once a good one counts.
    """
    last = F.max(F.struct("load_date", LANDED_AT, (F.col("state") == OK).alias("good"), "state")).alias("last")
    slices = ledger.groupBy("symbol_name", "timeseries_name", "month").agg(last)
    return slices.where(F.col("last.state") != OK).select("symbol_name", "timeseries_name", "month", "last.load_date", "last.state")


def refetch_list(ledger: DataFrame, intraday: DataFrame, as_of: date | str, months: int = 6) -> DataFrame:
    """What to ask the vendor for again: open refusals, and months of 1-minute bars that were never landed.

    A missing month that was refused comes once, with the refusal's state and load date. Symbols are those
    of the ledger and of the bars.
    """
    refused = open_refusals(ledger)
    symbols = ledger.select("symbol_name").union(intraday.select("symbol_name")).distinct()
    gaps = missing_months(backfill_grid(symbols, as_of, months), intraday).withColumn("timeseries_name", F.lit(INTRADAY))
    key = ["symbol_name", "timeseries_name", "month"]
    joined = gaps.withColumn("gap", F.lit(True)).join(refused, key, "full_outer")
    return joined.select(*key, "load_date", F.coalesce("state", F.lit(MISSING)).alias("state"))
