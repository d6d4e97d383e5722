"""The core table: Parquet bars in month folders, one folder per trading day within.

The day level keeps a nightly load from rewriting a whole month, and lets the
last-day mart read one day's files. A stored bar carries its load date and landing time.

Days are replaced through a pending folder within the table (readers of files skip it, as its name starts with an
underscore): the new days are complete in it, and marked so, before a stored day
is touched. :func:`read_core` takes a day from there until it is in its place, so no reader finds
a day missing. What a load leaves behind when it is cut off, the next one finishes (marked) or drops
(not marked). Loads of one table take turns.

Beside the days lie two small tables: the number of bars of every series per day, and for every kept
rollup the days that have changed since it was brought up to date.
"""

import uuid
from datetime import date, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.calendar import as_date, between_days, trade_date, with_partition_columns
from candlewick.operators.bars import unique_bars
from candlewick.schema import BAR_COLUMNS, BAR_KEY, CORE_TABLE, LANDING, VALUE_COLUMNS
from candlewick.sources import folders
from candlewick.workspace import temporary_tables

PARTITIONS = ["yyyymm", "trade_date"]
SORT_KEY = ["symbol_name", "timestamp", "timeseries_name"]
STORED = [*BAR_COLUMNS, *LANDING.fieldNames()]
PENDING, COMPLETE = "_pending", "_COMPLETE"
COUNTS = "_series_counts"
ROLLUPS, CHANGED = "_rollups", "changed"

SERIES_COUNTS = T.StructType(
    [
        T.StructField("symbol_name", T.StringType()),
        T.StructField("timeseries_name", T.StringType()),
        T.StructField("bars", T.LongType()),
        *[f for f in CORE_TABLE.fields if f.name in PARTITIONS],
    ]
)


def _day(folder: str) -> date:
    return as_date(folder.split("=")[-1])


def _day_folder(day: date) -> str:
    return f"yyyymm={day.year * 100 + day.month}/trade_date={day}"


def stored_days(spark: SparkSession, path: str) -> list[date]:
    """The days of the folders below ``path``, in order, by listing month and day folders."""
    months = [m for m in folders.children(spark, path) if m.startswith(f"{PARTITIONS[0]}=")]
    return [_day(d) for m in months for d in folders.children(spark, f"{path.rstrip('/')}/{m}") if d.startswith(f"{PARTITIONS[1]}=")]


def _pending_days(spark: SparkSession, path: str, below: str = "") -> dict[date, str]:
    """The days that are complete in pending folders, and the folder each is read from until it is moved."""
    pending = f"{path.rstrip('/')}/{PENDING}"
    found: dict[date, str] = {}
    for name in folders.children(spark, pending):
        if folders.exists(spark, f"{pending}/{name}/{COMPLETE}"):
            root = f"{pending}/{name}{below}"
            found |= {day: root for day in stored_days(spark, root) if day not in found}
    return found


def day_folders(spark: SparkSession, path: str, first: date | str, last: date | str) -> list[str]:
    """The stored folders of ``first`` to ``last``; asks for each day, lists nothing else."""
    first, last = as_date(first), as_date(last)
    named = [f"{path.rstrip('/')}/{_day_folder(first + timedelta(days=i))}" for i in range((last - first).days + 1)]
    return [f for f in named if folders.exists(spark, f)]


def read_core(spark: SparkSession, path: str, first: date | str | None = None, last: date | str | None = None) -> DataFrame:
    """The stored bars, with ``first`` and ``last`` of these days only; an absent table reads as an empty one.

    With days only their folders are listed, however many the table has.
    """
    pending = _pending_days(spark, path)
    if first is not None and last is not None:
        first, last = as_date(first), as_date(last)
        moving = {day: root for day, root in pending.items() if first <= day <= last}
        still = [f for f in day_folders(spark, path, first, last) if _day(f) not in moving]
        return between_days(_of_folders(spark, CORE_TABLE, path, still, moving), first, last)
    return _whole(spark, CORE_TABLE, path, pending)


def read_core_days(spark: SparkSession, path: str, days: list[date]) -> DataFrame:
    """The stored bars of some days, of which each is stored; only their folders are listed."""
    pending = _pending_days(spark, path)
    still = [f"{path.rstrip('/')}/{_day_folder(day)}" for day in days if day not in pending]
    return _of_folders(spark, CORE_TABLE, path, still, {day: pending[day] for day in days if day in pending})


def series_counts(spark: SparkSession, path: str) -> DataFrame:
    """``symbol_name``, ``timeseries_name``, ``bars``, ``trade_date``: how many bars every series has on every day.

    Bars are read only of days without stored counts, which a table written without them has.
    """
    root, pending = f"{path.rstrip('/')}/{COUNTS}", _pending_days(spark, path, f"/{COUNTS}")
    counts = _whole(spark, SERIES_COUNTS, root, pending)
    uncounted = sorted({*stored_days(spark, path), *_pending_days(spark, path)} - {*stored_days(spark, root), *pending})
    if uncounted:
        counts = counts.unionByName(_counted(read_core_days(spark, path, uncounted)))
    return counts.drop("yyyymm")


def _counted(stored: DataFrame) -> DataFrame:
    return stored.groupBy(*PARTITIONS, "symbol_name", "timeseries_name").agg(F.count("*").alias("bars"))


def _whole(spark: SparkSession, schema: T.StructType, path: str, pending: dict[date, str]) -> DataFrame:
    try:
        stored = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], schema)
    if not pending:
        return stored
    return stored.where(~F.col("trade_date").isin(list(pending))).unionByName(_of_folders(spark, schema, path, [], pending))


def _of_folders(spark: SparkSession, schema: T.StructType, path: str, still: list[str], moving: dict[date, str]) -> DataFrame:
    """Days read from their places and from where they are pending."""
    by_root = {path: still} if still else {}
    for day, root in moving.items():
        by_root.setdefault(root, []).append(f"{root}/{_day_folder(day)}")
    found = [spark.read.schema(schema).option("basePath", root).parquet(*named) for root, named in by_root.items()]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def with_landing(bars: DataFrame) -> DataFrame:
    """The stored columns; bars that say nothing of their landing count as landed now."""
    defaults = {"load_date": F.lit(None).cast("date"), "landed_at": F.current_timestamp()}
    return bars.withColumns({c: v for c, v in defaults.items() if c not in bars.columns}).select(STORED)


def replace_days(bars: DataFrame, path: str) -> list[date]:
    """Write bars, replacing exactly the days they belong to, and give these.

    The rebalance hint shuffles by day, then splits large days and joins small
    ones by size, so neither a busy day nor a hot symbol ends up in one task.
    Files are sorted for row-group skipping by symbol and time, and where names are too many for a dictionary
    a Bloom filter tells which row groups have a symbol.
    """
    spark = bars.sparkSession
    staged = f"{path.rstrip('/')}/{PENDING}/{uuid.uuid4().hex}"
    (
        with_partition_columns(with_landing(bars))
        .hint("rebalance", *PARTITIONS)
        .sortWithinPartitions(*PARTITIONS, *SORT_KEY)
        .write.partitionBy(*PARTITIONS)
        .option("parquet.bloom.filter.enabled#symbol_name", "true")
        .option("parquet.bloom.filter.expected.ndv#symbol_name", "100000")
        .parquet(staged)
    )
    counts = _counted(spark.read.schema(CORE_TABLE).parquet(staged))
    counts.hint("rebalance", *PARTITIONS).write.partitionBy(*PARTITIONS).parquet(f"{staged}/{COUNTS}")
    folders.mark(spark, f"{staged}/{COMPLETE}")
    return _move_in(spark, staged, path)


def _move_in(spark: SparkSession, staged: str, path: str) -> list[date]:
    """Put every staged day in its place; a day is staged until it is there."""
    days, rollups = stored_days(spark, staged), kept_rollups(spark, path)
    for day in days:
        for rollup in rollups:
            folders.mark(spark, f"{rollup_folder(path, rollup)}/{CHANGED}/{day}")
        for below in (f"/{COUNTS}", ""):
            source = f"{staged}{below}/{_day_folder(day)}"
            if not folders.exists(spark, source):
                continue  # the counts were moved before a cut
            target = f"{path.rstrip('/')}{below}/{_day_folder(day)}"
            folders.delete(spark, target)
            folders.move(spark, source, target)
    folders.delete(spark, staged)
    return days


def rollup_folder(path: str, interval: str) -> str:
    return f"{path.rstrip('/')}/{ROLLUPS}/{interval}"


def kept_rollups(spark: SparkSession, path: str) -> list[str]:
    """The intervals of which coarser bars are kept with the table."""
    return folders.children(spark, f"{path.rstrip('/')}/{ROLLUPS}")


def settle(spark: SparkSession, path: str) -> None:
    """Finish replacements that were cut off after they were complete, drop the others."""
    pending = f"{path.rstrip('/')}/{PENDING}"
    for name in folders.children(spark, pending):
        if folders.exists(spark, f"{pending}/{name}/{COMPLETE}"):
            _move_in(spark, f"{pending}/{name}", path)
        else:
            folders.delete(spark, f"{pending}/{name}")


def merge_bars(bars: DataFrame, path: str) -> list[date]:
    """Add bars to the core table; of two under the same key the one landed later stays. The days that changed are given.

    Loading the same bars twice therefore changes nothing, and neither does loading older ones
    again. Keys must be complete (``well_formed`` sees to that for landed files).
    """
    with temporary_tables(bars.sparkSession, "merge") as kept_as:
        return merge_unique_bars(kept_as(unique_bars(with_landing(bars), keep_landing=True), "loaded"), path)


def merge_unique_bars(bars: DataFrame, path: str) -> list[date]:
    """As :func:`merge_bars`, for bars that are unique by key and cheap to read again.

    Only loaded days are read, and of these only such are rewritten in which some bar is new or gives way.
    """
    spark = bars.sparkSession
    settle(spark, path)
    loaded = with_landing(bars)
    # One row, from a scan of the loaded timestamps.
    days = loaded.agg(
        F.to_date(F.min("timestamp")).alias("first"), F.to_date(F.max("timestamp")).alias("last")
    ).first()
    if days.first is None:
        return []
    # At most one row per calendar day from first to last, hence the broadcast.
    loaded_days = F.broadcast(loaded.select(trade_date().alias("trade_date")).distinct())
    stored = read_core(spark, path, days.first, days.last).join(loaded_days, "trade_date", "left_semi").select(STORED)
    if stored.isEmpty():
        return replace_days(loaded, path)
    changed = changed_days(stored, loaded)
    if not changed:
        return []
    merged = unique_bars(stored.unionByName(loaded).where(trade_date().isin(changed)), keep_landing=True)
    return replace_days(merged, path)


def changed_days(stored: DataFrame, loaded: DataFrame) -> list[date]:
    """The days on which merging ``loaded`` into ``stored`` gives other rows than there are; one date a day comes to the driver."""
    row = F.struct(*LANDING.fieldNames(), *VALUE_COLUMNS)
    both = stored.withColumn("is_stored", F.lit(True)).unionByName(loaded.withColumn("is_stored", F.lit(False)))
    best = both.groupBy(BAR_KEY).agg(F.max(row).alias("best"), F.max(F.when(F.col("is_stored"), row)).alias("was"))
    other = best.where(~F.col("best").eqNullSafe(F.col("was")))
    return sorted(r["d"] for r in other.select(trade_date().alias("d")).distinct().collect())
