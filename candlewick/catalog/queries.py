"""One query per operator, over the whole of the given tables.

Each takes a session and the folder of the tables. Single-day queries use the
same as-of day.
"""

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.catalog.event_bars import all_bars, daily_bars, intraday_bars
from candlewick.functions.calendar import local_date, month_slice, on_day, trailing_days
from candlewick.functions.prices import daily_volatility, pct_change_from_open
from candlewick.operators import aggregates, backfill, bars, dimensions, lookups
from candlewick.operators.resample import daily_from_intraday, resample
from candlewick.plans.job import run
from candlewick.plans.landings import ledger_of, read_ledger
from candlewick.plans.landings import refetch_list as open_fetches
from candlewick.plans.loads import delta_bars, delta_load, initial_load, quarantine_of
from candlewick.plans.mart import daily_marts, last_day_mart
from candlewick.plans.rollup import keep_rollup, read_rollup, refresh_rollups
from candlewick.plans.stored import latest_from_core, min_date_from_core, symbols_from_core
from candlewick.schema import BAR_COLUMNS, DAILY, INTRADAY, RAW_BAR, VALUE_COLUMNS
from candlewick.schema import THROTTLE_MARKER as THROTTLE_TEXT
from candlewick.sources import core_table, folders, payloads, raw_layer
from candlewick.streaming.landing import start_delta_stream
from candlewick.workspace import new_folder, written

AS_OF = date(2024, 1, 15)
LANDED = date(2024, 1, 31)
LANDED_NEXT = date(2024, 2, 1)
TRIM_TO = date(2024, 1, 20)
FOLLOWED = ["click", "purchase", "view"]
ERROR_MARKER = "license"
THROTTLE_MARKER = "@"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def _stored(spark: SparkSession, sf_dir: str, day: date | None = None) -> DataFrame:
    """Bars read from a core table, for queries that read them several times."""
    path = new_folder(spark, "core")
    core_table.replace_days(all_bars(spark, sf_dir, day), path)
    return core_table.read_core(spark, path)


def _landed(spark: SparkSession, sf_dir: str, load_date: date = LANDED) -> str:
    root = new_folder(spark, "raw")
    raw_layer.write_raw_layer(all_bars(spark, sf_dir), root, load_date)
    return root


# Sources and sinks


@query
def csv_scan_typed(spark, sf_dir):
    return raw_layer.scan_csv(spark, f"{_landed(spark, sf_dir)}/*/*/*", RAW_BAR)


@query
def csv_scan_untyped(spark, sf_dir):
    return raw_layer.scan_csv(spark, f"{_landed(spark, sf_dir)}/*/*/*")


@query
def raw_layer_scan(spark, sf_dir):
    landed = raw_layer.scan_raw_layer(spark, _landed(spark, sf_dir), LANDED)
    return raw_layer.well_formed(landed).select(BAR_COLUMNS)


@query
def raw_layer_sink(spark, sf_dir):
    """Everything is landed, then the daily files again with other volumes."""
    root = _landed(spark, sf_dir)
    corrected = daily_bars(spark, sf_dir).withColumn("volume", F.col("volume") + 1)
    raw_layer.write_raw_layer(corrected, root, LANDED)
    partitions = "load_date date, symbol_name string, timeseries_name string"
    back = spark.read.schema(f"{RAW_BAR.toDDL()}, {partitions}").option("header", True).csv(root)
    return back.select("load_date", *BAR_COLUMNS)


@query
def core_table_scan(spark, sf_dir):
    return _stored(spark, sf_dir).select(*BAR_COLUMNS, *core_table.PARTITIONS)


@query
def payload_screen(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return payloads.screen_texts(texts, "text", ERROR_MARKER, THROTTLE_MARKER).select("doc_id", "payload_class")


@query
def json_timeseries(spark, sf_dir):
    """Bars rendered as JSON payloads, one per symbol and hour, and read back."""
    hour = F.window("timestamp", "1 hour")
    stamp = F.col("timestamp").cast("string")
    bar = F.struct(*[F.col(c).cast("string").alias(f) for c, f in payloads.JSON_FIELDS.items()])
    # 60 one-minute bars at most.
    series = F.map_from_entries(F.collect_list(F.struct(stamp, bar)))
    rendered = (
        intraday_bars(spark, sf_dir)
        .groupBy("symbol_name", hour)
        .agg(series.alias("series"))
        .select(
            F.to_json(
                F.struct(
                    F.create_map(F.lit(payloads.SYMBOL_FIELD), F.col("symbol_name")).alias("Meta Data"),
                    F.col("series").alias("Time Series (1min)"),
                )
            ).alias("payload")
        )
    )
    return payloads.bars_from_json(rendered, "payload")


def _payloads(stored, series):
    """One JSON payload per symbol and day (1,440 one-minute bars at most) with all the named ``series`` of timeframes."""
    stamp = F.col("timestamp").cast("string")
    bar = F.struct(*[F.col(c).cast("string").alias(f) for c, f in payloads.JSON_FIELDS.items()])
    lists = [F.map_from_entries(F.collect_list(F.when(F.col("timeseries_name") == timeframe, F.struct(stamp, bar)))).alias(name) for name, timeframe in series.items()]
    meta = F.create_map(F.lit(payloads.SYMBOL_FIELD), F.col("symbol_name")).alias(payloads.META_FIELD)
    return stored.groupBy("symbol_name", F.to_date("timestamp")).agg(*lists).select("symbol_name", meta, *[F.col(f"`{name}`") for name in series])


@query
def json_all_series(spark, sf_dir):
    """Payloads with four series each, one of them of a name that no table lists."""
    finer = intraday_bars(spark, sf_dir)
    stored = bars.union_bars(all_bars(spark, sf_dir), resample(finer, "5min"))
    series = {"Time Series (Daily)": DAILY, "Time Series (1min)": INTRADAY, "Time Series (5min)": "5min", "Adjusted": DAILY}
    rendered = _payloads(stored, series).select(F.to_json(F.struct(F.col(f"`{payloads.META_FIELD}`"), *[F.col(f"`{n}`") for n in series])).alias("payload"))
    return payloads.bars_from_json(rendered, "payload")


@query
def json_timeseries_unreadable(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return payloads.unreadable_payloads(texts, "text").select("doc_id", "text", "reason")


# Projections and scalar expressions


@query
def project_daily(spark, sf_dir):
    return bars.project_daily(daily_bars(spark, sf_dir), "timestamp")


@query
def with_literals(spark, sf_dir):
    return bars.with_names(intraday_bars(spark, sf_dir).select(RAW_BAR.fieldNames()), "ALL", INTRADAY)


def _changes(spark, sf_dir, name, change):
    daily = bars.project_daily(daily_bars(spark, sf_dir), "timestamp")
    return daily.select("symbol_name", "timestamp", change.alias(name))


@query
def daily_volatility_(spark, sf_dir):
    return _changes(spark, sf_dir, "daily_volatility", daily_volatility())


@query
def pct_change_from_open_(spark, sf_dir):
    return _changes(spark, sf_dir, "pct_change_from_open", pct_change_from_open())


@query
def as_of_dates(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        "event_id",
        local_date("ts", "UTC", 1).alias("utc_yesterday"),
        local_date("ts", "America/New_York").alias("eastern_today"),
        local_date("ts", "America/New_York", 1).alias("eastern_yesterday"),
    )


# Filters


@query
def filter_timeframe(spark, sf_dir):
    return bars.of_timeframe(all_bars(spark, sf_dir), DAILY)


@query
def filter_as_of(spark, sf_dir):
    return on_day(all_bars(spark, sf_dir, AS_OF), AS_OF)


@query
def filter_delta_day(spark, sf_dir):
    return delta_bars(all_bars(spark, sf_dir, AS_OF), AS_OF)


@query
def filter_date_range(spark, sf_dir):
    return aggregates.since_first_intraday(
        daily_bars(spark, sf_dir), intraday_bars(spark, sf_dir), F.lit(TRIM_TO)
    )


@query
def filter_followed_symbols(spark, sf_dir):
    followed = bars.symbol_list(spark, FOLLOWED)
    return bars.followed_symbols(all_bars(spark, sf_dir), followed).select(BAR_COLUMNS)


# Lookups, for every day


def _lookup(spark, sf_dir, function, match):
    sides = [intraday_bars(spark, sf_dir)]
    if function is not lookups.max_volume_time:
        sides.append(daily_bars(spark, sf_dir))
    return function(*sides, match)


@query
def lookup_max_volume_value(spark, sf_dir):
    return _lookup(spark, sf_dir, lookups.max_volume_time, "value")


@query
def lookup_max_volume_keyed(spark, sf_dir):
    return _lookup(spark, sf_dir, lookups.max_volume_time, "keyed")


@query
def lookup_high_value(spark, sf_dir):
    return _lookup(spark, sf_dir, lookups.max_high_time, "value")


@query
def lookup_high_keyed(spark, sf_dir):
    return _lookup(spark, sf_dir, lookups.max_high_time, "keyed")


@query
def lookup_low_value(spark, sf_dir):
    return _lookup(spark, sf_dir, lookups.min_low_time, "value")


@query
def lookup_low_keyed(spark, sf_dir):
    return _lookup(spark, sf_dir, lookups.min_low_time, "keyed")


# Aggregations, ordering, set operations


@query
def agg_max_volume(spark, sf_dir):
    return aggregates.max_volume(intraday_bars(spark, sf_dir))


@query
def agg_first_bar(spark, sf_dir):
    return aggregates.first_timestamp(intraday_bars(spark, sf_dir))


@query
def min_intraday_date(spark, sf_dir):
    return aggregates.min_date(intraday_bars(spark, sf_dir))


@query
def first_bar_top1(spark, sf_dir):
    return bars.first_bar(intraday_bars(spark, sf_dir))


@query
def ordered_bars(spark, sf_dir):
    return bars.ordered_bars(all_bars(spark, sf_dir))


@query
def union_timeframes(spark, sf_dir):
    return bars.union_bars(intraday_bars(spark, sf_dir), daily_bars(spark, sf_dir))


# Pipelines


@query
def pipeline_initial(spark, sf_dir):
    """Landed on the trim date, so later daily bars are cut off."""
    core = new_folder(spark, "core")
    initial_load(spark, _landed(spark, sf_dir, TRIM_TO), core, TRIM_TO)
    return core_table.read_core(spark, core).select(BAR_COLUMNS)


@query
def pipeline_delta(spark, sf_dir):
    """A full load, then one day with corrected volumes, loaded twice."""
    raw, core = _landed(spark, sf_dir), new_folder(spark, "core")
    initial_load(spark, raw, core, LANDED)
    corrected = all_bars(spark, sf_dir).withColumn("volume", F.col("volume") + 1)
    raw_layer.write_raw_layer(corrected, raw, LANDED_NEXT)
    for _ in range(2):
        delta_load(spark, raw, core, LANDED_NEXT, AS_OF)
    return core_table.read_core(spark, core).select(BAR_COLUMNS)


@query
def pipeline_delta_out_of_order(spark, sf_dir):
    """As ``pipeline_delta``, and then the older landing once more: the newer values stay."""
    raw, core = _landed(spark, sf_dir), new_folder(spark, "core")
    initial_load(spark, raw, core, LANDED)
    corrected = all_bars(spark, sf_dir).withColumn("volume", F.col("volume") + 1)
    raw_layer.write_raw_layer(corrected, raw, LANDED_NEXT)
    for load_date in (LANDED_NEXT, LANDED):
        delta_load(spark, raw, core, load_date, AS_OF)
    return core_table.read_core(spark, core).select(BAR_COLUMNS)


def _landed_with_refusals(spark, sf_dir):
    """Everything landed, with an error text per nation, a slow-down text per region among copies of all
    daily bars with other volumes, and a broken line per region in files of their own."""
    root = _landed(spark, sf_dir)
    place = f"{root}/load_date={LANDED}/symbol_name={{}}/timeseries_name={{}}"
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.concat(F.lit('{"Error Message": "'), "n_name", F.lit('"}')))
    regions = spark.read.parquet(f"{sf_dir}/region.parquet")
    slow = regions.select(F.concat_ws(" ", F.lit(THROTTLE_TEXT), "r_name"))
    daily = daily_bars(spark, sf_dir).select(F.concat_ws(",", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), "open", "high", "low", "close", F.col("volume") + 7))
    broken = regions.select(F.concat(F.lit("broken,"), "r_name"))
    for lines, symbol, timeframe in ((nations, "click", INTRADAY), (daily.union(slow).coalesce(1), "purchase", DAILY), (broken, "view", INTRADAY)):
        lines.write.mode("append").text(place.format(symbol, timeframe))
    return root


@query
def pipeline_screened(spark, sf_dir):
    core = new_folder(spark, "core")
    initial_load(spark, _landed_with_refusals(spark, sf_dir), core, LANDED)
    return core_table.read_core(spark, core).select(BAR_COLUMNS)


@query
def pipeline_quarantine(spark, sf_dir):
    core = new_folder(spark, "core")
    initial_load(spark, _landed_with_refusals(spark, sf_dir), core, LANDED)
    kept = spark.read.parquet(quarantine_of(core))
    return kept.select("load_date", "symbol_name", "timeseries_name", "timestamp", "volume", "malformed_line", "payload_class")


def _landed_as_json(spark, sf_dir):
    """Two symbols as CSV, the others as a JSON file per day with both series; an error payload per nation, and per region
    one with a bar that has no time and one that has no prices."""
    root = new_folder(spark, "raw")
    everything = all_bars(spark, sf_dir)
    as_csv = F.col("symbol_name").isin("click", "view")
    raw_layer.write_raw_layer(everything.where(as_csv), root, LANDED)
    days = _payloads(everything.where(~as_csv), {"Time Series (Daily)": DAILY, "Time Series (1min)": INTRADAY})
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.lit("click").alias("symbol_name"), F.col("n_name").alias("Error Message"))
    odd = F.lit('{"soon":{"1. open":"1"},"2024-01-01 00:00:00":{"1. open":"x"}}')
    regions = spark.read.parquet(f"{sf_dir}/region.parquet").select(
        F.col("r_name").alias("symbol_name"), F.create_map(F.lit("1. Information"), F.col("r_name")).alias(payloads.META_FIELD),
        F.from_json(odd, "map<string,map<string,string>>").alias("Time Series (1min)"),
    )
    for files in (days, nations, regions):
        named = files.withColumns({"load_date": F.lit(str(LANDED)), "timeseries_name": F.lit(INTRADAY)})
        named.write.mode("append").option("maxRecordsPerFile", 1).partitionBy("load_date", "symbol_name", "timeseries_name").json(root)
    return root


@query
def pipeline_json(spark, sf_dir):
    core = new_folder(spark, "core")
    initial_load(spark, _landed_as_json(spark, sf_dir), core, LANDED)
    return core_table.read_core(spark, core).select(BAR_COLUMNS)


@query
def pipeline_json_quarantine(spark, sf_dir):
    core = new_folder(spark, "core")
    initial_load(spark, _landed_as_json(spark, sf_dir), core, LANDED)
    kept = spark.read.parquet(quarantine_of(core))
    return kept.select("load_date", "symbol_name", "timeseries_name", "timestamp", "malformed_line", "payload_class", "reason")


@query
def refetch_list(spark, sf_dir):
    """What is open after a night of refusals and another on which one of the refused series was landed."""
    raw, core = _landed_with_refusals(spark, sf_dir), new_folder(spark, "core")
    initial_load(spark, raw, core, LANDED)
    raw_layer.write_raw_layer(daily_bars(spark, sf_dir).where(F.col("symbol_name") == "purchase"), raw, LANDED_NEXT)
    delta_load(spark, raw, core, LANDED_NEXT, LANDED)
    ledger = read_ledger(spark, ledger_of(quarantine_of(core)))
    return open_fetches(ledger, bars.of_timeframe(core_table.read_core(spark, core), INTRADAY), LANDED)


def _corrected(spark, sf_dir):
    """A core table after a full load and a day's delta load of corrected volumes, with its raw layer and its files before the latter."""
    raw, core = _landed(spark, sf_dir), new_folder(spark, "core")
    initial_load(spark, raw, core, LANDED)
    file = F.col("_metadata.file_path").alias("file")
    before = written(core_table.read_core(spark, core).select("trade_date", file).distinct(), "files")
    raw_layer.write_raw_layer(all_bars(spark, sf_dir).withColumn("volume", F.col("volume") + 1), raw, LANDED_NEXT)
    delta_load(spark, raw, core, LANDED_NEXT, AS_OF)
    return raw, core, before


@query
def pipeline_delta_unchanged(spark, sf_dir):
    """After a correction of one day, both loads again: which days have files that were not there before."""
    raw, core, before = _corrected(spark, sf_dir)
    initial_load(spark, raw, core, LANDED)
    delta_load(spark, raw, core, LANDED_NEXT, AS_OF)
    now = core_table.read_core(spark, core).groupBy("trade_date", F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("bars"))
    known = before.withColumn("known", F.lit(True))
    days = now.join(known, ["trade_date", "file"], "left").groupBy("trade_date")
    return days.agg(F.sum("bars").alias("bars"), F.bool_or(F.col("known").isNull()).alias("rewritten"))


@query
def rollup_after_delta(spark, sf_dir):
    """5-minute bars kept through a load whose last hours were late and a delta load that corrects the day."""
    raw, core = new_folder(spark, "raw"), new_folder(spark, "core")
    late = (F.to_date("timestamp") == F.lit(AS_OF)) & (F.hour("timestamp") >= 20)
    raw_layer.write_raw_layer(all_bars(spark, sf_dir).where(~late), raw, LANDED)
    initial_load(spark, raw, core, LANDED)
    keep_rollup(spark, core, "5min")
    refresh_rollups(spark, core)
    raw_layer.write_raw_layer(all_bars(spark, sf_dir).withColumn("volume", F.col("volume") + 1), raw, LANDED_NEXT)
    delta_load(spark, raw, core, LANDED_NEXT, AS_OF)
    refresh_rollups(spark, core)
    return read_rollup(spark, core, "5min")


def _core(spark, sf_dir):
    path = new_folder(spark, "core")
    core_table.replace_days(all_bars(spark, sf_dir), path)
    return path


@query
def latest_100_from_core(spark, sf_dir):
    return latest_from_core(spark, _core(spark, sf_dir), 100)


@query
def min_intraday_date_from_core(spark, sf_dir):
    return min_date_from_core(spark, _core(spark, sf_dir))


@query
def core_followed_scan(spark, sf_dir):
    return symbols_from_core(spark, _core(spark, sf_dir), FOLLOWED).select(BAR_COLUMNS)


def _land_as(spark, bars, raw, load_date):
    """Land bars in files whose names depend on symbol, timeframe and number alone, so landing a series again keeps its names."""
    staged = new_folder(spark, "staged")
    raw_layer.write_raw_layer(bars, staged, load_date)
    for symbol in folders.children(spark, f"{staged}/load_date={load_date}"):
        for timeframe in folders.children(spark, f"{staged}/load_date={load_date}/{symbol}"):
            place = f"load_date={load_date}/{symbol}/{timeframe}"
            parts = [c for c in folders.children(spark, f"{staged}/{place}") if c.startswith("part-")]
            for number, part in enumerate(parts):
                folders.delete(spark, f"{raw}/{place}/bars-{number}.csv")
                folders.move(spark, f"{staged}/{place}/{part}", f"{raw}/{place}/bars-{number}.csv")


@query
def pipeline_stream_corrected(spark, sf_dir):
    """Everything streamed in, then one symbol landed again under the same file names with corrected volumes, and streamed twice."""
    raw, core, checkpoint = (new_folder(spark, name) for name in ("raw", "core", "stream"))
    everything = all_bars(spark, sf_dir)
    _land_as(spark, everything, raw, LANDED)
    start_delta_stream(spark, raw, core, checkpoint).awaitTermination()
    _land_as(spark, everything.where("symbol_name = 'purchase'").withColumn("volume", F.col("volume") + 1), raw, LANDED)
    for _ in range(2):
        start_delta_stream(spark, raw, core, checkpoint, corrections=True, open_from=LANDED).awaitTermination()
    return core_table.read_core(spark, core).select(BAR_COLUMNS)


def _load_then_mart(spark, sf_dir, mode):
    core, mart = new_folder(spark, "core"), new_folder(spark, "mart")
    run(spark, mode, _landed(spark, sf_dir), core, mart, LANDED, AS_OF)
    return spark.read.parquet(mart)


@query
def pipeline_initial_then_mart(spark, sf_dir):
    return _load_then_mart(spark, sf_dir, "initial")


@query
def pipeline_delta_then_mart(spark, sf_dir):
    return _load_then_mart(spark, sf_dir, "delta")


@query
def mart_full(spark, sf_dir):
    """The job's mart with surrogate key and change from the open; the day's symbols are numbered when it is built."""
    core, mart = new_folder(spark, "core"), new_folder(spark, "mart")
    run(spark, "delta", _landed(spark, sf_dir), core, mart, LANDED, AS_OF, full=True)
    return spark.read.parquet(mart)


@query
def mart_last_day(spark, sf_dir):
    return last_day_mart(all_bars(spark, sf_dir, AS_OF), AS_OF)


@query
def mart_last_day_value(spark, sf_dir):
    return last_day_mart(_stored(spark, sf_dir, AS_OF), AS_OF, "value")


@query
def mart_all_days(spark, sf_dir):
    return daily_marts(all_bars(spark, sf_dir))


@query
def mart_all_days_value(spark, sf_dir):
    return daily_marts(_stored(spark, sf_dir), "value")


# Request parameters


@query
def backfill_grid(spark, sf_dir):
    symbols = intraday_bars(spark, sf_dir).select("symbol_name").distinct()
    return backfill.backfill_grid(symbols, LANDED)


@query
def backfill_missing(spark, sf_dir):
    intraday = intraday_bars(spark, sf_dir)
    return backfill.missing_months(
        backfill.backfill_grid(intraday.select("symbol_name").distinct(), LANDED), intraday
    )


@query
def latest_100_bars(spark, sf_dir):
    return bars.latest_bars(all_bars(spark, sf_dir), 100)


@query
def trailing_days_(spark, sf_dir):
    return trailing_days(intraday_bars(spark, sf_dir), TRIM_TO, 10)


@query
def resample_5min(spark, sf_dir):
    return resample(intraday_bars(spark, sf_dir), "5min")


@query
def resample_5min_from_core(spark, sf_dir):
    """From a table that holds daily bars as well."""
    return resample(_stored(spark, sf_dir), "5min")


@query
def resample_15min(spark, sf_dir):
    return resample(intraday_bars(spark, sf_dir), "15min")


@query
def resample_30min(spark, sf_dir):
    return resample(intraday_bars(spark, sf_dir), "30min")


@query
def resample_60min(spark, sf_dir):
    return resample(intraday_bars(spark, sf_dir), "60min")


@query
def daily_from_intraday_(spark, sf_dir):
    return daily_from_intraday(intraday_bars(spark, sf_dir))


@query
def month_slice_(spark, sf_dir):
    return month_slice(intraday_bars(spark, sf_dir), "2024-01")


# Keys and other documented forms


@query
def symbol_dim(spark, sf_dir):
    return dimensions.symbol_dim(intraday_bars(spark, sf_dir))


@query
def symbol_dim_grown(spark, sf_dir):
    """Two of the symbols first, then all: the first keys stay."""
    path = new_folder(spark, "symbol-table")
    named = intraday_bars(spark, sf_dir)
    dimensions.extend_symbol_table(named.where(F.col("symbol_name").isin("purchase", "view")), path)
    return dimensions.extend_symbol_table(named, path)


@query
def mart_with_key(spark, sf_dir):
    symbols = written(dimensions.symbol_dim(intraday_bars(spark, sf_dir)), "symbols")
    return dimensions.with_symbol_key(mart_all_days(spark, sf_dir), symbols)


@query
def extremes_intraday(spark, sf_dir):
    return aggregates.intraday_extremes(intraday_bars(spark, sf_dir))


@query
def star_schema_bars(spark, sf_dir):
    return dimensions.star_schema(_stored(spark, sf_dir)).facts.select(
        "symbol_key", "timeseries_key", "timestamp", *VALUE_COLUMNS
    )
