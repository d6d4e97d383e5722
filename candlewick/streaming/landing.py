"""The delta load as a file stream: each landed file is taken once, whenever it arrives.

The file source knows a file by its name, so a ledger beside the checkpoint keeps names and times. One that is landed again
under a name that was taken is refused with an error before anything is loaded, or, with ``corrections``, taken
again before the new files. One that comes while a stream runs is found at the next start.
"""

import re
from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from candlewick.functions.calendar import as_date, on_day
from candlewick.operators.bars import followed_symbols
from candlewick.plans.landings import ledger_of, record_landings
from candlewick.plans.loads import quarantine_of
from candlewick.schema import RAW_BAR, TIMEFRAMES
from candlewick.sources import folders
from candlewick.sources.core_table import merge_bars
from candlewick.sources.payloads import screened
from candlewick.sources.raw_layer import LANDED_AT, MALFORMED_LINE, SOURCE_FILE, scan_raw_layer, with_path_columns, without_headers
from candlewick.workspace import temporary_tables

FILES_IN_BATCH = 1000


def landed_stream(spark: SparkSession, raw: str, timeframes: Iterable[str] = TIMEFRAMES, files_in_batch: int = FILES_IN_BATCH) -> DataFrame:
    """Lines of all load dates as they land, with the columns of ``scan_raw_layer`` and ``load_date``.

    There is no age limit: a late file counts like any other.
    """
    schema = T.StructType([*RAW_BAR.fields, T.StructField(MALFORMED_LINE, T.StringType())])
    files = (
        spark.readStream.schema(schema)
        .option("columnNameOfCorruptRecord", MALFORMED_LINE)
        .option("maxFileAge", "100000d")
        .option("maxFilesPerTrigger", files_in_batch)
        .csv(f"{raw.rstrip('/')}/*/*/{{,timeseries_name=}}{{{','.join(timeframes)}}}")
    )
    return with_path_columns(without_headers(files)).withColumn("load_date", _load_date().try_cast("date"))


def _load_date() -> Column:
    """The load date's folder of a source file, as text."""
    folder = F.substring_index(F.substring_index(SOURCE_FILE, "/", -4), "/", 1)
    return F.replace(folder, F.lit("load_date="), F.lit(""))


def landed_again(spark: SparkSession, raw: str, taken: str, open_from: date | str | None = None) -> DataFrame:
    """``source_file``, ``load_date`` (text) of the files that were written after they were taken.

    With ``open_from`` only folders of load dates from then on are listed; earlier ones are closed. Folders that
    name no date are never closed.
    """
    known = spark.read.parquet(taken).groupBy(SOURCE_FILE).agg(F.max(LANDED_AT).alias(LANDED_AT))
    dates = {f: f.removeprefix("load_date=") for f in folders.children(spark, raw)}
    if open_from is not None:
        dates = {f: d for f, d in dates.items() if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", d) or d >= str(as_date(open_from))}
    if not dates:
        return known.select(SOURCE_FILE, _load_date().alias("load_date")).limit(0)
    now = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load([f"{raw.rstrip('/')}/{f}" for f in dates])
        .select(F.col("path").alias("now_path"), F.col("modificationTime").alias("now"))
    )
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    again = known.join(now, (plain(F.url_decode(F.replace(SOURCE_FILE, F.lit("+"), F.lit("%2B")))) == plain("now_path")) & (F.col("now") > F.col(LANDED_AT)))
    return again.select(SOURCE_FILE, _load_date().alias("load_date"))


def _lines_of(spark: SparkSession, raw: str, again: DataFrame) -> DataFrame | None:
    """The lines of some files, read with the others of their load dates; None if there are no files."""
    dates = sorted(r["load_date"] for r in again.select("load_date").distinct().collect())  # at most one per folder
    if not dates:
        return None
    lines = [scan_raw_layer(spark, raw, d).withColumn("load_date", F.lit(d).try_cast("date")) for d in dates]
    return reduce(DataFrame.unionByName, lines).join(again.select(SOURCE_FILE), SOURCE_FILE, "left_semi")


def start_delta_stream(
    spark: SparkSession,
    raw: str,
    core: str,
    checkpoint: str,
    quarantine: str | None = None,
    day: date | str | None = None,
    symbols: DataFrame | None = None,
    files_in_batch: int = FILES_IN_BATCH,
    corrections: bool = False,
    open_from: date | str | None = None,
) -> StreamingQuery:
    """Load everything new and stop; with ``day`` or ``symbols`` only their bars are kept.

    With ``corrections`` files landed again under their names are merged first, and their bars, landed
    later, take the place of the old ones; bars that such a file no longer has stay. See :func:`landed_again`
    for ``open_from``. The merge is by key, so a batch repeated after a failure changes nothing; corrections count as
    taken once they are merged.
    """
    taken = f"{checkpoint.rstrip('/')}_files"
    refused_to = quarantine or quarantine_of(core)

    def merge(landed: DataFrame, written_by: str) -> None:
        bars, refused = screened(landed)
        by = refused.withColumn("written_by", F.lit(written_by)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        by.partitionBy("load_date", "written_by").parquet(refused_to)
        record_landings(bars, refused, ledger_of(refused_to), written_by)
        if symbols is not None:
            bars = followed_symbols(bars, symbols)
        merge_bars(bars if day is None else on_day(bars, day), core)

    def note(landed: DataFrame, name: str) -> None:
        landed.select(SOURCE_FILE, LANDED_AT).distinct().write.mode("overwrite").parquet(f"{taken}/batch={name}")

    def load(batch: DataFrame, batch_id: int) -> None:
        with temporary_tables(spark, "stream") as kept_as:
            landed = kept_as(batch, "landed")
            note(landed, str(batch_id))
            merge(landed, f"stream-{batch_id}")

    if folders.exists(spark, taken):
        with temporary_tables(spark, "again") as kept_as:
            again = kept_as(landed_again(spark, raw, taken, open_from), "files")
            first = again.first()
            if first and not corrections:
                raise ValueError(f"{first[SOURCE_FILE]} was landed again under the same name")
            lines = _lines_of(spark, raw, again) if first else None
            if lines is not None:
                # Corrections are numbered by those that are done, so one that was cut off is repeated under its number.
                name = f"again-{sum(c.startswith('batch=again-') for c in folders.children(spark, taken))}"
                landed = kept_as(lines, "landed")
                merge(landed, f"stream-{name}")
                note(landed, name)

    return (
        landed_stream(spark, raw, files_in_batch=files_in_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
