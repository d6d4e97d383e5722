"""The raw layer: CSV bars at ``<root>/<load date>/<symbol>/<timeframe>/<file>.csv``."""

from collections.abc import Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.schema import RAW_BAR, TIMEFRAMES, VALUE_COLUMNS

MALFORMED_LINE = "malformed_line"
LANDED_AT = "landed_at"
SOURCE_FILE = "source_file"
PAYLOAD_SUFFIX = ".json"
"""Ends the names of JSON files; all others are read as CSV lines."""
HEADER = ",".join(RAW_BAR.fieldNames())


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV files with a header row; without a ``schema`` every column is a string."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def scan_raw_layer(
    spark: SparkSession,
    root: str,
    load_date: date | str,
    timeframes: Iterable[str] = TIMEFRAMES,
    schema: T.StructType | None = RAW_BAR,
) -> DataFrame:
    """All bars landed on ``load_date``, with symbol and timeframe taken from the path.

    One scan over a path pattern, however many symbols there are. Both plain
    folders and the ``key=value`` folders of :func:`write_raw_layer` are read.
    A date without files gives an empty frame. With a ``schema``, lines that do
    not fit it are kept, with their text in ``malformed_line``; see
    :func:`well_formed` and :func:`malformed`. The header is told by its text, so a first
    line that is something else is not taken for one.
    """
    pattern = _landed_at(root, load_date, timeframes)
    reader = spark.read.option("header", schema is None)
    if schema is not None:
        file_schema = T.StructType([*schema.fields, T.StructField(MALFORMED_LINE, T.StringType())])
        reader = reader.schema(file_schema).option("columnNameOfCorruptRecord", MALFORMED_LINE)
    try:
        files = reader.csv(pattern)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return _no_files(spark, schema)
    return with_path_columns(files if schema is None else without_headers(files)).where(~F.col(SOURCE_FILE).endswith(PAYLOAD_SUFFIX))


def scan_payloads(spark: SparkSession, root: str, load_date: date | str, timeframes: Iterable[str] = TIMEFRAMES) -> DataFrame:
    """The JSON files landed on ``load_date``, one row each: ``value`` (the text) and the path columns of :func:`scan_raw_layer`."""
    try:
        files = spark.read.text(_landed_at(root, load_date, timeframes), wholetext=True, pathGlobFilter=f"*{PAYLOAD_SUFFIX}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return _no_files(spark, None).withColumn("value", F.lit(None).cast("string"))
    return with_path_columns(files)


def _landed_at(root: str, load_date: date | str, timeframes: Iterable[str]) -> str:
    return f"{root.rstrip('/')}/{{,load_date=}}{load_date}/*/{{,timeseries_name=}}{{{','.join(timeframes)}}}"


def _no_files(spark: SparkSession, schema: T.StructType | None) -> DataFrame:
    fields = list(schema.fields) if schema is not None else []
    if schema is not None:
        fields.append(T.StructField(MALFORMED_LINE, T.StringType()))
    fields.append(T.StructField(LANDED_AT, T.TimestampType()))
    fields += [T.StructField(name, T.StringType()) for name in (SOURCE_FILE, "symbol_name", "timeseries_name")]
    return spark.createDataFrame([], T.StructType(fields))


def with_path_columns(files: DataFrame) -> DataFrame:
    """Add ``symbol_name`` and ``timeseries_name`` from the folders of the file,
    ``landed_at``, the time the file was written, and ``source_file``, its path."""
    path = F.col("_metadata.file_path")
    return files.withColumns(
        {
            LANDED_AT: F.col("_metadata.file_modification_time"),
            SOURCE_FILE: path,
            "symbol_name": folder_value(path, 3, "symbol_name="),
            "timeseries_name": folder_value(path, 2, "timeseries_name="),
        }
    )


def folder_value(path: Column, place: int, prefix: str) -> Column:
    """The folder at ``place`` from the end, decoded, without its ``key=`` if it has one.

    This runs for every row, so it takes the general way only where a name is escaped.
    """
    folder = F.substring_index(F.substring_index(path, "/", -place), "/", 1)
    value = F.replace(folder, F.lit(prefix), F.lit(""))
    # A path is a URI; a key=value folder is escaped once more within it.
    value = F.nullif(value, F.lit("__HIVE_DEFAULT_PARTITION__"))
    once = _url_decoded(folder)
    decoded = F.when(folder.startswith(prefix), _url_decoded(_url_decoded(value))).otherwise(once)
    return F.when(F.contains(folder, F.lit("%")), decoded).otherwise(value)


def _url_decoded(text: Column) -> Column:
    # '+' stands for itself in a path.
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def _fits_schema() -> Column:
    # Naming every column makes the parser convert all of them: a CSV scan that
    # is pruned to some columns does not notice bad text in the others.
    complete = F.lit(True)
    for name in ["timestamp", *VALUE_COLUMNS]:
        complete = complete & F.col(name).isNotNull()
    return complete & F.col(MALFORMED_LINE).isNull()


def without_headers(lines: DataFrame) -> DataFrame:
    """Lines of headed files, without the headers."""
    is_header = F.lower(F.regexp_replace(MALFORMED_LINE, r"[\s\"\ufeff]", "")) == HEADER
    return lines.where(_fits_schema() | ~F.coalesce(is_header, F.lit(False)))


def well_formed(raw: DataFrame) -> DataFrame:
    """The lines that hold a complete bar."""
    return raw.where(_fits_schema()).drop(MALFORMED_LINE)


def malformed(raw: DataFrame) -> DataFrame:
    """The other lines, for a quarantine table."""
    return raw.where(~_fits_schema())


def write_raw_layer(bars: DataFrame, root: str, load_date: date | str) -> None:
    """Lay bars out as CSV by load date, symbol and timeframe.

    Landing a (date, symbol, timeframe) again replaces it and nothing else. The
    rebalance hint sizes the files: a hot symbol is split over several, small
    ones share a task.
    """
    keys = ["load_date", "symbol_name", "timeseries_name"]
    (
        bars.withColumn("load_date", F.lit(str(load_date)))
        .select(*keys, "timestamp", *VALUE_COLUMNS)
        .hint("rebalance", *keys)
        .sortWithinPartitions(*keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .partitionBy(*keys)
        .csv(root)
    )
