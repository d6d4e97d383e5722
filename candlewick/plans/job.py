"""The batch job: load, then rebuild the mart, for one as-of day.

    spark-submit candlewick/plans/job.py --mode delta --raw s3a://.../raw \\
        --core s3a://.../core --mart s3a://.../mart --load-date 2024-01-16 --day 2024-01-15
"""

import argparse
from datetime import date, timedelta
from typing import Literal

from pyspark.sql import SparkSession

from candlewick.functions.calendar import as_date, previous_local_day
from candlewick.operators.bars import symbol_list
from candlewick.operators.dimensions import extend_symbol_table
from candlewick.plans.loads import delta_load, initial_load
from candlewick.plans.mart import full_mart, last_day_mart
from candlewick.schema import DEFAULT_SYMBOLS
from candlewick.sources import folders
from candlewick.sources.core_table import read_core
from candlewick.sources.jdbc import write_jdbc


def rebuild_mart(
    spark: SparkSession, core: str, mart: str, day: date | str, match: str = "keyed", full: bool = False, **jdbc_options: str
) -> None:
    """Overwrite the mart with that of ``day``. ``mart`` is a folder, or a JDBC URL with
    the table named by the option ``dbtable``.

    With ``full`` it has the symbol's surrogate key first and the change from the open last;
    keys are kept in a table beside the mart, or at ``symbol_table``. A folder is
    written beside the mart and then takes its place, so a rebuild that fails leaves the old mart.
    """
    options = dict(jdbc_options)
    symbol_table = options.pop("symbol_table", None)
    if full and symbol_table is None:
        if mart.startswith("jdbc:"):
            raise ValueError("a full mart in a database needs a symbol_table folder")
        symbol_table = f"{mart.rstrip('/')}_symbols"
    check_target(mart, jdbc_options)
    bars = read_core(spark, core, day, day)
    result = last_day_mart(bars, day, match)
    if full:
        result = full_mart(result, extend_symbol_table(bars, symbol_table))
    if mart.startswith("jdbc:"):
        write_jdbc(result, mart, options.pop("dbtable"), "overwrite", **options)
        return
    staged = f"{mart.rstrip('/')}__next"
    result.write.mode("overwrite").parquet(staged)
    folders.replace(spark, staged, mart)


def check_target(mart: str, jdbc_options: dict[str, str]) -> None:
    if mart.startswith("jdbc:") and "dbtable" not in jdbc_options:
        raise ValueError("a JDBC mart needs the option dbtable")


def run(
    spark: SparkSession,
    mode: Literal["initial", "delta"],
    raw: str,
    core: str,
    mart: str,
    load_date: date | str,
    day: date | str | None = None,
    symbols: list[str] | None = None,
    quarantine: str | None = None,
    match: str = "keyed",
    full: bool = False,
    instant: str | None = None,
    zone: str = "UTC",
    **jdbc_options: str,
) -> None:
    """Load, then mart. Both use the same ``day``: the given one, or the day before that of
    ``instant`` in ``zone``, or the day before ``load_date``. An empty list of symbols means none."""
    check_target(mart, jdbc_options)
    if day is None:
        day = previous_local_day(instant, zone) if instant else as_date(load_date) - timedelta(days=1)
    day = as_date(day)
    followed = symbol_list(spark, symbols) if symbols is not None else None
    if mode == "initial":
        initial_load(spark, raw, core, load_date, followed, quarantine)
    else:
        delta_load(spark, raw, core, load_date, day, followed, quarantine)
    rebuild_mart(spark, core, mart, day, match, full, **jdbc_options)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--mode", choices=["initial", "delta"], required=True)
    for name in ("raw", "core", "mart", "load-date"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--day")
    parser.add_argument("--instant", help="take the day before the one of this instant in --zone")
    parser.add_argument("--zone", default="UTC")
    parser.add_argument("--full", action="store_true", help="add the symbol key and the change from the open")
    parser.add_argument("--symbols", nargs="*", help="load only these; without names, the default tickers")
    parser.add_argument("--quarantine")
    parser.add_argument("--match", choices=["keyed", "value"], default="keyed")
    parser.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE")
    arguments = vars(parser.parse_args(argv))
    if arguments["symbols"] == []:
        arguments["symbols"] = list(DEFAULT_SYMBOLS)
    jdbc_options = dict(item.split("=", 1) for item in arguments.pop("jdbc_option"))
    run(SparkSession.builder.appName("candlewick").getOrCreate(), **arguments, **jdbc_options)


if __name__ == "__main__":
    main()
