from datetime import date

import pytest
from pyspark.sql import functions as F

from candlewick.functions.calendar import between_days, local_date, month_slice, on_day, trailing_days
from candlewick.sources.core_table import read_core, replace_days
from helpers import bar, frame, planned


@pytest.fixture(scope="module")
def core(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("calendar") / "core")
    days = ["2023-12-31", "2024-01-01", "2024-01-15", "2024-01-16", "2024-01-31", "2024-02-01"]
    replace_days(frame(spark, [bar("A", "1min", f"{d} {t}") for d in days for t in ("00:00:00", "23:59:00")]), path)
    return read_core(spark, path)


def _days(df):
    return sorted({r.timestamp.date().isoformat() for r in df.collect()})


def test_day_ranges(core):
    assert _days(on_day(core, "2024-01-15")) == ["2024-01-15"]
    assert on_day(core, date(2024, 1, 15)).count() == 2
    assert _days(between_days(core, "2023-12-31", "2024-01-15")) == ["2023-12-31", "2024-01-01", "2024-01-15"]
    assert _days(month_slice(core, "2024-01")) == ["2024-01-01", "2024-01-15", "2024-01-16", "2024-01-31"]
    assert _days(month_slice(core, "2023-12")) == ["2023-12-31"]
    assert _days(trailing_days(core, "2024-01-31", 15)) == ["2024-01-16", "2024-01-31"]


def test_a_day_prunes_folders_and_reaches_the_scan(core):
    plan = planned(on_day(core, "2024-01-15"))
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "yyyymm" in partition_filters and "trade_date" in partition_filters
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(timestamp,2024-01-15T00:00)" in pushed
    assert "LessThan(timestamp,2024-01-16T00:00)" in pushed


def test_day_filter_goes_through_a_union(core):
    both = core.where("timeseries_name = 'daily'").unionByName(core.where("timeseries_name = '1min'"))
    assert planned(on_day(both, "2024-01-15")).count("GreaterThanOrEqual(timestamp,2024-01-15T00:00)") == 2


@pytest.mark.parametrize(
    ("instant", "yesterday"),
    [
        ("2023-09-02 00:00:00", "2023-08-31"),
        ("2023-09-02 05:00:00", "2023-09-01"),
        ("2023-12-02 00:00:00", "2023-11-30"),
        ("2023-12-02 05:00:00", "2023-12-01"),
    ],
)
def test_yesterday_in_eastern_time(spark, instant, yesterday):
    row = spark.range(1).select(
        local_date(F.lit(instant).cast("timestamp_ntz"), "US/Eastern", 1).alias("eastern"),
        local_date(F.lit(instant).cast("timestamp_ntz"), "UTC", 1).alias("utc"),
    ).first()
    assert row.eastern == date.fromisoformat(yesterday)
    assert row.utc == date.fromisoformat(instant[:10]).replace(day=1)
