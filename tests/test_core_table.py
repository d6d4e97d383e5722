import os

from candlewick.schema import BAR_COLUMNS
from candlewick.operators.bars import unique_bars
from candlewick.sources.core_table import merge_bars, read_core, replace_days
from helpers import bar, executed_plan, frame


def _stored(spark, path):
    return sorted(map(tuple, read_core(spark, path).select(BAR_COLUMNS).collect()))


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_absent_table_reads_empty(spark, tmp_path):
    assert read_core(spark, str(tmp_path / "none")).count() == 0


def test_layout(spark, tmp_path):
    path = str(tmp_path / "core")
    replace_days(frame(spark, [bar("A", "daily", "2024-01-30"), bar("A", "daily", "2024-02-01")]), path)
    folders = {os.path.relpath(d, path) for d, _, fs in os.walk(path) if any(f.endswith(".parquet") for f in fs)}
    days = {"yyyymm=202401/trade_date=2024-01-30", "yyyymm=202402/trade_date=2024-02-01"}
    assert folders == days | {f"_series_counts/{d}" for d in days}


def test_loading_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "core")
    bars = [bar(s, t, "2024-01-30") for s in "AB" for t in ("daily", "1min")]
    for _ in range(2):
        merge_bars(frame(spark, bars), path)
    assert _stored(spark, path) == sorted(bars)


def test_other_days_and_other_bars_of_the_day_stay(spark, tmp_path):
    path = str(tmp_path / "core")
    month = [bar(s, "daily", f"2024-01-{d:02}") for s in "AB" for d in range(1, 16)]
    merge_bars(frame(spark, month), path)
    before = _files(path)
    merge_bars(frame(spark, [bar("A", "daily", "2024-01-10", volume=9), bar("A", "daily", "2024-01-16")]), path)
    expected = [r for r in month if not (r[0] == "A" and r[2].day == 10)]
    expected += [bar("A", "daily", "2024-01-10", volume=9), bar("A", "daily", "2024-01-16")]
    assert _stored(spark, path) == sorted(expected)
    after = _files(path)
    untouched = {f: t for f, t in before.items() if "2024-01-10" not in f}
    assert {f: after.get(f) for f in untouched} == untouched


def test_days_between_loaded_days_are_not_rewritten(spark, tmp_path):
    path = str(tmp_path / "core")
    merge_bars(frame(spark, [bar("A", "daily", f"2024-01-{d:02}") for d in range(1, 6)]), path)
    before = {f: t for f, t in _files(path).items() if "2024-01-03" in f}
    merge_bars(frame(spark, [bar("B", "daily", "2024-01-01"), bar("B", "daily", "2024-01-05")]), path)
    assert before and {f: _files(path).get(f) for f in before} == before
    assert len(_stored(spark, path)) == 7


def test_nothing_to_load(spark, tmp_path):
    path = str(tmp_path / "core")
    merge_bars(frame(spark, []), path)
    assert read_core(spark, path).count() == 0


def test_of_copies_the_last_landed_wins(spark):
    rows = [(*bar("A", "daily", "2024-01-30", volume=v), f) for v, f in ((5, 1), (1, 2), (1, 2), (9, 0))]
    bars = spark.createDataFrame(rows, frame(spark, []).schema.add("landed_at", "integer"))
    assert list(map(tuple, unique_bars(bars).collect())) == [bar("A", "daily", "2024-01-30", volume=1)]


def test_copies_are_combined_before_the_shuffle(spark):
    plan = executed_plan(unique_bars(frame(spark, [bar("A", "daily", "2024-01-30")] * 50)))
    before_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "partial_max" in before_shuffle


def test_a_large_day_is_split_over_files(spark, tmp_path):
    path = str(tmp_path / "core")
    hot = spark.range(0, 400_000, 1, 16).selectExpr(
        "'HOT' AS symbol_name",
        "'1min' AS timeseries_name",
        "timestamp_ntz'2024-01-15 00:00:00' + make_dt_interval(0, 0, 0, id * 0.1) AS timestamp",
        *[f"CAST(xxhash64(id, '{c}') % 1000000 AS DECIMAL(18,4)) AS {c}" for c in ("open", "high", "low", "close")],
        "xxhash64(id) AS volume",
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "2MB")
    try:
        replace_days(hot, path)
    finally:
        spark.conf.set(setting, before)
    assert len(_files(path)) > 3
    assert read_core(spark, path).count() == 400_000
