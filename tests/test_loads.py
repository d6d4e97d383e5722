import pytest

from candlewick.plans import job
from candlewick.plans.job import run
from candlewick.plans.loads import delta_load, initial_load
from candlewick.schema import BAR_COLUMNS, DEFAULT_SYMBOLS, MART_COLUMNS
from candlewick.sources.core_table import read_core
from candlewick.sources.raw_layer import write_raw_layer
from candlewick.streaming.landing import start_delta_stream
from helpers import bar, frame
from test_raw_layer import land


def _stored(spark, path):
    return sorted(map(tuple, read_core(spark, path).select(BAR_COLUMNS).collect()))


@pytest.fixture
def paths(tmp_path):
    return {name: str(tmp_path / name) for name in ("raw", "core", "mart", "quarantine", "checkpoint")}


def test_initial_load_trims_daily_bars(spark, paths):
    minute = [bar("A", "1min", "2024-01-10 09:30:00"), bar("A", "1min", "2024-01-12 09:30:00")]
    daily = [bar("A", "daily", f"2024-01-{d:02}") for d in (9, 10, 11, 20, 21)]
    write_raw_layer(frame(spark, minute + daily), paths["raw"], "2024-01-20")
    initial_load(spark, paths["raw"], paths["core"], "2024-01-20")
    assert _stored(spark, paths["core"]) == sorted(minute + daily[1:4])


def test_initial_load_without_files(spark, paths):
    initial_load(spark, paths["raw"], paths["core"], "2024-01-20")
    assert _stored(spark, paths["core"]) == []


def test_delta_load_takes_one_day_and_can_be_repeated(spark, paths):
    days = [bar(s, t, f"2024-01-{d:02}") for s in "AB" for t in ("1min", "daily") for d in range(14, 17)]
    write_raw_layer(frame(spark, days), paths["raw"], "2024-01-16")
    for _ in range(2):
        delta_load(spark, paths["raw"], paths["core"], "2024-01-16", "2024-01-15")
    assert _stored(spark, paths["core"]) == sorted(r for r in days if r[2].day == 15)


def test_only_followed_symbols_are_loaded(spark, paths):
    write_raw_layer(frame(spark, [bar(s, "daily", "2024-01-15") for s in "ABC"]), paths["raw"], "2024-01-16")
    symbols = spark.createDataFrame([("A",), ("C",)], "symbol_name string")
    delta_load(spark, paths["raw"], paths["core"], "2024-01-16", "2024-01-15", symbols)
    assert {r[0] for r in _stored(spark, paths["core"])} == {"A", "C"}


def test_malformed_lines_go_to_quarantine(spark, paths, tmp_path):
    land(tmp_path / "raw", "2024-01-16", "A", "1min", "2024-01-15 09:30:00,1,1,1,1,1", "bad,1,2,3,4,5")
    land(tmp_path / "raw", "2024-01-16", "B", "1min", "2024-01-15 09:30:00,1,1,1,1,1")
    for _ in range(2):
        delta_load(spark, paths["raw"], paths["core"], "2024-01-16", "2024-01-15", quarantine=paths["quarantine"])
    assert len(_stored(spark, paths["core"])) == 2
    (row,) = spark.read.parquet(paths["quarantine"]).collect()
    assert (row.symbol_name, row.malformed_line, str(row.load_date)) == ("A", "bad,1,2,3,4,5", "2024-01-16")


@pytest.mark.parametrize("mode", ["initial", "delta"])
def test_job_loads_and_rebuilds_the_mart_of_the_same_day(spark, paths, mode):
    bars = [bar(s, t, f"2024-01-{d:02}") for s in "AB" for t in ("1min", "daily") for d in (14, 15)]
    write_raw_layer(frame(spark, bars), paths["raw"], "2024-01-16")
    run(spark, mode, paths["raw"], paths["core"], paths["mart"], "2024-01-16", symbols=["A"])
    mart = spark.read.parquet(paths["mart"])
    assert mart.columns == MART_COLUMNS
    assert [r.timestamp_with_max_high.day for r in mart.collect()] == [15]
    # A day off: the mart becomes empty, with the same columns.
    run(spark, mode, paths["raw"], paths["core"], paths["mart"], "2024-01-16", "2024-01-20")
    again = spark.read.parquet(paths["mart"])
    assert again.columns == MART_COLUMNS and again.count() == 0


def test_command_line(spark, paths, monkeypatch):
    calls = []
    monkeypatch.setattr(job, "run", lambda session, **arguments: calls.append(arguments))
    base = ["--mode", "delta", "--raw", "r", "--core", "c", "--mart", "m", "--load-date", "2024-01-16"]
    job.main([*base, "--symbols"])
    job.main([*base, "--day", "2024-01-12", "--symbols", "A", "--jdbc-option", "dbtable=marts.last_day"])
    assert calls[0]["symbols"] == list(DEFAULT_SYMBOLS) and calls[0]["day"] is None
    assert calls[1]["symbols"] == ["A"] and calls[1]["dbtable"] == "marts.last_day"


def test_stream_takes_each_landed_file_once(spark, paths, tmp_path):
    def load():
        query = start_delta_stream(spark, paths["raw"], paths["core"], paths["checkpoint"], paths["quarantine"])
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    land(tmp_path / "raw", "2024-01-16", "A", "1min", "2024-01-15 09:30:00,1,1,1,1,1", "bad,1,2,3,4,5")
    write_raw_layer(frame(spark, [bar("B", "daily", "2024-01-15")]), paths["raw"], "2024-01-16")
    assert load() > 0
    first = [bar("A", "1min", "2024-01-15 09:30:00"), bar("B", "daily", "2024-01-15")]
    assert _stored(spark, paths["core"]) == first
    assert load() == 0
    land(tmp_path / "raw", "2024-01-17", "A", "1min", "2024-01-16 09:30:00,1,1,1,1,7")
    load()
    assert _stored(spark, paths["core"]) == sorted([*first, bar("A", "1min", "2024-01-16 09:30:00", volume=7)])
