"""JSON payloads on the load path, one quarantine, and what is to be fetched again."""

import json
from datetime import date

import pytest

from candlewick.plans.landings import ledger_of, open_refusals, read_ledger, refetch_list
from candlewick.plans.loads import delta_load, initial_load, quarantine_of
from candlewick.schema import BAR_COLUMNS, ERROR_MARKER, THROTTLE_MARKER
from candlewick.sources.core_table import read_core
from candlewick.sources.payloads import bars_from_json, refused_bars, unreadable_payloads
from candlewick.streaming.landing import start_delta_stream
from helpers import bar, frame
from test_raw_layer import land

FIELDS = ["1. open", "2. high", "3. low", "4. close", "5. volume"]
GOOD = "2024-01-15 09:30:00,1,1,1,1,1"


def values(*numbers):
    return dict(zip(FIELDS, map(str, numbers)))


ONE = values(1, 1, 1, 1, 1)


def payload(symbol="AAA", **series):
    return json.dumps({"Meta Data": {"2. Symbol": symbol}} | series)


def texts(spark, *payloads):
    return spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "id int, payload string")


@pytest.fixture
def paths(tmp_path):
    return {name: str(tmp_path / name) for name in ("raw", "core", "checkpoint")}


def drop(tmp_path, load_date, symbol, name, text):
    folder = tmp_path / "raw" / load_date / symbol / "1min"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_every_series_of_a_payload_counts(spark):
    whole = payload(**{"Time Series (Daily)": {"2024-01-15": ONE}, "Time Series (1min)": {"2024-01-15 09:30:00": ONE}, "Time Series (Hourly)": {"2024-01-15 09:00:00": ONE}, "Weekly": {"2024-01-12": ONE}, "Note": {"x": "y"}})
    rows = sorted(map(tuple, bars_from_json(texts(spark, whole), "payload").collect()))
    assert rows == sorted([bar("AAA", "daily", "2024-01-15"), bar("AAA", "1min", "2024-01-15 09:30:00"), bar("AAA", "Hourly", "2024-01-15 09:00:00"), bar("AAA", "Weekly", "2024-01-12")])
    assert unreadable_payloads(texts(spark, whole), "payload").count() == 0


def test_readable_and_refused_part_the_input(spark):
    twice = '{"Meta Data": {"2. Symbol": "A"}, "Time Series (Daily)": {"2024-01-15": {"1. open": "1"}, "2024-01-15": {"1. open": "2"}}}'
    odd = payload(**{"Time Series (1min)": {"2024-01-15 09:30:00": ONE, "soon": ONE, "2024-01-15 09:31:00": 7}})
    empty = payload(**{"Time Series (1min)": {}, "Time Series (Daily)": {}})
    half = payload(**{"Time Series (1min)": {}, "Time Series (Daily)": {"2024-01-15": ONE}})
    rows = texts(spark, twice, odd, empty, half, "[1]", "3", None)
    assert sorted((r.symbol_name, r.timeseries_name) for r in bars_from_json(rows, "payload").collect()) == [("AAA", "1min"), ("AAA", "daily")]
    assert sorted((r.id, r.reason) for r in unreadable_payloads(rows, "payload").collect()) == [
        (0, "not json"), (2, "no bars"), (4, "no known series"), (5, "no known series"), (6, "not json"),
    ]
    assert sorted((r.id, r.stamp, r.bar) for r in refused_bars(rows, "payload").collect()) == [(1, "2024-01-15 09:31:00", "7"), (1, "soon", json.dumps(ONE, separators=(",", ":")))]


def test_payload_files_are_loaded_like_lines(spark, paths, tmp_path):
    land(tmp_path / "raw", "2024-01-16", "CSV", "1min", GOOD)
    drop(tmp_path, "2024-01-16", "JSON", "x.json", json.dumps(json.loads(payload("JSON", **{"Time Series (1min)": {"2024-01-15 09:30:00": ONE, "2024-01-15 09:31:00": values("x", 1, 1, 1, 1)}, "Time Series (Daily)": {"2024-01-15": ONE}})), indent=2))
    drop(tmp_path, "2024-01-16", "BARE", "y.json", json.dumps({"Time Series (1min)": {"2024-01-15 09:30:00": ONE}}))
    drop(tmp_path, "2024-01-16", "SLOW", "z.json", json.dumps({"Note": THROTTLE_MARKER}))
    for _ in range(2):
        initial_load(spark, paths["raw"], paths["core"], "2024-01-16")
    stored = {(r.symbol_name, r.timeseries_name) for r in read_core(spark, paths["core"]).collect()}
    assert stored == {("CSV", "1min"), ("JSON", "1min"), ("JSON", "daily"), ("BARE", "1min")}
    kept = spark.read.parquet(quarantine_of(paths["core"])).collect()
    assert sorted((r.symbol_name, r.payload_class, r.reason) for r in kept) == [("JSON", "malformed", "incomplete bar"), ("SLOW", "throttled", "no known series")]
    assert sorted((r.symbol_name, r.state) for r in read_ledger(spark, ledger_of(quarantine_of(paths["core"]))).collect()) == [("BARE", "ok"), ("CSV", "ok"), ("JSON", "ok"), ("SLOW", "throttled")]


def test_loads_and_streams_share_a_quarantine(spark, paths, tmp_path):
    land(tmp_path / "raw", "2024-01-16", "A", "1min", GOOD, "bad,1,2,3,4,5")
    delta_load(spark, paths["raw"], paths["core"], "2024-01-16", "2024-01-15")
    start_delta_stream(spark, paths["raw"], paths["core"], paths["checkpoint"]).awaitTermination()
    rows = spark.read.parquet(quarantine_of(paths["core"])).collect()
    assert sorted((str(r.load_date), r.written_by, r.malformed_line) for r in rows) == [("2024-01-16", w, "bad,1,2,3,4,5") for w in ("load", "stream-0")]
    assert {r.state for r in read_ledger(spark, ledger_of(quarantine_of(paths["core"]))).collect()} == {"ok"}


def test_a_later_good_landing_takes_an_entry_off(spark, paths, tmp_path):
    error, slow = f'{{"{ERROR_MARKER}": "no"}}', f'{{"Note": "{THROTTLE_MARKER}"}}'
    land(tmp_path / "raw", "2024-01-16", "OK", "1min", GOOD)
    drop(tmp_path, "2024-01-16", "SLOW", "intraday_1min_SLOW.csv", slow)
    drop(tmp_path, "2024-01-16", "BAD", "2023-12_intraday_1min_BAD.csv", error)
    drop(tmp_path, "2024-01-16", "BAD", "2023-11_intraday_1min_BAD.json", slow)
    initial_load(spark, paths["raw"], paths["core"], "2024-01-16")

    def still_open():
        return {(r.symbol_name, r.month, r.state, str(r.load_date)) for r in open_refusals(read_ledger(spark, ledger_of(quarantine_of(paths["core"])))).collect()}

    assert still_open() == {("SLOW", None, "throttled", "2024-01-16"), ("BAD", "2023-12", "error", "2024-01-16"), ("BAD", "2023-11", "throttled", "2024-01-16")}
    land(tmp_path / "raw", "2024-01-17", "SLOW", "1min", GOOD)
    drop(tmp_path, "2024-01-17", "BAD", "2023-12_intraday_1min_BAD.csv", "timestamp,open,high,low,close,volume\n2023-12-04 09:30:00,1,1,1,1,1\n")
    initial_load(spark, paths["raw"], paths["core"], "2024-01-17")
    assert still_open() == {("BAD", "2023-11", "throttled", "2024-01-16")}
    wanted = refetch_list(read_ledger(spark, ledger_of(quarantine_of(paths["core"]))), read_core(spark, paths["core"]).select(BAR_COLUMNS), "2024-01-31", 3).collect()
    assert sorted((r.symbol_name, r.month, r.state) for r in wanted) == [
        ("BAD", "2023-11", "throttled"), ("BAD", "2024-01", "missing"), ("OK", "2023-11", "missing"), ("OK", "2023-12", "missing"), ("SLOW", "2023-11", "missing"), ("SLOW", "2023-12", "missing"),
    ]


def test_without_a_ledger_only_gaps_are_listed(spark, tmp_path):
    nothing = read_ledger(spark, str(tmp_path / "none"))
    found = refetch_list(nothing, frame(spark, [bar("A", "1min", "2024-01-15 09:30:00")]), date(2024, 1, 31), 2).collect()
    assert [(r.symbol_name, r.timeseries_name, r.month, r.load_date, r.state) for r in found] == [("A", "1min", "2023-12", None, "missing")]
