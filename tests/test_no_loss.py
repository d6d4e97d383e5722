"""Nothing that was landed or stored gets lost without a sign."""

import os
import time

import pytest
from pyspark.sql import functions as F

from candlewick.operators import dimensions
from candlewick.operators.aggregates import intraday_extremes
from candlewick.operators.bars import of_timeframe, symbol_list
from candlewick.operators.lookups import max_high_time, max_volume_time
from candlewick.operators.resample import daily_from_intraday, resample
from candlewick.plans import job
from candlewick.plans.loads import delta_load, initial_load, quarantine_of
from candlewick.schema import BAR_COLUMNS, ERROR_MARKER, THROTTLE_MARKER
from candlewick.sources import core_table, folders
from candlewick.sources.payloads import unreadable_payloads
from candlewick.sources.raw_layer import write_raw_layer
from candlewick.streaming.landing import start_delta_stream
from candlewick.workspace import new_folder, shared_folder
from helpers import bar, count_nodes, executed_plan, frame, random_bars
from test_raw_layer import land

GOOD = "2024-01-15 09:30:00,1,1,1,1,1"


def _stored(spark, path):
    return sorted(map(tuple, core_table.read_core(spark, path).select(BAR_COLUMNS).collect()))


@pytest.fixture
def paths(tmp_path):
    return {name: str(tmp_path / name) for name in ("raw", "core", "mart", "checkpoint")}


def _stream(spark, paths, **options):
    query = start_delta_stream(spark, paths["raw"], paths["core"], paths["checkpoint"], **options)
    query.awaitTermination()


def test_the_stream_takes_old_files(spark, paths, tmp_path):
    land(tmp_path / "raw", "2024-01-16", "A", "1min", GOOD)
    _stream(spark, paths)
    land(tmp_path / "raw", "2024-01-16", "B", "1min", GOOD)
    old = time.time() - 400 * 86400
    os.utime(tmp_path / "raw/2024-01-16/B/1min/bars.csv", (old, old))
    _stream(spark, paths)
    assert {r[0] for r in _stored(spark, paths["core"])} == {"A", "B"}


def test_the_stream_refuses_a_name_that_was_taken(spark, paths, tmp_path):
    land(tmp_path / "raw", "2024-01-16", "A+ B", "1min", GOOD)
    _stream(spark, paths)
    _stream(spark, paths)
    path = tmp_path / "raw/2024-01-16/A+ B/1min/bars.csv"
    later = path.stat().st_mtime + 60
    os.utime(path, (later, later))
    with pytest.raises(ValueError, match="landed again"):
        _stream(spark, paths)


def _landed_later(tmp_path, seconds, symbol, load_date, *lines):
    land(tmp_path / "raw", load_date, symbol, "1min", *lines)
    path = tmp_path / "raw" / load_date / symbol / "1min" / "bars.csv"
    later = time.time() + seconds
    os.utime(path, (later, later))


def test_the_stream_takes_corrections_under_the_same_name(spark, paths, tmp_path):
    other = "2024-01-15 09:31:00,1,1,1,1,1"
    for symbol in ("A+ B", "C"):
        land(tmp_path / "raw", "2024-01-16", symbol, "1min", GOOD, other)
    _stream(spark, paths)
    assert folders.children(spark, f"{paths['checkpoint']}_files") == ["batch=0"]
    _landed_later(tmp_path, 60, "A+ B", "2024-01-16", GOOD.replace(",1,1,1,1,1", ",2,2,2,2,5"), "bad,1,2,3,4,5")
    land(tmp_path / "raw", "2024-01-17", "D", "1min", GOOD)
    _stream(spark, paths, corrections=True)
    stored = [
        bar("A+ B", "1min", "2024-01-15 09:30:00", 2, 2, 2, 2, 5),
        bar("A+ B", "1min", "2024-01-15 09:31:00"),
        *[bar("C", "1min", f"2024-01-15 09:{m}:00") for m in (30, 31)],
        bar("D", "1min", "2024-01-15 09:30:00"),
    ]
    assert _stored(spark, paths["core"]) == stored
    (row,) = spark.read.parquet(quarantine_of(paths["core"])).collect()
    assert (row.malformed_line, row.written_by) == ("bad,1,2,3,4,5", "stream-again-0")
    names = folders.children(spark, f"{paths['checkpoint']}_files")
    _stream(spark, paths, corrections=True)  # taken by now
    assert folders.children(spark, f"{paths['checkpoint']}_files") == names
    _landed_later(tmp_path, 120, "A+ B", "2024-01-16", GOOD.replace(",1,1,1,1,1", ",3,3,3,3,6"))
    _stream(spark, paths, corrections=True)
    assert _stored(spark, paths["core"])[0] == bar("A+ B", "1min", "2024-01-15 09:30:00", 3, 3, 3, 3, 6)


def test_a_correction_that_was_cut_off_is_taken_at_the_next_start(spark, paths, tmp_path, monkeypatch):
    land(tmp_path / "raw", "2024-01-16", "A", "1min", GOOD)
    _stream(spark, paths)
    _landed_later(tmp_path, 60, "A", "2024-01-16", GOOD.replace(",1,1,1,1,1", ",2,2,2,2,5"), "bad,1,2,3,4,5")
    with monkeypatch.context() as broken:
        broken.setattr("candlewick.streaming.landing.merge_bars", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            _stream(spark, paths, corrections=True)
    _stream(spark, paths, corrections=True)
    assert _stored(spark, paths["core"]) == [bar("A", "1min", "2024-01-15 09:30:00", 2, 2, 2, 2, 5)]
    assert spark.read.parquet(quarantine_of(paths["core"])).count() == 1


def test_closed_load_dates_are_not_listed(spark, paths, tmp_path):
    for load_date, symbol in (("2024-01-16", "A"), ("2024-01-17", "B")):
        land(tmp_path / "raw", load_date, symbol, "1min", GOOD)
    _stream(spark, paths)
    for load_date, symbol in (("2024-01-16", "A"), ("2024-01-17", "B")):
        _landed_later(tmp_path, 60, symbol, load_date, GOOD.replace(",1,1,1,1,1", ",2,2,2,2,5"))
    _stream(spark, paths, corrections=True, open_from="2024-01-17")
    assert [r[-1] for r in _stored(spark, paths["core"])] == [1, 5]
    _stream(spark, paths, corrections=True, open_from="2024-02-01")
    _stream(spark, paths, corrections=True)
    assert [r[-1] for r in _stored(spark, paths["core"])] == [5, 5]


def test_the_stream_can_be_kept_to_a_day_and_symbols(spark, paths, tmp_path):
    for symbol in "AB":
        land(tmp_path / "raw", "2024-01-17", symbol, "1min", GOOD, "2024-01-16 09:30:00,1,1,1,1,1")
    _stream(spark, paths, day="2024-01-15", symbols=symbol_list(spark, ["A"]), files_in_batch=1)
    assert _stored(spark, paths["core"]) == [bar("A", "1min", "2024-01-15 09:30:00")]


def test_bad_lines_are_kept_by_default(spark, paths, tmp_path):
    land(tmp_path / "raw", "2024-01-16", "A", "1min", GOOD, "bad,1,2,3,4,5")
    job.run(spark, "delta", paths["raw"], paths["core"], paths["mart"], "2024-01-16")
    (row,) = spark.read.parquet(quarantine_of(paths["core"])).collect()
    assert (row.malformed_line, row.payload_class) == ("bad,1,2,3,4,5", "malformed")


def test_a_mended_file_clears_its_refused_lines(spark, paths, tmp_path):
    land(tmp_path / "raw", "2024-01-16", "A", "1min", GOOD, "bad,1,2,3,4,5")
    delta_load(spark, paths["raw"], paths["core"], "2024-01-16", "2024-01-15")
    land(tmp_path / "raw", "2024-01-16", "A", "1min", GOOD)
    delta_load(spark, paths["raw"], paths["core"], "2024-01-16", "2024-01-15")
    assert spark.read.parquet(quarantine_of(paths["core"])).count() == 0


def test_refused_texts_of_one_line_or_more(spark, paths, tmp_path):
    land(tmp_path / "raw", "2024-01-16", "OK", "1min", GOOD)
    land(tmp_path / "raw", "2024-01-16", "MIXED", "1min", GOOD, f'{{"x": "{THROTTLE_MARKER}"}}')
    for symbol, text in (("ERR", f'{{"{ERROR_MARKER}": "no such symbol"}}'), ("SLOW", f'{{\n "Note": "{THROTTLE_MARKER} Soon again."\n}}\n')):
        folder = tmp_path / "raw/2024-01-16" / symbol / "1min"
        folder.mkdir(parents=True)
        (folder / "x.csv").write_text(text)
    delta_load(spark, paths["raw"], paths["core"], "2024-01-16", "2024-01-15")
    assert {r[0] for r in _stored(spark, paths["core"])} == {"OK"}
    kept = {(r.symbol_name, r.payload_class) for r in spark.read.parquet(quarantine_of(paths["core"])).collect()}
    assert kept == {("ERR", "error"), ("SLOW", "throttled"), ("MIXED", "throttled")}


def test_daily_bars_alone_are_an_error(spark, paths):
    write_raw_layer(frame(spark, [bar("A", "daily", "2024-01-15")]), paths["raw"], "2024-01-16")
    with pytest.raises(ValueError, match="1min"):
        initial_load(spark, paths["raw"], paths["core"], "2024-01-16")


def test_an_empty_symbol_list_means_none(spark, paths, tmp_path):
    land(tmp_path / "raw", "2024-01-16", "A", "1min", GOOD)
    job.run(spark, "delta", paths["raw"], paths["core"], paths["mart"], "2024-01-16", symbols=[])
    assert _stored(spark, paths["core"]) == []


def test_a_later_landing_wins_whichever_is_loaded_last(spark, paths):
    for load_date, volume in (("2024-01-16", 16), ("2024-01-17", 17)):
        write_raw_layer(frame(spark, [bar("A", "1min", "2024-01-15 09:30:00", volume=volume)]), paths["raw"], load_date)
    for load_date in ("2024-01-16", "2024-01-17", "2024-01-16"):
        delta_load(spark, paths["raw"], paths["core"], load_date, "2024-01-15")
    assert [r[-1] for r in _stored(spark, paths["core"])] == [17]


@pytest.mark.parametrize("moves", [0, 1])
def test_a_load_cut_off_while_days_are_replaced(spark, paths, monkeypatch, moves):
    days = ["2024-01-15", "2024-01-16", "2024-01-17"]
    core_table.merge_bars(frame(spark, [bar(s, "daily", d) for s in "AB" for d in days]), paths["core"])
    real, calls = folders.move, []

    def move(session, source, target):
        calls.append(target)
        if len(calls) > moves:
            raise InterruptedError
        real(session, source, target)

    monkeypatch.setattr(folders, "move", move)
    with pytest.raises(InterruptedError):
        core_table.merge_bars(frame(spark, [bar("A", "daily", d, volume=9) for d in days[:2]]), paths["core"])
    monkeypatch.setattr(folders, "move", real)
    core_table.merge_bars(frame(spark, [bar("C", "daily", days[0])]), paths["core"])
    wanted = [bar("A", "daily", d, volume=9) for d in days[:2]] + [bar("A", "daily", days[2]), bar("C", "daily", days[0])] + [bar("B", "daily", d) for d in days]
    assert _stored(spark, paths["core"]) == sorted(wanted)
    assert folders.children(spark, f"{paths['core']}/{core_table.PENDING}") == []


def test_an_unfinished_write_is_dropped(spark, paths):
    core_table.merge_bars(frame(spark, [bar("A", "daily", "2024-01-15")]), paths["core"])
    left = f"{paths['core']}/{core_table.PENDING}/x/yyyymm=202401/trade_date=2024-01-15"
    spark.range(3).write.parquet(left)
    core_table.settle(spark, paths["core"])
    assert _stored(spark, paths["core"]) == [bar("A", "daily", "2024-01-15")] and not os.path.exists(left)


def test_a_failing_rebuild_leaves_the_old_mart(spark, paths, monkeypatch):
    core_table.merge_bars(frame(spark, [bar("A", t, "2024-01-15") for t in ("daily", "1min")]), paths["core"])
    job.rebuild_mart(spark, paths["core"], paths["mart"], "2024-01-15")
    fails = F.raise_error(F.lit("no")).cast("bigint")
    monkeypatch.setattr(job, "last_day_mart", lambda *_: spark.range(1).select(fails.alias("daily_volume")))
    with pytest.raises(Exception, match="no"):
        job.rebuild_mart(spark, paths["core"], paths["mart"], "2024-01-15")
    assert spark.read.parquet(paths["mart"]).count() == 1


def test_a_replacement_cut_off_is_restored(spark, tmp_path):
    target = str(tmp_path / "t")
    spark.range(3).write.parquet(f"{target}__old")
    folders.restore(spark, target)
    assert spark.read.parquet(target).count() == 3
    spark.range(5).write.parquet(str(tmp_path / "s"))
    folders.replace(spark, str(tmp_path / "s"), target)
    assert spark.read.parquet(target).count() == 5 and not folders.exists(spark, f"{target}__old")


def test_a_jdbc_mart_without_a_table_is_refused_before_the_load(spark, paths, tmp_path):
    land(tmp_path / "raw", "2024-01-16", "A", "1min", GOOD)
    with pytest.raises(ValueError, match="dbtable"):
        job.run(spark, "delta", paths["raw"], paths["core"], "jdbc:x", "2024-01-16")
    assert not os.path.exists(paths["core"])


def test_only_the_folders_of_the_asked_days_are_read(spark, paths):
    days = [f"2024-01-{d:02}" for d in range(1, 29)]
    core_table.replace_days(frame(spark, [bar("A", "daily", d) for d in days]), paths["core"])
    one = core_table.read_core(spark, paths["core"], "2024-01-15", "2024-01-15")
    assert len({os.path.dirname(f) for f in one.inputFiles()}) == 1 and one.count() == 1
    assert core_table.read_core(spark, paths["core"], "2024-01-27", "2024-02-10").count() == 2
    assert core_table.read_core(spark, paths["core"], "2025-01-01", "2025-01-02").count() == 0


def test_a_folder_that_executors_do_not_share_is_refused(spark, monkeypatch):
    assert new_folder(spark, "x").startswith(shared_folder(spark))

    class Elsewhere:
        conf = spark.conf

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(RuntimeError):
            shared_folder(Elsewhere)


def test_facts_without_names_keep_the_unknown_key(spark):
    rows = [bar("A", "daily", "2024-01-15"), bar(None, "daily", "2024-01-15"), bar("A", None, "2024-01-16")]
    star = dimensions.star_schema(frame(spark, rows))
    assert sorted((r.symbol_key, r.timeseries_key) for r in star.facts.collect()) == [(0, 1), (1, 0), (1, 1)]


def test_keys_stay_when_symbols_are_added(spark, tmp_path):
    path = str(tmp_path / "symbols")
    for names in (["M", "Z"], ["A", "M"], [], ["Z", "B", "A"]):
        table = dimensions.extend_symbol_table(symbol_list(spark, names), path)
    assert {r.symbol_name: r.symbol_key for r in table.collect()} == {"M": 1, "Z": 2, "A": 3, "B": 4}


def test_a_full_mart(spark, paths):
    core_table.merge_bars(frame(spark, [bar("A", t, "2024-01-15", open=4, high=6, low=4, close=5) for t in ("daily", "1min")]), paths["core"])
    job.rebuild_mart(spark, paths["core"], paths["mart"], "2024-01-15", full=True)
    mart = spark.read.parquet(paths["mart"])
    assert mart.columns[0] == "symbol_key" and mart.columns[-1] == "pct_change_from_open"
    assert [(r.symbol_key, r.pct_change_from_open) for r in mart.collect()] == [(1, 25.0)]


def test_the_day_of_an_instant(spark, paths, tmp_path, monkeypatch):
    land(tmp_path / "raw", "2024-09-02", "A", "1min", "2024-08-31 09:30:00,1,1,1,1,1")
    job.run(spark, "delta", paths["raw"], paths["core"], paths["mart"], "2024-09-02", instant="2024-09-02T00:00:00", zone="America/New_York")
    assert [r[2].day for r in _stored(spark, paths["core"])] == [31]


def test_unreadable_payloads_keep_their_text(spark):
    texts = ["no json", "{}", '{"Time Series (Weekly)": {}}', '{"Time Series (Daily)": {}}', None, '{"Time Series (1min)": {"2024-01-01 00:00:00": {"1. open": "1"}}}']
    found = unreadable_payloads(spark.createDataFrame([(t,) for t in texts], "payload string"), "payload").collect()
    assert {r.payload: r.reason for r in found} == {"no json": "not json", "{}": "no known series", texts[2]: "no known series", texts[3]: "no bars", None: "not json"}


def test_timeframes_are_not_mixed(spark):
    rows = [bar("A", "1min", "2024-01-15 00:01:00", volume=5, high=2), bar("A", "daily", "2024-01-15", volume=500, high=9)]
    mixed = frame(spark, rows)
    assert [r.volume for r in resample(mixed, "5min").collect()] == [5]
    assert [r.volume for r in daily_from_intraday(mixed).collect()] == [5]
    assert [r.timestamp_with_max_volume.minute for r in intraday_extremes(mixed).collect()] == [1]
    times = max_high_time(mixed, of_timeframe(mixed, "daily"), "keyed").collect()
    assert [(r.symbol_name, r.timestamp_with_max_high) for r in times] == [(None, None)]
    two = frame(spark, [bar("A", t, "2024-01-15 00:00:00") for t in ("1min", "5min")])
    with pytest.raises(Exception, match="several intervals"):
        resample(two, "15min").collect()


def test_lookups_shuffle_bars_once_at_most(spark, tmp_path):
    path = str(tmp_path / "core")
    core_table.replace_days(frame(spark, random_bars(3)), path)
    intraday, daily = (of_timeframe(core_table.read_core(spark, path), t) for t in ("1min", "daily"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for times in (max_high_time(intraday, daily, "value"), max_high_time(intraday, daily, "keyed")):
            plan = executed_plan(times)
            facts = [x for x in plan.split("Exchange hashpartitioning")[1:] if "PARTIAL" not in x.split("FileScan")[0].upper()]
            assert sum("timestamp" in x.split("FileScan")[-1][:400] for x in facts) <= 1
        plan = executed_plan(max_volume_time(intraday, "keyed"))
        assert count_nodes(plan, "FileScan parquet") == 1 and "Join" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
