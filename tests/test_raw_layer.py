from decimal import Decimal

import pytest

from candlewick.schema import BAR_COLUMNS
from candlewick.sources.raw_layer import malformed, scan_csv, scan_raw_layer, well_formed, write_raw_layer
from helpers import bar, count_nodes, executed_plan, frame, ts

HEADER = "timestamp,open,high,low,close,volume"


def land(root, load_date, symbol, timeframe, *lines, name="bars.csv"):
    folder = root / load_date / symbol / timeframe
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


def test_plain_folders_give_symbol_and_timeframe(spark, tmp_path):
    odd = ["BRK.B", "A+B", "A B", "^GSPC", "50%"]
    for symbol in odd:
        land(tmp_path, "2024-01-31", symbol, "1min", "2024-01-30 09:30:00,1,2,0.5,1.5,10")
        land(tmp_path, "2024-01-31", symbol, "daily", "2024-01-30,1,2,0.5,1.5,10")
    land(tmp_path, "2024-01-30", "OLD", "daily", "2024-01-29,1,2,0.5,1.5,10")
    rows = well_formed(scan_raw_layer(spark, str(tmp_path), "2024-01-31")).collect()
    assert {(r.symbol_name, r.timeseries_name) for r in rows} == {(s, t) for s in odd for t in ("1min", "daily")}
    only = scan_raw_layer(spark, str(tmp_path), "2024-01-31", ["daily"])
    assert {r.timeseries_name for r in only.collect()} == {"daily"}
    assert {r.timestamp for r in only.collect()} == {ts("2024-01-30")}


def test_one_scan_for_any_number_of_symbols(spark, tmp_path):
    for i in range(12):
        land(tmp_path, "2024-01-31", f"S{i}", "1min", "2024-01-30 09:30:00,1,2,0.5,1.5,10")
    plan = executed_plan(scan_raw_layer(spark, str(tmp_path), "2024-01-31"))
    assert count_nodes(plan, "FileScan csv") == 1
    assert "Union" not in plan


def test_written_layout_reads_back(spark, tmp_path):
    symbols = ["BRK.B", "A+B", "A B", "^GSPC", "50%", "A/B", "123"]
    bars = [bar(s, t, "2024-01-30", 1, 2, "0.5", "1.5", 10) for s in symbols for t in ("1min", "daily")]
    write_raw_layer(frame(spark, bars), str(tmp_path), "2024-01-31")
    back = well_formed(scan_raw_layer(spark, str(tmp_path), "2024-01-31")).select(BAR_COLUMNS)
    assert sorted(map(tuple, back.collect())) == sorted(bars)


def test_landing_again_replaces_only_that_file(spark, tmp_path):
    write_raw_layer(frame(spark, [bar("A", "daily", "2024-01-30"), bar("B", "daily", "2024-01-30")]), str(tmp_path), "2024-01-31")
    write_raw_layer(frame(spark, [bar("A", "daily", "2024-01-29", volume=7)]), str(tmp_path), "2024-01-31")
    back = scan_raw_layer(spark, str(tmp_path), "2024-01-31").collect()
    assert {(r.symbol_name, r.volume) for r in back} == {("A", 7), ("B", 1)}


def test_values_are_read_exactly(spark, tmp_path):
    land(tmp_path, "2024-01-31", "A", "1min", "2024-01-30 09:30:00,2897.0399,2897.0399,0.0001,1,3000000000")
    row = scan_raw_layer(spark, str(tmp_path), "2024-01-31").first()
    assert (row.open, row.low, row.volume) == (Decimal("2897.0399"), Decimal("0.0001"), 3_000_000_000)


BAD = ["bad,1,2,3,4,5", "2024-01-30 09:31:00,1,2,3,4,x", "2024-01-30 09:32:00,1,2,3", "2024-01-30 09:33:00,1,2,3,4,5,6", "2024-01-30 09:34:00,1,2,3,4,"]


@pytest.mark.parametrize("columns", [["symbol_name"], ["timestamp"], ["open", "volume"], BAR_COLUMNS])
def test_malformed_lines_do_not_depend_on_the_columns_read(spark, tmp_path, columns):
    land(tmp_path, "2024-01-31", "A", "1min", "2024-01-30 09:30:00,1,2,3,4,5", *BAD)
    raw = scan_raw_layer(spark, str(tmp_path), "2024-01-31")
    assert len(well_formed(raw).select(columns).collect()) == 1
    assert len(malformed(raw).select(columns).collect()) == len(BAD)


def test_malformed_lines_keep_their_text(spark, tmp_path):
    land(tmp_path, "2024-01-31", "A", "1min", *BAD)
    rows = malformed(scan_raw_layer(spark, str(tmp_path), "2024-01-31")).collect()
    # A line that is only incomplete has no parse error; its fields are all there.
    assert sorted(r.malformed_line for r in rows if r.malformed_line) == sorted(BAD[:4])


def test_a_date_without_files_is_empty(spark, tmp_path):
    for schema in ("typed", None):
        raw = scan_raw_layer(spark, str(tmp_path), "2024-01-31", **({} if schema else {"schema": None}))
        assert raw.count() == 0
        assert {"symbol_name", "timeseries_name"} <= set(raw.columns)
    assert well_formed(scan_raw_layer(spark, str(tmp_path), "2024-01-31")).select(BAR_COLUMNS).count() == 0


def test_untyped_scan_is_all_strings(spark, tmp_path):
    land(tmp_path, "2024-01-31", "A", "daily", "2024-01-30,1,2,3,4,5")
    untyped = scan_csv(spark, f"{tmp_path}/2024-01-31/A/daily")
    assert set(dict(untyped.dtypes).values()) == {"string"}
    assert tuple(untyped.first()) == ("2024-01-30", "1", "2", "3", "4", "5")
