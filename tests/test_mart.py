from datetime import date

import pytest
from pyspark.sql import functions as F

from candlewick.functions.prices import daily_volatility, pct_change_from_open
from candlewick.operators.aggregates import intraday_extremes
from candlewick.operators.bars import of_timeframe
from candlewick.operators.lookups import max_high_time, max_volume_time, min_low_time
from candlewick.plans.mart import daily_marts, last_day_mart
from candlewick.schema import MART_COLUMNS
from candlewick.sources.core_table import read_core, replace_days
from helpers import bar, count_nodes, executed_plan, frame, model_mart, random_bars, ts

DAY = "2024-01-15"


def _times(mart):
    return {
        (r.trade_date, r.symbol_name): (r.timestamp_with_max_volume, r.timestamp_with_max_high, r.timestamp_with_min_low)
        for r in mart.collect()
    }


@pytest.mark.parametrize("match", ["keyed", "value"])
@pytest.mark.parametrize("seed", range(6))
def test_against_nested_loops(spark, seed, match):
    rows = random_bars(seed)
    assert _times(daily_marts(frame(spark, rows), match)) == model_mart(rows, match)


@pytest.mark.parametrize("seed", range(3))
def test_single_pass_equals_the_joins(spark, seed):
    bars = frame(spark, random_bars(seed, days=5))
    daily = of_timeframe(bars, "daily").withColumn("trade_date", F.to_date("timestamp"))
    intraday = of_timeframe(bars, "1min")
    joined = daily.select("trade_date", "symbol_name")
    for times in (
        max_volume_time(intraday, "keyed"),
        max_high_time(intraday, daily, "keyed"),
        min_low_time(intraday, daily, "keyed"),
    ):
        joined = joined.join(times, ["trade_date", "symbol_name"])
    assert _times(joined) == _times(daily_marts(bars))


def test_volume_of_another_symbol(spark):
    bars = frame(
        spark,
        [
            bar("A", "1min", f"{DAY} 10:00:00", volume=9),
            bar("B", "1min", f"{DAY} 09:00:00", volume=9),
            bar("B", "1min", f"{DAY} 11:00:00", volume=20),
        ],
    )
    value = {r.symbol_name: r.timestamp_with_max_volume for r in max_volume_time(bars, "value").collect()}
    keyed = {r.symbol_name: r.timestamp_with_max_volume for r in max_volume_time(bars, "keyed").collect()}
    assert value == {"A": ts(f"{DAY} 10:00:00"), "B": ts(f"{DAY} 09:00:00")}
    assert keyed == {"A": ts(f"{DAY} 10:00:00"), "B": ts(f"{DAY} 11:00:00")}


def _unmatched(spark):
    return frame(
        spark,
        [
            bar("A", "daily", DAY, high=10),
            bar("A", "1min", f"{DAY} 10:00:00", high=9),
            bar("A", "1min", f"{DAY} 10:01:00", high=9),
        ],
    )


def test_unmatched_high_drops_the_symbol(spark):
    bars = _unmatched(spark)
    for match in ("keyed", "value"):
        assert last_day_mart(bars, DAY, match).count() == 0
    extremes = intraday_extremes(of_timeframe(bars, "1min")).first()
    assert extremes.timestamp_with_max_high == ts(f"{DAY} 10:00:00")


@pytest.mark.parametrize("match", ["keyed", "value"])
def test_unmatched_target_leaves_a_null_symbol(spark, match):
    bars = _unmatched(spark)
    rows = max_high_time(of_timeframe(bars, "1min"), of_timeframe(bars, "daily"), match).collect()
    assert list(map(tuple, rows)) == [(date(2024, 1, 15), None, None)]


def test_zero_close_keeps_the_row(spark):
    bars = frame(spark, [bar("A", "daily", DAY, close=0), bar("A", "1min", f"{DAY} 10:00:00")])
    for match in ("keyed", "value"):
        row = last_day_mart(bars, DAY, match).first()
        assert row.daily_volatility is None and row.daily_close == 0


def test_day_without_bars_gives_an_empty_mart(spark):
    bars = frame(spark, [bar("A", "daily", DAY), bar("A", "1min", f"{DAY} 10:00:00")])
    for match in ("keyed", "value"):
        empty = last_day_mart(bars, "2024-01-20", match)
        assert empty.columns == MART_COLUMNS and empty.count() == 0
        assert empty.dtypes == last_day_mart(bars, DAY, match).dtypes


def test_other_timeframes_do_not_take_part(spark):
    bars = frame(
        spark,
        [bar("A", "daily", DAY, high=5), bar("A", "1min", f"{DAY} 10:00:00", high=5), bar("A", "5min", f"{DAY} 09:00:00", high=5, volume=99)],
    )
    assert last_day_mart(bars, DAY).first().timestamp_with_max_volume == ts(f"{DAY} 10:00:00")


def test_changes(spark):
    row = frame(spark, [bar("A", "daily", DAY, open=8, close=10), ]).select(
        daily_volatility("open", "close").alias("of_close"), pct_change_from_open("open", "close").alias("of_open")
    ).first()
    assert (row.of_close, row.of_open) == (20.0, 25.0)


def test_one_scan_one_shuffle_no_join(spark, tmp_path):
    path = str(tmp_path / "core")
    replace_days(frame(spark, random_bars(1)), path)
    for mart in (daily_marts(read_core(spark, path)), last_day_mart(read_core(spark, path), "2024-03-02")):
        plan = executed_plan(mart)
        assert count_nodes(plan, "FileScan parquet") == 1
        assert count_nodes(plan, "Exchange hashpartitioning") == 1
        assert "Join" not in plan


def test_value_join_never_pairs_a_bar_twice(spark):
    """Many symbols, one shared value: rows out of the join stay one per symbol."""
    symbols = [f"S{i}" for i in range(40)]
    bars = frame(
        spark,
        [bar(s, "daily", DAY) for s in symbols] + [bar(s, "1min", f"{DAY} 10:{m:02}:00") for s in symbols for m in range(20)],
    )
    assert last_day_mart(bars, DAY, "value").count() == 40
    times = max_high_time(of_timeframe(bars, "1min"), of_timeframe(bars, "daily"), "value")
    # Bars meet the distinct targets before anything is grouped, and are grouped once after that.
    plan = times._jdf.queryExecution().optimizedPlan().toString()
    bars_side = plan[plan.index("Join Inner") :]
    assert "Aggregate" not in bars_side
    assert plan.count("Aggregate") == 2
    rows = {(r.trade_date, r.symbol_name) for r in times.collect()}
    assert len(rows) == 40
