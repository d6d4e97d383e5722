"""The same results as plain SQL, written independently of the Spark plans."""

BARS = """
WITH ticks AS (
  SELECT event_type AS symbol_name, ts, event_id, CAST(value AS DECIMAL(18,4)) AS px,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS sz
  FROM events WHERE ts IS NOT NULL),
bars AS (
  SELECT symbol_name, '1min' AS timeseries_name, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS bar_ts,
         first(px ORDER BY ts, event_id) AS open, max(px) AS high, min(px) AS low,
         last(px ORDER BY ts, event_id) AS close, CAST(sum(sz) AS BIGINT) AS volume
  FROM ticks GROUP BY 1, 2, 3
  UNION ALL
  SELECT symbol_name, 'daily', CAST(date_trunc('day', ts) AS TIMESTAMP),
         first(px ORDER BY ts, event_id), max(px), min(px),
         last(px ORDER BY ts, event_id), CAST(sum(sz) AS BIGINT)
  FROM ticks GROUP BY 1, 2, 3),
dated AS (SELECT *, CAST(bar_ts AS DATE) AS trade_date FROM bars),
daily AS (SELECT * FROM dated WHERE timeseries_name = 'daily'),
intraday AS (SELECT * FROM dated WHERE timeseries_name = '1min'),
max_volumes AS (SELECT trade_date, symbol_name, max(volume) AS volume FROM intraday GROUP BY ALL),
"""

# Parts of further CTEs that follow BARS.
ALL_COLUMNS = 'symbol_name, timeseries_name, bar_ts AS "timestamp", open, high, low, close, volume'
AS_OF = "DATE '2024-01-15'"
TRIM_TO = "DATE '2024-01-20'"


def _bars(columns: str, source: str = "bars", tail: str = "") -> str:
    return f"{BARS} result AS (SELECT {columns} FROM {source} {tail}) SELECT * FROM result"


def _lookup(targets: str, value: str, keyed: bool, name: str) -> str:
    key = "AND b.symbol_name = t.symbol_name" if keyed else ""
    return f"""
      SELECT t.trade_date, b.symbol_name, min(b.bar_ts) AS {name}
      FROM intraday b RIGHT JOIN {targets} t
        ON b.trade_date = t.trade_date AND b.{value} = t.{value} {key}
      GROUP BY t.trade_date, b.symbol_name"""


LOOKUPS = {
    "max_volume": ("max_volumes", "volume", "timestamp_with_max_volume"),
    "high": ("daily", "high", "timestamp_with_max_high"),
    "low": ("daily", "low", "timestamp_with_min_low"),
}


def _lookup_query(which: str, keyed: bool) -> str:
    targets, value, name = LOOKUPS[which]
    return f"{BARS} result AS ({_lookup(targets, value, keyed, name)}) SELECT * FROM result"


def _mart(keyed: bool, columns: str, tail: str = "", extra: str = "") -> str:
    parts = ",".join(
        f"{which}_at AS ({_lookup(targets, value, keyed, name)})"
        for which, (targets, value, name) in LOOKUPS.items()
    )
    return f"""{BARS} {parts},
      mart AS (
        SELECT d.trade_date, d.symbol_name, d.volume AS daily_volume, d.open AS daily_open,
               d.close AS daily_close,
               100 - (CAST(d.open AS DOUBLE) * 100 / nullif(CAST(d.close AS DOUBLE), 0)) AS daily_volatility,
               v.timestamp_with_max_volume, h.timestamp_with_max_high, l.timestamp_with_min_low
        FROM daily d
        JOIN max_volume_at v ON v.trade_date = d.trade_date AND v.symbol_name = d.symbol_name
        JOIN high_at h ON h.trade_date = d.trade_date AND h.symbol_name = d.symbol_name
        JOIN low_at l ON l.trade_date = d.trade_date AND l.symbol_name = d.symbol_name)
      {extra}
      SELECT {columns} FROM mart {tail}"""


_ONE_DAY = ("* EXCLUDE (trade_date)", f"WHERE trade_date = {AS_OF}")
_SYMBOLS = "symbols AS (SELECT symbol_name, row_number() OVER (ORDER BY symbol_name) AS symbol_key FROM (SELECT DISTINCT symbol_name FROM bars))"


def _resample(minutes: int) -> str:
    return _bars(
        f"""symbol_name, '{minutes}min' AS timeseries_name,
            time_bucket(INTERVAL {minutes} MINUTE, bar_ts) AS "timestamp",
            first(open ORDER BY bar_ts) AS open, max(high) AS high, min(low) AS low,
            last(close ORDER BY bar_ts) AS close, CAST(sum(volume) AS BIGINT) AS volume""",
        "intraday",
        "GROUP BY 1, 2, 3",
    )


_GRID = """symbols AS (SELECT DISTINCT symbol_name FROM intraday),
  grid AS (SELECT symbol_name, strftime(DATE '2024-01-01' - to_months(CAST(i AS INTEGER)), '%Y-%m') AS month
           FROM symbols, range(6) t(i))"""

_STAMP = "strftime(bar_ts, '%Y-%m-%d %H:%M:%S')"

ORACLE_SQL: dict[str, str] = {
    "csv_scan_typed": _bars('bar_ts AS "timestamp", open, high, low, close, volume'),
    "csv_scan_untyped": _bars(
        f'{_STAMP} AS "timestamp", '
        + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ("open", "high", "low", "close", "volume"))
    ),
    "raw_layer_scan": _bars(ALL_COLUMNS),
    "raw_layer_sink": _bars(
        "DATE '2024-01-31' AS load_date, symbol_name, timeseries_name, bar_ts AS \"timestamp\", "
        "open, high, low, close, CASE WHEN timeseries_name = 'daily' THEN volume + 1 ELSE volume END AS volume"
    ),
    "core_table_scan": _bars(
        f"{ALL_COLUMNS}, CAST(year(bar_ts) * 100 + month(bar_ts) AS INTEGER) AS yyyymm, trade_date", "dated"
    ),
    "payload_screen": """
      SELECT doc_id, CASE WHEN contains(text, 'license') THEN 'error'
                          WHEN contains(text, '@') THEN 'throttled' ELSE 'ok' END AS payload_class
      FROM documents""",
    "json_timeseries": _bars(ALL_COLUMNS, "intraday"),
    "project_daily": _bars(
        'bar_ts AS "timestamp", symbol_name, volume AS daily_volume, open AS daily_open, close AS daily_close',
        "daily",
    ),
    "with_literals": _bars(
        "bar_ts AS \"timestamp\", open, high, low, close, volume, 'ALL' AS symbol_name, '1min' AS timeseries_name",
        "intraday",
    ),
    "daily_volatility": _bars(
        'symbol_name, bar_ts AS "timestamp", '
        "100 - (CAST(open AS DOUBLE) * 100 / nullif(CAST(close AS DOUBLE), 0)) AS daily_volatility",
        "daily",
    ),
    "pct_change_from_open": _bars(
        'symbol_name, bar_ts AS "timestamp", '
        "(CAST(close AS DOUBLE) - CAST(open AS DOUBLE)) * 100 / nullif(CAST(open AS DOUBLE), 0)"
        " AS pct_change_from_open",
        "daily",
    ),
    "as_of_dates": """
      SELECT event_id, CAST(ts AS DATE) - 1 AS utc_yesterday,
             CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) AS eastern_today,
             CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) - 1 AS eastern_yesterday
      FROM events""",
    "filter_timeframe": _bars(ALL_COLUMNS, "daily"),
    "filter_as_of": _bars(ALL_COLUMNS, "dated", f"WHERE trade_date = {AS_OF}"),
    "filter_delta_day": _bars(ALL_COLUMNS, "dated", f"WHERE trade_date = {AS_OF}"),
    "filter_date_range": _bars(
        ALL_COLUMNS,
        "daily",
        f"WHERE trade_date BETWEEN (SELECT min(trade_date) FROM intraday) AND {TRIM_TO}",
    ),
    "filter_followed_symbols": _bars(
        ALL_COLUMNS, tail="WHERE symbol_name IN ('click', 'purchase', 'view')"
    ),
    **{
        f"lookup_{which}_{match}": _lookup_query(which, match == "keyed")
        for which in LOOKUPS
        for match in ("value", "keyed")
    },
    "agg_max_volume": _bars("symbol_name, max(volume) AS volume", "intraday", "GROUP BY 1"),
    "agg_first_bar": _bars("symbol_name, min(bar_ts) AS first_timestamp", "intraday", "GROUP BY 1"),
    "min_intraday_date": _bars("min(trade_date) AS min_date", "intraday"),
    "first_bar_top1": _bars(ALL_COLUMNS, "intraday", "ORDER BY bar_ts, symbol_name LIMIT 1"),
    "ordered_bars": _bars(ALL_COLUMNS, tail="ORDER BY bar_ts DESC, symbol_name"),
    "union_timeframes": _bars(ALL_COLUMNS),
    "pipeline_initial": _bars(
        ALL_COLUMNS,
        "dated",
        "WHERE timeseries_name = '1min' OR trade_date BETWEEN "
        f"(SELECT min(trade_date) FROM intraday) AND {TRIM_TO}",
    ),
    "pipeline_delta": _bars(
        'symbol_name, timeseries_name, bar_ts AS "timestamp", open, high, low, close, '
        f"CASE WHEN trade_date = {AS_OF} THEN volume + 1 ELSE volume END AS volume",
        "dated",
    ),
    "pipeline_delta_out_of_order": _bars(
        'symbol_name, timeseries_name, bar_ts AS "timestamp", open, high, low, close, '
        f"CASE WHEN trade_date = {AS_OF} THEN volume + 1 ELSE volume END AS volume",
        "dated",
    ),
    "pipeline_stream_corrected": _bars(
        'symbol_name, timeseries_name, bar_ts AS "timestamp", open, high, low, close, '
        "CASE WHEN symbol_name = 'purchase' THEN volume + 1 ELSE volume END AS volume",
        "dated",
    ),
    "pipeline_delta_unchanged": _bars(f"trade_date, count(*) AS bars, trade_date = {AS_OF} AS rewritten", "dated", "GROUP BY trade_date"),
    "rollup_after_delta": _bars(
        f"""symbol_name, '5min' AS timeseries_name, time_bucket(INTERVAL 5 MINUTE, bar_ts) AS "timestamp",
            first(open ORDER BY bar_ts) AS open, max(high) AS high, min(low) AS low, last(close ORDER BY bar_ts) AS close,
            CAST(sum(CASE WHEN trade_date = {AS_OF} THEN volume + 1 ELSE volume END) AS BIGINT) AS volume""",
        "intraday",
        "GROUP BY 1, 2, 3",
    ),
    "pipeline_json": _bars(ALL_COLUMNS),
    "pipeline_json_quarantine": """SELECT DATE '2024-01-31' AS load_date, 'click' AS symbol_name, '1min' AS timeseries_name, CAST(NULL AS TIMESTAMP) AS "timestamp",
          '{"Error Message":"' || n_name || '"}' AS malformed_line, 'error' AS payload_class, 'no known series' AS reason FROM nation
        UNION ALL SELECT DATE '2024-01-31', r_name, '1min', NULL, '{"1. open":"1"}', 'malformed', 'unreadable bar' FROM region
        UNION ALL SELECT DATE '2024-01-31', r_name, '1min', TIMESTAMP '2024-01-01 00:00:00', '{"1. open":"x"}', 'malformed', 'incomplete bar' FROM region""",
    "json_all_series": f"""{BARS} five AS (
        SELECT symbol_name, '5min' AS timeseries_name, time_bucket(INTERVAL 5 MINUTE, bar_ts) AS "timestamp",
          first(open ORDER BY bar_ts) AS open, max(high) AS high, min(low) AS low, last(close ORDER BY bar_ts) AS close, CAST(sum(volume) AS BIGINT) AS volume
        FROM intraday GROUP BY 1, 2, 3)
        SELECT {ALL_COLUMNS} FROM bars UNION ALL SELECT * FROM five
        UNION ALL SELECT symbol_name, 'Adjusted', bar_ts, open, high, low, close, volume FROM daily""",
    "refetch_list": f"""{BARS} {_GRID}
        SELECT symbol_name, '1min' AS timeseries_name, month, CAST(NULL AS DATE) AS load_date, 'missing' AS state FROM grid g WHERE NOT EXISTS (
          SELECT 1 FROM intraday b WHERE b.symbol_name = g.symbol_name AND strftime(b.bar_ts, '%Y-%m') = g.month)
        UNION ALL SELECT 'click', '1min', NULL, DATE '2024-01-31', 'error' WHERE EXISTS (SELECT 1 FROM nation)
        UNION ALL SELECT 'view', '1min', NULL, DATE '2024-01-31', 'malformed' WHERE EXISTS (SELECT 1 FROM region)""",
    "latest_100_from_core": f"""{BARS} ranked AS (
        SELECT *, row_number() OVER (PARTITION BY symbol_name, timeseries_name ORDER BY bar_ts DESC) AS place
        FROM bars) SELECT {ALL_COLUMNS} FROM ranked WHERE place <= 100""",
    "min_intraday_date_from_core": _bars("min(trade_date) AS min_date", "intraday"),
    "core_followed_scan": _bars(ALL_COLUMNS, tail="WHERE symbol_name IN ('click', 'purchase', 'view')"),
    "pipeline_screened": _bars(ALL_COLUMNS),
    "pipeline_quarantine": f"""{BARS} refused AS (
        SELECT 'click' AS symbol_name, '1min' AS timeseries_name, CAST(NULL AS TIMESTAMP) AS "timestamp", CAST(NULL AS BIGINT) AS volume,
               '{{"Error Message": "' || n_name || '"}}' AS malformed_line, 'error' AS payload_class FROM nation
        UNION ALL SELECT 'view', '1min', NULL, NULL, 'broken,' || r_name, 'malformed' FROM region
        UNION ALL SELECT 'purchase', 'daily', NULL, NULL, 'Thank you for using Alpha Vantage! ' || r_name, 'throttled' FROM region
        UNION ALL SELECT 'purchase', 'daily', bar_ts, volume + 7, NULL, 'throttled' FROM daily)
      SELECT DATE '2024-01-31' AS load_date, * FROM refused""",
    "json_timeseries_unreadable": "SELECT doc_id, text, 'not json' AS reason FROM documents",
    "resample_5min_from_core": _resample(5),
    "symbol_dim_grown": f"""{BARS} named AS (SELECT DISTINCT symbol_name, symbol_name NOT IN ('purchase', 'view') AS later FROM intraday)
      SELECT row_number() OVER (ORDER BY later, symbol_name) AS symbol_key, symbol_name FROM named""",
    "mart_full": _mart(
        True,
        "symbol_key, mart.* EXCLUDE (trade_date), "
        "(CAST(daily_close AS DOUBLE) - CAST(daily_open AS DOUBLE)) * 100 / nullif(CAST(daily_open AS DOUBLE), 0) AS pct_change_from_open",
        f"JOIN day_symbols USING (symbol_name) WHERE trade_date = {AS_OF}",
        ", day_symbols AS (SELECT symbol_name, row_number() OVER (ORDER BY symbol_name) AS symbol_key "
        f"FROM (SELECT DISTINCT symbol_name FROM dated WHERE trade_date = {AS_OF}))",
    ),
    "pipeline_initial_then_mart": _mart(True, *_ONE_DAY),
    "pipeline_delta_then_mart": _mart(True, *_ONE_DAY),
    "mart_last_day": _mart(True, *_ONE_DAY),
    "mart_last_day_value": _mart(False, *_ONE_DAY),
    "mart_all_days": _mart(True, "*"),
    "mart_all_days_value": _mart(False, "*"),
    "backfill_grid": f"{BARS} {_GRID} SELECT symbol_name, month FROM grid",
    "backfill_missing": f"""{BARS} {_GRID} SELECT symbol_name, month FROM grid g WHERE NOT EXISTS (
        SELECT 1 FROM intraday b WHERE b.symbol_name = g.symbol_name AND strftime(b.bar_ts, '%Y-%m') = g.month)""",
    "latest_100_bars": f"""{BARS} ranked AS (
        SELECT *, row_number() OVER (PARTITION BY symbol_name, timeseries_name ORDER BY bar_ts DESC) AS place
        FROM bars) SELECT {ALL_COLUMNS} FROM ranked WHERE place <= 100""",
    "trailing_days": _bars(
        ALL_COLUMNS,
        "intraday",
        f"WHERE bar_ts >= {TRIM_TO} - INTERVAL 10 DAY AND bar_ts < {TRIM_TO} + INTERVAL 1 DAY",
    ),
    **{f"resample_{m}min": _resample(m) for m in (5, 15, 30, 60)},
    "daily_from_intraday": _bars(ALL_COLUMNS, "daily"),
    "month_slice": _bars(
        ALL_COLUMNS, "intraday", "WHERE bar_ts >= TIMESTAMP '2024-01-01' AND bar_ts < TIMESTAMP '2024-02-01'"
    ),
    "symbol_dim": f"{BARS} {_SYMBOLS} SELECT symbol_key, symbol_name FROM symbols",
    "mart_with_key": _mart(
        True, "symbol_key, mart.*", "JOIN symbols ON symbols.symbol_name = mart.symbol_name", f", {_SYMBOLS}"
    ),
    "extremes_intraday": f"""{BARS}
      highest AS (SELECT trade_date, symbol_name, max(volume) AS volume, max(high) AS high, min(low) AS low
                  FROM intraday GROUP BY ALL)
      SELECT trade_date, symbol_name,
             min(bar_ts) FILTER (WHERE b.volume = t.volume) AS timestamp_with_max_volume,
             min(bar_ts) FILTER (WHERE b.high = t.high) AS timestamp_with_max_high,
             min(bar_ts) FILTER (WHERE b.low = t.low) AS timestamp_with_min_low
      FROM intraday b JOIN highest t USING (trade_date, symbol_name)
      GROUP BY trade_date, symbol_name""",
    "star_schema_bars": f"""{BARS} {_SYMBOLS},
      series AS (SELECT timeseries_name, row_number() OVER (ORDER BY timeseries_name) AS timeseries_key
                 FROM (SELECT DISTINCT timeseries_name FROM bars))
      SELECT symbol_key, timeseries_key, bar_ts AS "timestamp", open, high, low, close, volume
      FROM bars JOIN symbols USING (symbol_name) JOIN series USING (timeseries_name)""",
}
