"""Every registered query against its SQL, on whole tables, as sorted rows of typed values."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from candlewick.catalog.oracle import ORACLE_SQL
from candlewick.catalog.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _sorted(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(name, spark, database, sf_dir):
    result = entry_point.queries()[name](spark, sf_dir)
    found = _sorted(result.columns, [tuple(row) for row in result.collect()])
    cursor = database.execute(entry_point.oracle_sql()[name])
    wanted = _sorted([d[0] for d in cursor.description], cursor.fetchall())
    assert found == wanted
    assert found[1]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLE_SQL) <= set(entry_point.oracle_sql())


def test_entry(spark):
    assert entry_point.entry(spark).count() == 5


# Symbol: volume, then hour and minute of largest volume, highest and lowest price on 2024-01-15.
KNOWN = {
    "click": (2249, "16:00", "01:32", "16:00"),
    "error": (3289, "05:51", "02:09", "02:51"),
    "purchase": (3146, "19:10", "00:08", "10:48"),
    "signup": (3451, "04:08", "08:49", "20:44"),
    "view": (3375, "23:06", "01:40", "00:14"),
}


@pytest.mark.parametrize(("query", "view_volume_time"), [("mart_last_day", "23:06"), ("mart_last_day_value", "00:36")])
def test_known_mart_rows(spark, sf_dir, query, view_volume_time):
    rows = entry_point.queries()[query](spark, sf_dir).collect()
    times = ["timestamp_with_max_volume", "timestamp_with_max_high", "timestamp_with_min_low"]
    found = {r.symbol_name: (r.daily_volume, *[r[t].strftime("%H:%M") for t in times]) for r in rows}
    volume, _, high, low = KNOWN["view"]
    assert found == KNOWN | {"view": (volume, view_volume_time, high, low)}
