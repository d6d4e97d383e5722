"""Small bar tables, plan inspection, and a plain-Python model of the mart."""

import random
import re
from datetime import datetime
from decimal import Decimal

from candlewick.schema import CORE_BAR


def ts(text):
    return datetime.fromisoformat(text)


def bar(symbol, timeframe, stamp, open=1, high=1, low=1, close=1, volume=1):
    prices = [None if p is None else Decimal(str(p)) for p in (open, high, low, close)]
    return (symbol, timeframe, None if stamp is None else ts(stamp), *prices, volume)


def frame(spark, bars):
    return spark.createDataFrame(bars, CORE_BAR)


def random_bars(seed, symbols="ABCDEF", days=3, minutes=25):
    """Bars with few distinct values, so that ties and matches across symbols abound."""
    rng = random.Random(seed)

    def value():
        return rng.choice([None, *range(1, 7)]) if rng.random() < 0.1 else rng.randint(1, 6)

    rows = []
    for symbol in symbols:
        for day in range(1, days + 1):
            if rng.random() < 0.85:
                rows.append(bar(symbol, "daily", f"2024-03-{day:02}", value(), value(), value(), value(), value()))
            for minute in rng.sample(range(60), rng.randint(0, minutes)):
                stamp = f"2024-03-{day:02} 10:{minute:02}:00"
                rows.append(bar(symbol, "1min", stamp, value(), value(), value(), value(), value()))
    return rows


def model_mart(rows, match):
    """{(day, symbol): (volume time, high time, low time)} by nested loops."""

    def earliest(symbol, day, position, wanted):
        times = [
            r[2]
            for r in rows
            if r[1] == "1min" and r[0] == symbol and r[2].date() == day and r[position] is not None and r[position] in wanted
        ]
        return min(times, default=None)

    def volumes(symbol, day):
        return [r[7] for r in rows if r[1] == "1min" and r[0] == symbol and r[2].date() == day and r[7] is not None]

    daily = [r for r in rows if r[1] == "daily"]
    symbols = {r[0] for r in rows}
    mart = {}
    for d in daily:
        symbol, day = d[0], d[2].date()
        sources = [symbol] if match == "keyed" else symbols
        maxima = {max(volumes(s, day)) for s in sources if volumes(s, day)}
        peers = [p for p in daily if p[2].date() == day and p[0] in sources]
        times = (
            earliest(symbol, day, 7, maxima),
            earliest(symbol, day, 4, {p[4] for p in peers}),
            earliest(symbol, day, 5, {p[5] for p in peers}),
        )
        if None not in times:
            mart[day, symbol] = times
    return mart


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count_nodes(plan, name):
    return len(re.findall(rf"(?m)^[\s:+\-*()\d]*{name}\b", plan))
