"""Rolling totals out of hourly panes equal the read over the last day at every hour."""
from __future__ import annotations

import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from bankroll.plans import reads as P
from bankroll.plans import rolling

START = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = "city string, window_start timestamp, txn_count long"


def panes(spark, counts):
    return spark.createDataFrame([(c, START + dt.timedelta(hours=h), n) for (c, h), n in counts.items() if n], SCHEMA)


def made(seed, cities=("Pune", "Delhi", None), hours=90):
    rnd = random.Random(seed)
    return Counter({(rnd.choice(cities[:2]), rnd.randrange(hours)): rnd.randrange(1, 4) for _ in range(25)})


def read(df):
    return Counter((r["city"], r["txn_count"]) for r in df.collect())


def test_every_hour_equals_the_read(spark):
    counts = made(1)
    q3 = panes(spark, counts)
    kept = rolling.totals(rolling.changes(q3)).collect()
    for h in range(-1, 120):
        now = START + dt.timedelta(hours=h)
        want = Counter()
        for (city, at), n in counts.items():
            if h - 24 <= at <= h:
                want[city] += n
        got = {r["city"]: r["txn_count"] for r in kept
               if r["hour_from"].replace(tzinfo=dt.timezone.utc) <= now < r["hour_to"].replace(tzinfo=dt.timezone.utc)}
        assert got == dict(want), h


def test_one_hour_against_the_read_itself(spark):
    q3 = panes(spark, made(2))
    kept = rolling.totals(rolling.changes(q3))
    for h in (0, 24, 25, 60):
        now = START + dt.timedelta(hours=h)
        assert read(rolling.totals_at(kept, now)) == read(P.r3t_city_totals(q3, now, "24 hours"))


def test_changes_of_batches_add_up(spark):
    first, second = made(3), made(4)
    both = panes(spark, first + second)
    taken = Counter({k: first[k] for k in list(first)[::2]})       # half of the first is taken back later
    rest = panes(spark, Counter(first + second) - taken)
    back = panes(spark, taken).withColumn("txn_count", -F.col("txn_count"))
    parts = rolling.changes(panes(spark, first)).unionByName(rolling.changes(panes(spark, second)))
    assert Counter(rolling.totals(parts).collect()) == Counter(rolling.totals(rolling.changes(both)).collect())
    parts = parts.unionByName(rolling.changes(back))
    assert Counter(rolling.totals(parts).collect()) == Counter(rolling.totals(rolling.changes(rest)).collect())


def test_empty_and_null_cities(spark):
    assert rolling.totals(rolling.changes(panes(spark, {}))).count() == 0
    rows = rolling.totals(rolling.changes(panes(spark, {(None, 0): 2, ("Pune", 0): 1})))
    assert read(rows) == Counter({(None, 2): 1, ("Pune", 1): 1})
    gone = panes(spark, {("Pune", 0): 2}).unionByName(panes(spark, {("Pune", 0): -2}))
    assert rolling.totals(rolling.changes(gone)).count() == 0
