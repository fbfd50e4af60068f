"""Places and running sums across ranges equal those of plain windows."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bankroll.operators import ordering as O


@pytest.fixture()
def rows(spark):
    """A third of the rows have one key, some have none; orders are distinct within keys."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 50).alias("k"),
        F.hash("id").alias("o"), F.col("id").alias("v"))
    return df.repartition(5)


def test_places_and_sums(spark, rows):
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "13")  # many ranges: the large key spans several
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        laid = O.lay_out(rows, ["k"], ["o"])
        got = O.running(laid, ["k"], {"n": F.lit(1), "s": F.col("v")}, {"x": F.col("v")}).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.enabled", old[1])
    seen: dict = {}
    for r in sorted(got, key=lambda r: (r.k is not None, r.k, r.o)):
        n, s, x = seen.get(r.k, (0, 0, 0))
        seen[r.k] = (n + 1, s + r.v, x ^ r.v)
        assert (r.n, r.s, r.x) == seen[r.k]
    assert len(got) == 3000


def test_descending_and_empty(spark, rows):
    got = O.numbered(rows.filter("k = 7"), ["k"], [F.col("o").desc()]).orderBy("place").collect()
    assert [r.place for r in got] == list(range(1, len(got) + 1))
    assert [r.o for r in got] == sorted((r.o for r in got), reverse=True)
    assert O.numbered(rows.limit(0), ["k"], ["o"]).collect() == []
