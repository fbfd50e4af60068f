"""R3T as a kept table: rolling totals per city out of hourly panes.

A pane (one hour of Q3) counts in the totals of every full hour from its own start to ``hours`` later, both
included as in R3. So it is a change of +n where it comes in and of -n an hour after it last counts. Changes are
signed and add up: those of a micro-batch are made of what the batch changed in Q3 alone
(the increments of ``streaming.signed``), and are stored beside the earlier ones. A city's total is the running
sum of its changes, a row per span of hours in which it stays the same; spans without any count are left out.

A city has at most one change per hour, so a window over a city is bounded by the hours of history.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HOURS = 24


def changes(panes: DataFrame, count: str = "txn_count", hours: int = HOURS) -> DataFrame:
    """(city, at, n): the signed changes that ``panes`` (window_start, city and a count, which
    may be negative) make."""
    out = F.col("window_start") + F.make_dt_interval(hours=F.lit(hours + 1))
    both = F.array(F.struct(F.col("window_start").alias("at"), F.col(count).cast("long").alias("n")),
                   F.struct(out.alias("at"), (-F.col(count)).cast("long").alias("n")))
    return folded(panes.select("city", F.inline(both)))


def folded(rows: DataFrame) -> DataFrame:
    """Changes added up: one row per city and hour, those that cancel out gone."""
    return rows.groupBy("city", "at").agg(F.sum("n").alias("n")).filter("n <> 0")


def totals(rows: DataFrame) -> DataFrame:
    """(city, hour_from, hour_to, txn_count): the total at every full hour of [hour_from, hour_to)."""
    per_city = Window.partitionBy("city").orderBy("at")
    return (folded(rows).select(
        "city", F.col("at").alias("hour_from"), F.lead("at").over(per_city).alias("hour_to"),
        F.sum("n").over(per_city.rowsBetween(Window.unboundedPreceding, 0)).alias("txn_count"))
        .filter("txn_count <> 0"))


def totals_at(kept: DataFrame, hour: datetime) -> DataFrame:
    """R3T at a full hour, out of the kept totals."""
    now = F.lit(hour)
    return kept.filter((F.col("hour_from") <= now) & (F.col("hour_to") > now)).select("city", "txn_count")
