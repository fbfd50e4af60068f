"""Aggregates kept by signed differences.

A micro-batch changes an aggregate by what its rows add under the new state less what their earlier
versions added under the old one. Each batch appends these signed increments; nothing of the
groups' other rows is read. A result is the sum of its increments, a group is there while its rows
are more than none.

Amounts that the exact decimal form holds are summed in it, so what is taken back is taken back
exactly. Any other amount (more places, too large, not finite) stays a value of its own, ``odd``, with a
signed number of rows, and is multiplied in at the end only if rows are left.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import buckets as B
from ..model import CITY_HIGH_VALUE, RESULT_KEYS, WINDOW
from ..plans import rollups as R

SIGNED = ("q3", "q5b", "q6")
OWNER = {"q5b": "customer_id", "q6": "branch_id"}
# what each result reads of a transaction
COLUMNS = {"q3": ("txn_id", "account_id", "amount", "txn_time"), "q5b": ("txn_id", "account_id", "amount", "txn_time"),
           "q6": ("txn_id", "account_id", "amount", "txn_time", "status")}


def parts(name: str, t: Mapping[str, DataFrame]) -> DataFrame:
    """(result keys, odd, amt, n): what the transactions of ``t`` add to result ``name``."""
    keys, none = RESULT_KEYS[name], F.lit(None).cast("double")
    if name == "q3":
        return R.q3_high_value_by_city(t).select(*keys, none.alias("odd"), F.lit(0).cast(B.EXACT).alias("amt"),
                                                 F.col("txn_count").alias("n"))
    x, owner = t["transaction"], OWNER[name]
    if name == "q5b":
        bucket, key = B.quarter_label("txn_time"), "quarter"
    else:
        x, bucket, key = x.filter(F.col("status") == "approved"), B.to_day("txn_time"), "txn_date"
    exact = B.money("amount")
    # per account first, so that an account with very many rows is one row a bucket in the join
    rows = x.select("account_id", bucket.alias(key), exact.alias("amt"),
                    F.when(exact.isNull(), F.col("amount")).alias("odd"))
    per_account = rows.groupBy("account_id", key, "odd").agg(
        F.coalesce(F.sum("amt"), F.lit(0)).alias("amt"), F.count(F.lit(1)).alias("n"))
    joined = per_account.join(t["account"].select("account_id", owner), "account_id")
    return joined.groupBy(*keys, "odd").agg(F.sum("amt").alias("amt"), F.sum("n").alias("n"))


def folded(increments: DataFrame, name: str) -> DataFrame:
    """Increments summed up: one row per result key and odd amount."""
    return increments.groupBy(*RESULT_KEYS[name], "odd").agg(
        F.sum("amt").cast("decimal(38,12)").alias("amt"), F.sum("n").alias("n")).filter("n <> 0 or amt <> 0")


def difference(name: str, before: Mapping[str, DataFrame], after: Mapping[str, DataFrame]) -> DataFrame:
    """What the transactions of ``after`` add, less what those of ``before`` added."""
    old = parts(name, before)
    taken = old.withColumn("amt", -F.col("amt")).withColumn("n", -F.col("n"))
    return folded(parts(name, after).unionByName(taken), name)


def change(name: str, rows: DataFrame, before: Mapping[str, DataFrame], after: Mapping[str, DataFrame],
           revisited: DataFrame | None = None) -> DataFrame:
    """What a batch changes of result ``name``: ``rows`` are transactions with a ``role``. ``new`` versions add
    under the dimensions ``after``, ``old`` ones are taken back under those ``before``, and the ``rest`` moves from
    the one to the other where its account is among ``revisited``."""
    keys, owner = RESULT_KEYS[name], OWNER.get(name, "city")
    owners = []
    for sign, role, t in ((1, "new", after), (-1, "old", before)):
        side = R.account_city(t) if name == "q3" else t["account"].select("account_id", owner)
        for as_role in (role,) if revisited is None else (role, "rest"):
            own = side if as_role == role else side.join(revisited, "account_id", "left_semi")
            owners.append(own.select("account_id", owner, F.lit(as_role).alias("role"), F.lit(sign).alias("sign")))
    sides = reduce(DataFrame.unionByName, owners)
    if name == "q3":
        per_account = rows.filter(B.above("amount", CITY_HIGH_VALUE)).groupBy(
            "account_id", "role", F.window("txn_time", WINDOW).alias("w")).agg(F.count("txn_id").alias("n")).select(
            "account_id", "role", F.col("w.start").alias("window_start"), F.lit(None).cast("double").alias("odd"),
            F.lit(0).cast(B.EXACT).alias("amt"), "n")
    else:
        if name == "q6":
            rows = rows.filter(F.col("status") == "approved")
        bucket, key = ((B.quarter_label("txn_time"), "quarter") if name == "q5b" else
                       (B.to_day("txn_time"), "txn_date"))
        exact = B.money("amount")
        per_account = rows.select("account_id", "role", bucket.alias(key), exact.alias("amt"), F.when(
            exact.isNull(), F.col("amount")).alias("odd")).groupBy("account_id", "role", key, "odd").agg(
            F.coalesce(F.sum("amt"), F.lit(0)).alias("amt"), F.count(F.lit(1)).alias("n"))
    joined = per_account.join(sides, ["account_id", "role"])
    part = joined.groupBy(*keys, "odd", "sign").agg(F.sum("amt").alias("amt"), F.sum("n").alias("n"))
    taken = F.col("sign") < 0
    return folded(part.withColumn("amt", F.when(taken, -F.col("amt")).otherwise(F.col("amt")))
                  .withColumn("n", F.when(taken, -F.col("n")).otherwise(F.col("n"))), name)


def totals(increments: DataFrame, name: str) -> DataFrame:
    """The result that the increments add up to, in the columns of its rollup."""
    keys = RESULT_KEYS[name]
    left = folded(increments, name).groupBy(*keys).agg(
        F.sum("amt").alias("amt_s"), F.sum(F.col("odd") * F.col("n")).alias("amt_ns"), F.sum("n").alias("rows"))
    left = left.filter("rows > 0")
    if name == "q3":
        return left.select("window_start", (F.col("window_start") + F.expr(f"INTERVAL {WINDOW}")).alias("window_end"),
                           "city", F.col("rows").alias("txn_count"))
    if name == "q5b":
        return left.select(*keys, B.money_total("amt").alias("amount"))
    return left.select("branch_id", B.year_text("txn_date").alias("txn_year"), "txn_date",
                       B.money_total("amt").alias("total_amount"), F.col("rows").alias("count_txn"))
