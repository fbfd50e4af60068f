"""Data-quality jobs over the contracts (QC1-QC8).

QC1-QC7 return ``(rule, tbl, item, violations)`` rows; QC8 returns value shares against
the generator's target weights. Every check is an aggregation with a partial phase or
an anti/semi join, one pass per table; nothing is collected to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import buckets as B
from ..model import (AMOUNT_MAX, AMOUNT_MIN, DOMAINS, FOREIGN_KEYS, MANAGER_SHARE, PRIMARY_KEYS,
                     SCHEMAS, TARGET_WEIGHTS)
from ..operators.joins import bounded_broadcast, orphan_count

Tables = Mapping[str, DataFrame]


def _counts_to_rows(df: DataFrame, rule: str, table: str, items: dict[str, F.Column]) -> DataFrame:
    """One pass over ``df`` computing one violation count per item, as rows."""
    agg = df.agg(*[F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")
                   .alias(f"c{i}") for i, cond in enumerate(items.values())])
    pairs = F.array(*[F.struct(F.lit(name).alias("item"), F.col(f"c{i}").alias("violations"))
                      for i, name in enumerate(items)])
    return agg.select(F.inline(pairs)).select(
        F.lit(rule).alias("rule"), F.lit(table).alias("tbl"), "item", "violations")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def qc1_domains(t: Tables) -> DataFrame:
    """QC1: values outside the enum domains (nulls are QC2's business)."""
    by_table: dict[str, dict[str, F.Column]] = {}
    for (table, col), domain in DOMAINS.items():
        by_table.setdefault(table, {})[col] = F.col(col).isNotNull() & ~F.col(col).isin(domain)
    return _union([_counts_to_rows(t[tb], "QC1", tb, items) for tb, items in by_table.items()])


def qc2_not_null(t: Tables, tables: list[str] | None = None) -> DataFrame:
    """QC2: nulls in required columns; NaN amounts."""
    parts = []
    for tb in tables or ["branch", "customer", "employee", "product", "account", "transaction"]:
        items = {f.name: F.col(f.name).isNull() for f in SCHEMAS[tb].fields if not f.nullable}
        if tb == "transaction":
            items["amount_nan"] = F.isnan("amount")
        parts.append(_counts_to_rows(t[tb], "QC2", tb, items))
    return _union(parts)


def qc3_foreign_keys(t: Tables) -> DataFrame:
    """QC3: child rows whose non-null foreign key has no parent (J7 anti joins)."""
    parts = []
    for child, ccol, parent, pcol in FOREIGN_KEYS:
        n = orphan_count(t[child].select(ccol), ccol, t[parent].select(pcol), pcol)
        parts.append(n.select(F.lit("QC3").alias("rule"), F.lit(child).alias("tbl"),
                              F.lit(f"{ccol}->{parent}.{pcol}").alias("item"), "violations"))
    return _union(parts)


def qc4_primary_keys(t: Tables) -> DataFrame:
    """QC4: key values that occur more than once."""
    parts = []
    for tb, keys in PRIMARY_KEYS.items():
        n = (t[tb].groupBy(*keys).count().filter(F.col("count") > 1)
             .agg(F.count(F.lit(1)).alias("violations")))
        parts.append(n.select(F.lit("QC4").alias("rule"), F.lit(tb).alias("tbl"),
                              F.lit(",".join(keys)).alias("item"), "violations"))
    return _union(parts)


def qc5_hierarchy(t: Tables) -> DataFrame:
    """QC5: exactly one root; exactly ceil(10 %) managers; every manager link points to an
    existing employee whose role is Manager."""
    emp = t["employee"]
    stats = emp.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("manager_id").isNull(), 1).otherwise(0)).alias("roots"),
        F.sum(F.when(F.col("role") == "Manager", 1).otherwise(0)).alias("managers"),
    )
    # the generator's own arithmetic: ceil(n * 0.10) in floating point
    want = F.ceil(F.col("n") * F.lit(MANAGER_SHARE)).cast("bigint")
    head = stats.select(
        F.abs(F.coalesce(F.col("roots"), F.lit(0)) - 1).cast("bigint").alias("root"),
        F.abs(F.coalesce(F.col("managers"), F.lit(0)) - F.greatest(F.lit(1), want))
        .cast("bigint").alias("manager_share"))
    managers = emp.filter(F.col("role") == "Manager").select(F.col("emp_id").alias("manager_id"))
    bad_links = (emp.filter(F.col("manager_id").isNotNull()).select("manager_id")
                 .join(managers, "manager_id", "left_anti")
                 .agg(F.count(F.lit(1)).alias("bad_manager_link")))
    rows = head.select(F.inline(F.array(
        F.struct(F.lit("root").alias("item"), F.col("root").alias("violations")),
        F.struct(F.lit("manager_share").alias("item"), F.col("manager_share").alias("violations")))))
    links = bad_links.select(F.lit("bad_manager_link").alias("item"),
                             F.col("bad_manager_link").alias("violations"))
    return rows.unionByName(links).select(F.lit("QC5").alias("rule"), F.lit("employee").alias("tbl"),
                                          "item", "violations")


def qc5_reachability(t: Tables, max_levels: int = 1000) -> DataFrame:
    """QC5, the tree: employees that no chain of managers ties to a root, told apart by what is above
    them: a manager that is no employee (``below_missing_manager``) or a cycle (``in_or_below_cycle``).

    An employee without manager is a root. Rows that repeat an id count once, with the least of their
    managers, so everyone has one manager at most and the descent ends; null ids are QC2's. It
    descends a level at a time, over a table that is small beside the facts; a chain of more than
    ``max_levels`` raises."""
    staff = t["employee"].filter("emp_id is not null").groupBy("emp_id").agg(F.min("manager_id").alias("manager_id"))
    found = staff.sparkSession.sql(f"""
        WITH RECURSIVE below(emp_id, lost) MAX RECURSION LEVEL {int(max_levels)} AS (
            SELECT e.emp_id, e.manager_id IS NOT NULL FROM {{staff}} e
                LEFT ANTI JOIN {{staff}} m ON e.manager_id = m.emp_id
            UNION ALL
            SELECT e.emp_id, b.lost FROM below b JOIN {{staff}} e ON e.manager_id = b.emp_id)
        SELECT * FROM below LIMIT ALL""", staff=staff)
    counted = staff.select(F.lit(1).alias("n"), F.lit(0).alias("lost")).unionByName(
        found.select(F.lit(-1).alias("n"), F.col("lost").cast("int").alias("lost"))).agg(
            *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("n", "lost")])
    return counted.select(F.inline(F.array(
        F.struct(F.lit("below_missing_manager").alias("item"), F.col("lost").alias("violations")),
        F.struct(F.lit("in_or_below_cycle").alias("item"), F.col("n").alias("violations"))))).select(
            F.lit("QC5").alias("rule"), F.lit("employee").alias("tbl"), "item", "violations")


def qc6_closed_at(t: Tables) -> DataFrame:
    """QC6: ``closed_at`` is set exactly when the account is Inactive."""
    acc = t["account"]
    inactive = F.coalesce(F.col("status") == "Inactive", F.lit(False))
    return _counts_to_rows(acc, "QC6", "account",
                           {"closed_at_iff_inactive": inactive != F.col("closed_at").isNotNull()})


def qc7_amounts(t: Tables) -> DataFrame:
    """QC7: amount outside [1, 150000] or with more than two decimals (a NaN or infinite
    amount breaks both)."""
    a = F.col("amount")
    return _counts_to_rows(t["transaction"], "QC7", "transaction", {
        "amount_range": (a < AMOUNT_MIN) | (a > AMOUNT_MAX),
        "amount_two_decimals": ~B.is_finite(a) | (a.cast("decimal(18,2)").cast("double") != a),
    })


def target_shares() -> list[tuple[str, str, str, float]]:
    """The target weights normalised to shares: (tbl, col, value, share)."""
    out = []
    for (tb, col), weights in TARGET_WEIGHTS.items():
        total = math.fsum(weights.values())
        out += [(tb, col, v, w / total) for v, w in weights.items()]
    return out


def qc8_shares(t: Tables) -> DataFrame:
    """QC8: observed share of every value of the weighted columns next to its target
    share (values without a target get null; targets never observed get n = 0)."""
    parts = []
    for (tb, col) in TARGET_WEIGHTS:
        parts.append(t[tb].groupBy(F.col(col).alias("value")).count()
                     .select(F.lit(tb).alias("tbl"), F.lit(col).alias("col"), "value",
                             F.col("count").alias("n")))
    counts = _union(parts)
    totals, _ = bounded_broadcast(counts.groupBy("tbl", "col").agg(F.sum("n").alias("total")))
    observed = counts.join(totals, ["tbl", "col"]).select(
        "tbl", "col", "value", "n", (F.col("n") / F.col("total")).alias("share"))
    # fixed target table (a few dozen rows of constants)
    targets = counts.sparkSession.createDataFrame(target_shares(), "tbl string, col string, value string, target double")
    return (observed.join(targets, ["tbl", "col", "value"], "full_outer")
            .select("tbl", "col", "value",
                    F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("n"),
                    F.coalesce(F.col("share"), F.lit(0.0)).alias("share"), "target"))


CHECKS = {
    "qc1": qc1_domains, "qc2": qc2_not_null, "qc3": qc3_foreign_keys, "qc4": qc4_primary_keys,
    "qc5": qc5_hierarchy, "qc6": qc6_closed_at, "qc7": qc7_amounts, "qc8": qc8_shares,
}
