"""Batch refresh of the maintained tables (S9 batch mode) and stream ordering.

``refresh_batch`` recomputes every requested result from the full inputs and replaces
its stored copy (serving layout, ``sources.layout``). Q5 is derived from the freshly
stored Q5a and Q5b, as the reference's read does, instead of recomputing them.
The stream modes live in ``bankroll.streaming``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import layout
from . import rollups as R

ORDER = ("q1", "q2", "q3", "q3r", "q4", "q5a", "q5b", "q6", "q5")


def refresh_batch(t: Mapping[str, DataFrame], root: str, names: tuple[str, ...] = ORDER,
                  partitions: int | None = None) -> dict[str, str]:
    """Recompute and store each result in ``names`` under ``root/<name>``; returns paths."""
    root = root.rstrip("/")
    paths: dict[str, str] = {}
    for name in ORDER:
        if name not in names:
            continue
        path = f"{root}/{name}"
        if name == "q5" and {"q5a", "q5b"} <= set(paths):
            spark = t["transaction"].sparkSession
            df = R.q5_high_value_customers(t, q5a=layout.read_result(spark, paths["q5a"]),
                                           q5b=layout.read_result(spark, paths["q5b"]))
        else:
            df = R.ROLLUPS[name](t)
        # a full refresh replaces every partition, including ones that no longer occur
        layout.write_result(df, name, path, partitions=partitions, partition_overwrite="static")
        paths[name] = path
    return paths


def ordered_by_account(txn: DataFrame, partitions: int) -> DataFrame:
    """Transactions in ``(account_id, txn_time)`` order: range-partitioned and sorted,
    so each account's rows are in time order across consecutive partitions; one hot
    account spans several partitions instead of filling one."""
    keys = [F.col("account_id"), F.col("txn_time"), F.col("txn_id")]
    return txn.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
