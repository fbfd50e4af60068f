"""Shards by vector bin packing: bytes, tokens and rows are balanced jointly.

Documents with equal texts form a group. Groups are placed one after the other, large ones
first, each in the shard where the dot product of the group's vector with the shard's
residual capacity is highest, among the shards with the most bytes left. Groups of which
there may be very many are first drawn together by hash into lots, whose number follows
from the row count, so the driver places a bounded number of items; a group that holds a
notable share of the whole is an item of its own, and one that is larger than a shard's
capacity is split into pieces.

The law is ``bytes``: shard sizes are near equal (a few times the smallest items apart).

Cases: a null text is empty (size 1, checksum 0, no tokens). Rows that repeat are placed one
by one, in the same shard unless their group was split. An empty table gives no rows. Extra
columns are not looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import written

LOT_ROWS = 20_000        # rows of one lot, and of one numbering task
LEAST_LOTS = 4_096
NOTABLE = 1 / 512        # share of bytes, tokens or rows that makes a group an item of its own
MEASURES = ("bytes", "tokens", "rows")


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item (rows of bytes, tokens, rows), in the order of falling bytes."""
    total = items.sum(0)
    scale = np.where(total > 0, total, 1.0) / shards
    need = items / scale
    left = np.ones((shards, items.shape[1]))
    out = np.zeros(len(items), np.int64)
    for k in np.lexsort((np.arange(len(items)), -need.max(1), -need[:, 0])).tolist():
        # shards that the item leaves within its own size of the emptiest one
        open_ = np.flatnonzero(left[:, 0] >= left[:, 0].max() - need[k, 0] - 1e-12)
        best = open_[np.argmax(left[open_] @ need[k])]
        out[k] = best
        left[best] -= need[k]
    return out


def pack(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, size, tokens, text_crc32, shard, slot): ``slot`` numbers a shard's rows
    without gaps from 0. Tokens are counted as white space characters plus one."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    spaces = sum((F.length(text) - F.length(F.replace(text, F.lit(c), F.lit(""))) for c in (" ", "\n")),
                 F.lit(0))
    rows = written(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.when(text == "", 0).otherwise(spaces + 1).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h"),
        F.monotonically_increasing_id().alias("n")), "shards-rows")
    spark = docs.sparkSession
    total = [x or 0 for x in rows.agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1))).first()]
    n = total[2]
    lots = max(LEAST_LOTS, -(-n // LOT_ROWS))
    groups = rows.groupBy("h").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"),
                                   F.count(F.lit(1)).alias("rows"))
    shares = [F.col(m) / F.lit(max(1, t)) for m, t in zip(MEASURES, total)]
    share = F.greatest(*shares)
    # at most 3 / NOTABLE groups pass
    large = groups.filter(share > NOTABLE).withColumn("share", share).collect()
    # a piece of a split group is a notable item itself
    pieces = {g["h"]: (int(np.ceil(g["share"] / NOTABLE)) if g["share"] > 1 / shards else 1) for g in large}
    first, named = lots, []
    for h in sorted(pieces):
        named.append((h, first, pieces[h]))
        first += pieces[h]
    named = spark.createDataFrame(named, "lh long, first long, pieces long")
    lot = F.when(F.col("first").isNull(), F.pmod(F.col("h"), F.lit(lots))).otherwise(
        F.col("first") + F.pmod(F.xxhash64("n"), F.col("pieces")))
    dealt = rows.join(F.broadcast(named), F.col("h") == F.col("lh"), "left").withColumn("lot", lot)
    # cells of bounded size within the lots number the rows
    sizes = written(dealt.groupBy("lot").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"),
                                             F.count(F.lit(1)).alias("rows")), "shards-lots")
    items = sizes.orderBy("lot").collect()  # lots: bounded, see above
    where = place(np.array([[r["bytes"], r["tokens"], r["rows"]] for r in items], float).reshape(-1, 3), shards)
    plan, slot = [], [0] * shards
    for r, s in zip(items, where.tolist()):
        plan.append((r["lot"], s, slot[s], max(1, -(-r["rows"] // LOT_ROWS))))
        slot[s] += r["rows"]
    plan = spark.createDataFrame(plan, "p long, shard int, base long, cells long")
    dealt = dealt.join(F.broadcast(plan), F.col("lot") == F.col("p")).withColumn(
        "cell", F.pmod(F.xxhash64("n", F.lit(1)), F.col("cells")))
    counts = dealt.groupBy("lot", "cell").agg(F.count(F.lit(1)).alias("held"))
    before = Window.partitionBy("lot").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("lot").alias("sl"), F.col("cell").alias("sc"),
                           F.coalesce(F.sum("held").over(before), F.lit(0)).alias("skip"))
    numbered = dealt.withColumn("k", F.row_number().over(Window.partitionBy("lot", "cell").orderBy("n")) - 1)
    out = numbered.join(starts, (F.col("lot") == F.col("sl")) & (F.col("cell") == F.col("sc")))
    return out.select(F.col("id").alias(id_col), "size", "tokens", "text_crc32", "shard",
                      (F.col("base") + F.col("skip") + F.col("k")).cast("long").alias("slot"))
