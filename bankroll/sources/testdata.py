"""Banking tables over the TESTDATA parquet files.

The test tables are TPC-H shaped. This module only *renames and types* their rows into
the banking contracts (branch, customer, employee, product, account, transaction); it
computes none of the rollups. Every column is a built-in expression, so the scans keep
Parquet column pruning and filter pushdown (a rollup that reads only ``amount`` and
``account_id`` reads only the lineitem columns behind them).

Mapping (fixed; keys stay integers):
  branch      <- nation x region
  customer    <- customer x nation
  employee    <- supplier (first tenth of the key range are managers under manager 0)
  product     <- part
  account     <- orders x customer (status from order status, branch = customer nation)
  transaction <- lineitem (time = ship date + a key-derived offset inside the day)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.buckets import from_epoch_millis
from ..model import MANAGER_SHARE
from ..operators.joins import bounded_broadcast
from ..session import use_utc

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = raw(spark, sf_dir, "nation")
    region, _ = bounded_broadcast(raw(spark, sf_dir, "region"))
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("branch_id"),
        F.col("n_name").alias("branch_name"),
        F.col("r_name").alias("city"),
        F.col("r_name").alias("region"),
    )


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, _ = bounded_broadcast(raw(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    c = raw(spark, sf_dir, "customer")
    return c.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.lit(None).cast("date").alias("dob"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.lit(None).cast("string").alias("pan_hash"),
        F.col("n_name").alias("city"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )


def employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = raw(spark, sf_dir, "supplier")
    # key range size N = max(key) + 1, as a scalar subquery (one value, computed on the cluster)
    n = s.select((F.max("s_suppkey") + 1).alias("n")).scalar()
    is_manager = F.col("s_suppkey") * 10 < n
    # ceil(N * 10 %) managers' worth of teams, in exact decimal arithmetic
    team = F.ceil(n * F.lit(MANAGER_SHARE).cast("decimal(3,2)")).cast("bigint")
    return s.select(
        F.col("s_suppkey").alias("emp_id"),
        F.col("s_name").alias("name"),
        F.when(is_manager, F.lit("Manager")).otherwise(F.lit("Teller")).alias("role"),
        F.col("s_nationkey").alias("branch_id"),
        F.when(F.col("s_suppkey") == 0, F.lit(None).cast("bigint"))
        .when(is_manager, F.lit(0).cast("bigint"))
        .otherwise(F.col("s_suppkey") % team).alias("manager_id"),
        F.lit(None).cast("date").alias("hire_date"),
    )


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_category"),
    )


def account(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    o = raw(spark, sf_dir, "orders")
    cust, _ = bounded_broadcast(raw(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"))
    opened = F.col("o_orderdate").cast("timestamp")
    return o.join(cust, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("account_id"),
        F.col("o_custkey").alias("customer_id"),
        F.lit(None).cast("string").alias("account_type"),
        F.when(F.col("o_orderstatus") == "F", "Active")
        .when(F.col("o_orderstatus") == "O", "Inactive")
        .otherwise("Frozen").alias("status"),
        F.col("c_nationkey").alias("branch_id"),
        opened.alias("opened_at"),
        F.when(F.col("o_orderstatus") == "O", opened + F.expr("INTERVAL 30 DAYS")).alias("closed_at"),
    )


def transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    li = raw(spark, sf_dir, "lineitem")
    qty = F.col("l_quantity").cast("int")
    # offset inside the ship day, in milliseconds (spreads rows over hours and minutes)
    offset = (F.col("l_orderkey") * 7919 + F.col("l_partkey") * 104729
              + F.col("l_linenumber") * 1299709) % 86_400_000
    ship_ms = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    ln6, sk5 = F.col("l_linenumber") % 6, F.col("l_suppkey") % 5
    return li.select(
        F.md5(F.concat_ws("-", *[F.col(c).cast("string") for c in
                                 ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")],
                          qty.cast("string"))).alias("txn_id"),
        F.col("l_orderkey").alias("account_id"),
        F.when(ln6 == 0, "Deposit").when(ln6 == 1, "Withdrawal").when(ln6 == 2, "Transfer")
        .when(ln6 == 3, "POS").when(ln6 == 4, "Fee").otherwise("EMI").alias("txn_type"),
        F.col("l_extendedprice").alias("amount"),
        F.when(sk5 == 0, "USD").when(sk5 == 1, "EUR").when(sk5 == 2, "GBP")
        .when(sk5 == 3, "INR").otherwise("AUD").alias("currency"),
        from_epoch_millis(ship_ms + offset).alias("txn_time"),
        F.when(qty % 10 < 6, "Digital").when(qty % 10 < 9, "Branch").otherwise("POS").alias("channel"),
        F.when(F.col("l_returnflag") == "A", "approved").when(F.col("l_returnflag") == "N", "pending")
        .otherwise("declined").alias("status"),
        F.col("l_partkey").alias("product_id"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("bigint"))
        .otherwise(F.col("l_suppkey")).alias("approved_by_emp_id"),
    )


class LazyTables(dict):
    """Table name -> DataFrame, each built on first use (so a rollup that needs two tables
    runs only those tables' size checks)."""

    def __init__(self, builders):
        super().__init__()
        self._builders = builders

    def __missing__(self, name):
        df = self._builders[name]()
        self[name] = df
        return df

    def __contains__(self, name):
        return name in self._builders


_TABLES: dict[str, tuple[SparkSession, LazyTables]] = {}


def tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    """The six banking tables over one (read-only) TESTDATA folder.

    One set per session and folder: every rollup of a refresh derives from the same
    DataFrames, so file listing and footer reads happen once.
    """
    key = sf_dir.rstrip("/")
    cached = _TABLES.get(key)
    if cached is None or cached[0] is not spark:  # built for another (maybe stopped) session
        builders = {n: (lambda f=f: f(spark, sf_dir)) for n, f in (
            ("branch", branch), ("customer", customer), ("employee", employee),
            ("product", product), ("account", account), ("transaction", transaction))}
        _TABLES[key] = (spark, LazyTables(builders))
    return _TABLES[key][1]
