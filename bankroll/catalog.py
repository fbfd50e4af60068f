"""Registry of the inventory queries over the TESTDATA tables.

``QUERIES[name](spark, sf_dir)`` maps the test tables into the banking contracts and
runs the library function for inventory id ``name`` on the whole tables.
``ORACLE_SQL[name]`` is its DuckDB twin. Fixed read parameters below are the ones the
fixture notes use for the test tables (the library defaults stay as in the reference).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import buckets as B
from .functions.buckets import to_wall_clock
from .model import AMOUNT_MAX, AMOUNT_MIN, PRIMARY_KEYS, Q5_MIN_ACCOUNTS, Q5_MIN_AMOUNT, SCHEMAS
from .operators import quality as Q
from .operators.compaction import latest_by_key, upsert
from .plans import oracle_sql as O
from .plans import reads as P
from .plans import rolling
from .plans import rollups as R
from .plans.refresh import ordered_by_account, refresh_batch
from .session import scratch_dir, use_utc
from .sources import layout, records, testdata, versions
from .streaming import intake, joined, kept_checks, numbering, stream_static
from .streaming.landed import LandedRefresh
from .streaming.sources import read_stream

# Read parameters used against the test tables.
R1_ACCOUNT, R1_FROM, R1_TO = 7, "19950101", "20011231"
R2_NOW, R2_SPAN = datetime(1998, 6, 15, 12, 0, 0), "12 hours"
R2M_FROM, R2M_TO = "199806150000", "199806152359"
R3_NOW, R3_SPAN = datetime(1998, 6, 15, 12, 0, 0), "24 hours"
R4_EMPLOYEE, R4_QUARTER = 3, "1998Q2"
R4M_MANAGER = 0
R5_MIN_ACCOUNTS, R5_MIN_AMOUNT = 5, 300_000
R6_BRANCH, R6_FROM, R6_TO = 4, "1998-07-01", "1998-07-31"

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def present(df: DataFrame) -> DataFrame:
    """Export form: instants become UTC wall-clock values (zone-less engines compare
    them as such); everything else is unchanged."""
    cols = [to_wall_clock(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType)
            else f.name for f in df.schema.fields]
    return df.select(*cols)


def run_query(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return present(QUERIES[name](spark, sf_dir))


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def _t(spark: SparkSession, sf_dir: str):
    return testdata.tables(spark, sf_dir)


# ---------------------------------------------------------------- maintained tables
def _rollup(name: str, fn: Callable, **kw) -> None:
    register(name, O.with_mapping(O.ROLLUP_SQL[name]))(
        lambda spark, sf_dir: fn(_t(spark, sf_dir), **kw))


for _name in ("q1", "q2", "q3", "q3r", "q4", "q5a", "q5b", "q6", "d6"):
    _rollup(_name, R.ROLLUPS[_name])

# bounds that some customers of the test tables reach, and the default ones (none does)
for _name, _bounds in (("q5", (3, 250_000)), ("q5_default", (Q5_MIN_ACCOUNTS, Q5_MIN_AMOUNT))):
    register(_name, O.with_mapping(O.q5_sql(*_bounds), {"q5b": O.ROLLUP_SQL["q5b"]}))(
        lambda spark, sf_dir, _b=_bounds: R.q5_high_value_customers(_t(spark, sf_dir), *_b))


# ---------------------------------------------------------------- end-user reads
def _q(name: str) -> str:
    return O.ROLLUP_SQL[name]


_ts = "timestamp '{}'".format
register("r1", O.with_mapping(
    f"select * from q1 where account_id = {R1_ACCOUNT} and txn_day >= '{R1_FROM}' "
    f"and txn_day <= '{R1_TO}' order by txn_timestamp desc", {"q1": _q("q1")}))(
    lambda spark, sf_dir: P.r1_account_days(R.q1_transactions_by_account(_t(spark, sf_dir)),
                                            R1_ACCOUNT, R1_FROM, R1_TO))

register("r2", O.with_mapping(
    f"select * from q2 where txn_time >= {_ts(R2_NOW)} - interval {R2_SPAN} "
    f"and txn_time <= {_ts(R2_NOW)}", {"q2": _q("q2")}))(
    lambda spark, sf_dir: P.r2_recent_high_value(R.q2_high_value_by_minute(_t(spark, sf_dir)),
                                                 R2_NOW, R2_SPAN))

register("r2m", O.with_mapping(
    f"select * from q2 where txn_minute between '{R2M_FROM}' and '{R2M_TO}'", {"q2": _q("q2")}))(
    lambda spark, sf_dir: P.r2m_minute_range(R.q2_high_value_by_minute(_t(spark, sf_dir)),
                                             R2M_FROM, R2M_TO))

register("r3", O.with_mapping(
    f"select city, txn_count from q3 where window_start >= {_ts(R3_NOW)} - interval {R3_SPAN} "
    f"and window_start <= {_ts(R3_NOW)}", {"q3": _q("q3")}))(
    lambda spark, sf_dir: P.r3_city_windows(R.q3_high_value_by_city(_t(spark, sf_dir)),
                                            R3_NOW, R3_SPAN))

register("r3t", O.with_mapping(
    f"select city, sum(txn_count) as txn_count from q3 "
    f"where window_start >= {_ts(R3_NOW)} - interval {R3_SPAN} and window_start <= {_ts(R3_NOW)} "
    f"group by city", {"q3": _q("q3")}))(
    lambda spark, sf_dir: P.r3t_city_totals(R.q3_high_value_by_city(_t(spark, sf_dir)),
                                            R3_NOW, R3_SPAN))

register("r4", O.with_mapping(
    f"select * from q4 where employee_id = {R4_EMPLOYEE} and \"quarter\" = '{R4_QUARTER}'",
    {"q4": _q("q4")}))(
    lambda spark, sf_dir: P.r4_employee_quarter(R.q4_withdrawals_by_employee(_t(spark, sf_dir)),
                                                R4_EMPLOYEE, R4_QUARTER))


def _r4m(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return P.r4m_manager_quarter(R.q4_withdrawals_by_employee(t), t["employee"], R4M_MANAGER,
                                 R4_QUARTER)


register("r4m", O.with_mapping(
    f"select * from q4 where \"quarter\" = '{R4_QUARTER}' and employee_id in "
    f"(select emp_id from bk_employee where manager_id = {R4M_MANAGER})", {"q4": _q("q4")}))(_r4m)

register("r5", O.with_mapping(O.q5_sql(R5_MIN_ACCOUNTS, R5_MIN_AMOUNT), {"q5b": _q("q5b")}))(
    lambda spark, sf_dir: R.q5_high_value_customers(_t(spark, sf_dir), R5_MIN_ACCOUNTS,
                                                    R5_MIN_AMOUNT))

register("r6", O.with_mapping(
    f"select txn_date, total_amount, count_txn from q6 where branch_id = {R6_BRANCH} "
    f"and txn_date >= date '{R6_FROM}' and txn_date <= date '{R6_TO}' order by txn_date desc",
    {"q6": _q("q6")}))(
    lambda spark, sf_dir: P.r6_branch_days(R.q6_branch_daily(_t(spark, sf_dir)), R6_BRANCH,
                                           R6_FROM, R6_TO))


# ---------------------------------------------------------------- data-quality checks
for _name, _fn in Q.CHECKS.items():
    register(_name, O.qc_sql(_name))(lambda spark, sf_dir, _f=_fn: _f(_t(spark, sf_dir)))


# ---------------------------------------------------------------- functions, records, compaction
def _account(spark, sf_dir):
    return _t(spark, sf_dir)["account"]


def _txn(spark, sf_dir):
    return _t(spark, sf_dir)["transaction"]


register("f9", O.with_mapping(O.FUNCTION_SQL["f9"]))(
    lambda spark, sf_dir: _account(spark, sf_dir).select(
        "account_id",
        *[B.parse_iso_timestamp(B.iso_utc_text(c)).alias(c) for c in ("opened_at", "closed_at")],
        B.parse_iso_date(B.iso_date_text("opened_at")).alias("opened_on"),
        B.parse_iso_date(F.concat(B.iso_date_text("opened_at"), F.lit("x"))).alias("bad_date"),
        B.parse_iso_timestamp(F.concat(F.lit("x"), B.iso_utc_text("opened_at"))).alias("bad_time")))

register("f10", O.with_mapping(O.FUNCTION_SQL["f10"]))(
    lambda spark, sf_dir: _account(spark, sf_dir).select(
        "account_id", B.iso_date_text(B.to_day("opened_at")).alias("opened_on"),
        B.iso_date_text(B.to_day("closed_at")).alias("closed_on")))

register("f11", O.with_mapping(O.FUNCTION_SQL["f11"]))(
    lambda spark, sf_dir: _account(spark, sf_dir).select(
        "account_id", B.iso_utc_text("opened_at").alias("opened_at"),
        B.iso_utc_text("closed_at").alias("closed_at")))


def _f12(spark, sf_dir):
    x = _txn(spark, sf_dir)
    cols = ("txn_id", "account_id", "approved_by_emp_id")
    agg = x.agg(*[F.sum(F.when(B.uuid_is_valid(B.uuid_text(c)), 1).otherwise(0)).cast("bigint")
                  .alias(f"v_{c}") for c in cols],
                F.count(F.lit(1)).alias("n"))
    rows = F.array(*[F.struct(F.lit(c).alias("item"), F.col(f"v_{c}").alias("valid"),
                              (F.col("n") - F.col(f"v_{c}")).alias("invalid")) for c in cols])
    return agg.select(F.inline(rows))


register("f12", O.with_mapping(O.FUNCTION_SQL["f12"]))(_f12)

register("f14", O.with_mapping(O.FUNCTION_SQL["f14"]))(
    lambda spark, sf_dir: _t(spark, sf_dir)["customer"].select(
        "customer_id", B.pan_hash("customer_id").alias("pan_hash")))

register("f17", O.with_mapping(O.FUNCTION_SQL["f17"]))(
    lambda spark, sf_dir: _txn(spark, sf_dir).select(
        "txn_id", B.clamp_round(F.col("amount") * 0.125, AMOUNT_MIN, AMOUNT_MAX).alias("amount")))

register("t7", O.with_mapping(O.FUNCTION_SQL["t7"]))(
    lambda spark, sf_dir: latest_by_key(_txn(spark, sf_dir), "account_id", ["txn_time", "txn_id"]))


def _s7(spark, sf_dir):
    return records.emit_keyed(_txn(spark, sf_dir), "transaction")


def _s8(spark, sf_dir):
    x = _txn(spark, sf_dir)
    good, _bad = records.parse_keyed(records.emit_keyed(x, "transaction"), "transaction", check_ids=False)
    # ids come back as text; restore the test tables' integer ids for comparison
    return good.select(*[F.col(c).cast(x.schema[c].dataType).alias(c) for c in x.columns])


register("s7", O.with_mapping(O.FUNCTION_SQL["s7"]))(_s7)
register("s8", O.with_mapping(O.FUNCTION_SQL["s8"]))(_s8)


# ---------------------------------------------------------------- sinks, stored tables
def _wire_sink(spark: SparkSession, sf_dir: str, write) -> str:
    root = scratch_dir(spark, "sink")
    write({"account": _account(spark, sf_dir)}, root)
    return f"{root}/account"


def _s4(spark, sf_dir):
    lines = spark.read.text(_wire_sink(spark, sf_dir, layout.write_json))
    return lines.select(F.from_json("value", records.wire_schema("account")).alias("r"),
                        F.size(F.json_object_keys("value")).alias("n_keys")).select("r.*", "n_keys")


def _s5(spark, sf_dir):
    path = _wire_sink(spark, sf_dir, layout.write_csv)
    return spark.read.option("header", True).schema(records.wire_schema("account")).csv(path)


register("s4", O.with_mapping(O.FUNCTION_SQL["s4"]))(_s4)
register("s5", O.with_mapping(O.FUNCTION_SQL["s5"]))(_s5)

register("s3", O.with_mapping("select * from bk_product"))(
    lambda spark, sf_dir: _stored_product(spark, sf_dir))


def _stored_product(spark, sf_dir):
    """S3: a stored table read with its contract (ids as text), in contract order."""
    path = scratch_dir(spark, "product")
    p = _t(spark, sf_dir)["product"]
    p.select(*[F.col(c).cast("string").alias(c) for c in reversed(p.columns)]).write.parquet(path)
    back = records.read_table(spark, path, "product")
    return back.select(*[F.col(c).cast(p.schema[c].dataType).alias(c) for c in p.columns])


# Of every table two later versions of some rows replace the stored ones
UPSERTED = {"branch": "city", "customer": "city", "employee": "role", "product": "product_category",
            "account": "status", "transaction": "status"}


def _s6(spark, sf_dir):
    out = None
    for name, column in UPSERTED.items():
        key = PRIMARY_KEYS[name][0]
        stored = _t(spark, sf_dir)[name]
        some = stored.filter(F.right(F.col(key).cast("string"), F.lit(1)).isin("0", "3", "6", "9"))
        changes = some.withColumn("version", F.explode(F.array(F.lit(2), F.lit(1)))).withColumn(
            column, F.concat(column, F.repeat(F.lit("*"), "version")))
        rows = upsert(stored, changes, key, "version").select(
            F.lit(name).alias("tbl"), F.col(key).cast("string").alias("key"), F.col(column).alias("value"))
        out = rows if out is None else out.union(rows)
    return out


register("s6", O.with_mapping(" union all ".join(
    f"select '{name}' as tbl, cast({PRIMARY_KEYS[name][0]} as varchar) as key, {column} || case when "
    f"right(cast({PRIMARY_KEYS[name][0]} as varchar), 1) in ('0', '3', '6', '9') then '**' else '' end as value "
    f"from {O.CTE_OF[name]}" for name, column in UPSERTED.items())))(_s6)


def _s8q(spark, sf_dir):
    """S8 with ids of the contract's form, and messages that are no JSON, hold a bad id, or
    lack a required value, in equal parts."""
    x = _txn(spark, sf_dir)
    ids = x.withColumns({c: F.md5(F.col(c).cast("string")) for c in ("account_id", "product_id",
                                                                     "approved_by_emp_id")})
    sent = records.emit_keyed(ids, "transaction")
    last = F.substring(F.get_json_object("value", "$.txn_id"), 32, 1)
    value = (F.when(last == "0", F.substring("value", 1, 60))
             .when(last == "1", F.regexp_replace("value", '"account_id":"[0-9a-f]+"', '"account_id":"none"'))
             .when(last == "2", F.regexp_replace("value", '"currency":"[A-Z]+"', '"currency":null'))
             .otherwise(F.col("value")))
    good, bad = records.parse_keyed(sent.withColumn("value", value), "transaction")
    return good.select("txn_id", F.lit(None).cast("string").alias("value"), F.lit("").alias("reason")).union(
        bad.select(F.lit(None).cast("string"), "value", "reason"))


register("s8q", O.with_mapping(O.FUNCTION_SQL["s8q"]))(_s8q)


def _s8_versions(spark, sf_dir):
    """S8 over four schema versions mixed, by the last digit of the transaction's id: 0-4 an older one (whole
    amounts, no channel, no approver), 5-8 one that calls the currency otherwise and has a field more, 9-b the
    contract's with a channel unknown to it, c-d a version made known later, others the contract's. What is
    quarantined at first is read again once that version is known; the unknown channel stays."""
    x = _txn(spark, sf_dir)
    wire = records.wire_schema("transaction")
    digit = F.right("txn_id", F.lit(1))
    version = (F.when(digit < "5", 1).when(digit < "9", 2).when(digit.isin("c", "d"), 4).otherwise(3))
    sent = records.encode(x, "transaction").withColumns({
        "channel": F.when(digit.isin("9", "a", "b"), F.lit("Kiosk")).otherwise(F.col("channel")),
        "ccy": F.col("currency"), "device": F.lit("d1")})
    drop = {1: ("channel", "approved_by_emp_id"), 2: ("currency",), 3: (), 4: ()}
    writers = {v: T.StructType([f for f in wire if f.name not in gone]) for v, gone in drop.items()}
    writers[1] = T.StructType([T.StructField(f.name, T.LongType() if f.name == "amount" else f.dataType)
                               for f in writers[1]])
    writers[2] = T.StructType([*writers[2], T.StructField("ccy", T.StringType()), T.StructField("device", T.StringType())])
    value = F.coalesce(*[F.when(version == v, F.to_json(
        F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]), {"ignoreNullFields": "false"}))
        for v, schema in writers.items()])
    known = versions.Versions("transaction", {v: s for v, s in writers.items() if v != 4},
                              defaults={"channel": "Digital"}, aliases={"currency": ("ccy",)})
    good, bad = versions.parse_versions(sent.select("txn_id", value.alias("value"), version.alias("schema_id")), known,
                                        check_ids=False)
    path = scratch_dir(spark, "quarantine")
    bad.write.parquet(path)
    later, stay = versions.replay(spark.read.parquet(path), known.adding(writers={4: writers[4]}), check_ids=False)
    kept = good.withColumn("replayed", F.lit(False)).unionByName(later.withColumn("replayed", F.lit(True)))
    kept = kept.select(*[F.col(c).cast(x.schema[c].dataType).alias(c) for c in x.columns], "schema_id", "replayed",
                       F.lit("").alias("reason"))
    return kept.unionByName(stay.select("txn_id", "schema_id", F.lit(True).alias("replayed"), "reason"),
                            allowMissingColumns=True)


register("s8_versions", O.with_mapping("""
select txn_id, case when kiosk then null else account_id end as account_id,
       case when kiosk then null else txn_type end as txn_type,
       case when kiosk then null when last < '5' then trunc(amount) else amount end as amount,
       case when kiosk then null else currency end as currency, case when kiosk then null else txn_time end as txn_time,
       case when kiosk then null when last < '5' then 'Digital' else channel end as channel,
       case when kiosk then null else status end as status, case when kiosk then null else product_id end as product_id,
       case when kiosk or last < '5' then null else approved_by_emp_id end as approved_by_emp_id,
       cast(case when last < '5' then 1 when last < '9' then 2 when last in ('c', 'd') then 4 else 3 end as integer)
           as schema_id,
       kiosk or last in ('c', 'd') as replayed, case when kiosk then 'unknown channel Kiosk' else '' end as reason
from sent""", {"sent": "select *, right(txn_id, 1) as last, right(txn_id, 1) in ('9', 'a', 'b') as kiosk from bk_txn"}))(
    _s8_versions)


def _stored(spark, sf_dir, *names: str) -> dict[str, DataFrame]:
    """Result tables as the batch refresh stores them."""
    paths = refresh_batch(_t(spark, sf_dir), scratch_dir(spark, "stored"), names=names)
    return {n: layout.read_result(spark, p) for n, p in paths.items()}


def _s9(spark, sf_dir):
    names = ("q1", "q2", "q3", "q3r", "q4", "q5a", "q5b", "q6")
    out = None
    for name, df in _stored(spark, sf_dir, *names).items():
        rows = df.agg(F.lit(name).alias("tbl"), F.count(F.lit(1)).alias("n"))
        out = rows if out is None else out.union(rows)
    return out


register("s9", O.with_mapping(" union all ".join(
    f"select '{n}' as tbl, count(*) as n from ({O.ROLLUP_SQL[n]})"
    for n in ("q1", "q2", "q3", "q3r", "q4", "q5a", "q5b", "q6"))))(_s9)


def _s10(spark, sf_dir):
    path = scratch_dir(spark, "table")
    name = f"bk_{path.rsplit('-', 1)[-1]}"
    layout.save_table(R.q5a_active_accounts(_t(spark, sf_dir)), name, path, name="q5a")
    return spark.table(name)


register("s10", O.with_mapping(_q("q5a")))(_s10)

# required columns that the test tables lack, filled for a round trip: as column and as SQL
_FILLED = {
    "account": {"account_type": (F.lit, "Savings", "'Savings'")},
    "employee": {"hire_date": (lambda d: F.lit(d).cast("date"), "2015-01-01", "date '2015-01-01'")},
    "customer": {"dob": (lambda d: F.lit(d).cast("date"), "1980-05-06", "date '1980-05-06'"),
                 "pan_hash": (B.pan_hash, "customer_id",
                              "upper(left(sha256('PAN-' || cast(customer_id as varchar)), 16))")},
}


def _filled(spark, sf_dir, kind: str) -> DataFrame:
    df = _t(spark, sf_dir)[kind]
    return df.withColumns({c: make(arg) for c, (make, arg, _) in _FILLED[kind].items()}) if kind in _FILLED else df


def _row_text(df: DataFrame, kind: str, label: str) -> DataFrame:
    """(sink, tbl, fields): a typed row as text, a null as ``~``, times as milliseconds, amounts as hundredths."""
    cols = []
    for f in SCHEMAS[kind].fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            c = F.unix_millis(c)
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c * 100).cast("bigint")
        cols.append(F.coalesce(c.cast("string"), F.lit("~")))
    return df.select(F.lit(label).alias("sink"), F.lit(kind).alias("tbl"), F.concat_ws("|", *cols).alias("fields"))


def _row_text_sql(kind: str, label: str) -> str:
    cols = []
    for f in SCHEMAS[kind].fields:
        c = _FILLED.get(kind, {}).get(f.name, (None, None, f.name))[2]
        if isinstance(f.dataType, T.TimestampType):
            c = f"epoch_ms({c})"
        elif isinstance(f.dataType, T.DoubleType):
            c = f"cast(round({c} * 100) as bigint)"
        cols.append(f"coalesce(cast({c} as varchar), '~')")
    return f"select '{label}' as sink, '{kind}' as tbl, concat_ws('|', {', '.join(cols)}) as fields from {O.CTE_OF[kind]}"


def _sinks(spark, sf_dir):
    """S4 and S5 for all six tables: written as JSON and CSV, read with the contract and decoded."""
    tables, out = {k: _filled(spark, sf_dir, k) for k in SCHEMAS}, []
    for label, write in (("json", layout.write_json), ("csv", layout.write_csv)):
        root = scratch_dir(spark, "sinks")
        write(tables, root)
        for kind in tables:
            wire = spark.read.schema(records.wire_schema(kind)).option("header", True).format(label).load(f"{root}/{kind}")
            out.append(_row_text(records.decode(wire, kind, check_ids=False)[0], kind, label))
    return reduce(DataFrame.unionByName, out)


def _keyed(spark, sf_dir):
    """S7 and S8 for all five kinds: emitted by key, parsed again, under the topic and key they had."""
    out = []
    for kind in records.TOPICS:
        sent = records.emit_keyed(_filled(spark, sf_dir, kind), kind)
        good, _ = records.parse_keyed(sent, kind, check_ids=False)
        out.append(_row_text(good, kind, "parsed"))
        out.append(sent.select(F.col("topic").alias("sink"), F.lit(kind).alias("tbl"), F.col("key").alias("fields")))
    return reduce(DataFrame.unionByName, out)


register("s4_s5_all", O.with_mapping(" union all ".join(
    _row_text_sql(k, label) for label in ("json", "csv") for k in SCHEMAS)))(_sinks)
register("s7_s8_all", O.with_mapping(" union all ".join(
    f"{_row_text_sql(k, 'parsed')} union all select '{topic}' as sink, '{k}' as tbl, "
    f"cast({records.MESSAGE_KEYS[k]} as varchar) as fields from {O.CTE_OF[k]}" for k, topic in records.TOPICS.items())))(
    _keyed)

BUCKETS = 8                   # at least
BUCKET_ROWS = 1_000_000       # of transactions in one, about 0.5 GB to sort and sum
STATE_ROWS = 2_500_000        # of transactions in one state partition


def _parts(spark, sf_dir, rows_each: int) -> int:
    """Parts of the transactions with so many rows each; Parquet footers tell how many there are."""
    return max(BUCKETS, -(-_txn(spark, sf_dir).count() // rows_each))


def _bucketed(spark, sf_dir, *kinds: str) -> dict[str, DataFrame]:
    """Tables stored in buckets of their account."""
    out, buckets = {}, _parts(spark, sf_dir, BUCKET_ROWS)
    for kind in kinds:
        path = scratch_dir(spark, "bucketed")
        name = f"bk_{kind}_{path.rsplit('-', 1)[-1]}"
        layout.save_bucketed(_t(spark, sf_dir)[kind], name, path, "account_id", buckets)
        out[kind] = spark.table(name)
    return out


for _name in ("q5b", "q6"):  # accounts beyond the broadcast bound, joined where they lie
    register(f"s11_bucketed_{_name}", O.with_mapping(_q(_name)))(
        lambda spark, sf_dir, _f=R.ROLLUPS[_name]: _f(_bucketed(spark, sf_dir, "transaction", "account"), broadcast=False))

# R1-R6 over the stored, pruned tables
STORED_READS = {
    "r1": ("q1", lambda d: P.r1_account_days(d, R1_ACCOUNT, R1_FROM, R1_TO)),
    "r2": ("q2", lambda d: P.r2_recent_high_value(d, R2_NOW, R2_SPAN)),
    "r2m": ("q2", lambda d: P.r2m_minute_range(d, R2M_FROM, R2M_TO)),
    "r3": ("q3", lambda d: P.r3_city_windows(d, R3_NOW, R3_SPAN)),
    "r4": ("q4", lambda d: P.r4_employee_quarter(d, R4_EMPLOYEE, R4_QUARTER)),
    "r6": ("q6", lambda d: P.r6_branch_days(d, R6_BRANCH, R6_FROM, R6_TO)),
}


def _stored_read(spark, sf_dir, name):
    table, read = STORED_READS[name]
    df = _stored(spark, sf_dir, table)[table]
    extra = [c for c in df.columns if c == "txn_month"]
    return read(df).drop(*extra)


for _name in STORED_READS:
    register(f"s11_{_name}", ORACLE_SQL[_name])(lambda spark, sf_dir, _n=_name: _stored_read(spark, sf_dir, _n))

for _name in ("q3r", "q5a", "q5b"):  # whole stored tables
    register(f"s11_{_name}", ORACLE_SQL[_name])(
        lambda spark, sf_dir, _n=_name: _stored(spark, sf_dir, _n)[_n].drop("txn_month"))


def _s11_q5(spark, sf_dir):
    stored = _stored(spark, sf_dir, "q5a", "q5b")
    return R.q5_high_value_customers(_t(spark, sf_dir), 3, 250_000, stored["q5a"], stored["q5b"])


register("s11_q5", ORACLE_SQL["q5"])(_s11_q5)

register("p9", O.with_mapping(
    f"select city, txn_count from q3 where window_start >= {_ts(R3_NOW)} "
    f"and window_start < {_ts(R3_NOW)} + interval 3 day", {"q3": _q("q3")}))(
    lambda spark, sf_dir: P.r3_city_windows(R.q3_high_value_by_city(_t(spark, sf_dir)), start_from=R3_NOW,
                                            start_to=R3_NOW + timedelta(days=3)))


# ---------------------------------------------------------------- order
def _with_position(df: DataFrame, *keys: str) -> DataFrame:
    """The place of each row in the order in which ``df`` comes (in its group by ``keys``)."""
    at = df.withColumn("__at", F.monotonically_increasing_id())
    return at.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("__at"))).drop("__at")


register("o1", O.with_mapping(
    f"select txn_id, row_number() over (order by txn_timestamp desc) as place from q1 "
    f"where account_id = {R1_ACCOUNT}", {"q1": _q("q1")}))(
    lambda spark, sf_dir: _with_position(P.r1_account_days(
        R.q1_transactions_by_account(_t(spark, sf_dir)), R1_ACCOUNT, "00000101", "99991231")).select(
            "txn_id", "place"))


def _o2(spark, sf_dir):
    """Rows of the stored Q6 that lie below their predecessor in its file."""
    df = _stored(spark, sf_dir, "q6")["q6"].select(
        "branch_id", "txn_date", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("k"))
    key = F.struct("branch_id", "txn_date")
    before = F.lag(key).over(Window.partitionBy("f").orderBy("k"))
    return df.select((before > key).alias("wrong")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("wrong"), 1)).alias("out_of_order"))


register("o2", O.with_mapping(f"select count(*) as n, 0::bigint as out_of_order from ({_q('q6')})"))(_o2)

register("t8", O.with_mapping(
    "select account_id, txn_id, row_number() over (partition by account_id order by txn_time, txn_id) "
    "as place from bk_txn"))(
    lambda spark, sf_dir: _with_position(ordered_by_account(_txn(spark, sf_dir), 8), "account_id").select(
        "account_id", "txn_id", "place"))


# ---------------------------------------------------------------- streams
class _Feed:
    """Folders of wire records and the landed refresh of some results over them."""

    def __init__(self, spark: SparkSession, sf_dir: str, results: tuple[str, ...] = ("q6",),
                 kinds: tuple[str, ...] = ("transaction", "account"), snapshot_every: int = 20):
        self.root = scratch_dir(spark, "feed")
        self.tables = _t(spark, sf_dir)
        self.src = {k: f"{self.root}/src/{k}" for k in kinds}
        for kind in self.src:  # the folders exist from the start
            self.send(kind, self._table(kind).limit(0), 0)
        self.refresh = LandedRefresh(spark, f"{self.root}/state", results=results, check_ids=False,
                                     snapshot_every=snapshot_every)

    def _table(self, kind: str) -> DataFrame:
        # the test tables lack two columns that the contracts require
        lacks = {"account": ("account_type", F.lit("Savings")), "employee": ("hire_date", F.lit("2015-01-01").cast("date"))}
        return self.tables[kind].withColumn(*lacks[kind]) if kind in lacks else self.tables[kind]

    def send(self, kind: str, rows: DataFrame | None = None, seq: int = 1, files: int = 1) -> None:
        """Rows as packed files of each input split; with ``files`` in so many parts, one after the other."""
        rows = self._table(kind) if rows is None else rows
        wire = records.encode(rows, kind).withColumn("seq", F.lit(seq).cast("long"))
        for part in range(files):
            own = wire if files == 1 else wire.filter(F.pmod(F.xxhash64(wire.columns[0]), F.lit(files)) == part)
            own.write.mode("append").options(**layout.PACKED).json(self.src[kind])

    def share(self, kind: str, part: int, of: int) -> int:
        """Files of ``kind`` that ``part`` of its ``of`` equal parts take, rounded up."""
        return -(-len(self.refresh.spark.read.text(self.src[kind]).inputFiles()) * part // of)

    def run(self, max_files: int | None = None) -> None:
        query = self.refresh.start(self.src, f"{self.root}/checkpoint", max_files_per_trigger=max_files,
                                   available_now=True)
        query.awaitTermination()
        if query.exception():
            raise query.exception()

    def result(self, name: str = "q6") -> DataFrame:
        return self.typed(self.refresh.read_view(name))

    @staticmethod
    def typed(view: DataFrame) -> DataFrame:
        # wire ids are text; the test tables' own are numbers
        ids = [c for c in ("branch_id", "customer_id", "account_id", "employee_id", "product_id", "approved_by_emp_id")
               if c in view.columns]
        return view.withColumns({c: F.col(c).cast("bigint") for c in ids})


def _stream(name: str):
    def deco(fn):
        def query(spark, sf_dir):
            feed = _Feed(spark, sf_dir)
            fn(feed)
            return feed.result()
        return register(name, O.with_mapping(_q("q6")))(query)
    return deco


@_stream("t2")
def _t2(feed: _Feed) -> None:
    """Several micro-batches keep Q6 fresh."""
    feed.send("account")
    feed.send("transaction", files=3)
    feed.run(max_files=feed.share("transaction", 2, 4))  # the empty file of the start is one of the four


@_stream("t5")
def _t5(feed: _Feed) -> None:
    """Accounts that move to their branch later revise Q6."""
    accounts = feed._table("account")
    feed.send("account", accounts.withColumn("branch_id", F.col("branch_id") + 100), 1)
    feed.send("transaction")
    feed.run()
    feed.send("account", accounts, 2)
    feed.run()


@_stream("t6")
def _t6(feed: _Feed) -> None:
    """Transactions that come before their accounts are counted once these arrive."""
    feed.send("transaction")
    feed.run()
    feed.send("account")
    feed.run()


@_stream("t9")
def _t9(feed: _Feed) -> None:
    """Transactions delivered twice, the first time with another time, count once."""
    feed.send("account")
    early = feed._table("transaction").withColumn("txn_time", F.col("txn_time") - F.expr("INTERVAL 45 DAYS"))
    feed.send("transaction", early, 1)
    feed.run()
    feed.send("transaction", seq=2)
    feed.run()


# Aggregates kept by signed differences, through all that revises them
def _t3_delta(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Transactions come with a wrong time and amount, accounts with other owners and branches with
    other cities; first the transactions are delivered again as they should be, then the rest."""
    kinds = ("transaction", "account", "branch") if name == "q3" else ("transaction", "account")
    feed = _Feed(spark, sf_dir, (name,), kinds, snapshot_every=0)
    right = {k: feed._table(k) for k in kinds}
    early = (F.col("txn_time") - F.expr("INTERVAL 45 DAYS")).alias("txn_time")
    odd = F.when(F.substring("txn_id", 1, 1) == "a", F.lit(float("inf"))).otherwise(F.col("amount") * 3 + 0.1)
    wrong = {"transaction": right["transaction"].withColumn("txn_time", early).withColumn("amount", odd),
             "account": right["account"].withColumn("customer_id", F.col("customer_id") + 1).withColumn(
                 "branch_id", F.lit(1).cast(right["account"].schema["branch_id"].dataType))}
    if name == "q3":
        wrong["branch"] = right["branch"].withColumn("city", F.concat(F.lit("Old "), "city"))
    for kind in kinds:
        feed.send(kind, wrong[kind], 1)
    feed.run()
    feed.send("transaction", right["transaction"], 2)
    feed.run()
    for kind in kinds[1:]:
        feed.send(kind, right[kind], 2)
    feed.run()
    return feed.result(name)


for _name in ("q3", "q5b", "q6"):
    register(f"t3_delta_{_name}", O.with_mapping(_q(_name)))(lambda spark, sf_dir, _n=_name: _t3_delta(spark, sf_dir, _n))


def _static_stream(spark, sf_dir, name: str, sent: list[DataFrame], **options) -> DataFrame:
    """Result of the stream-static refresh over batches sent one after the other."""
    root, t = scratch_dir(spark, "static"), _t(spark, sf_dir)
    dims = {k: t[k].select(*[F.col(c).cast("string").alias(c) if c.endswith("_id") else F.col(c)
                             for c in t[k].columns]) for k in ("account", "branch")}
    for rows in sent:
        wire = records.encode(rows, "transaction").withColumn("seq", F.lit(0).cast("long"))
        wire.write.mode("append").options(**layout.PACKED).json(f"{root}/src")
        query = stream_static.start(name, read_stream(spark, f"{root}/src", "transaction"), dims, f"{root}/out",
                                    f"{root}/checkpoint", available_now=True, **options)
        query.awaitTermination()
        if query.exception():
            raise query.exception()
    return stream_static.read_view(spark, name, f"{root}/out")


register("t3", O.with_mapping(_q("q6")))(
    lambda spark, sf_dir: _static_stream(spark, sf_dir, "q6", [
        _txn(spark, sf_dir).filter(F.col("txn_id") < "8"), _txn(spark, sf_dir).filter(F.col("txn_id") >= "8")])
    .select(F.col("branch_id").cast("bigint").alias("branch_id"), "txn_year", "txn_date", "total_amount",
            "count_txn"))


def _t4(spark, sf_dir):
    """Rows that come years behind the watermark are dropped when that is asked for."""
    x = _txn(spark, sf_dir)
    cut = F.lit("1996-01-01").cast("timestamp")
    return _static_stream(spark, sf_dir, "q3", [x.filter(F.col("txn_time") >= cut), x.filter(F.col("txn_time") < cut)],
                          drop_late=True)


register("t4", O.with_mapping("select * from q3 where window_start >= timestamp '1996-01-01'",
                              {"q3": _q("q3")}))(_t4)


def _t4_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each sent line ends: the second half of a stream of which the first half comes from 1996 on, with a
    bad time wherever the transaction's id ends with 0."""
    feed = _Feed(spark, sf_dir, kinds=("transaction",))
    out = f"{feed.root}/intake"
    x = feed._table("transaction")
    cut = F.lit("1996-01-01").cast("timestamp")
    for rows in (x.filter(F.col("txn_time") >= cut), x.filter(F.col("txn_time") < cut)):
        feed.send("transaction", rows.withColumn("txn_time", F.when(~F.col("txn_id").endswith("0"), F.col("txn_time"))))
        query = intake.start(read_stream(spark, feed.src["transaction"], "transaction"), out, delay="30 days",
                             check_ids=False, available_now=True)
        query.awaitTermination()
        if query.exception():
            raise query.exception()
    seen = [intake.rows(spark, out, fate).select("txn_id", F.lit(fate).alias("fate"), F.lit("").alias("reason"),
                                                 F.col("watermark")) for fate in intake.FATES]
    bad = intake.quarantined(spark, out).select("txn_id", F.lit("quarantined").alias("fate"), "reason",
                                                F.lit(None).cast("timestamp").alias("watermark"))
    return seen[0].union(seen[1]).union(bad)


# the first send of a feed is an empty one; the next batch has no watermark yet
register("t4_late", O.with_mapping("""
select txn_id,
       case when bad then 'quarantined' when not old then 'kept' when txn_time < top - interval 30 day then 'late'
            else 'kept' end as fate,
       case when bad then 'null txn_time' else '' end as reason,
       case when not bad and old then top - interval 30 day end as watermark
from sent, (select max(txn_time) as top from sent where not bad and not old)""", {
    "sent": "select txn_id, txn_time, right(txn_id, 1) = '0' as bad, txn_time < timestamp '1996-01-01' as old from bk_txn"}))(
    _t4_late)


# T6 as joins of streams: transactions come first, then dimension rows that are changed later
def _t6_join(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    kind = joined.PATHS[name][0]
    kinds = ("transaction", kind, "branch")
    feed = _Feed(spark, sf_dir, (name,), kinds)
    out, partitions = f"{feed.root}/joined", _parts(spark, sf_dir, STATE_ROWS)
    busy = joined.busy_keys(name, feed.tables["transaction"])

    def run():
        query = joined.start(name, feed.src, out, available_now=True, partitions=partitions, check_ids=False, busy=busy)
        query.awaitTermination()
        if query.exception():
            raise query.exception()

    feed.send("transaction")
    run()
    old = feed._table("branch").withColumns({c: F.concat(F.lit("Old "), c) for c in ("city", "branch_name")})
    feed.send("branch", old, 1)
    feed.send(kind)
    run()
    feed.send("branch", seq=2)
    run()
    return feed.typed(joined.read_view(spark, name, out))


for _name in joined.PATHS:
    register(f"t6_join_{_name}", O.with_mapping(_q(_name)))(lambda spark, sf_dir, _n=_name: _t6_join(spark, sf_dir, _n))


def _t8_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers per account over four sends whose rows are up to 300 days out of order."""
    feed = _Feed(spark, sf_dir, kinds=("transaction",))
    x = feed._table("transaction")
    shuffled = F.unix_date(F.col("txn_time").cast("date")) + F.pmod(F.xxhash64("txn_id"), F.lit(300))
    part = F.least(F.greatest(F.floor((shuffled - F.unix_date(F.lit("1992-01-01").cast("date"))) / 700), F.lit(0)), F.lit(3))
    out, partitions = f"{feed.root}/numbered", _parts(spark, sf_dir, STATE_ROWS)
    # a transaction of an account of its own far ahead lets the watermark pass all others
    ahead = x.orderBy("txn_id").limit(1).withColumn("account_id", F.lit(-1).cast("bigint")).withColumn(
        "txn_time", F.lit("2100-01-01").cast("timestamp"))
    for rows in (*[x.filter(part == k) for k in range(4)], ahead):  # a micro-batch each, of any number of files
        feed.send("transaction", rows)
        query = numbering.start(read_stream(spark, feed.src["transaction"], "transaction"), "400 days", out,
                                available_now=True, partitions=partitions, check_ids=False, buckets=8 * partitions)
        query.awaitTermination()
        if query.exception():
            raise query.exception()
    return feed.typed(numbering.read_view(spark, out)).select("account_id", "txn_id", "place")


register("t8_stream", ORACLE_SQL["t8"])(_t8_stream)


# the tree of QC5
register("qc5_tree", O.with_mapping("""
select 'QC5' as rule, 'employee' as tbl, 'below_missing_manager' as item,
       (select count(*) from below where lost) as violations
union all
select 'QC5', 'employee', 'in_or_below_cycle', (select count(*) from staff) - (select count(*) from below)""", {
    "staff": "select emp_id, min(manager_id) as manager_id from bk_employee where emp_id is not null group by emp_id",
    "below": """
select e.emp_id, e.manager_id is not null as lost from staff e
where not exists (select 1 from staff m where m.emp_id = e.manager_id)
union all
select e.emp_id, b.lost from below b join staff e on e.manager_id = b.emp_id"""}).replace("with ", "with recursive ", 1))(
    lambda spark, sf_dir: Q.qc5_reachability(_t(spark, sf_dir)))

def _qc_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QC3 and QC4 kept over four batches: transactions come first, then accounts and products, every third of
    these twice, then all other parents; at last the second ones are taken back."""
    t, out = _t(spark, sf_dir), scratch_dir(spark, "kept-checks")
    twice = {k: t[k].filter(F.col(PRIMARY_KEYS[k][0]) % 3 == 0) for k in ("account", "product")}
    batches = [({"transaction": t["transaction"]}, {}),
               ({k: t[k].union(rows) for k, rows in twice.items()}, {}),
               ({k: t[k] for k in ("branch", "customer", "employee")}, {}),
               ({}, twice)]
    for n, (added, removed) in enumerate(batches):
        kept_checks.apply(spark, out, n, added, removed)
    return kept_checks.read_view(spark, out)


register("qc_kept", f"select * from ({O.qc_sql('qc3')}) union all select * from ({O.qc_sql('qc4')})")(_qc_kept)

# R3T as a kept table: the twin adds up the panes of each span anew
_ROLLING_SQL = O.with_mapping("""
select p.city, p.hour_from, p.hour_to, cast(sum(q3.txn_count) as bigint) as txn_count
from spans p join q3 on q3.city = p.city and q3.window_start >= p.hour_from - interval 24 hour
     and q3.window_start <= p.hour_from
group by p.city, p.hour_from, p.hour_to""", {
    "q3": _q("q3"),
    "changed": """
select city, "at" from (
    select city, window_start as "at", txn_count as n from q3
    union all select city, window_start + interval 25 hour, -txn_count from q3) group by city, "at" having sum(n) <> 0""",
    "spans": 'select city, "at" as hour_from, lead("at") over (partition by city order by "at") as hour_to from changed'})

register("r3t_rolling", _ROLLING_SQL)(
    lambda spark, sf_dir: rolling.totals(rolling.changes(R.q3_high_value_by_city(_t(spark, sf_dir)))))


def _t3_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rolling totals kept by what each micro-batch changed in Q3: some transactions come with another time
    first, some accounts after their transactions."""
    kinds = ("transaction", "account", "branch")
    feed = _Feed(spark, sf_dir, ("q3",), kinds, snapshot_every=0)
    x = feed._table("transaction")
    feed.send("branch")
    feed.send("account", feed._table("account").filter("account_id % 3 = 0"))
    feed.send("transaction", x.withColumn("txn_time", F.col("txn_time") - F.expr("INTERVAL 7 HOURS")), 1)
    feed.run()
    feed.send("transaction", x, 2)
    feed.send("account")
    feed.run()
    return rolling.totals(rolling.changes(feed.refresh.increments("q3"), "n"))


register("t3_rolling", _ROLLING_SQL)(_t3_rolling)
