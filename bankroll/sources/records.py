"""Record forms of the contracts: typed scans, wire encoding, keyed emission, decoding.

* ``read_table`` (S1-S3): schema-first scan of a stored table (Parquet, JSON lines or
  CSV) projected to the contract's column order (F13); never inferred, never collected.
* ``encode`` / ``decode`` (F8-F11, F15): typed rows <-> wire rows. On the wire ids are
  text, dates ``yyyy-MM-dd``, dimension timestamps ISO-8601 UTC text with offset, and
  the transaction time epoch milliseconds.
* ``emit_keyed`` (S7): ``(topic, key, value)`` per row; transactions keyed by account,
  dimensions by their primary key; value is the JSON wire record (nulls kept).
* ``parse_keyed`` (S8): JSON value -> typed rows against the declared schema; rows that
  do not parse, or whose ids/times are malformed, go to a quarantine frame instead of
  failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import buckets as B
from ..model import CORRUPT, FIELD_ORDER, RAW_DIMENSIONS, RAW_TRANSACTION, SCHEMAS

# Topic names of the streams.
TOPICS = {
    "transaction": "banking.transactions",
    "account": "banking.dimensions.account",
    "branch": "banking.dimensions.branch",
    "customer": "banking.dimensions.customer",
    "employee": "banking.dimensions.employee",
}
# transactions are keyed by account (per-account ordering), dimensions by primary key
MESSAGE_KEYS = {"transaction": "account_id", "account": "account_id", "branch": "branch_id",
                "customer": "customer_id", "employee": "emp_id"}
ID_COLUMNS = {"branch_id", "customer_id", "emp_id", "manager_id", "account_id", "product_id",
              "txn_id", "approved_by_emp_id"}


def wire_schema(table: str) -> T.StructType:
    return RAW_TRANSACTION if table == "transaction" else RAW_DIMENSIONS[table]


def project(df: DataFrame, table: str) -> DataFrame:
    """the contract's columns, in the contract's order."""
    return df.select(*FIELD_ORDER[table])


def read_table(spark: SparkSession, path: str, table: str, fmt: str = "parquet") -> DataFrame:
    """Typed scan with the declared schema (no inference) and column order."""
    reader = spark.read.schema(SCHEMAS[table])
    if fmt == "csv":
        reader = reader.option("header", True)
    return project(reader.format(fmt).load(path), table)


def encode(df: DataFrame, table: str) -> DataFrame:
    """Typed rows -> wire rows (ids as text, times as text or epoch millis)."""
    cols = []
    for f in SCHEMAS[table].fields:
        c = F.col(f.name)
        if table == "transaction" and f.name == "txn_time":
            c = F.unix_millis(c)
        elif f.name in ID_COLUMNS:
            c = B.uuid_text(c)
        elif isinstance(f.dataType, T.DateType):
            c = B.iso_date_text(c)
        elif isinstance(f.dataType, T.TimestampType):
            c = B.iso_utc_text(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _typed(raw: DataFrame, table: str) -> list:
    cols = []
    for f in SCHEMAS[table].fields:
        c = F.col(f.name)
        if table == "transaction" and f.name == "txn_time":
            c = B.from_epoch_millis(c)
        elif isinstance(f.dataType, T.DateType):
            c = B.parse_iso_date(c)
        elif isinstance(f.dataType, T.TimestampType):
            c = B.parse_iso_timestamp(c)
        cols.append(c.alias(f.name))
    return cols


def decode(raw: DataFrame, table: str, check_ids: bool = True, found: str | None = None,
           more: list | None = None) -> tuple[DataFrame, DataFrame]:
    """Wire rows -> ``(typed rows, quarantined wire rows + reason)``.

    A row is quarantined when its text did not parse (``_corrupt_record``, if present, holds
    it), a non-null time text does not parse, a required column is null, or an id is not
    UUID text (F12; ``check_ids=False`` accepts other ids). Columns that are not part of the
    contract (e.g. a ``seq`` version) pass through after the contract columns. ``found`` names a
    column whose text, where not null, is the reason by itself; ``more`` are further problems
    (columns that are null where there is none).
    """
    contract = {f.name for f in SCHEMAS[table].fields}
    extra = [c for c in raw.columns if c not in contract and c != CORRUPT]
    typed = raw.select(*[F.col(c) for c in raw.columns],
                       *[c.alias(f"__t_{f.name}") for c, f in zip(_typed(raw, table),
                                                                   SCHEMAS[table].fields)])
    problems = []
    for f in SCHEMAS[table].fields:
        src, out = F.col(f.name), F.col(f"__t_{f.name}")
        if not f.nullable:
            problems.append(F.when(src.isNull(), F.lit(f"null {f.name}")))
        if isinstance(f.dataType, (T.DateType, T.TimestampType)):
            problems.append(F.when(src.isNotNull() & out.isNull(), F.lit(f"bad time {f.name}")))
        if isinstance(f.dataType, T.DoubleType):  # NaN / infinite amounts break the contract
            problems.append(F.when(src.isNotNull() & ~B.is_finite(src), F.lit(f"non-finite {f.name}")))
        if check_ids and f.name in ID_COLUMNS:
            problems.append(F.when(~B.uuid_is_valid(src), F.lit(f"bad id {f.name}")))
    reason = F.concat_ws("; ", F.array_compact(F.array(*problems, *(more or []))))
    if CORRUPT in raw.columns:
        reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("unparseable record")).otherwise(reason)
    if found:
        reason = F.coalesce(F.col(found), reason)
    flagged = typed.withColumn("__reason", reason)
    good = flagged.filter(F.col("__reason") == "").select(
        *[F.col(f"__t_{f.name}").alias(f.name) for f in SCHEMAS[table].fields], *extra)
    bad = flagged.filter(F.col("__reason") != "").select(*raw.columns,
                                                         F.col("__reason").alias("reason"))
    return good, bad


def emit_keyed(df: DataFrame, table: str) -> DataFrame:
    """``(topic, key, value)``: key is the message key as text, value the JSON wire
    record with every field (nulls included)."""
    wire = encode(df, table)
    return wire.select(
        F.lit(TOPICS[table]).alias("topic"),
        F.col(MESSAGE_KEYS[table]).alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in FIELD_ORDER[table]]),
                  {"ignoreNullFields": "false"}).alias("value"),
    )


def parse_keyed(messages: DataFrame, table: str, check_ids: bool = True
                ) -> tuple[DataFrame, DataFrame]:
    """Decode the ``value`` JSON of keyed messages against the table's wire schema.
    Messages that are no JSON of the schema, or have malformed fields, land in the quarantine
    frame ``(value, reason)`` with their value as it came."""
    schema = T.StructType([*wire_schema(table).fields, T.StructField(CORRUPT, T.StringType())])
    # each message is parsed once: a generator's output, unlike a projection's, is not copied
    # into the many expressions and filters over it
    parsed = messages.select(F.inline(F.array(F.struct(
        F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT}).alias("r"),
        F.col("value").alias("__value")))))
    rows = parsed.select("r.*", "__value", F.when(F.col("r").isNull(), F.lit("")).otherwise(
        F.col(f"r.{CORRUPT}")).alias("__bad")).drop(CORRUPT).withColumnRenamed("__bad", CORRUPT)
    good, bad = decode(rows, table, check_ids)
    return good.drop("__value"), bad.select(F.col("__value").alias("value"), "reason")
