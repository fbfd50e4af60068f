"""Records of several schema versions on one topic (S8): the writer's schema of each record is
resolved against the reader's, which is the table's contract.

A message names the version it was written with (``schema_id``). ``Versions`` holds the
writers' schemas (JSON wire types) and what the reader allows:

* a field that both have is read with the writer's type and promoted to the reader's (whole
  numbers to wider ones and to floating point, as ``PROMOTIONS`` lists);
* a field that only the writer has is left out;
* a field that only the reader has takes the reader's default, else null where it may be null;
* a field that was renamed is found under its older names (``aliases``);
* a value outside an enumeration takes the reader's default of that enumeration
  (``enum_defaults``), else the record is quarantined, and null stays null.

A version for which a field has neither is incompatible, and a version may be unknown: all
its records are quarantined, none fails the job. The quarantine keeps messages as they came,
so ``replay`` can read them again once a version or a value has been made known.

Each message is parsed once, by its own version's schema. Null values and versions, repeated
messages, empty tables and further columns (kept in the quarantine alone, whatever their
names) are allowed; a message without a value is an unparseable record.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import CORRUPT, DOMAINS, SCHEMAS
from .records import decode, wire_schema

# Types that a reader may widen.
PROMOTIONS = {
    "int": ("bigint", "float", "double"),
    "bigint": ("float", "double"),
    "float": ("double",),
}


@dataclass(frozen=True)
class Versions:
    """The writers' schemas of ``table`` by version, and the reader's allowances."""

    table: str
    writers: dict[int, T.StructType]
    defaults: dict[str, Any] = field(default_factory=dict)
    aliases: dict[str, tuple[str, ...]] = field(default_factory=dict)
    enum_defaults: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        known = {f.name for f in wire_schema(self.table)}
        unknown = (set(self.defaults) | set(self.aliases) | set(self.enum_defaults)) - known
        if unknown:
            raise ValueError(f"no fields of {self.table}: {sorted(unknown)}")

    def adding(self, **changes) -> Versions:
        """These versions and allowances with further ones (``writers={4: ...}`` etc.)."""
        return replace(self, **{k: {**getattr(self, k), **v} for k, v in changes.items()})

    def source(self, reader: T.StructField, version: int) -> T.StructField | None:
        """The writer's field that ``reader`` is read from, under its own name first."""
        written = {f.name: f for f in self.writers[version]}
        names = (reader.name, *self.aliases.get(reader.name, ()))
        return next((written[n] for n in names if n in written), None)

    def problems(self, version: int) -> list[str]:
        """Why records of ``version`` cannot be read (empty: they can)."""
        found = []
        for f in wire_schema(self.table):
            src = self.source(f, version)
            if src is None:
                if not f.nullable and f.name not in self.defaults:
                    found.append(f"no default for {f.name}")
                continue
            of, to = src.dataType.simpleString(), f.dataType.simpleString()
            if of != to and to not in PROMOTIONS.get(of, ()):
                found.append(f"{f.name} is {of}, not {to}")
        return found

    def readable(self) -> list[int]:
        return [v for v in sorted(self.writers) if not self.problems(v)]


def _resolved(versions: Versions, version: int, record: str) -> Column:
    """The reader's wire row of a record parsed with the writer's schema."""
    cols = []
    for f in wire_schema(versions.table):
        src = versions.source(f, version)
        if src is None:
            value = F.lit(versions.defaults.get(f.name))
        else:
            value = F.col(record).getField(src.name)
            domain = DOMAINS.get((versions.table, f.name))
            if domain and f.name in versions.enum_defaults:
                value = F.when(value.isNull() | value.isin(domain), value).otherwise(
                    F.lit(versions.enum_defaults[f.name]))
        cols.append(value.cast(f.dataType).alias(f.name))
    return F.struct(*cols, F.col(record).getField(CORRUPT).alias(CORRUPT))


def parse_versions(messages: DataFrame, versions: Versions, check_ids: bool = True
                   ) -> tuple[DataFrame, DataFrame]:
    """``(typed rows with their schema_id, quarantined messages + reason)`` of messages with the
    columns ``value`` and ``schema_id``. A quarantined message keeps all its columns."""
    readable = versions.readable()
    version = F.col("__message.schema_id")
    kept = messages.select(F.struct(*[F.col(f"`{c}`") for c in messages.columns]).alias("__message"))
    parsed = kept.select("__message", *[
        F.from_json(F.when(version == v, F.col("__message.value")),
                    T.StructType([*versions.writers[v].fields, T.StructField(CORRUPT, T.StringType())]),
                    {"columnNameOfCorruptRecord": CORRUPT}).alias(f"__v{v}") for v in readable])
    row = F.coalesce(*[F.when((version == v) & F.col(f"__v{v}").isNotNull(), _resolved(versions, v, f"__v{v}"))
                       for v in readable]) if readable else F.lit(None).cast(
        T.StructType([*wire_schema(versions.table).fields, T.StructField(CORRUPT, T.StringType())]))

    found = F.when(version.isNull(), F.lit("no schema version"))
    for v in sorted(versions.writers):
        if v not in readable:
            found = found.when(version == v, F.lit(f"incompatible version {v}: " + "; ".join(versions.problems(v))))
    found = found.when(~version.isin(sorted(versions.writers)) if versions.writers else F.lit(True),
                       F.concat(F.lit("unknown version "), version.cast("string")))
    found = found.when(F.col("__row").isNull(), F.lit("unparseable record"))
    enums = [F.when(F.col(name).isNotNull() & ~F.col(name).isin(DOMAINS[versions.table, name]),
                    F.concat(F.lit(f"unknown {name} "), F.col(name)))
             for name in (f.name for f in SCHEMAS[versions.table]) if (versions.table, name) in DOMAINS]

    # an array of one row is unpacked rather than its fields picked: picking would put the parsing
    # of every version into the expression of each field
    rows = (parsed.select("__message", F.explode(F.array(row)).alias("__row"))
            .select("__message", "__row", found.alias("__found")).select("__row.*", "__message", "__found"))
    good, bad = decode(rows, versions.table, check_ids, found="__found", more=enums)
    contract = [f.name for f in SCHEMAS[versions.table]]
    return (good.select(*contract, F.col("__message.schema_id").alias("schema_id")),
            bad.select(*[F.col("__message").getField(c).alias(c) for c in messages.columns], "reason"))


def replay(quarantine: DataFrame, versions: Versions, check_ids: bool = True
           ) -> tuple[DataFrame, DataFrame]:
    """Quarantined messages read once more, with what ``versions`` allows by now: ``(typed rows,
    messages that stay + their present reason)``."""
    return parse_versions(quarantine.drop("reason"), versions, check_ids)
