"""Column functions: time buckets, text forms, id checks.

All are built-in Spark expressions (JVM side, whole-stage codegen), so they run inside
the scan/project stage of every rollup. Time buckets are rendered in the session zone,
which ``bankroll.session`` pins to UTC.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket and text patterns of the maintained tables.
DAY_PATTERN = "yyyyMMdd"
TIMESTAMP_TEXT_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
MINUTE_PATTERN = "yyyyMMddHHmm"
HOUR_PATTERN = "yyyyMMddHH"
ISO_DATE_PATTERN = "yyyy-MM-dd"
UTC_OFFSET_TEXT = "+00:00"
PAN_PREFIX = "PAN-"
PAN_HASH_CHARS = 16


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def day_bucket(ts: str | Column) -> Column:
    """``yyyyMMdd`` day key."""
    return F.date_format(_c(ts), DAY_PATTERN)


def timestamp_text(ts: str | Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss.SSSSSS`` (millisecond values print as ``.123000``)."""
    return F.date_format(_c(ts), TIMESTAMP_TEXT_PATTERN)


def minute_bucket(ts: str | Column) -> Column:
    """``yyyyMMddHHmm`` minute key."""
    return F.date_format(_c(ts), MINUTE_PATTERN)


def hour_bucket(ts: str | Column) -> Column:
    """``yyyyMMddHH`` hour key."""
    return F.date_format(_c(ts), HOUR_PATTERN)


def quarter_label(ts: str | Column) -> Column:
    """``YYYYQn`` (e.g. ``2025Q1``)."""
    t = _c(ts)
    return F.concat(F.year(t).cast("string"), F.lit("Q"), F.quarter(t).cast("string"))


def year_text(ts: str | Column) -> Column:
    """the year as text."""
    return F.year(_c(ts)).cast("string")


def to_day(ts: str | Column) -> Column:
    """calendar date of the instant (UTC)."""
    return F.to_date(_c(ts))


def from_epoch_millis(ms: str | Column) -> Column:
    """F8: epoch milliseconds to a timestamp."""
    return F.timestamp_millis(_c(ms))


def parse_iso_date(text: str | Column) -> Column:
    """ISO date text to a date; malformed text gives null instead of failing."""
    return _c(text).try_cast("date")


def parse_iso_timestamp(text: str | Column) -> Column:
    """ISO-8601 date-time text (with or without offset) to a timestamp; bad text -> null."""
    return F.try_to_timestamp(_c(text))


def iso_date_text(d: str | Column) -> Column:
    """date (or the date of a timestamp) to ``yyyy-MM-dd``; null stays null."""
    return F.date_format(_c(d), ISO_DATE_PATTERN)


def iso_utc_text(ts: str | Column) -> Column:
    """timestamp (a date is midnight UTC) to ISO-8601 UTC text with offset.

    Same text as a zone-aware ISO formatter in automatic precision: the fraction is
    printed with six digits only when the sub-second part is not zero, and the offset
    is ``+00:00``. Null stays null.
    """
    t = _c(ts).cast("timestamp")
    frac = F.when(F.unix_micros(t) % 1_000_000 != 0, F.date_format(t, ".SSSSSS")).otherwise(F.lit(""))
    return F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), frac, F.lit(UTC_OFFSET_TEXT))


def uuid_is_valid(text: str | Column) -> Column:
    """does the text parse as a UUID? Null counts as valid (nullable ids).

    Accepted forms: 32 hex digits after dropping ``urn:`` / ``uuid:`` prefixes, the outer
    braces and every hyphen (so canonical ``8-4-4-4-12`` text and bare hex both pass).
    """
    t = _c(text)
    bare = F.regexp_replace(F.regexp_replace(t, "urn:|uuid:", ""), r"^\{+|\}+$", "")
    hexs = F.regexp_replace(bare, "-", "")
    return t.isNull() | hexs.rlike("^[0-9a-fA-F]{32}$")


def uuid_text(col: str | Column) -> Column:
    """id to text; null stays null."""
    return _c(col).cast("string")


def pan_hash(seq: str | Column) -> Column:
    """pseudonymous id -- first 16 hex digits of SHA-256 of ``PAN-<seq>``, upper case."""
    digest = F.sha2(F.concat(F.lit(PAN_PREFIX), _c(seq).cast("string")), 256)
    return F.upper(F.substring(digest, 1, PAN_HASH_CHARS))


def minus_interval(now: datetime | str | Column, interval: str) -> Column:
    """F16: ``now - INTERVAL '<interval>'``; ``now`` is passed in for repeatable reads."""
    start = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    return start - F.expr(f"INTERVAL {interval}")


def clamp_round(x: str | Column, lo: float, hi: float, digits: int = 2) -> Column:
    """clamp to ``[lo, hi]`` and round half up to ``digits`` decimals."""
    return F.round(F.greatest(F.lit(lo), F.least(_c(x), F.lit(hi))), digits)


EXACT = "decimal(28,12)"


def money(x: str | Column) -> Column:
    """The amount as a decimal of twelve places, or null if that is not its exact value (more
    places, out of range, not finite). Decimal sums do not depend on the order of addition
    (double sums do)."""
    c = _c(x)
    exact = c.try_cast(EXACT)
    return F.when(exact.cast("double") == c, exact)


def is_finite(x: str | Column) -> Column:
    c = _c(x)
    return ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def above(x: str | Column, threshold: float) -> Column:
    """``x > threshold`` with IEEE semantics: NaN is never above (Spark orders NaN last)."""
    return (_c(x) > threshold) & ~F.isnan(_c(x))


def money_sum_parts(x: str | Column, prefix: str) -> list[Column]:
    """Partial aggregates of an amount sum: the exact decimal sum of the amounts that have
    at most twelve places (``<prefix>_s``) and the double sum of all others, the non-finite
    among them (``<prefix>_ns``, null when there are none). No amount is rounded before the
    sum. Both re-aggregate with ``sum``, so they serve two-level plans."""
    c = _c(x)
    return [F.sum(money(c)).alias(f"{prefix}_s"),
            F.sum(F.when(money(c).isNull(), c)).alias(f"{prefix}_ns")]


def money_resum(prefix: str) -> list[Column]:
    """Second-level aggregation of ``money_sum_parts``."""
    return [F.sum(f"{prefix}_s").alias(f"{prefix}_s"), F.sum(f"{prefix}_ns").alias(f"{prefix}_ns")]


def money_total(prefix: str) -> Column:
    """Final amount: the exact sum as a double; a group that also holds amounts beyond twelve
    places, NaN or an infinity gets the double sum of those added, as a plain SUM would."""
    s, ns = F.col(f"{prefix}_s"), F.col(f"{prefix}_ns")
    return F.when(ns.isNull(), s.cast("double")) \
        .otherwise(ns + F.coalesce(s, F.lit(0)).cast("double"))


def to_wall_clock(ts: str | Column) -> Column:
    """Instant -> UTC wall-clock value (``timestamp_ntz``) for export to zone-less engines."""
    return _c(ts).cast("timestamp_ntz")
