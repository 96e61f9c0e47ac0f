"""``Column -> Column`` helpers. All of them stay inside JVM code generation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from ledgerwatch.schemas import AMOUNT, HOME_COUNTRY

# The mask between the two visible ends of an IBAN, and the text
# of a velocity block. Both are read by people and by other systems.
IBAN_MASK = "****"
VELOCITY_REASON = "VELOCITY_RULE: %d INSTANT_SEPA in %d min | risk_tier=%s"
VELOCITY_PREFIX = "VELOCITY_RULE"

MICROS_PER_SECOND = 1_000_000


def pseudonymize_iban(iban: Column, key: str) -> Column:
    """Keyed SHA-256 of an IBAN as 64 lower-case hex digits; NULL stays NULL.

    The key is prefixed to the text. This is not an RFC 2104 HMAC, and must not
    become one while older tables are joined on the hash.
    """
    return F.sha2(F.concat(F.lit(key), iban), 256)


def truncate_iban(iban: Column) -> Column:
    """First and last four characters around a mask. The ends of a short text overlap."""
    return F.concat(F.left(iban, F.lit(4)), F.lit(IBAN_MASK), F.right(iban, F.lit(4)))


def parse_eu_amount(text: Column, strict: bool = True) -> Column:
    """European amount text (``1.234,56``) as DECIMAL(18,2).

    Dots are thousands marks and are dropped wherever they stand, so ``1234.56``
    reads as 123456.00. ``strict=False`` gives NULL for text that is no amount,
    ``strict=True`` fails the query under ANSI mode.
    """
    plain = F.translate(text, ",.", ".")
    return plain.cast(AMOUNT) if strict else plain.try_cast(AMOUNT)


def format_eu_amount(amount: Column) -> Column:
    """Amount as text with a decimal comma, two decimals and no thousands mark."""
    return F.translate(amount.cast(AMOUNT).cast("string"), ".", ",")


def is_cross_border(beneficiary_iban: Column, home: str = HOME_COUNTRY) -> Column:
    """True when the beneficiary's country code differs from ``home`` (case counts)."""
    return F.left(beneficiary_iban, F.lit(2)) != F.lit(home)


def velocity_reason(count: Column, window_minutes: int, tier: Column) -> Column:
    """Human-readable reason of a velocity block."""
    return F.format_string(VELOCITY_REASON, count, F.lit(window_minutes), tier)


def timestamp_ntz(value: datetime) -> Column:
    """A zone-less timestamp literal that does not depend on the session zone."""
    return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def iso_text(at: Column) -> Column:
    """ISO-8601 text with microseconds, as the event feed writes it."""
    text = at.cast("string")
    whole = F.translate(F.substring(text, 1, 19), " ", "T")
    return F.concat(whole, F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0"))


def hours(at: Column) -> Column:
    """Number of whole hours since 1970-01-01 00:00, zone-less."""
    return F.unix_date(at.cast("date")).cast("bigint") * 24 + F.hour(at)


def minutes(at: Column) -> Column:
    """Number of whole minutes since 1970-01-01 00:00, zone-less."""
    return hours(at) * 60 + F.minute(at)


def seconds(at: Column) -> Column:
    """Number of whole seconds since 1970-01-01 00:00, zone-less."""
    return minutes(at) * 60 + F.second(at)


def micros(at: Column) -> Column:
    """Microseconds since 1970-01-01 00:00, zone-less."""
    second = F.date_part(F.lit("SECOND"), at)
    return minutes(at) * (60 * MICROS_PER_SECOND) + (second * MICROS_PER_SECOND).cast("bigint")


def from_micros(value: Column) -> Column:
    """Inverse of :func:`micros`."""
    seconds = (value.cast("decimal(18,0)") / MICROS_PER_SECOND).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def interval(**parts: int) -> Column:
    """Day-time interval literal: ``interval(days=30)``, ``interval(mins=60)``."""
    return F.make_dt_interval(**{name: F.lit(value) for name, value in parts.items()})


def _hashes(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.name.endswith("_hmac") and f.dataType == StringType()]


def packed_hashes(df: DataFrame) -> DataFrame:
    """The hash columns as bytes, half as wide in a shuffle; equal where the texts are equal.

    The last byte tells lower-case hex digits (0) from any other text (1).
    """

    def pack(name: str) -> Column:
        raw = F.unhex(F.col(name))
        digits = F.lower(F.hex(raw)) == F.col(name)
        return F.when(digits, F.concat(raw, F.unhex(F.lit("00")))).otherwise(F.concat(F.col(name).cast("binary"), F.unhex(F.lit("01"))))

    return df.withColumns({name: pack(name) for name in _hashes(df)})


def unpacked_hashes(df: DataFrame) -> DataFrame:
    """The hash columns as the texts that :func:`packed_hashes` was given."""

    def unpack(name: str) -> Column:
        kept = F.substring(F.col(name), F.lit(1), F.length(name) - 1)
        digits = F.substring(F.col(name), -1, 1) == F.unhex(F.lit("00"))
        return F.when(digits, F.lower(F.hex(kept))).otherwise(kept.cast("string"))

    return df.withColumns({f.name: unpack(f.name) for f in df.schema.fields if f.name.endswith("_hmac") and f.dataType == BinaryType()})
