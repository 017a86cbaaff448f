"""Money and clock decoding; every function yields NULL where the input is bad."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DECIMAL_TEXT = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
_NOT_FINITE = r"(?i)^[+-]?(inf|infinity|s?nan\d*)$"
_BASE64_TEXT = r"^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{4}|[A-Za-z0-9+/]{3}=|[A-Za-z0-9+/]{2}==)$"
_ISO_WITH_OFFSET = (
    r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?(Z|[+-]\d{2}(:?\d{2})?)$"
)

# The first integer read as microseconds, and the clock range.
MICROS_FROM = 100_000_000_000_000
MIN_MICROS = -62_135_596_800_000_000
MAX_MICROS = 253_402_300_799_999_999


def is_decimal_text(text: Column) -> Column:
    return text.rlike(_DECIMAL_TEXT)


def base64_unscaled(text: Column) -> Column:
    """Signed big-endian integer held in base64 text, as DECIMAL(20,0)."""
    digits = F.hex(F.try_to_binary(F.when(text.rlike(_BASE64_TEXT), text), F.lit("base64")))
    # A longer encoding of a small number repeats its sign byte.
    digits = F.regexp_replace(digits, "^(?:00)+(?=[0-7])", "")
    digits = F.regexp_replace(digits, "^(?:FF)+(?=[89A-F])", "")
    padded = F.when(digits.rlike("^[89A-F]"), F.lpad(digits, 16, "F")).otherwise(
        F.lpad(digits, 16, "0")
    )
    return F.when(F.length(digits).between(1, 16), F.conv(padded, 16, -10)).cast("decimal(20,0)")


def money(text: Column, *, encoding: str = "auto") -> Column:
    """DECIMAL(18,2) from decimal text or from base64 unscaled bytes.

    ``auto`` reads as decimal whatever looks like one, also a base64 text made
    of digits only; ``base64`` and ``decimal`` leave no choice. Extra decimals
    are rounded half-even; too many digits give NULL.
    """
    trimmed = F.btrim(text, F.lit(" \t\n\r\f\u000b"))
    plain = F.bround(F.when(is_decimal_text(trimmed), trimmed).try_cast("decimal(38,18)"), 2)
    packed = base64_unscaled(text) / F.lit(100).cast("decimal(3,0)")
    if encoding == "decimal":
        value = plain
    elif encoding == "base64":
        value = packed
    elif encoding == "auto":
        value = (
            F.when(is_decimal_text(trimmed), plain)
            .when(trimmed.rlike(_NOT_FINITE), F.lit(None))
            .otherwise(packed)
        )
    else:
        raise ValueError(f"unknown money encoding: {encoding}")
    return value.try_cast("decimal(18,2)")


def epoch_timestamp(number: Column) -> Column:
    """Timestamp of an epoch integer, micro- or milliseconds by its size."""
    micros = F.when(
        (number >= F.lit(MICROS_FROM)) | (number <= F.lit(-MICROS_FROM)), number
    ).otherwise(number * 1000)
    return F.when(micros.between(MIN_MICROS, MAX_MICROS), F.timestamp_micros(micros))


def epoch_millis(number: Column) -> Column:
    """Timestamp of epoch milliseconds, NULL outside the years 1 to 9999."""
    inside = number.between(MIN_MICROS // 1000, MAX_MICROS // 1000)
    return F.timestamp_micros(F.when(inside, number) * 1000)


def offset_timestamp(text: Column) -> Column:
    """Timestamp of ISO-8601 text with an explicit offset."""
    shaped = F.when(text.rlike(_ISO_WITH_OFFSET), F.replace(text, F.lit(","), F.lit(".")))
    return F.try_to_timestamp(shaped)


def iso_timestamp(text: Column) -> Column:
    """Timestamp of ISO-8601 text with or without an offset, to tell the two apart."""
    return F.try_to_timestamp(
        F.when(
            text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"),
            F.replace(text, F.lit(","), F.lit(".")),
        )
    )


def clock(text: Column, token: Column) -> Column:
    """Timestamp of a JSON scalar given as text plus its raw token."""
    return F.when(token.rlike(r"^-?\d+$"), epoch_timestamp(text.try_cast("bigint"))).when(
        token.startswith('"'), offset_timestamp(text)
    )
