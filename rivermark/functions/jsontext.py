"""JSON text: strict parsing, kinds and canonical rendering through VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MARK = "\u0001"
_TAIL = "\u0002end"

# One JSON string, or one number with a fraction or an exponent. Possessive
# loops keep the match iterative however long the string is.
_STRING_OR_DECIMAL = (
    r'("[^"\\]*+(?:\\.[^"\\]*+)*+")'
    r"|(-?(?:0|[1-9]\d*+)(?:\.\d++(?:[eE][+-]?\d++)?|[eE][+-]?\d++))"
)
_MAY_HOLD_DECIMAL = r"(?:^|[:,\[\s])-?\d+[.eE]"


def parse_strict(text: Column) -> Column:
    """VARIANT of a text that is exactly one JSON value, else NULL.

    The plain parser stops after the first value, so the text is parsed as the
    first of two array items and the second one must still be there.
    """
    pair = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_escaped(_TAIL)}"]')))
    complete = F.try_variant_get(pair, "$[1]", "string") == F.lit(_TAIL)
    return F.when(complete, F.try_variant_get(pair, "$[0]", "variant"))


def read_fields(text: Column, fields: str) -> Column:
    """Fields of a JSON object, read in one pass: a struct of ``v`` and ``e``.

    ``v`` holds the fields, objects in STRING fields as their text, and is NULL for
    a value that is no object. ``e`` is 1 if and only if the text is exactly one
    JSON value.
    """
    wrapped = F.concat(F.lit('{"v":'), text, F.lit(',"e":1}'))
    return F.from_json(
        wrapped,
        f"v STRUCT<{fields}>, e INT",
        {"allowSingleQuotes": "false", "mode": "PERMISSIVE"},
    )


def _escaped(text: str) -> str:
    return "".join(f"\\u{ord(c):04x}" if ord(c) < 32 else c for c in text)


def may_hold_decimals(text: Column) -> Column:
    """Cheap test that rules most texts out."""
    return text.rlike(_MAY_HOLD_DECIMAL)


def quote_decimals(text: Column) -> Column:
    """Turn decimal number tokens into strings, leaving strings and integers alone."""
    marked = F.regexp_replace(text, _STRING_OR_DECIMAL, f"$1{_MARK}$2{_MARK}")
    quoted = F.translate(F.replace(marked, F.lit(_MARK * 2), F.lit("")), _MARK, '"')
    return F.when(may_hold_decimals(text), quoted).otherwise(text)


def is_object_text(text: Column) -> Column:
    """True where valid JSON text is an object."""
    return F.btrim(text, F.lit(" \t\r\n")).startswith("{")


def base64_text(raw: Column) -> Column:
    """Base64 of bytes on one line."""
    return F.translate(F.base64(raw), "\r\n", "")


def canonical(text: Column) -> Column:
    """Compact text of one valid JSON value: sorted names, decimals as strings."""
    return sorted_text(quote_decimals(text))


def sorted_text(text: Column) -> Column:
    """Compact text with sorted names of JSON whose decimals are quoted already."""
    return F.to_json(F.try_parse_json(text))


def base64_object(raw: Column) -> Column:
    """Bytes that are no JSON, in a one-field object."""
    return F.to_json(F.struct(base64_text(raw).alias("base64")))
