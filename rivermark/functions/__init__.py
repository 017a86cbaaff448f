"""Column expressions: identities, JSON, money, clocks and text."""

from .barrier import computed
from .decode import (
    base64_unscaled,
    epoch_millis,
    is_decimal_text,
    iso_timestamp,
    money,
    offset_timestamp,
)
from .ids import event_id, offset_batch_id, output_part_id, uuid5
from .jsontext import (
    base64_object,
    base64_text,
    canonical,
    is_object_text,
    may_hold_decimals,
    parse_strict,
    quote_decimals,
    read_fields,
    sorted_text,
)
from .text import clean, first_name, last_name, safe_metadata

__all__ = [
    "base64_object",
    "base64_text",
    "base64_unscaled",
    "canonical",
    "clean",
    "computed",
    "epoch_millis",
    "event_id",
    "first_name",
    "is_decimal_text",
    "is_object_text",
    "iso_timestamp",
    "last_name",
    "may_hold_decimals",
    "money",
    "offset_batch_id",
    "offset_timestamp",
    "output_part_id",
    "parse_strict",
    "quote_decimals",
    "read_fields",
    "safe_metadata",
    "sorted_text",
    "uuid5",
]
