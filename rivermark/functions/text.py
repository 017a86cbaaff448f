"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space at the ends of a value: Unicode's, not ASCII's alone.
_BLANKS = (
    " \t\n\r\f\u000b\u001c\u001d\u001e\u001f\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The metadata fields that may be published.
SAFE_METADATA_FIELDS = (
    "accepted_count",
    "artifact_type",
    "checksum_sha256",
    "code_version",
    "consumer_group",
    "contains_delete",
    "contains_snapshot",
    "contains_tombstone",
    "dlq_topic",
    "entity_name",
    "error_code",
    "ingested_at",
    "ingestion_run_id",
    "input_checksum",
    "kafka_offset",
    "offset_end",
    "offset_start",
    "output_type",
    "partner_id",
    "pipeline_name",
    "partition",
    "processing_date",
    "processing_run_id",
    "record_count",
    "rejected_count",
    "schema_version",
    "silver_schema_version",
    "source_schema_version",
    "source_type",
    "source_file_name",
    "source_file_size",
    "source_name",
    "topic",
)


def clean(text: Column) -> Column:
    """Text without surrounding white space; NULL becomes empty."""
    # Searching the blanks is slow; ends that are visible ASCII need none of it.
    bare = F.ascii(text).between(33, 126) & F.ascii(F.substring(text, -1, 1)).between(33, 126)
    return F.when(bare, text).otherwise(F.coalesce(F.btrim(text, F.lit(_BLANKS)), F.lit("")))


def first_name(full_name: Column) -> Column:
    """Everything before the first blank of a full name."""
    return F.nullif(F.substring_index(F.btrim(full_name, F.lit(_BLANKS)), " ", 1), F.lit(""))


def last_name(full_name: Column) -> Column:
    """Everything after the first blank of a full name, NULL without one."""
    name = F.btrim(full_name, F.lit(_BLANKS))
    blank = F.instr(name, " ")
    return F.when(blank > 0, F.substr(name, blank + 1))


def safe_metadata(metadata: Column) -> Column:
    """Allow-listed entries of a map, names normalized and values bounded."""
    renamed = F.transform_keys(
        metadata,
        lambda k, _: F.replace(F.lower(F.btrim(k, F.lit(_BLANKS))), F.lit("-"), F.lit("_")),
    )
    trimmed = F.transform_values(
        renamed,
        lambda _, v: F.btrim(F.translate(v, "\r\n", "  "), F.lit(_BLANKS)),
    )
    kept = F.map_filter(
        trimmed,
        lambda k, v: k.isin(*SAFE_METADATA_FIELDS) & v.isNotNull() & (v != ""),
    )
    return F.transform_values(kept, lambda _, v: F.substring(v, 1, 1024))
