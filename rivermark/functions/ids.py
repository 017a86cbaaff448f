"""Deterministic identities as native hash expressions."""

from __future__ import annotations

from uuid import UUID

from pyspark.sql import Column
from pyspark.sql import functions as F

# UUID namespaces of the file and of the run identities.
FILE_NAMESPACE = UUID("22a08d63-cffc-4d36-8a83-a7b0d31c9f16")
URL_NAMESPACE = UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def _colon_hash(*parts: Column | str) -> Column:
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.sha2(F.concat_ws(":", *[c.cast("string") for c in columns]), 256)


def event_id(topic="kafka_topic", partition="kafka_partition", offset="kafka_offset") -> Column:
    """Hash of one record's coordinate."""
    return _colon_hash(topic, partition, offset)


def offset_batch_id(topic, partition, offset_start, offset_end, schema_version) -> Column:
    """Hash of one contiguous offset range."""
    return _colon_hash(topic, partition, offset_start, offset_end, schema_version)


def output_part_id(run_id, output_type, entity) -> Column:
    """Short hash that names a run's output of one kind for one entity."""
    return F.substring(_colon_hash(run_id, output_type, entity, F.lit("0")), 1, 16)


def uuid5(namespace: UUID, name: Column) -> Column:
    """Name-based UUID (version 5) without leaving the JVM."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), name.cast("binary")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


def file_id(source: Column, partner: Column, checksum: Column) -> Column:
    """Name-based id of one content of a source's partner."""
    return uuid5(FILE_NAMESPACE, F.concat_ws(":", source, partner, checksum))
