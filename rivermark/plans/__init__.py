"""Jobs, and the catalogue of queries over the base tables."""

from . import catalog_audits, catalog_control, catalog_events, catalog_settlements, catalog_streams
from .registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "catalog_audits",
    "catalog_control",
    "catalog_events",
    "catalog_settlements",
    "catalog_streams",
]
