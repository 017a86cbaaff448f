"""Set-based change-data-capture and settlement processing on Spark DataFrames."""

from .session import configure, shared_dir

__all__ = ["configure", "shared_dir"]
