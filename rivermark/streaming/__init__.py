"""Structured Streaming jobs."""

from .bronze import start_bronze_stream
from .state import start_state_stream, without_replays

__all__ = ["start_bronze_stream", "start_state_stream", "without_replays"]
