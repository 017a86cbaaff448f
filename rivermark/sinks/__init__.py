"""Published datasets and the run ledger."""

from .ledger_store import append_gates, append_runs, read_gates, read_runs
from .publish import CollisionError, Published, fingerprint, publish, read_output, read_published, run_path

__all__ = [
    "CollisionError",
    "Published",
    "append_gates",
    "append_runs",
    "fingerprint",
    "publish",
    "read_gates",
    "read_output",
    "read_published",
    "read_runs",
    "run_path",
]
