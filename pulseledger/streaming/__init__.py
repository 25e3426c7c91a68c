from .metrics import approx_sliding_actives, daily_counts, deduplicate, sliding_actives
from .sessions import emit_sessions, late_rows, reconcile_late, streaming_sessions, upsert_sessions_stream
from .sources import read_stream

__all__ = [
    "approx_sliding_actives",
    "daily_counts",
    "deduplicate",
    "emit_sessions",
    "late_rows",
    "read_stream",
    "reconcile_late",
    "sliding_actives",
    "streaming_sessions",
    "upsert_sessions_stream",
]
