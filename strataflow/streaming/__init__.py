from strataflow.streaming.continuous import (
    Continuous,
    bucket_stats_stream,
    compact,
    current_rows,
    drain_to_table,
    minute_gmv_stream,
    recent_buckets,
    session_stream,
    sliding_stats_stream,
)
from strataflow.streaming.event_time import (
    bucket_stats,
    deduplicated,
    emitted,
    latest,
    minute_orders,
    sessions,
    state_rows,
    store_batches,
    windowed,
)

__all__ = [
    "Continuous", "bucket_stats_stream", "compact", "current_rows", "drain_to_table", "minute_gmv_stream", "recent_buckets",
    "session_stream", "sliding_stats_stream",
    "bucket_stats", "deduplicated", "emitted", "latest", "minute_orders", "sessions", "state_rows", "store_batches", "windowed",
]
