from strataflow.sinks.audit import AuditLog, audit_append
from strataflow.sinks.tables import (
    assert_in_range,
    filter_range,
    load_many,
    load_verified,
    out_of_range,
    refresh,
    save_bucketed,
    stamp_sync_time,
    with_key_range,
    with_month,
)
from strataflow.sinks.upsert import dedupe_latest, dedupe_stored, has_duplicates, upsert_latest, upsert_partitions

__all__ = [
    "AuditLog", "assert_in_range", "audit_append", "dedupe_latest", "dedupe_stored", "filter_range", "has_duplicates", "load_many",
    "load_verified", "out_of_range", "refresh", "save_bucketed", "stamp_sync_time", "upsert_latest",
    "upsert_partitions", "with_key_range", "with_month",
]
