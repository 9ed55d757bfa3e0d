"""Append-only log of warehouse steps."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from strataflow import schemas


def audit_append(
    spark: SparkSession, path: str, run_id: str, log_id: int, step: str, status: str, rows: int, ms: int, message: str = ""
) -> None:
    row = (run_id, log_id, step, status, rows, ms, message, datetime.now(timezone.utc))
    spark.createDataFrame([row], schemas.AUDIT_LOG).coalesce(1).write.mode("append").parquet(path)


class AuditLog:
    """Times each step of a run and records its outcome, failures included."""

    def __init__(self, spark: SparkSession, path: str, run_id: str | None = None):
        self.spark, self.path = spark, path
        self.run_id = run_id or uuid.uuid4().hex
        self._next = 1

    def step(self, name: str, work: Callable[[], int | tuple[int, str]]) -> int:
        """Run ``work``, which returns its row count and optionally a note, and append one row about it."""
        begun = time.monotonic()
        try:
            result = work()
        except Exception as error:
            self._write(name, "failed", 0, begun, f"{type(error).__name__}: {error}")
            raise
        rows, note = result if isinstance(result, tuple) else (result, "")
        self._write(name, "success", rows, begun, note)
        return rows

    def _write(self, name: str, status: str, rows: int, begun: float, message: str) -> None:
        elapsed = int((time.monotonic() - begun) * 1000)
        audit_append(self.spark, self.path, self.run_id, self._next, name, status, rows, elapsed, message)
        self._next += 1
