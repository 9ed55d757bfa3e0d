"""Conditional pivots and shares."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_filtered(
    df: DataFrame, key: str, labels: Mapping[str, str], measure: str, fn: Callable[[Column], Column] = F.sum
) -> DataFrame:
    """One row with ``fn(measure)`` per wanted key value, keyed by output name: value -> column."""
    return df.agg(*[fn(F.when(F.col(key) == value, F.col(measure))).alias(out) for value, out in labels.items()])


def share_of_total(df: DataFrame, measure: str, name: str = "pct") -> DataFrame:
    """Adds ``100 * measure / sum(measure)``.

    The total is a scalar subquery, partially summed where the rows are; an
    un-partitioned window would first gather every row in one task.
    """
    total = df.agg(F.sum(measure).cast("double").alias("_total")).scalar()
    return df.withColumn(name, F.try_divide(F.col(measure).cast("double") * 100.0, total))
