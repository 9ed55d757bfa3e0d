"""Row generators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_series(bounds: DataFrame, start: Column | str, end: Column | str, name: str = "date_key") -> DataFrame:
    """Every day of the closed range held in each row of ``bounds`` (one row: one calendar)."""
    return bounds.select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias(name))


def replicate(df: DataFrame, copies: int, name: str = "copy_no") -> DataFrame:
    """Each row ``copies`` times, numbered from 1; a narrow row expansion, no join and no shuffle."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(1), F.lit(copies))))
