"""Key-based merge of a base table with changed rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.session import settle
from strataflow.sinks.folders import _remove


def _latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, then by the remaining columns.

    ``max`` over a struct is combined before the shuffle, so a key with a huge
    number of versions costs its task one row per input split; a row_number
    window would sort all of them in one place.
    """
    rest = [name for name in columns if name not in keys and name not in order]
    if not rest and not order:
        return df.select(*columns).distinct()
    picked = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in columns])


def dedupe_latest(df: DataFrame, keys: Sequence[str], version: str | None = None) -> DataFrame:
    """One row per business key, the newest by ``version`` where given; deterministic either way."""
    return _latest_per_key(df, keys, [version] if version else [], df.columns)


def dedupe_stored(df: DataFrame, keys: Sequence[str], version: str | None = None, counted: DataFrame | None = None) -> DataFrame:
    """``dedupe_latest`` of a frame that is cheap to read twice: keys alone are shuffled to find those that come more than once, and only
    rows of these are sorted and merged.  A frame whose keys are unique goes through as it is.

    ``counted`` is the same frame with an observation, which the search for repeated keys runs once.
    """
    twice = settle((df if counted is None else counted).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(*keys), "repeated-keys")
    if twice.isEmpty():
        return df
    return _matching(df, twice, keys, "left_anti").unionByName(dedupe_latest(_matching(df, twice, keys), keys, version))


def has_duplicates(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether any key occurs twice; shuffles key values only."""
    return bool(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).limit(1).count())


def upsert_latest(base: DataFrame, delta: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Base rows overlaid by delta rows of the same key; on equal versions the delta wins."""
    both = base.withColumn("_delta", F.lit(0)).unionByName(delta.withColumn("_delta", F.lit(1)))
    return _latest_per_key(both, keys, [version, "_delta"], both.columns).drop("_delta")


def upsert_partitions(
    spark: SparkSession, path: str, delta: DataFrame, keys: Sequence[str], version: str, part: str, sort: Sequence[str] = ()
) -> None:
    """Merge changed rows into a stored table, rewriting only the partitions they fall into.

    Touched are the partitions of the changed rows and those where their keys are stored already, so a key that
    moves leaves its old partition; NULL is a partition like any other.  The merged partitions are settled before the
    old ones are replaced, so a failure never loses base rows.  Partitions that lose all their rows are removed last.
    """
    base = spark.read.parquet(path)
    delta = settle(delta.select(*base.columns), "upsert-delta")
    changed = delta.select(*keys).distinct()
    homes = _matching(base, changed, keys).select(part)
    touched = settle(homes.union(delta.select(part)).distinct(), "upsert-touched")
    merged = settle(upsert_latest(_matching(base, touched, [part]), delta, keys, version), "upsert")
    left = merged.select(part).distinct()
    emptied = settle(_matching(touched, left, [part], "left_anti"), "upsert-emptied")
    # One folder per emptied partition, at most as many as the table has partitions.
    folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]+$", 1).alias("folder")
    stale = [row.folder for row in _matching(base.select("*", "_metadata"), emptied, [part]).select(folder).distinct().collect()]
    writer = merged.hint("rebalance", part).sortWithinPartitions(part, *sort).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
    for name in stale:
        _remove(spark, name)


def _matching(rows: DataFrame, wanted: DataFrame, on: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows whose values are among ``wanted``, NULL equal to NULL."""
    right = wanted.select(*[F.col(c).alias(f"_w_{c}") for c in on])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in on])
    return rows.join(right, same, how)
