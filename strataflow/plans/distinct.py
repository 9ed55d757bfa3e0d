"""Distinct counts as stored state: exact ones by bitmaps, close ones by sketches.

A count of distinct keys cannot be added up over days, but the set of a day can be stored and united.  A bitmap holds 32,768 neighbouring key
numbers in 4 KB, so a day has one per stretch of numbers that occurs in it.  Uniting is a bitwise or: it may be done in any order and
any number of times, so batches, late rows and replays merge, and any range of days is counted from the days' bitmaps without the facts.

Numbers far apart would give nearly empty bitmaps; ``dense_numbers`` gives keys of any kind numbers without gaps, old ones kept.  Where a count may be off by a
stated share, a HyperLogLog sketch of a few KB per group does the same at any number of keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.operators.ordered import ordinals
from strataflow.session import settle
from strataflow.streaming.continuous import Continuous

BUCKET, BITS = "_bucket", "_bits"
# 2 ** 14 registers: a relative standard error of 0.8 %.  Three of them are the bound that is promised.
LOG_REGISTERS, ERROR_BOUND = 14, 0.025


def dense_numbers(keys: DataFrame, key: str, known: DataFrame | None = None, number: str = "key_no") -> DataFrame:
    """(key, number): every key's number, from 1 without gaps; keys in ``known`` keep theirs and new ones follow.  Null is no key.

    Numbers are dealt by range, so no task holds all keys.
    """
    wanted = keys.where(F.col(key).isNotNull()).select(key).distinct()
    if known is None:
        return ordinals(wanted, [key]).select(key, F.col("row_no").alias(number))
    fresh = ordinals(wanted.join(known.select(key), key, "left_anti"), [key])
    taken = F.coalesce(known.agg(F.max(number)).scalar(), F.lit(0))
    return known.select(key, number).unionByName(fresh.select(key, (F.col("row_no") + taken).alias(number)))


def bitmaps(rows: DataFrame, by: Sequence[str | Column], number: str) -> DataFrame:
    """(by, bucket, bits): the numbers of each group, any long; rows without one count nowhere.  Combined before the shuffle."""
    present = rows.where(F.col(number).isNotNull())
    return present.groupBy(*by, F.bitmap_bucket_number(number).alias(BUCKET)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITS))


def united(stored: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """Bitmaps of coarser groups, or of several batches."""
    return stored.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(stored: DataFrame, by: Sequence[str | Column], name: str = "distinct_count") -> DataFrame:
    """The number of different keys per group, exact."""
    named = [F.col(c) if isinstance(c, str) else c for c in by]
    whole = united(stored, named)
    groups = [c for c in whole.columns if c not in (BUCKET, BITS)]
    return whole.groupBy(*groups).agg(F.sum(F.bitmap_count(BITS)).alias(name))


def distinct_in_ranges(stored: DataFrame, day: str, ranges: DataFrame, name: str = "distinct_count") -> DataFrame:
    """(range columns, name): different keys over each range (first_day, last_day, ...), both included; 0 where no day of it has any.

    Ranges are written out as days, clipped to those that are stored, and meet the bitmaps on equality: the work grows with the days of the
    ranges and the bitmaps of a day, not with rows.
    """
    held = stored.agg(F.min(day).alias("low"), F.max(day).alias("high"))
    first = F.greatest(F.col("first_day"), held.select("low").scalar())
    last = F.least(F.col("last_day"), held.select("high").scalar())
    spans = ranges.withColumns({"_first": first, "_last": last}).where("_first <= _last")
    days = spans.select(*ranges.columns, F.explode(F.sequence("_first", "_last", F.expr("INTERVAL 1 DAY"))).alias("_day"))
    met = days.join(stored.select(F.col(day).alias("_day"), BUCKET, BITS), "_day").drop("_day")
    counted = distinct_counts(met, ranges.columns, "_count").withColumnsRenamed({c: f"_r_{c}" for c in ranges.columns})
    same = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in ranges.columns]
    return ranges.join(counted, same, "left").select(*ranges.columns, F.coalesce("_count", F.lit(0)).alias(name))


def distinct_stream(events: DataFrame, by: Sequence[Column], number: str, name: str = "distinct_count") -> Continuous:
    """A continuous exact count: batches are stored as bitmaps, which merge in any order; a replayed batch changes nothing."""
    def merge(partials: DataFrame) -> DataFrame:
        return united(partials, [c for c in partials.columns if c not in (BUCKET, BITS)])

    def finish(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*[c for c in rows.columns if c not in (BUCKET, BITS)]).agg(F.sum(F.bitmap_count(BITS)).alias(name))

    return Continuous(events, lambda rows: bitmaps(rows, by, number), merge, finish)


# Sketches

def sketches(rows: DataFrame, by: Sequence[str | Column], key: str, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """(by, sketch) of the keys of each group; keys are long, string or binary."""
    return rows.groupBy(*by).agg(F.hll_sketch_agg(key, log_registers).alias("sketch"))


def merged_sketches(stored: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    return stored.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimates(stored: DataFrame, name: str = "distinct_estimate") -> DataFrame:
    """The estimate of each sketch; within ``ERROR_BOUND`` of the exact count, three standard errors."""
    return stored.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")


def sketch_stream(events: DataFrame, by: Sequence[Column], key: str, name: str = "distinct_estimate") -> Continuous:
    """A continuous estimate: batches are stored as sketches, which merge in any order."""
    def merge(partials: DataFrame) -> DataFrame:
        return merged_sketches(partials, [c for c in partials.columns if c != "sketch"])

    return Continuous(events, lambda rows: sketches(rows, by, key), merge, lambda rows: estimates(rows, name))


def stored_bitmaps(rows: DataFrame, by: Sequence[str | Column], number: str, label: str) -> DataFrame:
    """The bitmaps as a written table."""
    return settle(bitmaps(rows, by, number), label)
