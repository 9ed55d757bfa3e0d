"""Join of points in time with the intervals that hold them, by bins whose width follows the intervals' lengths.

A range condition alone compares every point with every interval.  Here an interval goes to the level whose bins are as wide as it is long, or up to
four times wider, so it lies in at most two bins; a point goes to one bin of every level that has intervals.  Both meet on level and bin,
by equality, and the range condition is checked on what has met.  Short intervals are told apart by narrow bins however long others are, and a
very long one costs two rows.  The levels are powers of four of a second, 20 of them for any span of years.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions import epoch_micros
from strataflow.operators.ordered import running_total
from strataflow.session import settle

SECOND, STEP, LEVELS = 1_000_000, 4, 20
WIDTHS = [SECOND * STEP ** level for level in range(LEVELS)]


def _bin(at: Column, width: Column) -> Column:
    """The number of the bin that holds a place; whole-number arithmetic, also before 1970."""
    return F.call_function("div", at - F.pmod(at, width), width)


def _clipped(intervals: DataFrame, start: str, end: str, low: Column, high: Column) -> DataFrame:
    first = F.greatest(F.coalesce(epoch_micros(start), low), low)
    last = F.least(F.coalesce(epoch_micros(end), high + 1), high + 1)
    real = F.col(start).isNull() | F.col(end).isNull() | (epoch_micros(start) < epoch_micros(end))
    return intervals.where(real).withColumns({"_from": first, "_to": last}).where("_from < _to")


def interval_bins(intervals: DataFrame, start: str, end: str, low: Column, high: Column) -> DataFrame:
    """The intervals with their place, ``_from`` and ``_to`` in microseconds, once per level and bin: at most two rows each.

    Bounds that are null are open and clipped to [low, high], as are those beyond it; intervals that hold no instant of it vanish.
    """
    held = _clipped(intervals, start, end, low, high)
    length = F.col("_to") - F.col("_from")
    level = sum(((length > width).cast("int") for width in WIDTHS[:-1]), F.lit(0))
    leveled = held.withColumn("_level", level)
    width = F.get(F.array(*[F.lit(w).cast("long") for w in WIDTHS]), F.col("_level"))
    bins = F.sequence(_bin(F.col("_from"), width), _bin(F.col("_to") - 1, width))
    return leveled.withColumn("_bin", F.explode(bins))


def interval_join(
    points: DataFrame, ts: str, intervals: DataFrame, start: str, end: str, how: str = "inner", totals: Mapping[str, str | None] | None = None,
) -> DataFrame:
    """Every point with every interval where ``start <= ts < end``; a null bound is open, an interval that ends where or before it starts is empty.

    With ``how="left"`` points in no interval, and points without a time, are kept with nulls.  Column names of the two sides must differ.

    ``totals``, output column -> measure of the points or None for their number, asks for one row per interval that holds points, with the exact sums over
    them, in place of the pairs, whose number grows with the points times the intervals.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown join {how!r}")
    if totals is not None:
        if how != "inner":
            raise ValueError("totals are for the inner join")
        return _interval_totals(points, ts, intervals, start, end, totals)
    clash = set(points.columns) & set(intervals.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    rows = points
    if how == "left":
        # Numbers that a task run again would deal differently are fixed by writing them.
        rows = settle(points.withColumn("_point", F.monotonically_increasing_id()), "points")
    bounds = points.agg(F.min(epoch_micros(ts)).alias("low"), F.max(epoch_micros(ts)).alias("high"))
    low, high = bounds.select("low").scalar(), bounds.select("high").scalar()
    placed = settle(interval_bins(intervals, start, end, low, high), "interval-bins")
    present: Sequence[int] = sorted(r[0] for r in placed.select("_level").distinct().collect())  # twenty at most
    at = epoch_micros(ts)
    levels = F.array(*[F.struct(F.lit(n).alias("_level"), _bin(at, F.lit(WIDTHS[n]).cast("long")).alias("_bin")) for n in present])
    if present:
        spread = rows.where(F.col(ts).isNotNull()).withColumns({"_at": at, "_place": F.explode(levels)}).select(
            *rows.columns, "_at", "_place._level", "_place._bin")
    else:
        spread = rows.limit(0).withColumns({"_at": at, "_level": F.lit(0), "_bin": F.lit(0).cast("long")})
    inside = (F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_to"))
    joined = spread.alias("p").join(placed.alias("i"), (F.col("p._level") == F.col("i._level")) & (F.col("p._bin") == F.col("i._bin")) & inside)
    met = joined.select(*[F.col(f"p.{c}") for c in rows.columns], *[F.col(f"i.{c}") for c in intervals.columns])
    if how == "inner":
        return met
    met = settle(met, "interval-join")
    alone = rows.join(met.select("_point").distinct(), "_point", "left_anti")
    return met.unionByName(alone, allowMissingColumns=True).drop("_point")


def _interval_totals(points: DataFrame, ts: str, intervals: DataFrame, start: str, end: str, totals: Mapping[str, str | None]) -> DataFrame:
    """Sums per interval as the difference of two running totals: what came before its end less what came before its start.

    Points become one row per instant, the bounds are instants too, so the running total has a row for each and a bound finds it by equality.  Work grows
    with the points plus the intervals.
    """
    clash = set(totals) & set(intervals.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    at = epoch_micros(ts)
    bounds = points.agg(F.min(at).alias("low"), F.max(at).alias("high"))
    low, high = bounds.select("low").scalar(), bounds.select("high").scalar()
    held = settle(_clipped(intervals, start, end, low, high), "interval-bounds")
    measures = list(dict.fromkeys(m for m in totals.values() if m is not None))
    sums, known = {m: f"_s{i}" for i, m in enumerate(measures)}, {m: f"_k{i}" for i, m in enumerate(measures)}
    # How many values were known tells a sum over none, which is null, from one that is zero.
    per_instant = points.where(F.col(ts).isNotNull()).groupBy(at.alias("_at")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.coalesce(F.sum(m), F.lit(0)).alias(sums[m]) for m in measures], *[F.count(m).alias(known[m]) for m in measures])
    marks = held.select(F.explode(F.array("_from", "_to")).alias("_at")).distinct()
    both = per_instant.unionByName(marks, allowMissingColumns=True)
    columns = ["_n", *sums.values(), *known.values()]
    instants = both.groupBy("_at").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])
    running = running_total(instants, ["_at"], {c: f"_t{c}" for c in columns})
    before = settle(running.select("_at", *[(F.col(f"_t{c}") - F.col(c)).alias(c) for c in columns]), "before-instants")
    opened = before.select(F.col("_at").alias("_o_at"), *[F.col(c).alias(f"_o{c}") for c in columns])
    closed = before.select(F.col("_at").alias("_c_at"), *[F.col(c).alias(f"_c{c}") for c in columns])
    joined = held.join(opened, F.col("_from") == F.col("_o_at")).join(closed, F.col("_to") == F.col("_c_at"))
    inside = {c: F.col(f"_c{c}") - F.col(f"_o{c}") for c in columns}
    out = [(inside["_n"] if m is None else F.when(inside[known[m]] > 0, inside[sums[m]])).alias(name) for name, m in totals.items()]
    return joined.where(inside["_n"] > 0).select(*intervals.columns, *out)
