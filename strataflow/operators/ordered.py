"""Exact order-dependent operators that never put a whole key, or the whole table, in one task.

A window needs all rows of its partition together.  With no partition key, or
with a key that holds a large share of the table, that is one task.  Here the
rows are cut into *chunks*, contiguous ranges of (keys, order).  Windows run
inside (key, chunk); what must cross a chunk border - a running sum, a row
count, the last few rows - is carried by a summary.

Chunks come from Spark's range partitioning over the keys and the complete
order, so a hot key, and even many rows of one time, spread over several chunks.
The partition numbers are stored with the rows: whatever is recomputed later
sees the same chunks.  Only keys that lie across a border need the summary, and
every border cuts at most one key, so the summary holds at most two rows per
chunk: a proven size, and therefore broadcast.

Where few rows per calendar unit are known beforehand (minutes of a day, days of
a year), the caller passes that unit as the chunk and the plan stays lazy.  Spark then
chooses how to join the summary, which has one row per unit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.session import settle

_CHUNK = "_chunk"


def _chunked(
    df: DataFrame, order: Sequence[str], keys: Sequence[str], pieces: int | None, chunk: Column | None
) -> DataFrame:
    if chunk is not None:
        if keys:
            raise ValueError("a chunk column is for series without keys")
        return df.withColumn(_CHUNK, chunk)
    by = [*keys, *order]
    ranged = df.repartitionByRange(pieces, *by) if pieces else df.repartitionByRange(*by)
    return settle(ranged.withColumn(_CHUNK, F.spark_partition_id()), "ordered")


def _across_borders(summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Summary rows of keys that have more than one chunk."""
    if not keys:
        return summary
    chunks = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return summary.withColumn("_chunks", chunks).where(F.col("_chunks") > 1).drop("_chunks")


def _carry(df: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left", bounded: bool = True) -> DataFrame:
    """Join a summary to the rows, NULL keys included; broadcast only if its size is proven."""
    right = small.select(*[F.col(c).alias(f"_s_{c}") if c in on else F.col(c) for c in small.columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in on])
    return df.join(F.broadcast(right) if bounded else right, same, how).drop(*[f"_s_{c}" for c in on])


def running_total(
    df: DataFrame,
    order: Sequence[str],
    measures: Mapping[str, str],
    keys: Sequence[str] = (),
    pieces: int | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Running sums in the order of ``order`` (a total order), per ``keys``: measure -> output column."""
    rows = _chunked(df, order, keys, pieces, chunk)
    totals = rows.groupBy(*keys, _CHUNK).agg(*[F.sum(m).alias(f"_t_{out}") for m, out in measures.items()])
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = _across_borders(totals, keys).select(
        *keys, _CHUNK, *[F.sum(f"_t_{out}").over(before).alias(f"_o_{out}") for out in measures.values()]
    )
    inside = Window.partitionBy(*keys, _CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)

    def total(measure: str, out: str) -> Column:
        """NULL as long as neither side has seen a value."""
        before_chunk, so_far = F.col(f"_o_{out}"), F.sum(measure).over(inside)
        return F.coalesce(before_chunk + so_far, before_chunk, so_far).alias(out)

    carried = _carry(rows, offsets, [*keys, _CHUNK], bounded=chunk is None)
    return carried.select(*df.columns, *[total(m, out) for m, out in measures.items()])


def preceding_max(
    df: DataFrame,
    order: Sequence[str],
    measure: str,
    keys: Sequence[str] = (),
    name: str = "reached",
    pieces: int | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Adds the greatest measure of all earlier rows, per ``keys``; NULL for the first row."""
    rows = _chunked(df, order, keys, pieces, chunk)
    tops = rows.groupBy(*keys, _CHUNK).agg(F.max(measure).alias("_top"))
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = _across_borders(tops, keys).select(*keys, _CHUNK, F.max("_top").over(before).alias("_earlier"))
    inside = Window.partitionBy(*keys, _CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    carried = _carry(rows, offsets, [*keys, _CHUNK], bounded=chunk is None)
    return carried.select(*df.columns, F.greatest("_earlier", F.max(measure).over(inside)).alias(name))


def ordinals(
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = (),
    rank: bool = False,
    ntiles: int | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Adds ``row_no`` and, where asked for, ``rank_no`` (ties on the first order column) and ``tile``.

    Equal to ROW_NUMBER, RANK and NTILE over the same keys, ascending; pass a
    negated column for descending order.
    """
    if not keys and not rank and ntiles is None:
        return _numbered(df, order, pieces)
    rows = _chunked(df, order, keys, pieces, None)
    value = F.col(order[0])
    inside = Window.partitionBy(*keys, _CHUNK)
    ranked = rows.withColumn("_rank", F.rank().over(inside.orderBy(order[0]))) if rank else rows.withColumn("_rank", F.lit(0))
    ends = ranked.groupBy(*keys, _CHUNK).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(F.struct(value.alias("v"))).alias("_first"),
        F.max(F.struct(value.alias("v"), F.col("_rank").alias("r"))).alias("_last"))
    per_key = Window.partitionBy(*keys)
    before = per_key.orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = _across_borders(ends, keys).select(
        *keys, _CHUNK, F.sum("_rows").over(before).alias("_before"), F.sum("_rows").over(per_key).alias("_all"),
        F.col("_first.v").alias("_first"), F.col("_last.v").alias("_last"), F.col("_last.r").alias("_last_rank"))
    if rank:
        # A value that runs on from earlier chunks has the rank it got in the first of them.
        starts = offsets.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_last").alias("_v"),
                                (F.coalesce("_before", F.lit(0)) + F.col("_last_rank")).alias("_r"))
        starts = starts.groupBy(*[f"_k_{k}" for k in keys], "_v").agg(F.min("_r").alias("_border_rank"))
        same = reduce(lambda a, b: a & b, [*[F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], F.col("_first").eqNullSafe(F.col("_v"))])
        offsets = offsets.join(starts, same, "left").drop("_v", *[f"_k_{k}" for k in keys])
    numbered = _carry(ranked, offsets, [*keys, _CHUNK])
    earlier = F.coalesce("_before", F.lit(0))
    columns = [F.col(c) for c in df.columns] + [
        F.coalesce("_all", F.count(F.lit(1)).over(inside)).alias("_all"), (earlier + F.row_number().over(inside.orderBy(*order))).alias("row_no")]
    if rank:
        carried = F.col("_border_rank").isNotNull() & value.eqNullSafe(F.col("_first"))
        columns.append(F.when(carried, F.col("_border_rank")).otherwise(earlier + F.col("_rank")).alias("rank_no"))
    numbered = numbered.select(*columns)
    if ntiles is not None:
        numbered = numbered.withColumn("tile", _tile(F.col("row_no"), F.col("_all"), ntiles))
    return numbered.drop("_all")


def _numbered(df: DataFrame, order: Sequence[str], pieces: int | None) -> DataFrame:
    """``row_no`` alone: a chunk is sorted and numbered where it is written, so its rows are shuffled once."""
    ranged = (df.repartitionByRange(pieces, *order) if pieces else df.repartitionByRange(*order)).sortWithinPartitions(*order)
    # The number of the chunk in the upper bits, the place in it in the lower 33.
    rows = settle(ranged.withColumn("_place", F.monotonically_increasing_id()), "ordered").withColumn(_CHUNK, F.shiftright("_place", 33))
    before = Window.orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(_CHUNK).agg(F.count(F.lit(1)).alias("_rows")).select(_CHUNK, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    place = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return _carry(rows, offsets, [_CHUNK]).select(*df.columns, (F.col("_before") + place + 1).alias("row_no"))


def _tile(row_no: Column, rows: Column, tiles: int) -> Column:
    """The first ``rows % tiles`` tiles hold one row more than the others."""
    extra = F.pmod(rows, F.lit(tiles))
    small = (rows - extra) / tiles
    index, in_large = row_no - 1, extra * (small + 1)
    of_large = F.floor(index / (small + 1))
    of_small = extra + F.floor(F.try_divide(index - in_large, small))
    return (F.when(index < in_large, of_large).otherwise(of_small) + 1).cast("int")


def _with_halo(
    df: DataFrame, order: Sequence[str], measure: str, keys: Sequence[str], reach: int,
    pieces: int | None, chunk: Column | None,
) -> DataFrame:
    """The rows of each (key, chunk) plus copies of the ``reach`` rows that precede them, flagged ``_halo``."""
    rows = _chunked(df, order, keys, pieces, chunk).withColumn("_halo", F.lit(False))
    bounded, width = chunk is None, max(reach, 1)
    lent = [c for c in dict.fromkeys([*order, measure]) if c not in keys]
    # Only keys cut by a border lend rows to their next chunks: at most one per border.
    sizes = _across_borders(rows.groupBy(*keys, _CHUNK).agg(F.count(F.lit(1)).alias("_n")), keys)
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # The last rows of every chunk, numbered through the whole key from 0.
    latest = Window.partitionBy(*keys, _CHUNK).orderBy(*[F.col(c).desc() for c in order])
    crossing = _carry(rows.select(*keys, _CHUNK, *lent), starts, [*keys, _CHUNK], "inner", bounded)
    tails = crossing.withColumn("_rn", F.row_number().over(latest)).where(F.col("_rn") <= reach).select(
        *keys, *lent, (F.col("_start") + F.col("_n") - F.col("_rn")).alias("_at"))
    # A chunk wants the numbers just below its first.  They lie in one or two spans of ``reach`` numbers, so the join is on equality.
    spans = F.array_distinct(F.array(*[F.floor((F.col("_start") - back) / width) for back in (width, 1)]))
    wanted = starts.where("_start > 0").select(*keys, _CHUNK, "_start", F.explode(spans).alias("_span"))
    found = _carry(tails.withColumn("_span", F.floor(F.col("_at") / width)), wanted, [*keys, "_span"], "inner", bounded)
    halo = found.where((F.col("_at") < F.col("_start")) & (F.col("_at") >= F.col("_start") - reach))
    return rows.unionByName(halo.select(*keys, _CHUNK, *lent, F.lit(True).alias("_halo")), allowMissingColumns=True)


def moving_average(
    df: DataFrame,
    order: Sequence[str],
    measure: str,
    rows: int,
    keys: Sequence[str] = (),
    name: str = "moving_avg",
    pieces: int | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Mean of the current and the ``rows - 1`` preceding rows, per key."""
    spread = _with_halo(df, order, measure, keys, rows - 1, pieces, chunk)
    frame = Window.partitionBy(*keys, _CHUNK).orderBy(*order).rowsBetween(-(rows - 1), 0)
    mean = F.try_divide(F.sum(measure).over(frame).cast("double"), F.count(measure).over(frame).cast("double"))
    return spread.withColumn(name, mean).where(~F.col("_halo")).select(*df.columns, name)


def lagged(
    df: DataFrame,
    order: Sequence[str],
    measure: str,
    keys: Sequence[str] = (),
    offset: int = 1,
    name: str = "previous",
    pieces: int | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """The measure ``offset`` rows earlier, per key; NULL at the start."""
    spread = _with_halo(df, order, measure, keys, offset, pieces, chunk)
    inside = Window.partitionBy(*keys, _CHUNK).orderBy(*order)
    return spread.withColumn(name, F.lag(measure, offset).over(inside)).where(~F.col("_halo")).select(*df.columns, name)
