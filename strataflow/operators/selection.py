"""Exact ranks, percentiles and tiles by distributed selection: no sort, no window, no row through one task.

The value at a rank is found by narrowing.  A pass cuts the range in which the value must lie into ``BINS`` stretches and counts the rows, or
their weight, in each; the stretch that holds the rank is the next range.  Counts of all wanted ranks come from the same pass, and at
most ranks x bins of them reach the driver, whatever the table's size.  Values are compared as whole numbers in their own order, so
after ``1 + bits / 10`` passes, at most eight for any type of 64 bits, a range is a single value: the exact one.

Tiles are then a comparison of each row with a few cut points.  Where a cut falls among equal values, the rows of that value are cut by the
tie-breaking column in the same way.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.functions import epoch_micros

BINS = 1024
_CODE = "decimal(38,0)"


def _code(value: str, kind: T.DataType) -> Column:
    """A whole number in the order of the values."""
    column = F.col(value)
    if isinstance(kind, T.DecimalType):
        return (column * F.lit(10 ** kind.scale).cast(_CODE)).cast(_CODE)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return column.cast(_CODE)
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast(_CODE)
    if isinstance(kind, T.TimestampNTZType):
        return epoch_micros(column).cast(_CODE)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast(_CODE)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # The bits of a float are in the order of its size; those of negative ones run the other way.  Zero has one code, and NaN is the greatest.
        plain = F.when(column == 0, F.lit(0.0)).otherwise(F.coalesce(column.cast("double"), F.lit(0.0)))
        bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), plain).cast("long")
        return F.when(bits >= 0, bits.cast(_CODE)).otherwise(F.lit(-(1 << 63)).cast(_CODE) - bits.cast(_CODE))
    raise TypeError(f"no order of whole numbers for {kind.simpleString()}")


def _whole(number: int) -> Column:
    """A literal of any size that 38 digits hold."""
    return F.lit(str(number)).cast(_CODE)


@dataclass(frozen=True)
class Selected:
    """A value, the weight of all smaller ones, and its own."""

    value: Any
    below: int | Decimal
    equal: int | Decimal


def select_ranks(df: DataFrame, value: str, ranks: Sequence[int | Decimal], weight: Column | None = None, bins: int = BINS) -> list[Selected | None]:
    """For each rank the smallest value whose rows, with all smaller ones, weigh at least so much; None beyond the whole weight.

    Ranks count from 1; without ``weight`` every row weighs one.  Rows with a null value, and rows whose weight is null or not above zero, take no part.
    """
    if bins < 2:
        raise ValueError("two bins at least")
    kind = df.schema[value].dataType
    share = F.lit(1).cast("long") if weight is None else weight
    rows = df.select(F.col(value).alias("v"), _code(value, kind).alias("c"), share.alias("w")).where("v IS NOT NULL AND w > 0")
    whole = rows.agg(F.min("c").alias("low"), F.max("c").alias("high"), F.sum("w").alias("w")).first()
    if whole.low is None:
        return [None] * len(ranks)
    out: list[Selected | None] = [None] * len(ranks)
    # Range -> (weight below it, the ranks that lie in it).
    open_ranges = {(int(whole.low), int(whole.high)): (0, [n for n, rank in enumerate(ranks) if rank <= whole.w])}
    while open_ranges := {span: held for span, held in open_ranges.items() if held[1]}:
        spans = sorted(open_ranges)
        place, bin_no = F.lit(None).cast("int"), F.lit(None).cast("long")
        for number, (low, high) in enumerate(spans):  # ranges never overlap
            inside = (F.col("c") >= _whole(low)) & (F.col("c") <= _whole(high))
            width = -(-(high - low + 1) // bins)
            offset = (F.col("c") - _whole(low)).cast(_CODE)
            place = F.when(inside, F.lit(number)).otherwise(place)
            bin_no = F.when(inside, F.call_function("div", offset, _whole(width)).cast("long")).otherwise(bin_no)
        counted = rows.select("v", "c", "w", place.alias("p"), bin_no.alias("b")).where("p IS NOT NULL").groupBy("p", "b").agg(
            F.sum("w").alias("w"), F.min("c").alias("low"), F.max("c").alias("high"), F.min("v").alias("v")).collect()
        found = sorted(counted, key=lambda r: (r.p, r.b))
        following: dict[tuple[int, int], tuple[Any, list[int]]] = {}
        for number, span in enumerate(spans):
            below, waiting = open_ranges[span]
            for row in (r for r in found if r.p == number):
                here = [n for n in waiting if below < ranks[n] <= below + row.w or (ranks[n] <= below and out[n] is None)]
                waiting = [n for n in waiting if n not in here]
                if row.low == row.high:
                    for n in here:
                        out[n] = Selected(row.v, below, row.w)
                elif here:
                    following[int(row.low), int(row.high)] = (below, here)
                below += row.w
        open_ranges = following
    return out


def percentiles(df: DataFrame, value: str, parts: Sequence[int], whole: int = 100, weight: Column | None = None) -> list[Any]:
    """The discrete percentiles ``parts`` of ``whole``: the smallest value that this share of the weight does not exceed; None without rows."""
    share = F.lit(1).cast("long") if weight is None else weight
    total = df.where(F.col(value).isNotNull()).agg(F.sum(F.when(share > 0, share))).first()[0]
    if total is None:
        return [None] * len(parts)
    # The least weight that reaches the share, in whole weight units or exact fractions of them.
    ranks = [max(Decimal(total) * part / whole, Decimal("1e-9")) if isinstance(total, Decimal) else max(-(-total * part // whole), 1) for part in parts]
    return [found and found.value for found in select_ranks(df, value, ranks, weight)]


@dataclass(frozen=True)
class Cut:
    """Rows after this place belong to the next tile: greater values, and of equal ones those with a greater tie."""

    value: Any
    tie: Any
    whole: bool  # whether all rows of the value stand before the cut


def tile_cuts(df: DataFrame, value: str, tie: str, tiles: int) -> list[Cut]:
    """The cuts between tiles by ``value`` and then ``tie``, nulls first; the first tiles hold one row more where the rows don't divide.

    ``tie`` must tell rows of one value apart, and be no null there.
    """
    n, known = df.agg(F.count(F.lit(1)), F.count(value)).first()
    missing, size, extra = n - known, n // tiles, n % tiles
    ends = [k * size + min(k, extra) for k in range(1, tiles)]
    inside = [end - missing for end in ends]
    found = select_ranks(df, value, [r for r in inside if r > 0])
    at = iter(found)
    picked = [None if r <= 0 else next(at) for r in inside]
    wanted: dict[Any, list[tuple[int, int]]] = {}
    cuts: list[Cut | None] = [None] * len(ends)
    for number, (end, rank, chosen) in enumerate(zip(ends, inside, picked)):
        held, here = (None, end) if rank <= 0 else (chosen.value, rank - chosen.below)
        amount = missing if rank <= 0 else chosen.equal
        if here == amount:
            cuts[number] = Cut(held, None, True)
        else:
            wanted.setdefault(held, []).append((number, here))
    for held, places in wanted.items():  # at most one search per cut
        same = df.where(F.col(value).isNull() if held is None else F.col(value) == F.lit(held).cast(df.schema[value].dataType))
        ties = select_ranks(same, tie, [max(here, 1) for _, here in places])
        for (number, here), chosen in zip(places, ties):
            cuts[number] = Cut(held, chosen.value if here and chosen else None, False)
    return cuts


def with_tile(df: DataFrame, value: str, tie: str, tiles: int, name: str = "tile") -> DataFrame:
    """Adds the tile from 1, as NTILE over ``value`` and ``tie`` would, nulls first."""
    kinds = df.schema[value].dataType, df.schema[tie].dataType
    number = F.lit(1)
    for cut in tile_cuts(df, value, tie, tiles):
        held = F.col(value)
        if cut.value is None:
            equal, greater = held.isNull(), held.isNotNull()
        else:
            literal = F.lit(cut.value).cast(kinds[0])
            equal, greater = F.coalesce(held == literal, F.lit(False)), F.coalesce(held > literal, F.lit(False))
        if not cut.whole:
            later = F.lit(True) if cut.tie is None else F.col(tie) > F.lit(cut.tie).cast(kinds[1])
            greater = greater | (equal & later)
        number = number + greater.cast("int")
    return df.withColumn(name, number)
