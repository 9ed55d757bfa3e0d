"""Sharding by weighted rendezvous hashing.

Every shard draws a number for a record key; the record goes to the shard with the best draw.  With weights the draw
is ``-ln(u) / weight`` and the smallest wins, so a shard holds records in proportion to its weight.  A draw depends on
the key and the shard alone: a new shard can only win records for itself, and a lost shard's records are the only ones
that move.  DataFrame functions only; no shuffle but the numbering of slots, which never gathers a shard in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import partitions, prefix_ranks, table, unsigned_crc32

DIGITS = 13  # hex digits of a draw: 52 bits, exact in a double


def draw(key: Column, shard: int) -> Column:
    """A number in (0, 1), fixed by the key and the shard."""
    digest = F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f"/{shard}")).cast("binary")), 1, DIGITS)
    return (F.conv(digest, 16, 10).cast("double") + 0.5) / float(16 ** DIGITS)


def rendezvous(key: Column, weights: Mapping[int, float] | Sequence[float]) -> Column:
    """The shard of a key.  Ties go to the smaller shard number; a null key counts as the empty key."""
    shards = dict(weights) if isinstance(weights, Mapping) else dict(enumerate(weights))
    if not shards or any(not w > 0 for w in shards.values()):
        raise ValueError("every shard needs a weight above zero")
    costs = [F.struct((-F.log(draw(key, s)) / F.lit(float(w))).alias("cost"), F.lit(s).alias("shard"))
             for s, w in sorted(shards.items())]
    return (F.array_min(F.array(*costs)) if len(costs) > 1 else costs[0]).getField("shard")


def shard(docs: DataFrame, weights: Mapping[int, float] | Sequence[float], key: str = "doc_id", text: str = "text",
          grown: Mapping[int, float] | Sequence[float] | None = None) -> DataFrame:
    """Key, size, checksum, shard, slot and, with ``grown``, the shard among those weights.

    Rows that repeat a key share its shard and get slots of their own.  Null texts have size 8 and the checksum of the
    empty text.  Columns beside key and text are ignored; an empty table gives an empty result.
    """
    at = F.col(key)
    sized = docs.select(
        at.alias("key"), (F.octet_length(F.coalesce(F.col(text).cast("string"), F.lit(""))) + 8).cast("long").alias("size"),
        unsigned_crc32(F.col(text)).alias("text_crc32"), rendezvous(at, weights).cast("int").alias("shard"),
        (rendezvous(at, grown).cast("int") if grown is not None else F.lit(None).cast("int")).alias("grown_shard"),
    )
    placed = prefix_ranks(sized, ["shard"], ["key", "size", "text_crc32"], partitions(docs.sparkSession), "slot")
    return placed.withColumn("slot", F.col("slot").cast("long"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 of equal weight; the law is ``key``."""
    placed = shard(table(spark, sf_dir, "documents"), [1.0] * 24, grown=[1.0] * 25)
    return placed.select(F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
