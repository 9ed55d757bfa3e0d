"""Best-fit packing planned on a histogram of lengths.

A plan needs to know how many pieces have each length, not which.  Pieces are cut and counted by Spark; best-fit decreasing
then runs over the counts, at most ``capacity`` numbers, and its output is a table of slots: pieces of length L with ranks
from ``first`` to ``last`` go into consecutive sequences at a given offset.  Pieces take their slots by a join on length and
rank.  Ranks within a length are numbered in buckets, so a length that a third of all pieces share is no task of its own.

The plan's size depends on the capacity alone, never on the number of documents, which is why it may be broadcast.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import partitions, prefix_ranks, table
from strataflow.session import settle

CAPACITY, END_ID = 1024, 2
TOKENIZER = "byte_bpe_50k"
PLAN = "length int, first long, last long, base long, per int, at int"


@cache
def encoder(name: str = TOKENIZER):
    """text -> ids, as ``tokenizers`` gives them from ``<name>.json``.

    The vocabulary's rank file gives the same ids several times faster; texts that hold a special token's string, and
    any that the fast path refuses, go through ``tokenizers`` itself.
    """
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    special = [t.content for t in exact.get_added_tokens_decoder().values()]
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if any(s in text for s in special):
            return exact.encode(text, add_special_tokens=False).ids
        try:
            return fast.encode_ordinary(text)
        except BaseException as refused:  # the fast path reports an overlong match by a panic, which is no Exception
            if isinstance(refused, (KeyboardInterrupt, SystemExit)):
                raise
            return exact.encode(text, add_special_tokens=False).ids

    return encode


def pieces(docs: DataFrame, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", name: str = TOKENIZER) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids with the end mark, cut only where it exceeds ``capacity``.

    The first piece of a cut document holds what is left over, the others are full.  Null texts hold the end mark alone.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(name)
        for rows in batches:
            out = []
            for doc, value in zip(rows["doc_id"], rows["text"]):
                ids = np.array([*encode(value), END_ID], dtype="<u4")
                stop = (len(ids) - 1) % capacity + 1
                start, piece = 0, 0
                while start < len(ids):
                    out.append((doc, piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes())))
                    start, stop, piece = stop, stop + capacity, piece + 1
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    # Ids travel as text: pandas would round large ones beside a null.
    whole = docs.select(F.col(key).cast("string").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    cut = whole.mapInPandas(run, "doc_id string, piece int, start long, length long, ids_crc32 long")
    return cut.withColumn("doc_id", F.col("doc_id").cast("long"))


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts; rows (length, first, last, base, per, at).

    Ranks first..last of that length: rank r lies in sequence ``base + (r - first) // per`` at offset
    ``at + (r - first) % per * length``.  Open sequences of equal room are kept as ranges of numbers; each length goes to
    the smallest room that holds it, filling a sequence as long as the length fits again, as best fit would.
    """
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> ranges (base, count)
    opened, out = 0, []
    for length in sorted((n for n in histogram if histogram[n] > 0), reverse=True):
        left, rank = histogram[length], 0

        def put(base: int, count: int, room: int) -> int:
            """Fill up to ``count`` sequences from ``base``; the number of pieces placed."""
            per = room // length
            full, over = divmod(min(left, count * per), per)
            at = capacity - room
            if full:
                out.append((length, rank, rank + full * per - 1, base, per, at))
                rooms[room - per * length].append((base, full))
            if over:
                out.append((length, rank + full * per, rank + full * per + over - 1, base + full, over, at))
                rooms[room - over * length].append((base + full, 1))
            used = full + bool(over)
            if used < count:
                rooms[room].append((base + used, count - used))
            return full * per + over

        for room in sorted(r for r in rooms if r >= length):
            for base, count in rooms.pop(room):
                placed = put(base, count, room) if left else rooms[room].append((base, count)) or 0
                left, rank = left - placed, rank + placed
            if not left:
                break
        if left:
            fresh = -(-left // (capacity // length))
            put(opened, fresh, capacity)
            opened += fresh
        rooms.pop(0, None)
    return out


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset.  ``cut`` needs doc_id, piece, start, length, ids_crc32 and is read more than once."""
    spark = cut.sparkSession
    # At most ``capacity`` rows reach the driver, whatever the input.
    counts = {int(r.length): int(r.n) for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.createDataFrame(plan(counts, capacity), PLAN).withColumnRenamed("length", "slot_length")
    ranked = prefix_ranks(cut, ["length"], ["doc_id", "piece", "ids_crc32"], partitions(spark), "rank")
    taken = ranked.join(F.broadcast(slots), (F.col("length") == F.col("slot_length")) & F.col("rank").between(F.col("first"), F.col("last")))
    nth = F.col("rank") - F.col("first")
    return taken.select(
        *cut.columns, (F.col("base") + F.floor(nth / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("at") + nth % F.col("per") * F.col("length")).cast("long").alias("offset"))


def packed(docs: DataFrame, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", name: str = TOKENIZER) -> DataFrame:
    """All documents packed; an empty table gives no sequences.  Rows that repeat a key are packed each."""
    return pack(settle(pieces(docs, capacity, key, text, name), "pieces"), capacity)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place."""
    return packed(table(spark, sf_dir, "documents").select("doc_id", "text"))
