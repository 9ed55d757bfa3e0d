"""Near-duplicates by SimHash: linked are fingerprints of 64 bits that differ in at most three.

Fingerprints meet at anchors.  The 64 bits hold two blocks of 31; three differing bits leave one block with at most one
of them.  The anchors of a block are the words of the Hamming code of length 31, which covers the block with radius 1:
every fingerprint has one home anchor within distance 1, and is copied to every anchor within radius plus
threshold, 1 + 1 = 2, which is its home and at most 15 others.  Two fingerprints whose blocks differ in at most one bit then
meet where one is at home, and are compared there on all 64 bits.  The code is perfect, so no anchor is drawn by
chance and no link is lost.

Equal fingerprints are one node before anything is compared, so a group of exact copies of any size is one row.
Comparing is a join on the anchor whose condition holds the bit distance: pairs beyond it never leave the join, and
adaptive execution splits anchors that many fingerprints share.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import body, components, table, text_hash
from strataflow.session import settle

SEED, SHINGLE, DISTANCE = 42, 3, 3
BLOCKS, LENGTH = (0, 32), 31  # first bit of each block; its bits
STEP = 1 << 15  # shingles hashed at a time, which bounds memory for texts of any length


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the text's word shingles, A-Z lower-cased; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    total = len(words) - shingle + 1
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, total, STEP):
        part = words[at:at + STEP + shingle - 1]
        hashes = [xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(*[part[k:] for k in range(shingle)])]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, row, fp) of every row, ``row`` a hash of the text; null texts count as empty, fingerprint 0."""
    @F.pandas_udf("long")
    def marked(bodies: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in bodies], dtype=np.uint64).view(np.int64))

    value = F.col(text)
    return docs.select(F.col(key).cast("long").alias("doc_id"), text_hash(value).alias("row"), marked(body(value)).alias("fp"))


def _block(fp: Column, first: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << LENGTH) - 1)) if first else fp.bitwiseAND(F.lit((1 << LENGTH) - 1))


def _syndrome(block: Column) -> Column:
    """0 for a code word, else the number, from 1, of the one bit to flip."""
    out = F.lit(0).cast("long")
    for parity in range(5):
        mask = sum(1 << (place - 1) for place in range(1, LENGTH + 1) if place >> parity & 1)
        odd = F.bit_count(block.bitwiseAND(F.lit(mask))).bitwiseAND(F.lit(1)).cast("long")
        out = out.bitwiseOR(odd * (1 << parity))
    return out


def _flips(syndrome: int, radius: int) -> list[int]:
    """Bit masks that lead from a word with this syndrome to every code word within ``radius`` (1 or 2)."""
    if syndrome == 0:
        return [0]
    near = [1 << (syndrome - 1)]
    pairs = [(1 << (a - 1)) | (1 << ((a ^ syndrome) - 1)) for a in range(1, LENGTH + 1) if a < a ^ syndrome]
    return near if radius == 1 else near + pairs


def links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(u, v), u < v: distinct fingerprints that differ in at most ``distance`` bits, 3 at most."""
    if not 0 <= distance <= 3:
        raise ValueError("two blocks with radius 1 serve distances up to 3")

    def at_anchors(name: str, radius: int) -> DataFrame:
        table_of = F.array(*[F.array(*[F.lit(m).cast("long") for m in _flips(s, radius)]) for s in range(LENGTH + 1)])
        parts = F.array(*[F.struct(F.lit(n).alias("n"), _block(F.col("fp"), first).alias("block")) for n, first in enumerate(BLOCKS)])
        cut = nodes.select(F.col("fp").alias(name), F.explode(parts).alias("part")).select(name, "part.n", "part.block")
        flips = F.get(table_of, _syndrome(F.col("block")).cast("int"))
        return cut.select(name, "n", "block", F.explode(flips).alias("flip")).select(
            name, (F.col("n").cast("long") * (1 << LENGTH)).bitwiseOR(F.col("block").bitwiseXOR(F.col("flip"))).alias("anchor"))

    home, copies = at_anchors("u", 1), at_anchors("v", 2)
    near = (F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance)
    # Spark sizes a side by the fingerprints alone, not by the sixteen or thirty-two anchors of each, so it is told not to broadcast one.
    return home.hint("merge").join(copies, (home.anchor == copies.anchor) & near).select("u", "v").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, row, fp, component_id, chosen) of every row.

    component_id is the smallest doc_id reachable over links; rows of equal fingerprints are linked, empty texts among
    each other too.  Rows without a doc_id take part; a component of such rows alone has a null component_id.  ``chosen`` marks
    the row that stands for its component: smallest doc_id, null last, then smallest ``row``; rows equal to it in both are
    marked too.  An empty table gives an empty result.
    """
    marks = settle(fingerprints(docs, key, text, shingle), "simhash")
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id"), F.col("row"))
    nodes = settle(marks.groupBy("fp").agg(F.min(place).alias("least")), "simhash-nodes")
    roots = components(links(nodes, distance), "simhash-links")
    joined = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = joined.groupBy("root").agg(F.min("least").alias("first"))
    named = joined.join(least, "root").select("fp", "first")
    chosen = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row") == F.col("first.row"))
    # Every document's mark: copies compress so well that the file of very many passes for a small table.
    return marks.hint("merge").join(named, "fp").select("doc_id", "row", "fp", F.col("first.doc_id").alias("component_id"), chosen.alias("chosen"))


def without_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each component, with the columns of ``docs``."""
    def named(doc_id: Column, row: Column) -> list[Column]:
        return [F.coalesce(doc_id.cast("long").cast("string"), F.lit("null")).alias("__id"), row.alias("__row")]

    found = near_duplicates(docs, key, text, **options).where("chosen").select(*named(F.col("doc_id"), F.col("row"))).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__all"), *named(F.col(key), text_hash(F.col(text))))
    # Rows that repeat id and text are one document; they lie together after the join.
    return rows.join(found, ["__id", "__row"]).dropDuplicates(["__id", "__row"]).select("__all.*")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
