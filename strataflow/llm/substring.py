"""Substring dedup: words covered by a run of 50 words that also stands in an earlier document are removed.

Corpus text is read as a De Bruijn graph whose nodes are sampled 10-word k-mers.  In every window of 50 words the k-mer
with the smallest hash is a node, so whoever holds a window holds its node at the same place, while only about one k-mer in
21 is kept.  An edge is the span of words from one node of a document to the next, both included, known by another hash than nodes are.

1. Nodes in several documents are kept; joining their occurrences with what all occurrences have in common marks the edges
   that do not branch.  Along them a document's path compacts: every window inside a compacted path is the same wherever
   its node occurs, so one source, the smallest document at the node, decides the whole run.
2. Windows that a branch or an end keeps out of the compacted paths are looked up one by one: the smallest document
   of each window, again by a join.
3. Each claim is checked by a second hash: nodes and windows meet by one hash, and an occurrence counts as a repeat only if what it
   carries of another (the edges around a node, the digest of a window) equals what the source document has there.  The source's
   position itself is not carried.

Only hashes and positions are shuffled for the search; the texts are shuffled once, by document, and read twice from there.
Counts are combined before their shuffles, and joins on a hot node or window are split by adaptive execution.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import body, table, text_hash
from strataflow.session import settle

WINDOW, KMER = 50, 10
CHUNK = 1 << 16  # windows looked at together when nodes are chosen
PLACE = np.uint64((1 << 20) - 1)  # bits that hold a k-mer's place among those looked at together
# Two odd multipliers give two independent rolling hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
FLAGS = ("earlier", "one_out", "one_in")
START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


class _Powers:
    """Powers of a base and of its inverse, as many as the longest text so far has needed."""

    def __init__(self, base: int):
        self.steps = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        if n >= len(self.up):
            self.up, self.down = (self._grown(step, max(n + 1, 1 << 12)) for step in self.steps)

    @staticmethod
    def _grown(step: np.uint64, n: int) -> np.ndarray:
        out = np.full(n, step)
        out[0] = 1
        return np.multiply.accumulate(out)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


_POWERS = [_Powers(base) for base in BASES]
_HASHES = _WordHashes()


def _forgetting(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The frames of a partition; afterwards a worker, which may live on for other work, holds none of what they needed."""
    try:
        yield from frames
    finally:
        _HASHES.clear()
        _POWERS[:] = [_Powers(base) for base in BASES]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Rolling:
    """Hashes of any span of a document's words in constant time each."""

    def __init__(self, words: list[bytes]):
        self.n = len(words)
        self.marks = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=self.n)
        self.sums: dict[int, np.ndarray] = {}

    def spans(self, start: np.ndarray, stop: np.ndarray, which: int) -> np.ndarray:
        powers = _POWERS[which]
        if which not in self.sums:
            powers.reach(self.n)
            self.sums[which] = np.zeros(self.n + 1, dtype=np.uint64)
            np.cumsum(self.marks * powers.up[:self.n], out=self.sums[which][1:])
        total = self.sums[which]
        return _mixed((total[stop] - total[start]) * powers.down[start] + (stop - start).astype(np.uint64))

    def smallest(self) -> np.ndarray:
        """For each window the place of its smallest k-mer, the leftmost of equals.

        A k-mer is ranked by the upper bits of its hash; its place fills the lower ones, so a running minimum finds both.
        """
        at = np.arange(self.n - KMER + 1)
        kmers, width = self.spans(at, at + KMER, 0) & ~PLACE, WINDOW - KMER + 1
        best = []
        for first in range(0, len(kmers) - width + 1, CHUNK):
            part = kmers[first:first + CHUNK + width - 1]
            low, span = part | np.arange(len(part), dtype=np.uint64), 1
            while 2 * span <= width:
                low, span = np.minimum(low[:-span], low[span:]), 2 * span
            if span < width:
                low = np.minimum(low[:span - width], low[width - span:])
            best.append((low & PLACE).astype(np.int64) + first)
        return np.concatenate(best)


def _signed(h: np.ndarray) -> np.ndarray:
    return h.astype(np.uint64).view(np.int64)


def _digest(h: np.ndarray) -> np.ndarray:
    """31 bits of a second hash, beside the 64 of the key."""
    return (h & np.uint64(0x7FFFFFFF)).astype(np.int32)


def _in_parts(columns: Iterator[dict], rows: int = 1 << 15) -> Iterator[pd.DataFrame]:
    """Columns of many documents put together up to about ``rows``; a column is an array or one value for all its rows.

    One frame for many documents, as a frame costs more than most documents do; and not one for a whole batch of long texts.
    """
    held, size = [], 0

    def whole() -> pd.DataFrame:
        return pd.DataFrame({name: np.concatenate([np.broadcast_to(c[name], c["start"].shape) for c in held]) for name in held[0]})

    for part in columns:
        held.append(part)
        size += len(part["start"])
        if size >= rows:
            yield whole()
            held, size = [], 0
    if held:
        yield whole()


def _node_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def of(docs: pd.DataFrame) -> Iterator[dict]:
        for doc, row, text in zip(docs["doc_id"], docs["row"], docs["body"]):
            words = text.split()
            if len(words) < WINDOW:
                continue
            roll = Rolling(words)
            at = np.unique(roll.smallest())
            # An edge reaches from one node's start to the next one's end; the first and last reach the document's ends.
            # Edges cover their nodes by the second hash, so nodes whose keys collide have edges that differ.
            right = np.append(roll.spans(at[:-1], at[1:] + KMER, 1), roll.spans(at[-1:], np.array([roll.n]), 1) ^ END)
            left = np.insert(right[:-1], 0, roll.spans(np.array([0]), at[:1] + KMER, 1)[0] ^ START)
            yield {
                "doc_id": doc, "row": row, "start": at, "node": _signed(roll.spans(at, at + KMER, 0)),
                "out_edge": _signed(right), "in_edge": _signed(left)}

    yield from _forgetting(part for docs in batches for part in _in_parts(of(docs)))


def _reaches(roll: Rolling, nodes: np.ndarray, one_out: np.ndarray, one_in: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far the path stays unbranched from each node to the right and to the left, in words."""
    right, left = nodes + KMER, nodes.copy()
    for i in range(len(nodes) - 1, -1, -1):
        if one_out[i]:
            right[i] = right[i + 1] if i + 1 < len(nodes) else roll.n
    for i in range(len(nodes)):
        if one_in[i]:
            left[i] = left[i - 1] if i else 0
    return right, left


def _unsettled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs that a compacted path decides, with check -1, and single windows still to be looked up."""
    def of(docs: pd.DataFrame) -> Iterator[dict]:
        columns = (docs[name] for name in ("doc_id", "row", "body", "start", *FLAGS))
        for doc, row, text, start, *marked in zip(*columns):
            roll = Rolling(text.split())
            best = roll.smallest()
            nodes = np.unique(best)
            at = np.searchsorted(nodes, start)
            flags = {name: np.zeros(len(nodes), dtype=bool) for name in ("shared", *FLAGS)}
            flags["shared"][at] = True
            for name, values in zip(FLAGS, marked):
                flags[name][at] = values
            right, left = _reaches(roll, nodes, flags["one_out"], flags["one_in"])
            starts, node = np.arange(roll.n - WINDOW + 1), np.searchsorted(nodes, best)
            inside = flags["shared"][node] & (left[node] <= starts) & (starts + WINDOW <= right[node])
            decided = starts[inside & flags["earlier"][node]]
            if len(decided):
                cut = np.flatnonzero(np.diff(decided) > 1)
                first, last = decided[np.insert(cut + 1, 0, 0)], decided[np.append(cut, len(decided) - 1)]
                # Their keys meet no window's and are spread, so that these rows do not meet in one task.
                spread = _mixed(first.astype(np.uint64) ^ np.uint64(row & (1 << 64) - 1))
                yield {"doc_id": doc, "row": row, "start": first, "length": last - first + WINDOW, "window": _signed(spread), "check": -1}
            single = starts[flags["shared"][node] & ~inside]
            if len(single):
                yield {
                    "doc_id": doc, "row": row, "start": single, "length": WINDOW,
                    "window": _signed(roll.spans(single, single + WINDOW, 0)), "check": _digest(roll.spans(single, single + WINDOW, 1))}

    yield from _forgetting(part for docs in batches for part in _in_parts(of(docs)))


def _kept(text: bytes, starts: np.ndarray | None, lengths: np.ndarray | None) -> tuple[int, int, bytes]:
    """Words of the text, words inside the spans, and the others joined by one space."""
    words = text.split()
    gone = np.zeros(len(words), dtype=bool)
    for at, size in zip(starts, lengths) if starts is not None else ():
        gone[at:at + size] = True
    return len(words), int(gone.sum()), b" ".join(w for w, g in zip(words, gone) if not g)


def _counted(bodies: pd.Series, starts: pd.Series, lengths: pd.Series) -> pd.DataFrame:
    out = [_kept(*row) for row in zip(bodies, starts, lengths)]
    return pd.DataFrame([(n, cut, hashlib.sha256(kept).hexdigest()) for n, cut, kept in out], columns=["n_words", "n_removed", "kept_sha256"])


def _shortened(bodies: pd.Series, starts: pd.Series, lengths: pd.Series) -> pd.Series:
    """The text without the words inside its spans; null, like the body, for a text that has none."""
    return pd.Series([None if text is None else _kept(text, start, length)[2].decode() for text, start, length in zip(bodies, starts, lengths)], dtype=object)


def repeated_spans(base: DataFrame) -> DataFrame:
    """(doc_id, row, spans) for documents with words to remove; ``base`` holds (doc_id, row, body, ...), no null doc_id."""
    nodes = settle(
        base.select("doc_id", "row", "body").mapInPandas(
            _node_rows, "doc_id long, row long, start int, node long, out_edge long, in_edge long"), "kmer-nodes")
    # An edge is unbranched only if all occurrences agree, the source's among them; windows beyond such edges are looked up one by one.
    # Smallest and largest numbers alone: Spark combines them in place, without sorting and without wider rows.
    known = settle(nodes.groupBy("node").agg(
        F.min("doc_id").alias("source_doc"), F.max("doc_id").alias("last"),
        (F.min("out_edge") == F.max("out_edge")).alias("one_out"), (F.min("in_edge") == F.max("in_edge")).alias("one_in"),
    ).where("source_doc < last").drop("last"), "kmer-shared")
    earlier = F.col("source_doc") < F.col("doc_id")
    # Rows that repeat id and text have the same nodes and spans; sets, combined before their shuffle, hold them once, so that an
    # array is bounded by one text however many copies it is joined back to.
    # The shared nodes grow with the texts, and their file holds an eleventh of what they take in a broadcast.
    marks = nodes.select("doc_id", "row", "start", "node").join(known.hint("merge"), "node").groupBy("doc_id", "row").agg(
        F.collect_set(F.struct("start", earlier.alias("earlier"), "one_out", "one_in")).alias("marks"))
    # Flat arrays instead of an array of rows, which Python would hold as one dictionary a node.
    flat = marks.select("doc_id", "row", *[F.col(f"marks.{name}").alias(name) for name in ("start", *FLAGS)])
    # All columns of the base, though not all are needed: then one shuffle of the texts serves this join and the one of the caller.
    rows = base.join(flat, ["doc_id", "row"]).mapInPandas(
        _unsettled, "doc_id long, row long, start int, length int, window long, check int")
    # Joined by another hash of the key than the one it was grouped by: the join then has a shuffle of its own on either side, which
    # adaptive execution can split where a window is in very many documents.
    source = rows.where("check >= 0").groupBy("window", "check").agg(F.min("doc_id").alias("source_doc"), F.max("doc_id").alias("last")) \
        .where("source_doc < last").select(F.xxhash64("window", "check").alias("key"), "window", "check", "source_doc")
    keyed = rows.withColumn("key", F.xxhash64("window", "check"))
    gone = keyed.join(source, ["key", "window", "check"], "left").where("check = -1 OR source_doc < doc_id")
    return gone.groupBy("doc_id", "row").agg(F.collect_set(F.struct("start", "length")).alias("spans"))


def _with_spans(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, row, body, carry, spans) per row; ``carry`` holds all columns but the text, ``spans`` is null where nothing is to be removed."""
    base = docs.select(
        F.col(key).cast("long").alias("doc_id"), text_hash(F.col(text)).alias("row"), body(F.col(text)).alias("body"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("carry"))
    keyed = base.where("doc_id IS NOT NULL")
    # The search reads the same columns by the same key as this join, so one shuffle of the texts serves both.
    marked = keyed.join(repeated_spans(keyed), ["doc_id", "row"], "left")
    return marked.unionByName(base.where("doc_id IS NULL").withColumn("spans", F.lit(None).cast(marked.schema["spans"].dataType)))


def substring_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(carry, n_words, n_removed, kept_sha256) per row; ``carry`` holds the other columns of the row.

    Null texts have no words.  Documents without a key lose nothing and are no one's source.  Rows that repeat a key are
    never each other's source; each is judged by its own text.  Very long texts are read whole.  An empty table gives an empty result.
    """
    counted = F.pandas_udf(_counted, "n_words long, n_removed long, kept_sha256 string")
    found = counted(F.col("body"), F.col("spans.start"), F.col("spans.length"))
    return _with_spans(docs, key, text).select("carry", found.alias("found")).select("carry", "found.*")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with their repeated words removed and n_chars, where there is one, brought up to date; columns as in ``docs``.

    Texts that lose nothing keep their spacing and never leave the JVM; null texts become empty.  Other cases as in ``substring_dedup``.
    """
    rows = _with_spans(docs, key, text)
    cut = F.col("spans").isNotNull()
    short = F.pandas_udf(_shortened, "string")(F.when(cut, F.col("body")), F.col("spans.start"), F.col("spans.length"))
    rows = rows.select("carry", "body", cut.alias("cut"), short.alias("short"))
    kept = {c: F.col("carry").getField(c) for c in docs.columns if c != text}
    kept[text] = F.when(F.col("cut"), F.col("short")).otherwise(F.col("body").cast("string"))
    if "n_chars" in kept:
        kept["n_chars"] = F.when(F.col("cut"), F.length("short").cast(docs.schema["n_chars"].dataType)).otherwise(kept["n_chars"])
    return rows.select(*[kept[c].alias(c) for c in docs.columns])


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words in, words removed and the digest of the kept words of every document."""
    found = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("carry.doc_id", "n_words", "n_removed", "kept_sha256")
