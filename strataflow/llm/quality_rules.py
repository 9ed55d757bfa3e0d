"""Quality rules: line frequency across the documents of a host, beside plain counts of each text.

Lines are normalised (lower case, digits as one sign, white space as one space) and hashed.  A line that stands in more documents of
one host than the limit allows is boilerplate there; it is removed from every document, and a document that loses too many
of its words is rejected.  Only line hashes are shuffled, each once per document; counts are combined before
their shuffle, so a line that a third of all documents share is one row per task.  Texts are never shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import body, table
from strataflow.session import settle

SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
SPACES = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
DIGITS = re.compile(rb"[0-9]+")
# A line is boilerplate in a host if it stands in more documents than this, however many the host has.
LEAST_DOCS = 20
# Rejected is a document that loses more than this share of its words.
DEPLETED = 0.5
LINE = "array<struct<line: bigint, words: bigint>>"


def normalised(line: bytes) -> bytes:
    return DIGITS.sub(b"0", b" ".join(line.lower().split()))


def repeated_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that is found twice or more in the text."""
    n = len(words) - 2
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    # Pairs, then triples, get numbers of their own, so any vocabulary fits 64 bits.
    _, pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
    triples = pairs[:-1].astype(np.int64) * len(numbers) + ids[2:]
    _, which, counts = np.unique(triples, return_inverse=True, return_counts=True)
    twice = counts[which] > 1
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift:shift + n] |= twice
    return int(covered.sum())


def _code_points(text: bytes) -> int:
    raw = np.frombuffer(text, dtype=np.uint8)
    return int(((raw & 0xC0) != 0x80).sum())


def measures(text: bytes) -> tuple[int, int, int, int, int, list[dict]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the distinct lines with their words."""
    words = text.split()
    seen, again, lines = set(), 0, Counter()
    for line in text.split(b"\n"):
        size = len(line.split())
        if size:
            again += line in seen
            seen.add(line)
            lines[xxhash.xxh64_intdigest(normalised(line))] += size
    signed = [{"line": h - (1 << 64) if h >> 63 else h, "words": n} for h, n in lines.items()]
    chars = _code_points(text) - sum(text.count(s) for s in SPACES)
    return len(words), chars, sum(text.count(s) for s in SYMBOLS), again, repeated_words(words), signed


def _measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"]
    for docs in batches:
        found = pd.DataFrame([measures(t) for t in docs["body"]], columns=names)
        yield pd.concat([docs[["host", "row", "key"]], found], axis=1)


def boilerplate(lines: DataFrame, totals: DataFrame, least_docs: int = LEAST_DOCS, share: float | None = None) -> DataFrame:
    """(host, line) above the limit; ``lines`` holds (host, key, line), one row or more per document and line, ``totals`` (host, host_docs).

    With a ``share``, the line must also stand in more than that share of the host's documents, a limit that grows with the host.
    """
    once = lines.select("host", "key", "line").distinct()
    counts = once.groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > least_docs)
    if share is None:
        return counts.select("host", "line")
    return counts.join(totals, "host").where(F.col("docs") > F.lit(share) * F.col("host_docs")).select("host", "line")


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
            least_docs: int = LEAST_DOCS, share: float | None = None, depleted: float = DEPLETED) -> DataFrame:
    """key, the counts, removed_words, base_failed and kept of every row.

    Null texts are empty and fail the base rules; documents of a null host share a host of their own.  Rows that
    repeat a key count once per line, and are judged each by its own text.
    """
    out = ("host string, row long, key string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
           f"n_repeat_words long, lines {LINE}")
    # Keys travel as text: pandas would round large ones beside a null.
    rows = docs.select(
        F.col(key).cast("string").alias("key"), F.coalesce(F.col(host).cast("string"), F.lit("(none)")).alias("host"),
        F.xxhash64(body(F.col(text))).alias("row"), body(F.col(text)).alias("body"))
    found = settle(rows.mapInPandas(_measured, out).withColumn("key", F.col("key").cast("long")), "quality-counts")
    lines = found.select("host", "key", "row", F.explode("lines").alias("at")).select("host", "key", "row", "at.line", "at.words")
    totals = found.groupBy("host").agg(F.count("*").alias("host_docs"))
    common = boilerplate(lines, totals, least_docs, share)
    # A document that stands in the table twice has its lines twice; distinct leaves one of each.
    lost = lines.join(common, ["host", "line"]).distinct().groupBy("key", "row", "host").agg(F.sum("words").alias("lost")).select(
        F.col("key").alias("__key"), F.col("row").alias("__row"), F.col("host").alias("__host"), "lost")
    same = F.col("key").eqNullSafe(F.col("__key")) & (F.col("row") == F.col("__row")) & (F.col("host") == F.col("__host"))
    judged = found.join(lost, same, "left").select(
        "key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.coalesce("lost", F.lit(0)).cast("long").alias("removed_words"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("removed_words") <= F.lit(depleted) * F.col("n_words")))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's counts and the verdict for every document, with ``source`` as the host."""
    return quality(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).withColumnRenamed("key", "doc_id")


# Lines are compared as normalised text rather than by hash.
OP2_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '(none)') AS host, coalesce(text, '') AS text FROM documents),
words AS MATERIALIZED (
  SELECT doc_id, host, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d
), triples AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM words)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS n FROM triples) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS s(k) GROUP BY 1
), lines AS MATERIALIZED (
  SELECT doc_id, host, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
    regexp_replace(array_to_string(regexp_extract_all(
      translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' '), '[0-9]+', '0', 'g') AS norm
  FROM (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line FROM d)
), full_lines AS (SELECT * FROM lines WHERE n > 0),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY 1),
common AS (SELECT host, norm FROM full_lines GROUP BY host, norm HAVING count(DISTINCT doc_id) > 20), lost AS (SELECT doc_id, sum(n) AS n FROM full_lines JOIN common USING (host, norm) GROUP BY 1),
counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dups.n, 0)::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0)::BIGINT AS removed_words
  FROM words LEFT JOIN dups USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN lost USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND removed_words <= 0.5 * n_words AS kept
FROM counted
"""
