"""Filter interaction audit: what every filter of a set removes, in every order in which the filters can be applied.

Each document is reduced to one bit per filter, and documents are counted by part and by the cell of their bits.  The counts of a
part are reshaped to a tensor with one axis of length two per filter, pass and fail.  Every figure of a step is a contraction of that tensor
with one selector per axis: pass, fail or all.  Documents removed by a step pass every earlier filter, fail this one and
may do either on later ones; the selectors of all steps of all orders are laid out once and contracted for many parts at a time.

Only hashes, bits and ids are shuffled, never a text.  A part holds at most 2 ** filters cells, whatever the number of its documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import WORD, table
from strataflow.session import settle

PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
PARTS = 64  # parts contracted together, which bounds the tensors in memory
MOST = 6  # filters; every order of each is reported
RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long")


def text_failures(text: Column) -> dict[str, Column]:
    """Failure of the filters that look at one text alone; a null text is empty."""
    body = F.coalesce(text.cast("string"), F.lit(""))
    words = F.regexp_extract_all(body, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * F.length(F.regexp_replace(body, "[^A-Z]+", "")) > 5 * F.length(body),
        "D": body.rlike("[#$%&*|]"),
    }


def flagged(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, A, B, C, D, E, good, toxic) of every row.

    E fails if the same text stands in any row with a smaller id.  Rows without an id are copies of nothing, and nothing is a copy of them; rows that
    repeat an id are not copies of each other.  A document is good or toxic if any of its rows in ``labels`` says so.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = settle(docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(body.cast("binary"), 256)).alias("same"),
        *[failed.alias(name) for name, failed in text_failures(F.col(text)).items()]), "audit-rows")
    # One row per text that several ids share.  Joined by a hash of the text's hash too: both sides then have a shuffle of their own, so that
    # adaptive execution can split a text that very many rows hold.
    spread = F.xxhash64("same").alias("spread")
    first = rows.groupBy("same").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("same", spread, "first")
    copies = rows.select("*", spread).join(first, ["spread", "same"], "left").withColumn("E", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)))
    marked = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.coalesce(F.max(F.col(source) == 1), F.lit(False)).alias(name) for source, name in (("quality", "good"), ("toxic", "toxic"))])
    known = copies.join(marked, "doc_id", "left")
    return known.select("part", *"ABCDE", *[F.coalesce(name, F.lit(False)).alias(name) for name in ("good", "toxic")])


class Steps:
    """The selectors of every step of every order, and which filter each step applies."""

    def __init__(self, filters: Sequence[str]):
        self.orders = ["".join(p) for p in permutations(filters)]
        self.count = len(filters)
        at = {name: axis for axis, name in enumerate(filters)}
        self.axis = np.array([at[name] for order in self.orders for name in order])
        steps = [(order[:n], order[n]) for order in self.orders for n in range(self.count)]
        self.kept = self._laid_out(filters, [(before + own, "") for before, own in steps])
        self.removed = self._laid_out(filters, steps)
        self.failing = self._laid_out(filters, [("", own) for _, own in steps])
        self.alone = self._laid_out(filters, [("".join(f for f in filters if f != own), own) for _, own in steps])

    @staticmethod
    def _laid_out(filters: Sequence[str], wanted: list[tuple[str, str]]) -> np.ndarray:
        """One selector per filter and step: (filters, steps, 2)."""
        return np.array([[PASS if f in passed else FAIL if f in failed else ALL for passed, failed in wanted] for f in filters], dtype=np.int64)

    @staticmethod
    def contracted(tensors: np.ndarray, selectors: np.ndarray) -> np.ndarray:
        """(parts, steps) counts out of (parts, 2, 2, ...) tensors, one axis after the other."""
        out = np.einsum("pa...,sa->ps...", tensors, selectors[0])
        for selector in selectors[1:]:
            out = np.einsum("psa...,sa->ps...", out, selector)
        return out

    def report(self, parts: Sequence[str], counts: np.ndarray) -> pd.DataFrame:
        """All steps of the parts; ``counts`` is (parts, 3, cells): documents, good ones, toxic ones."""
        documents, good, toxic = (counts[:, n].reshape(-1, *[2] * self.count) for n in range(3))
        removed = self.contracted(documents, self.removed)
        owed = np.stack([removed[:, self.axis == axis].sum(axis=1) for axis in range(self.count)], axis=1)
        steps = len(self.axis)
        figures = {
            "kept": self.contracted(documents, self.kept), "removed": removed,
            "redundant": self.contracted(documents, self.failing) - removed, "unique_fails": self.contracted(documents, self.alone),
            "good_lost": self.contracted(good, self.removed), "toxic_lost": self.contracted(toxic, self.removed),
            "shapley": owed[:, self.axis]}
        return pd.DataFrame({
            "part": np.repeat(np.array(parts, dtype=object), steps),
            "filter_order": np.tile(np.repeat(np.array(self.orders, dtype=object), self.count), len(parts)),
            "step": np.tile(np.arange(steps, dtype=np.int32) % self.count + 1, len(parts)),
            **{name: values.ravel() for name, values in figures.items()}})


def interactions(flags: DataFrame, filters: Sequence[str] = "ABCDE") -> DataFrame:
    """Every step of every order per part: (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    ``flags`` holds part, good, toxic and one boolean column per filter, true where the row fails it; filters have names of one letter and there are
    at most six.  Steps that remove nothing have rows of zeros.  No rows give no parts and an empty result.
    """
    if not 1 <= len(filters) <= MOST or len(set(filters)) < len(filters) or any(len(f) != 1 for f in filters):
        raise ValueError(f"one to {MOST} filters with different names of one letter")
    bits = [F.col(name).cast("int") * (1 << (len(filters) - 1 - axis)) for axis, name in enumerate(filters)]
    cells = flags.groupBy("part", reduce(Column.__add__, bits).alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    # At most 2 ** filters entries each.
    tensors = cells.groupBy("part").agg(*[F.collect_list(F.struct("cell", name)).alias(name) for name in ("n", "good", "toxic")])

    def contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps = Steps(filters)
        for batch in batches:
            for at in range(0, len(batch), PARTS):
                some = batch.iloc[at:at + PARTS]
                counts = np.zeros((len(some), 3, 1 << len(filters)), dtype=np.int64)
                for row, entries in enumerate(zip(some["n"], some["good"], some["toxic"])):
                    for kind, pairs in enumerate(entries):
                        for pair in pairs:
                            cell, number = pair.values()
                            counts[row, kind, cell] = number
                yield steps.report(list(some["part"]), counts)

    return tensors.mapInPandas(contract, RESULT)


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """The five filters of ``flagged`` over whole texts, per part; null parts are the part with the empty name."""
    return interactions(flagged(docs, labels, key, text, part))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source, order and step: what the step keeps, removes and loses."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return audit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


# Copies are compared as texts, and every step counts its documents anew.
OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), marked AS (
  SELECT doc_id, coalesce(max(quality = 1), false) AS good, coalesce(max(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id
), judged AS (
  SELECT d.doc_id, part, CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM d
), cells AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM judged LEFT JOIN marked USING (doc_id) GROUP BY part, fails
), letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
    JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)
), steps AS (
  SELECT filter_order, CAST(k AS INTEGER) AS step, substr(filter_order, k, 1) AS own, substr(filter_order, 1, k - 1) AS before
  FROM orders CROSS JOIN range(1, 6) AS t(k)
), seen AS (
  SELECT part, filter_order, step, own, n, good, toxic, fails, contains(fails, own) AS failing,
    length(translate(fails, before, '')) = length(fails) AS here
  FROM cells CROSS JOIN steps
), counted AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (WHERE here AND NOT failing), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (WHERE here AND failing), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE NOT here AND failing), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (WHERE fails = own), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (WHERE here AND failing), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE here AND failing), 0)::BIGINT AS toxic_lost
  FROM seen GROUP BY part, filter_order, step, own
)
SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM counted
"""
