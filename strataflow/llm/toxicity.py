"""Toxicity by a learnt lexicon whose misspellings are caught and whose quotations count less.

The lexicon is a trie of words and stems that stand out in documents labelled toxic.  A Levenshtein automaton accepts what is
within a few edits of one term; run over the trie it accepts what is within reach of any.  The product of both is built
while words are read and kept, so a word costs one lookup per letter, and most end after a few letters.

Each hit is weighed by its context: within a window of words, an opening and a closing quotation mark around it or a reporting
word before it make it a quotation.  A document's score is a logistic function of how often each term is used and quoted.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import fold_remainder, table
from strataflow.session import settle

FOLDS, HELD = 3, 1
THRESHOLD = 0.7
# Labelled documents to learn from, chosen by a hash of the id, and terms kept.
SAMPLE_DOCS, TERMS = 12_000, 300
STEMS = (4, 5, 6, 7)  # lengths of the stems that are counted beside whole words
LEVELS = (1, 2, 4)  # a term counts as present from so many uses
CONTEXT = 6
QUOTED = 0.25  # a quoted hit, relative to one that is not
MEMORY = 200_000  # words and states a task remembers before it starts afresh
TOKEN = re.compile(r"[^\W_]+")
OPEN, CLOSE = "\"“„«»'‘", "\"”“»«'’"
# Words that announce somebody else's words.
REPORTING = frozenset("said says wrote writes quoted quotes called sagte schrieb nannte dit écrit dijo escribió".split())


def edits(term: str, stem: bool) -> int:
    """Edits allowed: none for short terms, one for middling, two for long; stems are stricter as any ending may follow."""
    return (len(term) >= 5) + (len(term) >= 9) if not stem else int(len(term) >= 7)


class Lexicon:
    """Trie of terms with the Levenshtein automaton run over it; stems are written with a final ``*``."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[int, int, bool]]] = [[]]  # (term, edits allowed, stem)
        self.most = [0]
        for number, term in enumerate(terms):
            word, stem = term.rstrip("*"), term.endswith("*")
            allowed, at = edits(word, stem), 0
            self.most[0] = max(self.most[0], allowed)
            for c in word:
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.most.append(0)
                at = self.children[at][c]
                self.most[at] = max(self.most[at], allowed)
            self.ends[at].append((number, allowed, stem))
        self._reset()

    def _reset(self) -> None:
        start = self._closed({0: 0})
        self.states: list[tuple[dict[int, int], frozenset[int]]] = [(start, self._stems(start))]
        self.numbers = {self._name(*self.states[0]): 0}
        self.steps: list[dict[str, int]] = [{}]
        self.words: dict[str, tuple[int, ...]] = {}

    @staticmethod
    def _name(nodes: dict[int, int], stems: frozenset[int]):
        return frozenset(nodes.items()), stems

    def _closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """Letters of a term may be missing: children one edit away, and so on."""
        todo = list(nodes)
        while todo:
            at = todo.pop()
            for child in self.children[at].values():
                cost = nodes[at] + 1
                if cost <= self.most[child] and cost < nodes.get(child, 99):
                    nodes[child] = cost
                    todo.append(child)
        return nodes

    def _stems(self, nodes: dict[int, int]) -> frozenset[int]:
        return frozenset(n for at, cost in nodes.items() for n, allowed, stem in self.ends[at] if stem and cost <= allowed)

    def _step(self, state: int, c: str) -> int:
        nodes, stems = self.states[state]
        after: dict[int, int] = {}

        def put(node: int, cost: int) -> None:
            if cost <= self.most[node] and cost < after.get(node, 99):
                after[node] = cost

        for at, cost in nodes.items():
            put(at, cost + 1)  # a letter too many
            for letter, child in self.children[at].items():
                put(child, cost + (letter != c))
        after = self._closed(after)
        found = stems | self._stems(after)
        name = self._name(after, found)
        if name not in self.numbers:
            self.numbers[name] = len(self.states)
            self.states.append((after, found))
            self.steps.append({})
        self.steps[state][c] = self.numbers[name]
        return self.numbers[name]

    def match(self, word: str) -> tuple[int, ...]:
        """Terms within reach of a word."""
        known = self.words.get(word)
        if known is not None:
            return known
        if len(self.words) > MEMORY or len(self.states) > MEMORY:
            self._reset()
        state = 0
        for c in word:
            ahead = self.steps[state].get(c)
            state = self._step(state, c) if ahead is None else ahead
            if not self.states[state][0]:
                break
        nodes, stems = self.states[state]
        whole = {n for at, cost in nodes.items() for n, allowed, stem in self.ends[at] if not stem and cost <= allowed}
        found = tuple(sorted(whole | stems))
        self.words[word] = found
        return found


def quoted(tokens: list[re.Match], text: str, at: int) -> bool:
    """Whether the token stands in quotation marks that open and close within the window, or after a reporting word."""
    first, last = tokens[max(0, at - CONTEXT)], tokens[min(len(tokens) - 1, at + CONTEXT)]
    before, after = text[first.start():tokens[at].start()], text[tokens[at].end():last.end() + 2]
    opening = max((before.rfind(mark) for mark in OPEN), default=-1)
    opened = opening >= 0 and (opening == 0 or not before[opening - 1].isalnum())
    closed = any(m in after for m in CLOSE)
    return opened and closed or any(t.group().lower() in REPORTING for t in tokens[max(0, at - 3):at])


def uses(lexicon: Lexicon, text: str) -> dict[int, float]:
    """Uses of each term in a whole text, quotations counted in part."""
    lowered = text.lower()
    hits = [(i, found) for i, word in enumerate(TOKEN.findall(lowered)) if (found := lexicon.match(word))]
    if not hits:
        return {}
    tokens, out = list(TOKEN.finditer(lowered)), Counter()
    for i, found in hits:
        weight = QUOTED if quoted(tokens, lowered, i) else 1.0
        for term in found:
            out[term] += weight
    return out


@dataclass
class Model:
    terms: list[str]
    weights: np.ndarray
    bias: float
    lexicon: Lexicon = field(init=False)

    def __post_init__(self):
        self.lexicon = Lexicon(self.terms)

    def __getstate__(self):
        return self.terms, self.weights, self.bias

    def __setstate__(self, state):
        self.terms, self.weights, self.bias = state
        self.lexicon = Lexicon(self.terms)

    def score(self, text: str) -> float:
        z = self.bias + sum(self.weights[n] * np.log2(1 + c) for n, c in uses(self.lexicon, text).items())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def presence(text: str) -> set[str]:
    """Words and stems of a text with the levels of use they reach, as ``term/level``."""
    words = Counter(w for w in TOKEN.findall(text.lower()) if len(w) >= 3)
    stems = Counter()
    for w, n in words.items():
        for size in STEMS:
            if len(w) > size:
                stems[w[:size] + "*"] += n
    return {f"{t}/{level}" for counted in (words, stems) for t, n in counted.items() for level in LEVELS if n >= level}


def labelled(docs: DataFrame, labels: DataFrame, learnable, sample_docs: int = SAMPLE_DOCS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, toxic) of at most about ``sample_docs`` labelled rows, chosen by a hash of the id.

    Rows that repeat an id count once, by the smallest of their texts, so an id of many rows doesn't widen the sample.
    """
    marks = labels.where(F.col("toxic").isNotNull() & F.col(key).isNotNull() & learnable).groupBy(F.col(key).alias("key")).agg(F.max("toxic").alias("toxic"))
    marks = settle(marks, "labels")
    share = min(1.0, sample_docs / max(1, marks.count()))
    spread = (F.xxhash64("key", F.lit("toxicity")) / 2.0 ** 64) + 0.5
    # At most about sample_docs rows of two numbers, whatever the size of the label table.
    few = F.broadcast(marks.where(spread < share))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return rows.join(few, "key").groupBy("key", "toxic").agg(F.min("text").alias("text"))


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        both = (Counter(), Counter())
        for text, toxic in zip(rows["text"], rows["toxic"]):
            both[int(toxic > 0)].update(presence(text))
        # A term that no toxic text of the batch has can only lower a count, never make a candidate.
        terms = sorted(both[0].keys() | both[1].keys())
        yield pd.DataFrame({"term": terms, "clean": [both[0][t] for t in terms], "toxic": [both[1][t] for t in terms]})


def candidates(sample: DataFrame, terms: int) -> list[str]:
    """The terms that set toxic texts apart most surely, by the log-likelihood ratio of their best level."""
    sizes = {int(r.toxic > 0): int(r.n) for r in sample.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return []
    counts = sample.mapInPandas(_counted, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    share, total = sizes[1] / (sizes[0] + sizes[1]), F.col("clean") + F.col("toxic")

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    surprise = part(F.col("toxic"), total * share) + part(F.col("clean"), total * (1 - share))
    strong = counts.where((F.col("toxic") >= 4) & (F.col("toxic") > 2 * share * total))
    best = strong.groupBy(F.substring_index("term", "/", 1).alias("term")).agg(F.max(surprise).alias("surprise"))
    return [r.term for r in best.orderBy(F.desc("surprise"), "term").limit(terms).collect()]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, steps: int = 25) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge-penalised logistic regression, by Newton steps.

    A rarer label counts for more, by the root of how much rarer it is, or few toxic rows would be outvoted.
    """
    design = np.column_stack([x, np.ones(len(x))])
    part = np.where(y > 0, (y <= 0).mean(), (y > 0).mean()) ** 0.5
    part /= part.mean()
    beta, penalty = np.zeros(design.shape[1]), np.full(design.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = (design * (part * p * (1 - p))[:, None]).T @ design + np.diag(penalty)
        move = np.linalg.solve(hessian, design.T @ (part * (y - p)) - penalty * beta)
        beta += np.clip(move, -4, 4)
        if np.abs(move).max() < 1e-6:
            break
    return beta[:-1], float(beta[-1])


def fit(docs: DataFrame, labels: DataFrame, learnable, sample_docs: int = SAMPLE_DOCS, terms: int = TERMS, key: str = "doc_id", text: str = "text") -> Model:
    """Learns lexicon and weights from labelled rows where ``learnable`` holds.

    Without both labels among them the lexicon is empty and every score is the share of toxic rows.
    """
    sample = settle(labelled(docs, labels, learnable, sample_docs, key, text), "toxic-sample")
    names = candidates(sample, terms)
    if not names:
        share = sample.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0] or 0.0
        return Model([], np.zeros(0), float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))
    shared = docs.sparkSession.sparkContext.broadcast(Model(names, np.zeros(len(names)), 0.0))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = [uses(shared.value.lexicon, t) for t in rows["text"]]
            yield pd.DataFrame({"toxic": (rows["toxic"] > 0).astype("int32"), "term": [list(f) for f in found], "uses": [list(f.values()) for f in found]})

    # At most sample_docs rows of at most ``terms`` numbers.
    got = sample.mapInPandas(run, "toxic int, term array<int>, uses array<double>").collect()
    x, y = np.zeros((len(got), len(names))), np.array([r.toxic for r in got], dtype=float)
    for n, r in enumerate(got):
        x[n, r.term] = np.log2(1 + np.array(r.uses))
    weights, bias = logistic(x, y)
    return Model(names, weights, bias)


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(row, score) with ``row`` the whole input row, whatever its columns are called.  Null and empty texts score as texts without a hit."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype="float64")

    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), score(whole).alias("score"))


def learnt(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of this corpus, from rows outside the held-out fold."""
    return fit(docs, labels, fold_remainder(F.col("doc_id"), FOLDS) != HELD)


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below ``threshold``."""
    return scored(docs, model).where(F.col("score") < threshold).select("row.*")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction of every document."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    found = scored(docs, learnt(docs, labels))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), (fold_remainder(F.col("row.doc_id"), FOLDS) == HELD).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
