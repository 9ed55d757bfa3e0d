"""Language identification by cross-parsing entropy.

A suffix automaton per language holds every substring of a sample of its labelled text.  A text is parsed against it
into longest matches: each phrase is as long as the sample allows.  Text in the sample's language needs few phrases; the language with the
fewest, times the bits that name a place in its sample, wins.

Automata are tables of next states for the commonest letters and sorted lists of steps for all others, so every letter of the samples
counts, in any number of scripts.  A task parses many blocks of text in step, up to 64 languages at once, one table
lookup per common letter and one search per other letter.  Blocks are 1,024 characters of a text and every character of every text is in one, so long
texts are spread over many blocks instead of holding up a batch.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import fold_remainder, table

FOLDS, HELD = 4, 2
UNDETERMINED = "und"
# The bounded sample: about so many documents per language, chosen by a hash of the id, so many letters of each at most, and so many in all.
SAMPLE_DOCS, DOC_CHARS, SAMPLE_CHARS = 200, 200, 16_000
# Languages parsed at once; more are parsed group by group.
GROUP = 64
# Codes that have a column in the tables, at most, and cells of all tables together; steps by other codes are searched.
ALPHABET, CELLS = 64, 1 << 24
BLOCK = 1024
NO_LETTER = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    """Lower-cased letters; every run of anything else is one space.  Number signs alone, such as a raised two, are no text."""
    found = NO_LETTER.sub(" ", text.lower()).strip() if text else ""
    return found if any(map(str.isalpha, found)) else ""


def automaton(text: list[int]) -> list[dict[int, int]]:
    """The next state by letter of every state.  State 0 is the start."""
    after: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text:
        new = len(after)
        after.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in after[p]:
            after[p][c] = new
            p = link[p]
        if p >= 0:
            q = after[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(after)
                after.append(dict(after[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and after[p].get(c) == q:
                    after[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return after


def steps_of(after: list[dict[int, int]]) -> np.ndarray:
    """(state, letter, next state) of every step, by state and letter."""
    return np.array([(state, c, row[c]) for state, row in enumerate(after) for c in sorted(row)], dtype=np.int64).reshape(-1, 3)


def suffix_automaton(text: list[int], width: int = ALPHABET) -> np.ndarray:
    """Next-state table for letters below ``width``, -1 where no substring goes on."""
    after = automaton(text)
    return table_of(steps_of(after), len(after), width)


def table_of(steps: np.ndarray, states: int, width: int) -> np.ndarray:
    out = np.full((states, width), -1, dtype=np.int32)
    near = steps[steps[:, 1] < width]
    out[near[:, 0], near[:, 1]] = near[:, 2]
    return out


@dataclass(frozen=True)
class Model:
    languages: list[str]
    chars: dict[str, int]  # letter -> code from 2; 0 is any letter of no sample, 1 ends a sample text
    tables: np.ndarray  # the languages' tables below each other, for the codes that have a column
    keys: np.ndarray  # state and code of the other steps as one sorted number, and
    targets: np.ndarray  # the states they lead to
    roots: np.ndarray
    bits: np.ndarray  # to name a place in each sample

    @staticmethod
    def fit(samples: dict[str, list[str]], alphabet: int = ALPHABET, cells: int = CELLS) -> Model:
        languages = sorted(samples)
        common = Counter(c for texts in samples.values() for t in texts for c in t).most_common()
        chars = {c: n + 2 for n, (c, _) in enumerate(sorted(common, key=lambda x: (-x[1], x[0])))}
        steps, roots, bits, at = [np.empty((0, 3), dtype=np.int64)], [], [], 0
        for name in languages:
            codes = [c for t in samples[name] for c in [*(chars[x] for x in t), 1]]
            after = automaton(codes)
            own = steps_of(after)
            steps.append(own[own[:, 1] > 1] + [at, 0, at])  # the end of a text is not matched
            roots.append(at)
            bits.append(math.log2(len(codes) + 2))
            at += len(after)
        whole, states = np.concatenate(steps), max(at, 1)
        width = max(2, min(alphabet, cells // states))
        far = whole[whole[:, 1] >= width]
        return Model(
            languages, chars, table_of(whole, states, width), far[:, 0] * (len(chars) + 2) + far[:, 1], far[:, 2].astype(np.int32),
            np.array(roots, dtype=np.int64), np.array(bits))

    def codes(self, text: str) -> np.ndarray:
        points, known = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4"), self._lookup()
        return known[np.minimum(points, len(known) - 1)]

    def _lookup(self) -> np.ndarray:
        if "_codes" not in self.__dict__:
            # The last place is for all letters beyond.
            out = np.zeros(max(map(ord, self.chars), default=0) + 2, dtype=np.min_scalar_type(len(self.chars) + 1))
            for c, n in self.chars.items():
                out[ord(c)] = n
            self.__dict__["_codes"] = out
        return self.__dict__["_codes"]

    def _next(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The states, one row per language, after one more code per column; -1 where no substring goes on."""
        width = self.tables.shape[1]
        if len(self.keys) == 0 and len(self.chars) + 2 <= width:
            return self.tables.ravel()[state * width + c]
        out = self.tables.ravel()[state * width + np.minimum(c, width - 1)]
        far = np.flatnonzero(c >= width)
        if len(far):
            key = state[:, far] * (len(self.chars) + 2) + c[far]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out[:, far] = np.where(self.keys[at] == key, self.targets[at], -1)
        return out

    def phrases(self, texts: list[str]) -> np.ndarray:
        """(texts, languages): phrases of each text's blocks against each language."""
        blocks, owner = [], []
        for n, text in enumerate(texts):
            codes = self.codes(text)
            for first in range(0, len(codes), BLOCK):
                blocks.append(codes[first:first + BLOCK])
                owner.append(n)
        total = np.zeros((len(texts), len(self.languages)))
        if not blocks:
            return total
        order = np.argsort([-len(b) for b in blocks], kind="stable")
        lengths = np.array([len(blocks[i]) for i in order])
        padded = np.zeros((int(lengths[0]), len(blocks)), dtype=self._lookup().dtype)
        for column, i in enumerate(order):
            padded[:len(blocks[i]), column] = blocks[i]
        running = np.searchsorted(-lengths, -np.arange(len(padded)), side="left")
        for first in range(0, len(self.roots), GROUP):
            counts = self._parsed(padded, running, self.roots[first:first + GROUP, None])
            np.add.at(total[:, first:first + GROUP], np.array(owner)[order], counts.T)
        return total

    def _parsed(self, padded: np.ndarray, running: np.ndarray, roots: np.ndarray) -> np.ndarray:
        """Phrases of every block, a column, against the languages that start at ``roots``."""
        state = np.repeat(roots, padded.shape[1], axis=1)
        counts = np.zeros(state.shape)
        codes = np.arange(len(self.chars) + 2)
        started = self._next(np.repeat(roots, len(codes), axis=1), codes)
        started = np.where(started < 0, roots, started)
        for t, m in enumerate(running):
            c = padded[t, :m]
            ahead = self._next(state[:, :m], c)
            miss = ahead < 0
            again = started[:, c]
            # A miss ends the phrase under way, if there is one; a letter that no phrase starts with is one of its own.
            counts[:, :m] += miss & (state[:, :m] != roots)
            counts[:, :m] += miss & (again == roots)
            state[:, :m] = np.where(miss, again, ahead)
        return counts + (state != roots)

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and score of normalised texts; the score compares the winner's entropy with the runner-up's, 0.5 for a tie."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        cost = self.phrases(texts) * self.bits
        names, scores = [], []
        for text, row in zip(texts, cost):
            if not text:
                names.append(UNDETERMINED)
                scores.append(0.0)
                continue
            best = int(row.argmin())
            rest = np.delete(row, best)
            second = float(rest.min()) if len(rest) else math.inf
            names.append(self.languages[best])
            scores.append(1.0 if math.isinf(second) else second / (second + float(row[best])))
        return names, scores


def fit(docs: DataFrame, learnable, key: str = "doc_id", text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS,
        doc_chars: int = DOC_CHARS, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Learns from rows where ``learnable`` holds and lang is not null.

    About ``sample_docs`` documents per language, drawn by a hash of the id at a rate that follows the language's size, for any number of
    languages.  A document gives a piece of at most ``doc_chars`` letters from a hashed place of its whole text, and all drawn documents share
    ``sample_chars``, so a header that the texts open with weighs no more than it is long.  Rows that repeat an id count once.
    """
    named = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & learnable)
    named = named.select(F.col(lang).cast("string").alias("lang"), F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    # One number per language, as few as the automata every task holds.
    rates = F.broadcast(named.groupBy("lang").agg((F.lit(sample_docs) / F.count("*")).alias("rate")))
    hashed = F.xxhash64("key", F.lit("language"))
    drawn = named.join(rates, "lang").where(hashed / 2.0 ** 64 + 0.5 < F.col("rate")).groupBy("lang", hashed.alias("h")).agg(F.min("text").alias("t"))

    @F.pandas_udf("string")
    def piece(texts: pd.Series, places: pd.Series) -> pd.Series:
        return pd.Series([sampled(letters(t), h, doc_chars) for t, h in zip(texts, places)], dtype=object)

    # About sample_docs strings of at most doc_chars letters per language reach the driver.
    pieces: dict[str, dict[str, None]] = {}
    for r in sorted(drawn.select("lang", "h", piece("t", "h").alias("t")).collect(), key=lambda r: (r.lang, r.h, r.t)):
        if r.t:
            pieces.setdefault(r.lang, {})[r.t] = None
    return Model.fit({name: shared_out(list(held), sample_chars) for name, held in pieces.items()})


def sampled(text: str, place: int, size: int) -> str:
    """At most ``size`` letters of a text from a place that a number picks, the same for the same number."""
    start = place % (len(text) - size + 1) if len(text) > size else 0
    return text[start:start + size]


def shared_out(pieces: list[str], total: int) -> list[str]:
    """The pieces cut so that they hold ``total`` letters at most: short ones whole, the others equally long."""
    out, left = {}, total
    for waiting, (n, text) in zip(range(len(pieces), 0, -1), sorted(enumerate(pieces), key=lambda x: len(x[1]))):
        out[n] = text[:left // waiting]
        left -= len(out[n])
    return [out[n] for n in range(len(pieces)) if out[n]]


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", folds: int = FOLDS, held: int = HELD) -> DataFrame:
    """key, held_out, lang_pred and score of every row's whole text.

    Null texts and texts without a letter are ``und`` with score 0; ties go to the language first in order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        names, scores = shared.value.predict([letters(t) for t in texts])
        return pd.DataFrame({"lang_pred": names, "score": scores})

    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    held_out = (fold_remainder(F.col(key), folds) == held).alias("held_out")
    return docs.select(F.col(key).cast("long").alias("key"), held_out, predicted(whole).alias("found")).select("key", "held_out", "found.*")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs, fold_remainder(F.col("doc_id"), FOLDS) != HELD)
    return identify(docs, model).withColumnRenamed("key", "doc_id")
