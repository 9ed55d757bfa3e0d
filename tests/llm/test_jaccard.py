"""The n-gram Jaccard join against all pairs of sets, with groups of copies, passages many documents share, and odd texts."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import common, jaccard

DOCS = "doc_id long, text string, sig string, row int, n int, grp int, body int, first int, token int"


def prose(seed, n, words=4000):
    rng = random.Random(seed)
    return " ".join(f"Wort{rng.randrange(words)}" for _ in range(n))


def edited(text, seed, changes):
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(words)


def sets_of(texts, shingle):
    out = []
    for text in texts:
        words = (text or "").encode().lower().split()
        k = min(shingle, len(words))
        out.append({tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set())
    return out


def by_hand(rows, shingle=5, percent=80):
    sets = sets_of([t for _, t in rows], shingle)
    root = list(range(len(rows)))

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            root[top(a)] = top(b)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[top(n)] = min(i, least.get(top(n), i))
    return sorted(((i, len(sets[n]), least.get(top(n)) if sets[n] else i) for n, (i, _) in enumerate(rows)), key=repr)


def found(spark, rows, **options):
    common.ready(spark)
    docs = spark.createDataFrame([(i, t, "x", 1, 2, 3, 4, 5, 6) for i, t in rows], DOCS).repartition(3)
    out = jaccard.jaccard_components(docs, **options)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    """Near copies around the threshold, a chain, groups of copies, shared passages, short and empty texts, null ids and repeated ids."""
    rows, big = [], (1 << 60) + 1
    for n in range(30):
        base = prose(n, 40 + 15 * n)
        rows += [(100 * n + 50 - k, edited(base, 31 * n + k, k * (1 + n // 12))) for k in range(6)]
    chain = prose(900, 400)
    for k in range(8):  # each linked with the next one, the ends far apart
        rows.append((5000 + (k * 3) % 8, chain))
        chain = edited(chain, 7000 + k, 6)
    passage = [prose(901 + k, 55) for k in range(3)]
    rows += [(6000 + n, prose(2000 + n, 30 + 4 * n) + " " + passage[n % 3] + " " + passage[(n + 1) % 3]) for n in range(60)]
    crowd = prose(950, 150)
    rows += [(7000 + n, edited(crowd, 8000 + n, n % 4)) for n in range(80)] + [(7200 + n, crowd) for n in range(40)]
    rows += [(8000, None), (8001, ""), (8002, " \n\t "), (8003, "one two"), (8004, "ONE  two"), (8005, "one two three"), (8006, "a b c d e"), (8007, "A B C D E a b c d e"),
             (8008, "Ä b"), (8009, "ä b"), (None, crowd), (None, "nobody else says this at all here"), (None, None), (big, prose(1, 55)), (big + 1, prose(1, 55)),
             (8010, "x " * 3000), (8011, "x " * 30), (9, prose(960, 60)), (9, prose(961, 60)), (9, prose(960, 60)), (3, prose(961, 60)), (8012, "z y " * 40)]
    return rows


def test_components_equal_all_pairs(spark, corpus):
    assert found(spark, corpus) == by_hand(corpus)


@pytest.mark.parametrize("shingle, percent", [(1, 100), (2, 50), (5, 95)])
def test_other_lengths_and_shares(spark, corpus, shingle, percent):
    rows = corpus[::2]
    assert found(spark, rows, shingle=shingle, percent=percent) == by_hand(rows, shingle, percent)


def test_matrix_alone_finds_every_link(spark, corpus, monkeypatch):
    """Without groups to start from, and with every token known as common: nothing but bounds and order decides."""
    monkeypatch.setattr(jaccard, "star_pairs", lambda sets, percent: sets.select(F.col("sig").alias("u"), F.col("sig").alias("v")).limit(0))
    rows = corpus[:230]
    assert found(spark, rows) == by_hand(rows)
    monkeypatch.setattr(jaccard, "HOT", 8)
    monkeypatch.setattr(jaccard, "GROUP", 3)
    monkeypatch.setattr(jaccard, "PROBE", 0)
    assert found(spark, rows) == by_hand(rows)


def test_bounds_hold_for_linked_sets():
    rng = np.random.default_rng(5)
    hot = np.sort(rng.integers(0, 1 << 63, 3000, dtype=np.uint64))
    for _ in range(300):
        n = int(rng.integers(1, 400))
        base = np.concatenate([rng.integers(0, 1 << 63, n, dtype=np.uint64), rng.choice(hot, int(rng.integers(0, 400)), replace=False)])
        drop, add = int(rng.integers(0, len(base) // 6 + 1)), int(rng.integers(0, len(base) // 8 + 1))
        a = np.unique(base)
        b = np.unique(np.concatenate([rng.choice(a, max(1, len(a) - drop), replace=False), rng.integers(0, 1 << 63, add, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 80 * (len(a) + len(b) - both):
            continue
        order = hot, np.arange(1, len(hot) + 1)
        met = len(np.intersect1d(jaccard._first(a, order, 80), jaccard._first(b, order, 80)))
        assert met >= min(jaccard._spare(len(a), 80), jaccard._spare(len(b), 80))
        differ = int(np.bitwise_count(jaccard._bits(a) ^ jaccard._bits(b)).sum())
        assert differ * 180 <= 20 * (len(a) + len(b))
        assert jaccard._near(np.array(len(a)), jaccard._bits(a), np.array(len(b)), jaccard._bits(b), 80)


def test_very_long_texts_and_repeated_rows(spark):
    long = prose(1, 200_000, 50_000)
    words = long.split(" ")
    words[::100] = ["other"] * len(words[::100])
    rows = [(4, long), (2, " ".join(words)), (3, " ".join(words[:100_000])), *[(5, prose(2, 80))] * 200, (1, edited(prose(2, 80), 3, 1))]
    assert found(spark, rows) == by_hand(rows)


def shared_passages(n):
    """Texts that are half one of two passages, none of which is common in a small batch, and near copies of every tenth."""
    passage = [prose(970 + k, 64) for k in range(2)]
    rows = [(k, prose(3000 + k, 60, 10 ** 6) + " " + passage[k % 2]) for k in range(n)]
    return rows + [(10 ** 4 + k, edited(text, k, 1)) for k, text in rows[::10]]


def test_tokens_shared_by_many_meet_few_groups(spark, monkeypatch):
    """Twice the texts that share a passage give about twice the pairs of groups that meet, not four times as many."""
    monkeypatch.setitem(common.BATCHES, "spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    met, pairs = [], jaccard.group_pairs

    def counting(matrix):
        held = matrix.groupBy("token").agg(F.countDistinct("grp").alias("groups"))
        met.append(held.agg(F.sum(F.col("groups") * (F.col("groups") - 1) / 2)).first()[0])
        return pairs(matrix)

    monkeypatch.setattr(jaccard, "group_pairs", counting)
    for n in (150, 300):
        assert found(spark, shared_passages(n)) == by_hand(shared_passages(n))
    assert met[1] < 3 * met[0] + 300


def test_crowded_tokens_are_left_out_of_a_row_or_the_row_begins_anew(spark, corpus, monkeypatch):
    monkeypatch.setattr(jaccard, "star_pairs", lambda sets, percent: sets.select(F.col("sig").alias("u"), F.col("sig").alias("v")).limit(0))
    monkeypatch.setattr(jaccard, "CROWD", 2)
    monkeypatch.setattr(jaccard, "THRONG", 4)
    rows = corpus[:300] + corpus[-22:]
    assert found(spark, rows) == by_hand(rows)
    monkeypatch.setattr(jaccard, "HOT", 40)  # most of the crowded tokens stay where they are
    assert found(spark, rows) == by_hand(rows)


def test_an_empty_table(spark):
    assert found(spark, []) == [] and found(spark, [(1, None), (None, "")]) == [(1, 0, 1), (None, 0, None)]


def test_hot_groups_are_split(spark, corpus):
    """Joins with a summary shuffle both sides anew, which is what lets adaptive execution split a hot key."""
    common.ready(spark)
    sets = spark.range(100).select(F.col("id").cast("string").cast("binary").alias("sig"), (F.col("id") % 2).alias("band"))
    summary = sets.groupBy("band").agg(F.min("sig").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = jaccard._met(sets, summary, "band")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("hashpartitioning(_spread") == 2
