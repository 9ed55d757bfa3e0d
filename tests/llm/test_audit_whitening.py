"""The filter audit against every document by hand, and whitening against a dense eigensolver."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from strataflow.llm import audit, common, whitening

DOCS = "doc_id long, text string, source string, lang string, part string, same int, A int, good int, n int"
LABELS = "doc_id long, quality int, toxic int"


def audited(rows, labels):
    """Each document walked through each order."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out, owed = Counter(), Counter()
    keys = {(part or "") for _, _, part in rows}
    for i, text, part in rows:
        text, part = text or "", part or ""
        words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode())
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": any(c in text for c in "#$%&*|"), "E": i is not None and i > least[text]}
        for order in map("".join, permutations("ABCDE")):
            there = True
            for step, own in enumerate(order, 1):
                at = (part, order, step)
                out[at, "redundant"] += fails[own] and not there
                out[at, "unique_fails"] += fails[own] and sum(fails.values()) == 1
                removed = there and fails[own]
                out[at, "removed"] += removed
                out[at, "good_lost"] += removed and i in good
                out[at, "toxic_lost"] += removed and i in toxic
                owed[part, own] += removed
                there = there and not fails[own]
                out[at, "kept"] += there
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return {
        (part, order, step): (*[out[(part, order, step), n] for n in names], owed[part, order[step - 1]])
        for part in keys for order in map("".join, permutations("ABCDE")) for step in range(1, 6)}


def prose(seed, n, words=60):
    rng = random.Random(seed)
    return " ".join(f"word{rng.randrange(words)}" for _ in range(n))


def test_audit_equals_a_walk_through_every_order(spark):
    shared = prose(1, 70, 400)
    rows = [(n, shared, ("a", "b", None)[n % 3]) for n in range(40)]  # one text in every part
    rows += [(100 + n, prose(n, 30 + 3 * n, 20 + 5 * n) + ("", " $", " ABCDEF" * 9, "\n|")[n % 4], ("a", "b")[n % 2]) for n in range(24)]
    rows += [(7, shared, "b"), (7, shared, "b"), (None, shared, "a"), (None, shared, "a"), (None, None, None), (300, None, "c"), (301, "", "c"),
             (302, " \n\t ", "c"), (303, "Ω" * 60 + " É" * 60, "c"), (304, prose(5, 200_000, 9), "d"), (0, shared + " ", "a")]
    labels = [(n, n % 2, n % 3 == 0) for n in range(0, 130, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (7, None, 1), (9, None, None), (999, 1, 1)]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    common.ready(spark)
    docs = spark.createDataFrame([(i, t, s, "x", "y", 1, 2, 3, 4) for i, t, s in rows], DOCS).repartition(3)
    got = audit.audit(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in got} == audited(rows, labels) and len(got) == 600 * 5


def test_audit_of_nothing_and_of_other_filters(spark):
    common.ready(spark)
    assert audit.audit(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).count() == 0
    flags = spark.createDataFrame([("p", True, False, True, False), ("p", True, True, False, True), (None, False, False, False, False)],
                                  "part string, X boolean, Y boolean, good boolean, toxic boolean")
    got = {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in audit.interactions(flags, "XY").collect()}
    assert got["p", "XY", 1] == (0, 2, 0, 1, 1, 1, 3) and got["p", "XY", 2] == (0, 0, 1, 0, 0, 0, 1)
    assert got["p", "YX", 1] == (1, 1, 0, 0, 0, 1, 1) and got[None, "XY", 1] == (1, 0, 0, 0, 0, 0, 0) and len(got) == 8
    with pytest.raises(ValueError):
        audit.interactions(flags, "XX")


VECTORS = "vec_id long, embedding array<float>, label int, x int, place int, value int"


def vectors(spark, rows):
    common.ready(spark)
    return spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], VECTORS).repartition(3)


def dense(values, k):
    x = np.floor(1024 * np.array(values, dtype=np.float32).astype(float)) + 100_000
    near = x - x.mean(axis=0)
    e, v = np.linalg.eigh(near.T @ near / len(x))
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return e, near @ v / np.sqrt(np.abs(e)), e / (near ** 2).sum() * len(x)


def checked(spark, rows, kept, k=8, tolerance=1e-9):
    grid = whitening.on_grid(vectors(spark, rows))
    learnt = whitening.fit(grid, k)
    got = sorted((r.vec_id, tuple(r.whitened)) for r in whitening.whitened(grid, learnt).collect())
    e, white, share = dense([v for _, v in kept], k)
    real = e > 1e-12 * e[0]
    e, white, share = e[real], white[:, real], share[real]
    assert np.allclose(learnt.deviations ** 2, e, rtol=1e-12) and np.allclose(learnt.explained, share, rtol=1e-12)
    assert whitening.identity_error(grid, learnt) < 1e-9
    mine = np.array([w for _, w in got])
    want = white[np.lexsort((np.arange(len(kept)), [i for i, _ in kept]))]
    assert np.allclose(mine * np.sign((mine * want).sum(axis=0)), want, atol=tolerance)
    return learnt


def test_whitening_equals_a_dense_solver(spark):
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    values = (rng.standard_normal((300, 12)) * 2.0 ** -np.arange(12)) @ turn
    rows = [(n, [float(c) for c in v]) for n, v in enumerate(values)]
    odd = [(1000, None), (1001, [None] * 12), (1002, [float("nan")] * 12), (1003, [float("inf")] + [0.0] * 11), (1004, [0.5] * 3), (1005, []), (1006, [3e38] * 12)]
    checked(spark, rows + odd, rows)


def test_few_directions_end_early_and_flat_ones_have_no_component(spark):
    rng = np.random.default_rng(4)
    values = np.round(rng.standard_normal((200, 3)) * [9, 5, 2]) @ np.array([[1, 0, 1, 0, 1, 0], [0, 1, 0, 1, 0, 1], [1, 1, -1, -1, 0, 0]])
    rows = [(n, [float(c) for c in v]) for n, v in enumerate(values)]
    assert len(checked(spark, rows, rows).deviations) == 3
    grid = whitening.on_grid(vectors(spark, rows))
    chain = whitening.Bidiagonal(grid, whitening.centre(grid))
    vector, beta = None, 0.0
    while not chain.settled(3, beta):
        vector, beta = chain.step(vector, beta)
    assert len(chain.right) <= 4


def test_equal_deviations_are_all_found(spark):
    """One chain sees one direction of an eigenvalue; the others come from fresh starts."""
    rows = [(2 * n + s, [float(8 * (1 - 2 * s)) if at == n else 0.0 for at in range(6)]) for n in range(6) for s in range(2)]
    grid = whitening.on_grid(vectors(spark, rows))
    learnt = whitening.fit(grid, 6)
    assert np.allclose(learnt.deviations, learnt.deviations[0]) and len(learnt.deviations) == 6
    assert whitening.identity_error(grid, learnt) < 1e-9 and np.allclose(learnt.components @ learnt.components.T, np.eye(6))


def test_deviations_are_exact_and_repeats_take_part(spark):
    rows = [(1, [0.25, -3.0]), (1, [0.25, -3.0]), (None, [1e9, 7.0]), (3, [-2.5e14, 0.1]), (4, [0.0, -0.0])]
    grid = whitening.on_grid(vectors(spark, rows))
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    want = sorted(sum((5 * c - s) ** 2 for c, s in zip(v, sums)) for v in x)
    got = [r.deviation for r in whitening.whitened(grid, whitening.fit(grid)).collect()]
    assert sorted(int(d) for d in got if d is not None) == [w for w in want if w < 10 ** 38] and len(got) == 5


def test_no_vectors_one_vector_and_equal_vectors(spark, tmp_path):
    for at, rows in enumerate(([], [(1, None)], [(1, [0.5, 0.25])], [(n, [0.5, 0.25]) for n in range(9)])):
        folder = str(tmp_path / f"table{at}")
        vectors(spark, rows).write.parquet(f"{folder}/embeddings.parquet")
        out = whitening.op11_whitening(spark, folder)
        assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_query_whitens_the_given_vectors(spark, sf_dir):
    out = whitening.op11_whitening(spark, sf_dir).toPandas()
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    e, white, share = dense(list(rows["embedding"]), 8)
    mine = out.pivot(index="vec_id", columns="component", values="whitened").loc[rows["vec_id"]].to_numpy()
    assert np.allclose(mine * np.sign((mine * white).sum(axis=0)), white, atol=1e-9)
    assert np.allclose(out.groupby("component")["explained"].first(), share, rtol=1e-12)
    assert out["identity_error"].nunique() == 1 and out["identity_error"].iloc[0] < 1e-9 and (out["n"] == len(rows)).all()
