"""The corpus operators against brute force on small fixtures with nulls, empties, ties, repeats and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import oracle
import pytest
import xxhash
from pyspark.sql import functions as F

from strataflow.llm import (
    common, language, mixing, packing, quality_rules, sharding, simhash, substring, toxicity, urlfilter, vptree,
)
from strataflow.session import settle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row int, key int, score int, shard int, body int"
BIG = (1 << 60) + 1  # not a double


def prose(seed: int, n: int, words: int = 4000) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n)).translate(str.maketrans("0123456789", "abcdefghij"))


def rows_of(texts: list[tuple]) -> list[tuple]:
    return [(i, t, ("en", "de", None)[n % 3], ("a", "a", "b", None)[n % 4], len(t or ""), 0, 1, 2, 3, 4) for n, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def texts():
    shared = prose(1, 120)
    whole = prose(2, 300)
    near = whole.split()
    near[150] = "changed"
    return [
        (5, whole), (7, whole), (7, whole), (6, " ".join(near)), (1, prose(3, 80) + "\n" + shared + "\n" + prose(4, 30)),
        (2, shared + "  " + prose(5, 200)), (3, prose(6, 60) + "\t" + shared), (10, None), (11, ""), (12, " \n\t "), (13, "one two"),
        (14, "a b c " * 40), (None, whole), (None, None), (BIG, prose(7, 5000) + " " + whole), (BIG + 1, "é#ü 12\n\né#ü 12\nX"),
        (15, shared + " " + shared), (16, "Ω" * 3000), (2, "another text under a used id " + shared), (20, " ".join(shared.split()[:50])),
        (21, " ".join(shared.split()[3:52])),
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    common.ready(spark)
    return spark.createDataFrame(rows_of(texts), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    common.ready(spark)
    return spark.createDataFrame([], DOCS)


def words(text) -> list[bytes]:
    return (text or "").encode().split()


# 1 substring dedup

def repeated(rows: list[tuple]) -> Counter:
    """(doc_id, words, removed, digest) by the definition."""
    first: dict[tuple, int] = {}
    for doc, text in rows:
        w = words(text)
        for s in range(len(w) - 49) if doc is not None else ():
            k = tuple(w[s:s + 50])
            first[k] = min(doc, first.get(k, doc))
    out = Counter()
    for doc, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - 49) if doc is not None else ():
            if first[tuple(w[s:s + 50])] < doc:
                gone[s:s + 50] = [True] * 50
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[doc, len(w), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_substring_dedup_equals_the_definition(docs, texts):
    got = substring.substring_dedup(docs)
    assert Counter((r.carry.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()) == repeated(texts)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_substring_dedup_on_mosaics(spark, seed):
    """Documents made of a few passages in many orders, with single words changed: branches everywhere."""
    rng = random.Random(seed)
    blocks = [prose(100 * seed + n, rng.randrange(5, 90), 6) if n % 3 == 0 else prose(100 * seed + n, rng.randrange(20, 90)) for n in range(12)]
    rows = []
    for doc in range(60):
        w = " ".join(rng.choice(blocks) for _ in range(rng.randrange(1, 7))).split()
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(3)}"
        rows.append((rng.randrange(50), " ".join(w)))
    found = substring.substring_dedup(spark.createDataFrame(rows_of(rows), DOCS))
    assert Counter((r.carry.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found.collect()) == repeated(rows)


def test_substring_texts_keep_their_columns(docs, none):
    out = substring.without_repeats(docs)
    assert out.schema.names == docs.schema.names and out.count() == docs.count()
    by = {(r.doc_id, r.text): r for r in out.collect()}
    assert (13, "one two") in by and by[13, "one two"].key == 1
    assert any(r.doc_id == 7 and r.text == "" and r.n_chars == 0 for r in by.values())
    assert substring.substring_dedup(none).count() == 0


def test_shortened_texts_have_the_counted_digest(docs):
    """The rows that the stage returns against the digests; texts that lose nothing keep their spacing, which a digest doesn't see."""
    digests = Counter((r.carry.doc_id, r.kept_sha256) for r in substring.substring_dedup(docs).collect())
    texts = Counter((r.doc_id, hashlib.sha256(b" ".join(words(r.text))).hexdigest()) for r in substring.without_repeats(docs).collect())
    assert texts == digests


def test_very_long_texts_are_cut_whole(spark):
    """More windows than are looked at together."""
    shared, long = prose(41, 150_000, 60_000), prose(42, 60_000, 60_000)
    rows = [(1, shared), (2, long + " " + shared), (3, " ".join(shared.split()[140_000:]))]
    got = substring.substring_dedup(common.ready(spark).createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.carry.doc_id, r.n_words, r.n_removed) for r in got} == {(1, 150_000, 0), (2, 210_000, 150_000), (3, 10_000, 10_000)}
    assert not substring._HASHES


def test_copies_of_a_row_do_not_lengthen_its_spans(spark):
    common.ready(spark)
    shared = prose(31, 120)
    late = prose(32, 70) + " " + shared + " " + prose(33, 70)
    rows = [(1, shared)] + [(2, late)] * 40 + [(3, prose(34, 60) + " " + shared)]
    base = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).select(
        "doc_id", substring.text_hash(F.col("text")).alias("row"), substring.body(F.col("text")).alias("body"))
    spans = {r.doc_id: sorted((s.start, s.length) for s in r.spans) for r in substring.repeated_spans(base).collect()}
    assert set(spans) == {2, 3} and all(len(s) == len(set(s)) <= 71 for s in spans.values())
    got = [r.n_removed for r in substring.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == [0] + [120] * 41


def test_shared_nodes_are_not_broadcast(spark, docs):
    base = docs.where("doc_id IS NOT NULL").select("doc_id", common.text_hash(F.col("text")).alias("row"), common.body(F.col("text")).alias("body"))
    plan = substring.repeated_spans(base)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"(\w+Join) \[node#", plan).group(1) == "SortMergeJoin"


# 2 quality rules

def test_quality_counts_equal_the_definition(docs, texts):
    got = Counter((r.key, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules.quality(docs).collect())
    want = Counter()
    for doc, text in texts:
        w, t = words(text), text or ""
        grams = Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if x.encode().split()]
        bad = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        want[doc, len(w), sum(len(x.decode()) for x in w), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), bad] += 1
    assert got == want


def test_common_lines_deplete_a_document_of_one_host_only(spark, none):
    line = "please accept all 12 cookies before you read on " * 6
    rows = [(n, prose(n, 60) + ("\n" + line if n < 30 else ""), "en", "a" if n % 2 else "b") for n in range(60)]
    rows += [(100, "\n".join([line.upper()] * 3) + "\n" + prose(100, 55), "en", "a"), (101, "\n".join([line] * 3) + "\n" + prose(101, 55), "en", "c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.key: r for r in quality_rules.quality(frame, least_docs=10, share=0.1).collect()}
    assert got[100].removed_words == 3 * 54 and not got[100].kept and got[101].removed_words == 0
    assert got[1].removed_words == 54 and got[1].kept and got[59].removed_words == 0
    doubled = {r.key: r for r in quality_rules.quality(frame.union(frame), least_docs=10, share=0.1).collect()}
    assert doubled[100].removed_words == got[100].removed_words
    assert quality_rules.quality(none).count() == 0


def test_a_line_is_as_common_in_a_large_host_as_in_a_small_one(spark):
    line = "please accept all cookies before you read on " * 9
    rows = [(n, prose(n, 60) + ("\n" + line if n % 100 == 0 else ""), "en", "hot") for n in range(2500)]
    rows += [(3000 + n, prose(n, 60) + "\n" + line, "en", "small") for n in range(25)]
    got = quality_rules.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).where("removed_words > 0").collect()
    assert {r.key for r in got} == {*range(0, 2500, 100), *range(3000, 3025)} and not any(r.kept for r in got)


def differs_from_sql(spark, tmp_path, rows, query, sql):
    """What a registered query and its SQL say of a table of documents."""
    common.ready(spark).createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    return oracle.compare(query(spark, str(tmp_path)), con, sql)


def test_quality_sql_has_the_limit_of_the_query(spark, tmp_path):
    """A host of 3,000 documents, thirty of which share a line: fewer than one in a hundred."""
    line = "please accept all cookies before you read on " * 9
    rows = [(n, prose(n, 60) + ("\n" + line if n % 100 == 0 else ""), "en", "hot") for n in range(3000)]
    assert differs_from_sql(spark, tmp_path, rows, quality_rules.op2_quality_rules, quality_rules.OP2_SQL) is None


def test_mixing_sql_has_the_budget_of_the_query(spark, tmp_path):
    """A stray document with a source of its own would thin out all others; sources that go with languages need more sweeps."""
    rows = [(n, prose(n, 40 + n % 90), ("en", "de", "fr")[n % 3 if n % 10 == 0 else 0], f"s{n % 7}") for n in range(900)] + [(5000, prose(1, 50), "en", "stray")]
    assert differs_from_sql(spark, tmp_path, rows, mixing.op10_mixing, mixing.op10_sql()) is None


# 3 sharding

def test_equal_rows_are_numbered_in_many_buckets(spark, monkeypatch):
    dealt, real = [], common.settle
    monkeypatch.setattr(common, "settle", lambda df, label: dealt.append(real(df, label)) or dealt[-1])
    rows = spark.range(20_000).select(F.lit(1).alias("g"), F.lit(7).alias("a"))
    got = common.prefix_ranks(rows, ["g"], ["a"], 16, "n")
    assert sorted(r.n for r in got.collect()) == list(range(20_000))
    sizes = [r["count"] for r in dealt[0].groupBy("__bucket").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 20_000 / 16


def test_shards_are_stable_gapless_and_near_their_weights(docs, texts, none):
    got = sharding.shard(docs, [1.0] * 24, grown=[1.0] * 25).collect()
    assert len(got) == len(texts)
    assert Counter((r.key, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in got if r.key == 7}) == 1
    assert sharding.shard(none, [1.0]).count() == 0


def test_weights_and_lost_shards(spark):
    keys = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    got = keys.select("doc_id", sharding.rendezvous(F.col("doc_id"), [1.0, 2.0, 5.0]).alias("a"),
                      sharding.rendezvous(F.col("doc_id"), {0: 1.0, 2: 5.0}).alias("b")).collect()
    share = Counter(r.a for r in got)
    assert abs(share[1] / 20000 - 0.25) < 0.02 and abs(share[2] / 20000 - 0.625) < 0.02
    assert all(r.a == r.b for r in got if r.a != 1)
    with pytest.raises(ValueError):
        sharding.rendezvous(F.lit(1), [1.0, 0.0])


# 4 toxicity

def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_accepts_what_the_distance_says():
    terms = ["idiot", "pathetic", "disgusting", "scum", "vequ*", "lostrasch*"]
    lexicon, rng = toxicity.Lexicon(terms), random.Random(4)
    tried = list(map(str.lower, ["idi0t", "idiotic", "idit", "iidiot", "patetic", "pathetics", "disgustng", "dsgustin", "scum", "scun", "vequatre", "veqatre", "lostraschig", "lostrschig", ""]))
    for _ in range(3000):
        word = list(rng.choice(terms).rstrip("*"))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(word) + 1)
            word[at:at + rng.randrange(2)] = rng.choice(["", "a", "e", "s", "t"])
        tried.append("".join(word) + rng.choice(["", "", "e", "chen"]))
    for word in tried:
        want = set()
        for n, term in enumerate(terms):
            bare, stem = term.rstrip("*"), term.endswith("*")
            parts = [word[:k] for k in range(len(word) + 1)] if stem else [word]
            if min(distance(bare, p) for p in parts) <= toxicity.edits(bare, stem):
                want.add(n)
        assert set(lexicon.match(word)) == want, word


def test_quotations_weigh_less():
    lexicon = toxicity.Lexicon(["idiot"])
    assert toxicity.uses(lexicon, "you are an idiot and a fool") == {0: 1.0}
    assert toxicity.uses(lexicon, 'he heard "you are an idiot" and left') == {0: toxicity.QUOTED}
    assert toxicity.uses(lexicon, "she said idiot is a bad word") == {0: toxicity.QUOTED}
    assert toxicity.uses(lexicon, "") == {}


def test_toxicity_learns_from_the_right_rows_and_spares_the_clean(spark, docs, none):
    rng, rows, labels = random.Random(9), [], []
    for n in range(400):
        bad, text = n % 5 == 0, prose(n, 80).split()
        if bad:
            for _ in range(4):
                text.insert(rng.randrange(80), rng.choice(["blargface", "snorfwit", "grumbletoad"]))
        rows.append((n, " ".join(text)))
        labels.append((n, int(bad), 7))
    frame = spark.createDataFrame(rows_of(rows), DOCS)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, text int")
    model = toxicity.learnt(frame, marks)
    assert {"blargface", "snorfwit", "grumbletoad"} <= set(model.terms)
    got = {r.row.doc_id: r.score for r in toxicity.scored(frame, model).collect()}
    assert all((got[n] >= 0.7) == (n % 5 == 0) for n in range(400))
    assert model.score("you blargfase and snorfwitt and grumbletoed and blargface") > 0.7
    kept = toxicity.without_toxic(docs, model)
    assert kept.schema == docs.schema and kept.count() == docs.count()
    blank = toxicity.learnt(none, marks.limit(0))
    assert blank.terms == [] and 0 <= blank.score("") <= 1 and toxicity.scored(none, blank).count() == 0
    flipped = marks.withColumn("toxic", F.when(common.fold_remainder(F.col("doc_id"), 3) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.learnt(frame, flipped).terms == model.terms


def test_an_id_of_many_rows_does_not_widen_the_samples(spark):
    rows = [(7, prose(n, 30)) for n in range(500)] + [(n, prose(n, 30)) for n in range(600, 620)]
    frame = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, i % 2) for i in [7, *range(600, 620)]], "doc_id long, toxic int")
    drawn = toxicity.labelled(frame, marks, F.lit(True)).collect()
    assert sorted(r.key for r in drawn) == [7, *range(600, 620)]
    assert {r.text for r in drawn if r.key == 7} == {min(t for i, t in rows if i == 7)}
    one, many = (language.fit(f, F.lit(True), sample_docs=10_000, sample_chars=10**6) for f in (frame.where("doc_id <> 7"), frame))
    # One more text of at most 200 letters with its end mark.
    assert one.bits[0] < many.bits[0] <= np.log2(2 ** one.bits[0] + 201)


# 5 nearest neighbours

def test_factor_one_is_exact_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(n, [float(x) for x in rng.integers(-2, 3, 6)]) for n in range(300)]
    rows += [(300 + n, rows[20][1]) for n in range(60)] + [(20, rows[20][1])]
    odd = [(400, None), (401, []), (402, [0.0] * 6), (403, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (404, [float("nan")] * 6), (405, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]),
           (None, [1.0] * 6), (420, [1.0, 2.0]), (440, [3.0, 1.0]), (421, [9.0, 9.0])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], "vec_id long, embedding array<double>, rank int")
    got = defaultdict(list)
    for r in vptree.neighbours(frame, lambda i: i % 20 == 0, k=20, relax=1.0, values=400).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    seen = {i: v for i, v in rows if any(v)} | {i: v for i, v in odd if i in (420, 440, 421)}
    for q in [i for i in seen if i % 20 == 0]:
        want = sorted((-sum(a * b for a, b in zip(seen[q], v)), i) for i, v in seen.items() if i != q and len(v) == len(seen[q]))[:20]
        assert sorted(got.pop(q)) == [(n + 1, i, -s) for n, (s, i) in enumerate(want)]
    assert not got
    several = spark.createDataFrame([(1, [float(n), 1.0]) for n in range(200)] * 2 + [(20, [1.0, 0.0])], "vec_id long, embedding array<double>")
    found = vptree.neighbours(several, lambda i: i == 20, k=5, relax=1.0, values=40).collect()
    assert sorted((r.rank, r.vec_id, r.score) for r in found) == [(n, 1, 200.0 - n) for n in range(1, 6)]
    assert vptree.neighbours(frame.limit(0), lambda i: i % 20 == 0).count() == 0


def test_recall_of_the_relaxed_search(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    data = frame.select("vec_id", "embedding").toPandas().sort_values("vec_id")
    ids, matrix = data["vec_id"].to_numpy(), np.stack(data["embedding"]).astype(float)
    got = defaultdict(set)
    for r in vptree.neighbours(frame, lambda i: i % 20 == 0, values=1 << 13).collect():
        got[r.query_id].add(r.vec_id)
    hit = [len(got[int(ids[q])] & set(vptree.exact(matrix, ids, q, 20))) / 20 for q in range(len(ids)) if ids[q] % 20 == 0]
    assert np.mean(hit) >= 0.9


# 6 language

def test_suffix_automaton_knows_exactly_the_substrings():
    text = [2, 3, 2, 2, 3, 4, 2, 3, 2, 3]
    steps = language.suffix_automaton(text)
    inside = {tuple(text[a:b]) for a in range(len(text)) for b in range(a + 1, len(text) + 1)}

    def accepted(word) -> bool:
        state = 0
        for c in word:
            state = steps[state, c]
            if state < 0:
                return False
        return True

    for n in range(1, 5):
        for k in range(3 ** n):
            word = tuple(2 + k // 3 ** j % 3 for j in range(n))
            assert accepted(word) == (word in inside)


def test_phrases_are_longest_matches():
    model = language.Model.fit({"x": ["banana bandana"], "y": ["ananas kanada"]})
    for text in ["banana", "anabana zz", "kanadabandana", "q", "ban" * 900]:
        for column, sample in enumerate(["banana bandana", "ananas kanada"]):
            count = 0
            for first in range(0, len(text), language.BLOCK):
                block, at = text[first:first + language.BLOCK], 0
                while at < len(block):
                    size = 1  # a letter that no phrase starts with is one of its own
                    while block[at] in sample and at + size < len(block) and block[at:at + size + 1] in sample:
                        size += 1
                    at, count = at + size, count + 1
            assert model.phrases([text])[0, column] == count


def test_every_letter_of_every_script_counts():
    rng, letters = random.Random(4), {"a": 0x61, "b": 0x430, "c": 0x4E00, "d": 0x5E00, "e": 0x20000}
    texts = {n: ["".join(chr(at + rng.randrange(25 if at < 0x500 else 300)) for _ in range(600))] for n, at in letters.items()}
    for cells in (language.CELLS, 1):
        model = language.Model.fit(texts, cells=cells)
        for name, (sample,) in texts.items():
            assert model.predict([sample[100:200]])[0] == [name]
            text, at, count = sample[40:90] + sample[7:30] + sample[300:301] + chr(0x3B1), 0, 0
            while at < len(text):
                size = 1
                while text[at] in sample and at + size < len(text) and text[at:at + size + 1] in sample:
                    size += 1
                at, count = at + size, count + 1
            assert model.phrases([text])[0, sorted(texts).index(name)] == count


def test_more_languages_than_are_parsed_at_once(spark):
    rows = [(n, prose(n % 70, 30), f"l{n % 70:02}") for n in range(140)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert len(model.languages) == 70 > language.GROUP
    assert model.predict([language.letters(prose(n, 30)[:150]) for n in (3, 69)])[0] == ["l03", "l69"]


def test_language_on_the_given_documents_and_odd_rows(spark, sf_dir, docs, none):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.fit(given, common.fold_remainder(F.col("doc_id"), 4) != 2)
    found = language.identify(given, model).where("held_out").join(given.select(F.col("doc_id").alias("key"), "lang"), "key")
    right = [r.lang == r.lang_pred for r in found.collect() if r.lang is not None]
    assert len(right) > 20 and np.mean(right) >= 0.98
    odd = {r.key: r for r in language.identify(docs, model).collect()}
    assert odd[10].lang_pred == odd[11].lang_pred == odd[12].lang_pred == "und" and odd[10].score == 0.0
    assert all(0 <= r.score <= 1 for r in odd.values()) and BIG in odd
    empty = language.fit(none, F.lit(True))
    assert [r.lang_pred for r in language.identify(docs, empty).distinct().collect()] == ["und"] * language.identify(docs, empty).distinct().count()
    assert language.identify(none, model).count() == 0


def test_pieces_come_from_anywhere_in_a_text(spark):
    """Texts of two languages behind one long header: the header alone tells nothing, what follows does."""
    header = "this page is kept by the council of the town and may be read by all who live there " * 40
    rows = [(n, header + prose(n, 300, 40) if n % 2 else header + " ".join(f"za{w}ok" for w in prose(n, 300, 40).split()), "w" if n % 2 else "z") for n in range(120)]
    docs = common.ready(spark).createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, F.lit(True), sample_docs=1000)
    assert max(len(model.languages), 0) == 2
    names, _ = model.predict([language.letters(prose(500, 100, 40)), language.letters(" ".join(f"za{w}ok" for w in prose(501, 100, 40).split()))])
    assert names == ["w", "z"]
    assert language.sampled("abcdef", 4, 3) in ("abc", "bcd", "cde", "def") and language.sampled("ab", 9, 3) == "ab"
    assert language.shared_out(["a" * 10, "b", "c" * 100], 21) == ["a" * 10, "b", "c" * 10] and language.shared_out([], 5) == []


def test_number_signs_are_no_letters():
    assert [language.letters(t) for t in ("12 \u00b2 \u00bd _", "x\u00b2", "\u00d1\u00d8 1", None)] == ["", "x\u00b2", "\u00f1\u00f8", ""]


# 7 packing

def test_fast_ids_equal_the_tokenizer_s():
    import public_tokenizers
    from tokenizers import Tokenizer

    exact, encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.encoder()
    for text in ["", " ", "a  b\n\n c", "don't we'll", "x<|endoftext|>y", "Ωμέγα 123456 ｆｕｌｌ", "\u00a0\u2003z", "#" * 500, "\r\n\t end ", "🙂🙂"]:
        assert encode(text) == exact.encode(text, add_special_tokens=False).ids


def test_pieces_rebuild_the_documents_and_fit_gapless(docs, texts, none):
    got, encode = packing.packed(docs).collect(), packing.encoder()
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    want = Counter()
    for doc, text in texts:
        ids = [*encode(text or ""), 2]
        starts = [0, *range((len(ids) - 1) % 1024 + 1, len(ids), 1024)]
        for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            want[doc, n, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert packing.packed(none).count() == 0


def test_plan_is_best_fit_decreasing():
    rng = random.Random(3)
    for _ in range(60):
        capacity = rng.choice([7, 20, 64])
        lengths = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 120))]
        rooms = []
        for n in sorted(lengths, reverse=True):
            fit = [r for r in rooms if r >= n]
            rooms.append(capacity) if not fit else None
            best = min(fit, default=capacity)
            rooms.remove(best)
            rooms.append(best - n)
        used, ranks = defaultdict(int), Counter()
        for length, first, last, base, per, at in packing.plan(Counter(lengths), capacity):
            for r in range(first, last + 1):
                used[base + (r - first) // per] += length
                ranks[length, r] += 1
        assert sorted(capacity - r for r in rooms) == sorted(used.values())
        assert ranks == Counter((n, r) for n, c in Counter(lengths).items() for r in range(c))


# 8 url filters

def test_cascade_is_exact_on_its_universe(spark):
    keys = spark.range(30000).select(F.concat(F.lit("host"), "id").alias("key"), (F.xxhash64("id") % 9 == 0).alias("listed"))
    found = urlfilter.cascade(keys.union(keys.limit(10)).union(spark.createDataFrame([(None, True)], "key string, listed boolean")))
    assert len(found.levels) > 3 and found.bytes < 30000 and keys.where(found.member(F.col("key")) != F.col("listed")).count() == 0
    for every in (True, False):
        flat = urlfilter.cascade(keys.limit(50).withColumn("listed", F.lit(every)))
        assert keys.limit(50).where(flat.member(F.col("key")) != F.lit(every)).count() == 0
    with pytest.raises(ValueError):
        urlfilter.cascade(keys, max_bytes=100)
    split = urlfilter.cascades(keys, max_bytes=1500)
    assert len(split) > 1 and all(c.bytes <= 1500 for c in split)
    pages = keys.select("key", "listed", F.concat(F.lit("http://"), "key", F.lit(".net/x")).alias("url"), F.monotonically_increasing_id().alias("page_id"))
    whole = urlfilter.cascades(pages.select(urlfilter.host_of(F.col("url")).alias("key"), "listed"), max_bytes=1500)
    judged = urlfilter.judge(pages, whole).join(pages.select("page_id", "listed"), "page_id")
    assert judged.count() == keys.count() and judged.where((F.col("verdict") == "block") != F.col("listed")).count() == 0


def test_rules_and_parts(spark):
    cases = {
        "http://WWW.Example.org/en/1?x": ("www.example.org", "/en/1", "example.org/en/1", "block"), "https://a.org": ("a.org", "", None, "allow"),
        "https://b.example.org/es/2#t": ("b.example.org", "/es/2", "example.org/es/", "block"), "x://notorg/": ("notorg", "/", None, "allow"),
        "http://s.com/de/": ("s.com", "/de/", "com/de/", "block"), "http://s.com/fr/1": ("s.com", "/fr/1", "com/fr/", "allow"),
        "http://h.net?u=http://z.org/": ("h.net", "", None, "allow"), "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "http://org/a": ("org", "/a", "org/", "allow"), "http://bad.net/\n/x": ("bad.net", "/\n/x", None, "block"), "": ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(n, u, "h") for n, u in enumerate(cases)], "page_id long, url string, host string")
    listed = urlfilter.cascade(spark.createDataFrame([("bad.net", True), ("h.net", False), ("notorg", False), ("", False), ("a.org", False)], "key string, listed boolean"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(pages, listed).collect()}
    assert [got[n] for n in range(len(cases))] == list(cases.values())
    assert urlfilter.judge(pages.limit(0), urlfilter.cascade(urlfilter.host_list(pages.limit(0)))).count() == 0


# 9 simhash

def mark(text) -> int:
    w = words((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    if not w:
        return 0
    grams = [b" ".join(g) for g in zip(w, w[1:], w[2:])] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_and_components(docs, texts, none):
    marks, got = [mark(t) for _, t in texts], simhash.near_duplicates(docs).collect()
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if (marks[a] ^ marks[b]).bit_count() <= 3:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {g: min((texts[n][0] for n in range(len(texts)) if group[n] == g and texts[n][0] is not None), default=None) for g in group}
    assert Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got) == Counter((texts[n][0], marks[n], least[group[n]]) for n in range(len(texts)))
    kept = simhash.without_near_duplicates(docs)
    assert kept.schema == docs.schema and kept.count() == len(set(group))
    assert simhash.near_duplicates(none).count() == 0 and simhash.without_near_duplicates(none).count() == 0


def test_no_link_is_lost_at_the_anchors(spark):
    rng, base = random.Random(8), []
    for _ in range(150):
        x = rng.getrandbits(64)
        base.append(x)
        for flips in (1, 2, 3, 4, 5):
            y = x
            for b in rng.sample(range(64), flips):
                y ^= 1 << b
            base.append(y)
    base = sorted(set(base))
    signed = [x - (1 << 64) if x >> 63 else x for x in base]
    got = {(r.u, r.v) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    want = {tuple(sorted((a, b))) for n, a in enumerate(signed) for b in signed[:n] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert got == want
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([], "fp long"), 4)


def test_neither_anchors_nor_marks_are_broadcast(spark, docs):
    """Files of fingerprints look small beside their anchors, or beside the marks of copies."""
    nodes = settle(spark.range(500).select(F.xxhash64("id").alias("fp")), "few-fingerprints")
    found = simhash.links(nodes)
    found.collect()
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    whole = simhash.near_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"\w+Join \[fp#", whole).group().startswith("SortMergeJoin")


def test_components_of_paths_stars_and_rings(spark):
    pairs = [(n, n + 1) for n in range(100, 140)] + [(7, n) for n in range(300, 360)] + [(1000 + n, 1000 + (n + 1) % 9) for n in range(9)] + [(5, 5)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(pairs, "u long, v long"), "rings").collect()}
    assert got == {n: 100 for n in range(100, 141)} | {7: 7} | {n: 7 for n in range(300, 360)} | {n: 1000 for n in range(1000, 1009)}


# 10 mixing

def test_raking_meets_the_targets(spark):
    rng, cells = random.Random(2), []
    for s in "abcd":
        for lang in ("en", "de"):
            for t in "xyz":
                cells.append((s, lang, t, rng.randrange(100, 5000) * (9 if s == "a" else 1)))
    frame = spark.createDataFrame(cells, "source string, lang string, topic string, mass long")
    want = {"source": dict(a=.25, b=.25, c=.3, d=.2), "lang": dict(en=.6, de=.4), "topic": dict(x=.2, y=.3, z=.5)}
    targets = {d: spark.createDataFrame(list(v.items()), f"{d} string, share double") for d, v in want.items()}
    got = mixing.rake(frame, targets, sweeps=12).collect()
    for d, shares in want.items():
        for value, share in shares.items():
            assert abs(sum(r.weight for r in got if r[d] == value) - share) < 1e-6


def test_drawn_documents_follow_their_probability(spark, docs, none):
    rows = [(n, prose(n, 40), "en" if n % 4 else "de", "big" if n % 3 else "small") for n in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    chances = mixing.calibrated(frame).select("row.doc_id", "source", "lang", "tokens", "probability").toPandas()
    assert chances["probability"].max() == 1.0 and len(chances) == 3000
    drawn = {r.doc_id for r in mixing.sample(frame).collect()}
    for _, cell in chances.groupby(["source", "lang"]):
        expected, found = cell["probability"].sum(), sum(i in drawn for i in cell["doc_id"])
        assert abs(found - expected) <= 5 * max(1.0, (cell["probability"] * (1 - cell["probability"])).sum() ** 0.5)
    assert mixing.sample(docs).schema == docs.schema and mixing.calibrated(docs).count() == docs.count()
    assert mixing.sample(none).count() == 0


def test_a_stray_source_does_not_thin_out_the_corpus(spark):
    texts = {n: prose(n, 100) for n in range(50)}
    rows = [(n, texts[n % 50], ("en", "de")[n % 2], f"s{n % 4}") for n in range(4000)]
    frame = spark.createDataFrame([*rows, (4000, "one stray word", "en", "stray"), (4001, "and one", None, None)], "doc_id long, text string, lang string, source string")
    chances = mixing.calibrated(frame).select("row.doc_id", "tokens", "probability").toPandas()
    kept = (chances["tokens"] * chances["probability"]).sum() / chances["tokens"].sum()
    assert abs(kept - mixing.BUDGET) < 1e-6 and chances["probability"].max() == 1.0
    assert (chances[chances["doc_id"] >= 4000]["probability"] == 1.0).all()
    assert mixing.sample(frame).count() > 2200
    even = mixing.calibrated(spark.createDataFrame(rows, frame.schema)).agg(F.min("probability")).first()[0]
    assert even > 0.99


def correlated(spark, aligned: float):
    """Six sources, each nearly one language, and three topics."""
    cells = []
    for s in range(6):
        for lang in range(3):
            for n, t in enumerate("xyz"):
                share = aligned if lang == s % 3 else (1 - aligned) / 2
                cells.append((f"s{s}", f"l{lang}", t, int(1e6 * share * (s + 1) ** 2 * (n + 1))))
    return spark.createDataFrame(cells, "source string, lang string, topic string, mass long")


def test_raking_goes_on_until_correlated_cells_meet_the_targets(spark):
    frame = correlated(spark, 0.95)
    targets = {d: mixing.flattened(frame, d, mixing.FLATTEN[d]) for d in mixing.DIMENSIONS}
    got = mixing.rake(frame, targets).toPandas()
    for d in mixing.DIMENSIONS:
        shares = {r[d]: r.share for r in targets[d].collect()}
        for value, weight in got.groupby(d)["weight"].sum().items():
            assert abs(weight / shares[value] - 1) <= mixing.TOLERANCE


def test_raking_reports_targets_that_cannot_be_met(spark):
    frame = spark.createDataFrame([("a", "en", "x", 100), ("b", "de", "x", 100)], "source string, lang string, topic string, mass long")
    want = {"source": dict(a=.7, b=.3), "lang": dict(en=.5, de=.5), "topic": dict(x=1.0)}
    targets = {d: spark.createDataFrame(list(v.items()), f"{d} string, share double") for d, v in want.items()}
    with pytest.warns(UserWarning, match="cannot be met"):
        assert mixing.rake(frame, targets).count() == 2
