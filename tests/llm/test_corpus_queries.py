"""The registered corpus queries against their oracles, and the pipeline stage by stage."""

from __future__ import annotations

from collections import defaultdict

import corpus_pipeline
import oracle
import pytest
from test_corpus_operators import DOCS, mark, prose, repeated, rows_of

from strataflow.llm import common, packing
from strataflow.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(name, spark, sf_dir):
    assert oracle.compare(QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), ORACLES[name]) is None


def test_every_operator_has_one_query():
    assert [n.split("_")[0] for n in QUERIES] == ["pipeline", *[f"op{n}" for n in range(1, 14)]]
    assert [name.split()[0] for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "substring", "mixing", "best-fit"]


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op3_sharding", "op4_toxicity", "op5_nearest_neighbours", "op6_language_id", "op7_best_fit_packing", "op9_simhash", "op13_jaccard_join"])
def test_query_returns_a_row_for_every_document(name, spark, sf_dir):
    out = QUERIES[name](spark, sf_dir)
    if name == "op5_nearest_neighbours":
        asked = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where("vec_id % 20 = 0").count()
        assert out.count() == 20 * asked
    else:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        assert out.select("doc_id").distinct().count() == docs.count()


def test_pipeline_on_the_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left = {r.doc_id: r.text for r in corpus_pipeline.drop_toxic(spark, docs, sf_dir).collect()}
    toxic = {r.doc_id for r in QUERIES["op4_toxicity"](spark, sf_dir).where("predicted = 1").collect()}
    assert set(left) == {r.doc_id for r in docs.collect()} - toxic
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in out} <= set(left)
    by = defaultdict(list)
    for r in out:
        by[r.sequence_id].append((r.offset, r.length))
    assert all(sum(n for _, n in parts) <= packing.CAPACITY for parts in by.values())


def test_middle_stages_equal_their_definitions(spark, sf_dir):
    whole = prose(21, 200)
    near = whole.split()
    near[100] = "other"
    texts = [(3, whole), (1, whole), (2, " ".join(near)), (4, prose(22, 90)), (4, prose(22, 90)), (5, prose(23, 70) + " " + prose(22, 90)), (6, None), (7, "")]
    docs = common.ready(spark).createDataFrame(rows_of(texts), DOCS)
    once = corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir)
    kept = sorted((r.doc_id, r.text) for r in once.collect())
    same = (mark(whole) ^ mark(" ".join(near))).bit_count() <= 3
    assert [i for i, _ in kept] == ([1, 4, 5, 6] if same else [1, 2, 4, 5, 6])
    cut = corpus_pipeline.cut_repeats(spark, once, sf_dir)
    want = {k[0]: k for k in repeated(kept)}
    assert {r.doc_id: len((r.text or "").encode().split()) for r in cut.collect()} == {i: k[1] - k[2] for i, k in want.items()}
    assert cut.schema.names == docs.schema.names
    mixed = corpus_pipeline.mix_sources(spark, cut, sf_dir)
    assert mixed.schema.names == docs.schema.names
    assert {r.doc_id for r in corpus_pipeline.pack_sequences(spark, mixed, sf_dir).collect()} == {r.doc_id for r in mixed.collect()}


def test_stages_take_an_empty_table(spark, sf_dir):
    docs = common.ready(spark).createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs, sf_dir).count() == 0
