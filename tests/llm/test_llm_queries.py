"""The registered queries against brute force or their SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import public_tokenizers as P
from tests.llm import brute
from tests.oracle_check import compare, connect


@pytest.fixture(scope="module")
def docs(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


BRUTE = {
    "op2_secrets": brute.secret_rows,
    "op3_bpe_round_trip": lambda d: brute.bpe_rows(d, P.path("byte_bpe_50k.json")),
    "op6_token_records": lambda d: brute.record_rows(d, P.path("word_bpe_49k.json")),
    "op8_substring_dedup": brute.repeats,
    "op10_simhash": lambda d: brute.simhash_rows(d, 4, 4),
}


@pytest.mark.parametrize("name", BRUTE)
def test_query_matches_brute_force(spark, sf, docs, name):
    assert sorted(tuple(r) for r in entry.queries()[name](spark, sf).collect()) == sorted(BRUTE[name](docs))


def test_vectors_match_brute_force(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in entry.queries()["op4_vector_dedup"](spark, sf).collect())
    assert got == brute.vector_rows(rows)


@pytest.mark.parametrize("name", ["op5_decontamination", "op7_line_dedup", "op9_url_filter", "op12_merkle_manifest", "op13_conversation_trie"])
def test_query_matches_sql(spark, sf, name):
    result, _ = compare(spark, connect(sf), sf, entry.queries()[name], entry.oracle_sql()[name])
    assert result == "ok"


def test_toxicity_holds_out_a_fifth(spark, sf, docs):
    rows = entry.queries()["op1_toxicity"](spark, sf).collect()
    assert {r.doc_id for r in rows} == {i for i, _ in docs}
    assert {r.held_out for r in rows} == {True, False} and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.5) for r in rows)


def test_language_model_scores_every_document(spark, sf, docs):
    rows = entry.queries()["op11_language_model"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in docs)
    assert len({r.train_tokens for r in rows}) == 1 and all(r.score < 0 and r.n_known <= r.n_tokens for r in rows)
    # Held-out words cost some hundred bits at most on average.
    out = [r for r in rows if r.held_out]
    assert out and sum(r.score for r in out) / sum(r.n_tokens for r in out) > -30


def test_all_are_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
