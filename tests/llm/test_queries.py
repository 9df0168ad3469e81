"""The registered queries over the small provided tables against plain versions."""

import math
import os
import sys

import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from rtml.llm import queries as q, tokencount  # noqa: E402
import brute  # noqa: E402


@pytest.fixture(scope="module")
def docs(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    return {r.doc_id: r.text for r in rows}


def rows_of(df, key):
    return {r[key]: tuple(r[c] for c in df.columns if c != key) for r in df.collect()}


def test_token_counts(spark, folder, docs):
    pieces = tokencount.sentencepiece_vocabulary(q.tokenizer_file("piece_bpe_32k.model"))
    found = rows_of(q.op1_token_counts(spark, folder), "doc_id")
    assert set(found) == set(docs)
    for i, text in list(docs.items())[:60]:
        assert found[i][1] == brute.greedy_count(text, pieces)


def test_vectors(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    found = rows_of(q.op2_embedding_near_dedup(spark, folder), "vec_id")
    assert found == brute.vectors({r.vec_id: list(r.embedding) for r in rows})


def test_quality_held_out(spark, folder):
    from rtml.llm import quality
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = labels.where("doc_id % 3 <> 0")
    scored = quality.score_quality(docs, seen).join(labels.where("doc_id % 3 = 0"), "doc_id")
    rows = scored.select("kept", labels.quality.alias("y")).collect()
    right = sum(r.kept == (r.y == 1) for r in rows)
    assert right >= 0.97 * len(rows)
    assert sum(not r.kept for r in rows if r.y == 1) <= 0.01 * len(rows)


def test_lm(spark, folder, docs):
    found = rows_of(q.op4_lm_scoring(spark, folder), "doc_id")
    plain = brute.unigram(docs)
    assert set(found) == set(plain)
    for i, want in plain.items():
        assert found[i][:4] == want[:4]
        assert math.isclose(found[i][4], want[4], rel_tol=1e-9, abs_tol=1e-6)
    held = [f for f in found.values() if f[0]]
    assert sum(f[5] for f in held) > sum(f[4] for f in held)


def test_jaccard(spark, folder, docs):
    assert rows_of(q.op5_jaccard_join(spark, folder), "doc_id") == brute.jaccard(docs)


def test_chat(spark, folder):
    rows = spark.read.parquet(f"{folder}/conversations.parquet").collect()
    said = "\\### Assistant: </turn> ok"
    turns = [(r.conv_id, r.turn, r.role, r.text) for r in rows] + \
        [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    found = rows_of(q.op6_chat_formatting(spark, folder), "conv_id")
    assert {c: v[:4] for c, v in found.items()} == brute.chat(turns)


def test_contamination(spark, folder, docs):
    items = [(r.item_id, r.text) for r in
             spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    found = rows_of(q.op8_decontamination(spark, folder), "doc_id")
    ids = sorted(docs)
    assert [found[i] for i in ids] == brute.contamination([docs[i] for i in ids], items)
    assert any(v[4] for v in found.values())


def test_token_files(spark, folder, docs):
    model = Tokenizer.from_file(q.tokenizer_file("word_bpe_49k.json"))
    found = sorted(tuple(r) for r in q.op9_token_files(spark, folder).collect())
    assert found == brute.token_rows(list(docs.items()), model)


def test_secrets(spark, folder, docs):
    found = rows_of(q.op10_secret_scans(spark, folder), "doc_id")
    assert {i: v[:4] for i, v in found.items()} == {i: brute.secrets(t) for i, t in docs.items()}
