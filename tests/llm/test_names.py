"""Columns named like the operators' own, and roles that stand as they are written."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from rtml.llm import chat, jaccard, mixing  # noqa: E402

OWN = ("_gone", "_again", "_row", "_key", "_mc", "_mk", "_ms", "_mh", "_s", "_h", "row", "key", "copies")


def table(spark, rows):
    kind = "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in OWN)
    return spark.createDataFrame([(*r, *[f"{c}{i}" for c in OWN]) for i, r in enumerate(rows)], kind)


def test_keep_one_keeps_all_columns(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text, "a"), (2, text, "a"), (3, "other words stand in this text here", "b"),
            (3, text + " more", "b"), (3, "other words stand in this text here", "b"), (None, text, None)]
    docs = table(spark, rows)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    assert sorted(r.doc_id or 0 for r in found) == [0, 1]
    assert all(r._gone == r._gone.replace(r._gone, f"_gone{r.key[3:]}") for r in found)
    lone = jaccard.keep_one(docs.where("source = 'b' AND text LIKE 'other%'"))
    assert [(r.doc_id, r._again[:6]) for r in lone.collect()] == [(3, "_again")]


def test_mix_keeps_all_columns(spark):
    rows = [(i, "some words " * (i % 3 + 1), "big" if i % 10 else "small") for i in range(60)]
    docs = table(spark, rows)
    plan = mixing.mixture(docs, max_repetition=2.0)
    mixed = mixing.mix(docs, plan)
    assert mixed.columns == docs.columns
    times = {r.doc_id: r.copies for r in mixing.mixed_ids(docs, plan).collect()}
    found = [r.doc_id for r in mixed.collect()]
    assert {i: found.count(i) for i in times} == times
    assert {r._mc for r in mixed.collect()} <= {f"_mc{i}" for i in range(60)}


@pytest.mark.parametrize("role", ["a\\b", "assistant", "x: y", "</turn>", "a\\s"])
def test_mask_starts_after_the_written_role(spark, role):
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, role, "said \\ this"),
                                   (1, 2, role, "</turn> and ### this")],
                                  "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(turns, trained_role=role)
    row = chat.conversation_digests(out).first()
    import hashlib
    want = "said \\ this</turn> and ### this"
    assert (row.loss_chars, row.loss_sha256) == (len(want), hashlib.sha256(want.encode()).hexdigest())
