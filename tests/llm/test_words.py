"""Language identification, spelling variants and collocations against plain versions."""

import itertools
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from brute import LOWER  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from rtml.llm import collocations, langid, queries, variants  # noqa: E402

CLASH = "id long, word string, n long, key long, role byte, ids string, row long, miss string, " \
    "lang_pred string, score double, segment string, h long, total long, phrase string"
N_CLASH = len(CLASH.split(","))


def table(spark, rows):
    kind = f"doc_id long, text string, lang string, source string, {CLASH}"
    return spark.createDataFrame([(*r, None, *[None] * N_CLASH) for r in rows], kind)


@pytest.fixture(scope="module")
def real(spark, folder):
    return [(r.doc_id, r.text, r.lang) for r in
            spark.read.parquet(f"{folder}/documents.parquet").collect()]


def rows_of(df, *key):
    out = {tuple(r[k] for k in key): tuple(r[c] for c in df.columns if c not in key)
           for r in df.collect()}
    return {k[0] if len(key) == 1 else k: v for k, v in out.items()}


# collocations

def brute_phrases(rows, least, longest=5, top=2000):
    """{(lang, rank): (phrase, a, l, r, n, score)} by slicing every piece."""
    grams, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                grams[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = {}
    for lang, f in grams.items():
        good = {g: a for g, a in f.items() if a >= least and len(g) > 1}
        found = []
        for g, a in good.items():
            inside = [h for h in good if len(h) > len(g) and good[h] >= a and
                      any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1))]
            if not inside:
                score, k = min((1000 * a * total[lang] // (f[g[:k]] * f[g[k:]]), k)
                               for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(found)[:top]):
            out[lang, i + 1] = (p.decode(), -a, left, right, total[lang], -s)
    return out


def phrase_rows():
    draw = random.Random(5)
    rows = []
    for i in range(120):
        words = [f"w{min(int(draw.expovariate(0.2)), 30)}" for _ in range(60)]
        words[10:10] = ["New", "york", "city", "hall", "of", "fame"][:draw.randrange(2, 7)]
        words[30:30] = ["é,", "a.b", "x\x0by", "　wide", "z\x1cz"]
        rows.append((i % 50, " ".join(words), [None, "en", "de"][i % 3]))
    return rows + [(None, None, "en"), (1, "", "fr"), (2, " \t.,", None), (3, "q" * 40_000, "en"),
                   (4, ("long " + "y" * 90 + " ") * 400, "en"), *rows[:5]]


@pytest.mark.parametrize("head", [1 << 19, 12, 0])
def test_collocations_match_slicing(spark, head):
    """Also with a dictionary that is mostly, or wholly, joined by a shuffle."""
    rows = phrase_rows()
    found = collocations.collocations(table(spark, rows).repartition(5), min_count=6, head=head)
    assert rows_of(found, "lang", "rank") == brute_phrases(rows, 6)


def test_collocations_top_and_length(spark):
    rows = phrase_rows()
    found = collocations.collocations(table(spark, rows), min_count=4, max_words=3, top=7)
    assert rows_of(found, "lang", "rank") == brute_phrases(rows, 4, 3, 7)


def test_collocations_query(spark, folder, real):
    assert rows_of(queries.op13_collocations(spark, folder), "lang", "rank") == \
        brute_phrases(real, 100)


def test_collocations_of_nothing(spark):
    empty = table(spark, []).where("false")
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(table(spark, [(1, "a b", "en")])).count() == 0


def test_collocation_scores_pass_64_bits(spark):
    big = 4_000_000_000
    cut = spark.range(1).select(F.expr(
        f"cast(1000 as decimal(4,0)) * cast({big} as decimal(15,0)) * cast({big * 1000} as "
        f"decimal(19,0)) div (cast({big} as decimal(19,0)) * cast({big + 1} as decimal(19,0)))"))
    assert cut.first()[0] == 1000 * big * big * 1000 // (big * (big + 1))


def test_pair_tiles_count_all(spark):
    draw = np.random.default_rng(3)
    tiles, want = collocations.PairTiles(), Counter()
    for _ in range(4):
        a = draw.integers(1, 5000, 3000) ** 2 // 2500 + 1
        b = draw.integers(1, 5000, 3000)
        tiles.add(a, b)
        want.update(zip(a.tolist(), b.tolist()))
        tiles.merge()
    got = Counter()
    for keys, counts in tiles.drain():
        for k, n in zip(keys.tolist(), counts.tolist()):
            got[k >> 32, k & 0xFFFFFFFF] += n
    assert got == want and not list(tiles.drain())[0][0].size


def test_runs_are_trimmed():
    ids = np.array([0, 3, 0, 1, 2, 0, 0, 4, 5, 6, 7, 0, 8])
    assert collocations.trimmed(ids).tolist() == [1, 2, 0, 4, 5, 6, 7, 0]
    assert collocations.trimmed(ids[:2]).tolist() == [] and not len(collocations.trimmed(ids[:0]))


# spelling variants

def brute_variants(rows, slip=199, letters=6, least=5, ratio=5):
    n = Counter()
    for i, text, *_ in rows:
        i = "" if i is None else i
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{i}:{w}".encode()) if slip else 1
            if slip and h % slip == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= letters:
                n[w] += 1
    n = {w: c for w, c in n.items() if c >= least}
    cuts = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            cuts[w[:i] + w[i + 1:]].add(w)
            cuts[w[:i] + "\0" + w[i + 1:]].add(w)
    near = defaultdict(set)
    for cut, words in cuts.items():
        if "\0" in cut:
            for w in words:
                near[w] |= words - {w}
        elif cut in n:
            near[cut] |= words
            for w in words:
                near[w].add(cut)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def test_variants_query(spark, folder, real):
    found = rows_of(queries.op12_spelling_variants(spark, folder), "word")
    assert found == brute_variants(real) and len(found) > 300
    assert any(v[0] for v in found.values())


def word_rows():
    draw = random.Random(9)
    stems = ["".join(draw.choice("abcdeéßÀ") for _ in range(draw.randrange(5, 11)))
             for _ in range(60)]
    rows = []
    for i in range(300):
        words = []
        for _ in range(40):
            w = draw.choice(stems[:int(draw.triangular(1, 60, 1))])
            at = draw.randrange(len(w))
            edit = draw.randrange(12)
            w = w[:at] + draw.choice("abcXé") * (edit < 2) + w[at + (edit % 2):] if edit < 3 else w
            words.append(w)
        rows.append((i % 200, " ".join(words), None))
    return rows + [(None, " ".join(stems), None), (7, None, None), (8, "", None), (9, "12 ÷×÷×÷×", None),
                   (10, ("g" * 30_000 + " " + "g" * 29_999 + " ") * 5, None), *rows[:3]]


@pytest.mark.parametrize("slip", [None, 3])
def test_variants_match_deletion_sets(spark, slip):
    rows = word_rows()
    found = rows_of(variants.spelling_variants(table(spark, rows).repartition(4), slip=slip), "word")
    want = brute_variants(rows, slip)
    assert found == want
    assert any(v[0] for v in want.values())


def test_chain_of_forms(spark):
    words = ["abcdefg", "abcdefgh", "abcdefghi", "abcdefghij", "abcdefghijk", "other"]
    rows = [(w, 6 ** i) for i, w in enumerate(words)]
    found = rows_of(variants.variant_groups(spark.createDataFrame(rows, "word string, n long")),
                    "word")
    assert [found[w][1] for w in words] == ["abcdefghijk"] * 5 + ["other"]


def test_ties_go_to_the_first_word(spark):
    rows = [("aaaaab", 50), ("aaaaac", 50), ("aaaaa", 10), ("aaaaad", 9), ("é", 1), ("", 3)]
    found = rows_of(variants.variant_groups(spark.createDataFrame(rows, "word string, n long")),
                    "word")
    assert found["aaaaad"] == ("aaaaab", "aaaaab", 9, 3, 50)
    assert found["aaaaac"] == (None, "aaaaac", 50, 3, None) and found[""] == (None, "", 3, 0, None)


def test_signatures_meet_after_any_edit():
    draw = random.Random(2)
    for _ in range(300):
        w = "".join(draw.choice("abcé\U0001f600") for _ in range(draw.randrange(2, 14)))
        at, c = draw.randrange(len(w)), draw.choice("abz")
        for v in (w[:at] + c + w[at:], w[:at] + c + w[at + 1:], w[:at] + w[at + 1:]):
            short, long = sorted([w, v], key=len)
            keys, roles = variants.signatures([short, long], 4)
            role = int(len(short) < len(long))
            assert set(keys[0][roles == 0]) & set(keys[1][roles == role])


def test_variants_of_nothing(spark):
    empty = table(spark, []).where("false")
    assert variants.spelling_variants(empty).count() == 0
    assert variants.spelling_variants(table(spark, [(1, "short words", None)])).count() == 0


# language identification

def plain_marginals(field, emitted):
    n, total = len(field.langs), 0
    out = np.zeros((len(emitted), n))
    for path in itertools.product(range(n), repeat=len(emitted)):
        score = field.first[path[0]] + sum(emitted[i, y] for i, y in enumerate(path)) + \
            sum(field.moves[a, b] for a, b in zip(path, path[1:]))
        out[range(len(path)), path] += np.exp(score)
        total += np.exp(score)
    return out / total


def small_field(n=3):
    draw = np.random.default_rng(1)
    field = langid.Field([f"l{i}" for i in range(n)], np.zeros((langid.LEXICON, n)), np.ones(n))
    field.first, field.moves = draw.normal(size=n), draw.normal(size=(n, n)) * 2
    return field, draw


def test_forward_backward_equals_all_paths():
    field, draw = small_field()
    lengths = np.array([1, 7, 0, 4, 8])
    emitted = draw.normal(size=(lengths.sum(), 3)) * 3
    found, at = field.marginals(emitted, lengths), 0
    for n in lengths:
        if n:
            assert np.allclose(found[at:at + n], plain_marginals(field, emitted[at:at + n]))
        at += n


def test_blocks_equal_the_plain_recursion():
    field, draw = small_field(4)
    lengths = np.array([700, 32, 33, 1, 64])
    emitted = draw.normal(size=(lengths.sum(), 4)) * 3
    found, at = field.marginals(emitted, lengths), 0
    for n in lengths:
        e, move = np.exp(emitted[at:at + n]), np.exp(field.moves)
        ahead, behind = np.zeros((n, 4)), np.ones((n, 4))
        ahead[0] = np.exp(field.first) * e[0]
        for t in range(1, n):
            ahead[t] = ahead[t - 1] @ move * e[t]
            ahead[t] /= ahead[t].sum()
        for t in range(n - 2, -1, -1):
            behind[t] = move @ (e[t + 1] * behind[t + 1])
            behind[t] /= behind[t].sum()
        both = ahead * behind
        assert np.allclose(found[at:at + n], both / both.sum(axis=1, keepdims=True))
        at += n


def test_move_gap_is_the_gradient():
    field, draw = small_field()
    emitted, label = draw.normal(size=(5, 3)), np.array([0, 1, 1, 2, 0])

    def likelihood():
        paths = [field.first[p[0]] + sum(emitted[i, y] for i, y in enumerate(p)) +
                 sum(field.moves[a, b] for a, b in zip(p, p[1:]))
                 for p in itertools.product(range(3), repeat=5)]
        own = field.first[label[0]] + emitted[range(5), label].sum() + \
            field.moves[label[:-1], label[1:]].sum()
        return own - np.log(np.exp(paths).sum())

    ahead, behind = field.messages(emitted, np.array([5]))
    gap = langid._move_gap(field, emitted, label, np.array([0]), ahead, behind)
    for i, j in itertools.product(range(3), repeat=2):
        field.moves[i, j] += 1e-5
        high = likelihood()
        field.moves[i, j] -= 2e-5
        low = likelihood()
        field.moves[i, j] += 1e-5
        assert abs((high - low) / 2e-5 - gap[i, j]) < 1e-4


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs, langid.train_field(docs, F.crc32(F.col("doc_id").cast("string")) % 4 != 2)


def test_language_held_out(spark, trained):
    docs, _ = trained
    found = queries.op11_language_id(spark, "/root/testdata/sf0.01")
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.doc_id for r in held} == {r.doc_id for r in rows
                                        if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)


def test_runs_follow_code_switching(spark, trained):
    docs, field = trained
    pure = {r.lang: r.text for r in docs.where("crc32(cast(doc_id as string)) % 4 = 2 AND "
                                               "n_chars > 800").collect()}
    parts = [" ".join(pure[c].split()[10:60]) for c in ("en", "fr", "de")]
    text = " | ".join(parts)
    runs = langid.language_runs(table(spark, [(1, text, None)]), field).first().runs
    right = 0
    for lang, part in zip(("en", "fr", "de"), parts):
        a = text.index(part)
        right += sum(max(0, min(r.stop, a + len(part)) - max(r.start, a))
                     for r in runs if r.lang == lang)
    assert right >= 0.9 * len(text)
    assert all(a.stop <= b.start for a, b in zip(runs, runs[1:]))


def test_language_edges(spark, trained):
    docs, field = trained
    long = " ".join(r.text for r in docs.where("lang = 'de'").limit(200).collect())
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 34 -- ²", None), (4, long, "en"),
            (None, "the of and", "xx"), (4, long, "fr"), (6, "日本語", None), (7, "x" * 60_000, None)]
    found = langid.identify(table(spark, rows), field).collect()
    assert found[0][1:] == found[1][1:] == found[2][1:] == ("und", 0.0)
    assert found[3].lang_pred == "de" and found[3] == found[5] and found[4].lang_pred == "en"
    assert len(found) == len(rows) and found[6].lang_pred in field.langs
    assert [len(r.runs) for r in langid.language_runs(table(spark, rows[:3]), field).collect()] == \
        [0, 0, 0]


def test_language_without_training_rows(spark):
    empty = table(spark, []).where("false")
    assert langid.train_field(empty) is None
    assert langid.identify(empty, None).count() == 0
    assert langid.identify(table(spark, [(1, "some text", "en")]), None).first().lang_pred == "und"
    one = langid.train_field(table(spark, [(1, "some text", "en"), (2, None, "fr"), (3, "x", None)]))
    assert one.langs == ["en"]
    assert langid.identify(table(spark, [(1, "other", None)]), one).first()[1:] == ("en", 1.0)
