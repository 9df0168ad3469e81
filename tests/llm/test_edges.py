"""Nulls, empty and very long texts, ties, repeated rows, empty tables, extra columns."""

import os
import random
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from rtml.llm import (chat, common, decontaminate, jaccard, langmodel, mixing, quality,  # noqa: E402
                      queries, secrets, tokencount, tokenfiles, vectors, words)

# names that the operators use inside, as columns they must not look at
CLASH = "id long, rep long, n long, key string, copies long, spans string, items string, " \
    "blob string, word string, turn long, s string, block long, host string, _k1 long"
N_CLASH = len(CLASH.split(","))


def prose(seed, n, vocabulary=400):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


LONG = prose(1, 30_000, 5000) + " " + "x" * 50_000
TEXTS = {0: prose(2, 120), 1: None, 2: "", 3: " \n\t ", 4: "One two", 5: "one  TWO", 6: LONG,
         7: LONG.replace("w17 ", "w18 "), 8: prose(2, 120) + " tail", 9: "é ü ß 　 日本語 ＡＢＣ",
         10: prose(2, 120), 11: "token: abcdef1 secret:token:abcdefgh AKIA" + "B" * 16 +
         " 0123456789abcdef01234567 \U0001f600 password='zz' api_key=\"Q12345\""}


def table(spark, rows, ids="doc_id", extra=""):
    kind = f"{ids} long, text string, source string, lang string{extra}, {CLASH}"
    return spark.createDataFrame([(*r, *[None] * N_CLASH) for r in rows], kind)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "a" if i % 2 else None, "en") for i, t in TEXTS.items()]
    return table(spark, rows).repartition(3)


@pytest.fixture(scope="module")
def empty(spark, docs):
    return docs.where("false")


def by_id(df, key="doc_id"):
    return {r[key]: tuple(r[c] for c in df.columns if c != key) for r in df.collect()}


def test_token_counts(docs, empty):
    pieces = ["▁", "▁on", "▁one", "o", "ne", "tw", "t", "w", "▁w1", "12", "é"]
    found = by_id(tokencount.count_tokens(docs, pieces))
    assert {i: v[1] for i, v in found.items()} == \
        {i: brute.greedy_count(t, pieces) for i, t in TEXTS.items()}
    assert found[1] == found[2] == found[3] == (0, 0)
    assert tokencount.count_tokens(empty, pieces).count() == 0
    assert tokencount.count_tokens(docs.union(docs), pieces).count() == 2 * len(TEXTS)


def test_automaton_against_greedy():
    draw = random.Random(5)
    for _ in range(40):
        pieces = ["▁"] + ["".join(draw.choice("abc") for _ in range(draw.randint(1, 5)))
                          for _ in range(draw.randint(1, 12))]
        machine = tokencount.Automaton(pieces)
        for _ in range(30):
            word = "".join(draw.choice("abcd") for _ in range(draw.randint(1, 20)))
            assert machine.count("▁" + word) == brute.greedy_count(word, pieces)


def vector_rows():
    draw = np.random.default_rng(3)
    rows = {i: draw.standard_normal(16).tolist() for i in range(80)}
    for i in range(80, 140):  # near copies of one, links at all distances around the threshold
        rows[i] = (np.array(rows[3]) + draw.standard_normal(16) * draw.uniform(0, 0.3)).tolist()
    rows |= {200: None, 201: [], 202: [0.0] * 16, 203: [float("nan")] * 16, 204: [None] * 16,
             205: [float("inf")] + [1.0] * 15, 206: rows[5], 207: rows[5], 208: [1.0, 2.0],
             209: [2.0, 4.0], 210: [x * 1e-30 for x in rows[7]], 211: [x * 1e30 for x in rows[7]]}
    return rows


def test_vectors(spark):
    rows = vector_rows()
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows.items()],
                               "vec_id long, embedding array<double>, id long, unit string")
    found, plain = by_id(vectors.vector_links(df), "vec_id"), brute.vectors(rows)
    assert set(found) == set(plain)
    links, wanted = sum(v[0] for v in found.values()), sum(v[0] for v in plain.values())
    assert 0.9 * wanted <= links <= wanted
    assert all(found[i][0] <= plain[i][0] for i in plain)
    for i in (0, 200, 201, 202, 203, 204, 205, 206, 207, 208, 209):
        assert found[i] == plain[i]
    assert vectors.vector_links(df.where("false")).count() == 0


def test_vectors_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 7)
    rows = {i: [1.0, 0.001 * i, 0.0] for i in range(60)} | {99: [0.0, 1.0, 0.0]}
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")
    assert by_id(vectors.vector_links(df), "vec_id") == brute.vectors(rows)


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(i, i % 2, 1) for i in (0, 4, 5, 6, 7, 8)] +
                                   [(0, 0, 1), (None, 1, 1), (2, 7, 1)],
                                   "doc_id long, quality int, id long")
    scored = by_id(quality.score_quality(docs, labels))
    assert set(scored) == set(TEXTS) and all(0 <= v[3] <= 1 for v in scored.values())
    assert scored[0][:5] == scored[10][:5] and scored[1][0] == scored[2][0]
    assert quality.score_quality(empty, labels).count() == 0
    nothing = by_id(quality.score_quality(docs, labels.where("false")))
    assert all(v[4] for v in nothing.values())
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == \
        {i for i, v in scored.items() if v[4]}


def test_sparse_sites_shrink(spark):
    bad = "!!! ### $$$ " * 20
    rows = [(i, bad if i < 300 else prose(i, 40), "bad" if i < 300 else "good", "en")
            for i in range(600)] + [(900, prose(1, 40), "bad", "en"), (901, prose(1, 40), "one", "en")]
    labels = spark.createDataFrame([(i, int(i >= 300)) for i in range(0, 600, 2)],
                                   "doc_id long, quality int")
    found = by_id(quality.score_quality(table(spark, rows), labels))
    assert found[0][1] < 0.1 < 0.9 < found[599][1]      # rich hosts keep their own level
    assert 0.3 < found[901][1] < 0.8                    # a host of one document stays near the mean
    assert not found[0][4] and found[599][4] and found[901][4]


def test_lm(docs, empty):
    found, plain = by_id(langmodel.score_texts(docs)), brute.unigram(TEXTS)
    assert {i: v[:4] for i, v in found.items()} == {i: v[:4] for i, v in plain.items()}
    assert all(abs(found[i][4] - plain[i][4]) < 1e-6 * abs(plain[i][4]) for i in plain)
    assert all(v[5] <= 0 for v in found.values())
    assert langmodel.score_texts(empty).count() == 0


def test_lm_is_a_distribution():
    """Probabilities of all words, and of one unseen word per shape, add up to one."""
    names = [f"w{i}".encode() for i in range(1500)] + [b"\n", b"a,", b"b.", "é".encode()]
    counts = [2000 - i for i in range(len(names))]
    static = [0.1] * langmodel.SHAPES
    for w, c in list(zip(names, counts))[langmodel.CLASSES * langmodel.WIDTH:]:
        static[langmodel.shape_of(w)] += c + 0.1
    vocab = langmodel.Vocabulary(names, counts, sum(counts), len(names), static)
    model, lookup = langmodel.Model(vocab), langmodel.Lookup(vocab)
    model.w1[:] = np.random.default_rng(1).normal(0, .5, model.w1.shape)
    model.w2[:] = np.random.default_rng(2).normal(0, .5, model.w2.shape)
    unseen = [b"q0", b"q0,", b"q0.", "ö".encode(), "ö,".encode(), "ö.".encode()]
    places = np.array([lookup[w] for w in names + unseen])
    label, slot, _, _, fixed, at = lookup.tables()
    label, slot, fixed = label[places], slot[places], fixed[places].copy()
    fixed[len(names):] += np.log10(0.1)
    feats = [np.repeat(f[2:], len(places)) for f in
             langmodel.history(np.array([5, 6, 7], np.uint64), np.array([0]))]
    logp = langmodel.log_probabilities(model, feats, label, slot)
    total = np.exp(logp + fixed * np.log(10)).sum()
    assert abs(total - 1) < 1e-3


def test_lm_models_every_head_word(spark):
    """The modelled words follow the counts; each has a slot of its own, learned from its history."""
    words = [(f"w{i}".encode(), 5000 - i) for i in range(3000)]
    vocab = langmodel.gather_vocabulary(spark.createDataFrame(words, "word binary, c long"))
    lookup = langmodel.Lookup(vocab)
    places = np.array([lookup[w] for w, _ in words])
    label, slot, names, *_ = lookup.tables()
    assert vocab.modelled == len({*zip(label[places], slot[places])}) == 3000 and min(slot[places]) >= 0
    assert vocab.classes >= 32 and vocab.classes * vocab.width < 3000 + vocab.classes
    model, squares = langmodel.Model(vocab), [np.zeros(len(langmodel.Model(vocab).w1), np.float32)
                                              for _ in range(2)]
    text = np.tile(places[[5, 2900]], 50)    # a rare word after a frequent one
    feats = langmodel.history(names[text], np.array([0]))
    before = langmodel.log_probabilities(model, feats, label[text], slot[text])
    for _ in range(20):
        langmodel.train_on(model, squares, feats, label[text], slot[text])
    after = langmodel.log_probabilities(model, feats, label[text], slot[text])
    assert before[51] < -7 and after[51] > -1


def test_lm_work_follows_the_logarithm(spark):
    """Few branchings lead to a word; before training they give each word its share of the corpus."""
    words = [(f"w{i}".encode(), 10**6 // (i + 3)) for i in range(4000)]
    vocab = langmodel.gather_vocabulary(spark.createDataFrame(words, "word binary, c long"))
    model, lookup = langmodel.Model(vocab), langmodel.Lookup(vocab)
    places = np.array([lookup[w] for w, _ in words])
    label, slot = (c[places] for c in lookup.tables()[:2])
    steps = model.classes.count[label] + model.words.count[label * model.words.width + slot]
    shares = np.array([c for _, c in words]) / vocab.tokens
    assert vocab.modelled == 4000 and (steps * shares).sum() < 2 * np.log2(4000)
    feats = langmodel.history(places.astype(np.uint64), np.array([0]))
    logp = langmodel.log_probabilities(model, feats, label, slot)
    assert np.abs(logp - np.log(shares)).max() < 0.01


def test_lm_tokens_of_a_batch():
    """Words as the plain splitter gives them, each looked up once a batch; every text has its end."""
    texts = [" A b  c\t", "", None, "x\x0by\x0cz\x1cw\x85\r\nÀB A, b.", "  ", "b " * 50]
    distinct, places, starts = langmodel._tokens(pa.array(texts, pa.string()))
    found = distinct.to_pylist()
    plain = [[*words.spaced_words(t and t.encode()), langmodel.END] for t in texts]
    assert [found[i] for i in places] == [w for x in plain for w in x]
    assert np.diff(starts).tolist() == [len(x) for x in plain] and len(found) == len({*found})
    assert langmodel.shapes_of(distinct).tolist() == [langmodel.shape_of(w) for w in found]


def test_lm_weights_of_a_block_lie_together(spark):
    """Four levels of branchings share a line of 16 weights, so a word's path reads few lines a feature."""
    words = [(f"w{i}".encode(), 10**6 // (i + 3)) for i in range(4000)]
    model = langmodel.Model(langmodel.gather_vocabulary(spark.createDataFrame(words,
                                                                              "word binary, c long")))
    for paths in (model.classes, model.words):
        for first, count in zip(paths.first.tolist(), paths.count.tolist()):
            names = paths.names[first:first + count].tolist()
            assert len({n >> 4 for n in names}) <= -(-count // 4) and len({*names}) == count


def test_lm_step_is_the_plain_one():
    """A step over several chunks equals sums per weight, added up one by one, and the adaptive rule."""
    names = [f"w{i}".encode() for i in range(1500)]
    vocab = langmodel.Vocabulary(names, [3000 - i for i in range(1500)], 3 * 10**6, 1500,
                                 [0.1] * langmodel.SHAPES, 1500)
    model, draw = langmodel.Model(vocab), np.random.default_rng(3)
    label, slot, name, *_ = langmodel.Lookup(vocab).of(pa.array(names))
    text = draw.integers(0, 1500, langmodel._BATCH + 500)
    feats = langmodel.history(name[text], np.array([0, 70]))
    size, paths = len(model.w1), model.classes
    sums = np.zeros(size)
    for i, leaf in enumerate(label[text].tolist()):
        for at in range(paths.first[leaf], paths.first[leaf] + paths.count[leaf]):
            error = -paths.sides[at] / (1 + np.exp(paths.sides[at] * paths.logs[at]))
            for f in feats:
                sums[(f[i] ^ paths.names[at]) & (size - 1)] += error
    langmodel.train_on(model, [np.zeros(size, np.float32) for _ in range(2)], feats, label[text],
                       slot[text])
    wanted = -langmodel._RATE * sums / np.sqrt(sums * sums + 1e-3)
    close = np.abs(model.w1 - wanted) < 1e-3
    assert close[np.abs(sums) > 0.05].all() and not model.w1[sums == 0].any() and not model.sums.any()


def test_lm_steps_grow():
    """A step has at most a sixteenth of the tokens before it, once those fill the least step."""
    seen = 0
    while seen < 10**6:
        step = langmodel.step_tokens(seen, 1 << 21)
        assert 1 <= step <= max(seen // 16, langmodel._BATCH // 4) and step <= 1 << 17
        seen += step
    assert langmodel.step_tokens(10**9, 1 << 21) == 1 << 17


def test_jaccard(spark, docs, empty):
    assert by_id(jaccard.jaccard_components(docs)) == brute.jaccard(TEXTS)
    assert jaccard.jaccard_components(empty).count() == 0
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    wanted = brute.jaccard(TEXTS, 5, 80)
    assert {r.doc_id for r in kept.select("doc_id").collect()} == \
        {i for i, v in wanted.items() if v[1] == i}


def near_copies(seed, families=12):
    """Families of chained edits, so that many links lie just above or below the threshold."""
    draw, out = random.Random(seed), {}
    for f in range(families):
        base = [f"f{f}x{draw.randrange(300)}" for _ in range(draw.choice([6, 30, 80, 200]))]
        passage = [f"p{i}" for i in range(60)] if f % 3 == 0 else []
        for _ in range(draw.randint(2, 25)):
            words_ = list(base)
            for _ in range(draw.randint(0, 1 + len(base) // 40)):
                words_[draw.randrange(len(words_))] = f"e{draw.randrange(10**6)}"
            if draw.random() < 0.3:
                base = words_
            out[len(out)] = " ".join(words_ + passage)
    return out


@pytest.mark.parametrize("k,percent,block", [(4, 85, 128), (5, 80, 5), (1, 50, 16)])
def test_jaccard_families(spark, monkeypatch, k, percent, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    texts = near_copies(k)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    assert by_id(jaccard.jaccard_components(df, k, percent)) == brute.jaccard(texts, k, percent)


def test_every_link_comes_from_a_tree(spark, monkeypatch):
    """Links to a leader of many members in several blocks; without trees there are none."""
    texts = near_copies(4)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    hub = jaccard._lead_tasks(spark.createDataFrame([(i, 99) for i in range(40)], "a long, b long"),
                              spark.createDataFrame([(i, 1, [7]) for i in [*range(40), 99]],
                                                    "id long, n long, grams array<long>"), 8)
    assert hub.where("side = 1").count() == 40 and hub.where("side = 2").count() == 5
    links = jaccard._run_tasks(hub, jaccard._lead, 85, "a long, b long")
    assert sorted((r.a, r.b) for r in links.collect()) == [(i, 99) for i in range(40)]
    for work in ("_lead", "_link"):
        monkeypatch.setattr(jaccard, work, lambda rows, percent, out: None)
    assert by_id(jaccard.jaccard_components(df, 4, 85)) == brute.jaccard(texts, 4, 100)


def test_jaccard_repeated_ids(spark):
    """A copy under one id does not take out another text of that id; one row of a group is kept."""
    a, b, c = prose(21, 80), prose(22, 80), prose(23, 80)
    rows = [(1, a), (5, a), (5, b), (9, b + " tail"), (7, c), (7, c), (8, c + " tail"), (3, None),
            (3, c), (4, ""), (None, a), (None, a)]
    df = table(spark, [(i, t, None, None) for i, t in rows]).repartition(3)
    found = jaccard.jaccard_components(df)
    assert {(r.doc_id, r.component_id) for r in found.collect()} == \
        {(1, 1), (5, 1), (9, 1), (7, 3), (8, 3), (3, 3), (4, 4), (None, None)}
    assert found.count() == len(rows)
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 3, 4]
    twice = table(spark, [(2, c, None, None), (2, c, "a", None), (6, b, None, None)])
    assert sorted(r.doc_id for r in jaccard.keep_one(twice).collect()) == [2, 6]


def test_mark_counts_clashing_halves():
    """Shared grams whose halves are equal count one by one, so a pair at the threshold is marked."""
    shared = [100, 100, 200, 200, 300, 400, 500, 600]
    rows = [(1, 0, 0, i, i, 100, np.array([*range(8 * i, 8 * i + 8), *shared], np.uint32), 3)
            for i in (1, 2)]
    assert len(rows[0][6]) == jaccard.prefix_length(100, 85) and jaccard.needed(100, 100, 85) == 92
    out = []
    jaccard._mark(rows, 85, out)    # 8 unshared each, 92 shared
    assert sorted(out) == [(1, 1), (1, 2)]


def test_sets_are_sent_for_possible_links_only(spark, monkeypatch):
    """Members of a group that sizes and the gram's places keep from linking leave it before any set
    is sent: here sets of very different sizes that share a passage."""
    passage, kept, plain = " ".join(f"s{i}" for i in range(30)), {}, jaccard.stored
    texts = {i: prose(i, 40 * 2 ** i, 10**6) + " " + passage for i in range(6)}
    for i in range(10, 30, 2):    # groups of two, which their leader's pair decides
        texts[i] = f"{prose(i, 60, 10**6)} {prose(i + 1, 60, 10**6)}"
        texts[i + 1] = f"{prose(i, 60, 10**6)} {prose(i + 50, 60, 10**6)}"

    def watched(df, label):
        kept[label] = plain(df, label)
        return kept[label]

    monkeypatch.setattr(jaccard, "stored", watched)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(2)
    assert by_id(jaccard.jaccard_components(df)) == brute.jaccard(texts)
    assert kept["groups"].groupBy("gram").count().where("count > 1").count() > 0
    assert kept["mixed"].count() == 0
    assert kept["possible"].where("least(a, b) < 10").count() == 0


def test_first_shared_gram_keeps_every_link():
    """Every linked pair of sets is near in the group of the first gram that they share."""
    draw, percent = np.random.default_rng(5), 85
    for _ in range(300):
        base = np.unique(draw.integers(0, 2**40, 100))
        x, y = (np.union1d(base[draw.random(len(base)) > draw.uniform(0, 0.2)],
                           draw.integers(0, 2**40, draw.integers(0, 20))) for _ in range(2))
        both, out = np.intersect1d(x, y), []
        for gram in both[:1].tolist():
            jaccard._near([(gram, 0, 0, i, i, len(s), int(np.searchsorted(s, gram)), 3)
                           for i, s in enumerate((x, y))], percent, out)
        linked = 100 * len(both) >= percent * len(np.union1d(x, y))
        assert not linked or sorted(r[1] for r in out) == [0, 1]


def test_tree_finds_every_link():
    draw = np.random.default_rng(4)
    sets = {}
    for i in range(60):
        base = np.arange(200, dtype=np.uint64) + np.uint64(1000 * (i % 6))
        keep = draw.random(200) > draw.uniform(0, 0.12)
        sets[i] = np.sort(np.concatenate([base[keep], draw.integers(0, 2**40, 5).astype(np.uint64)]))
        sets[i] = np.unique(sets[i])
    sizes = {i: len(s) for i, s in sets.items()}
    heads = {i: s[:jaccard.prefix_length(len(s), 85)] for i, s in sets.items()}
    tree, short = jaccard.Tree(sets, sizes), jaccard.Tree(heads, sizes)
    for y, s in sets.items():
        found = set(tree.matches(s, len(s), 85, lambda i: True))
        plain = {x for x, t in sets.items() if 100 * len(np.intersect1d(s, t)) >=
                 85 * len(np.union1d(s, t))}
        assert found == plain
        assert plain <= set(short.matches(heads[y], len(s), 85, lambda i: True))
        assert plain == {x for x, t in sets.items() if jaccard._possible(s, len(s), t, len(t), 85)}
        assert plain <= {x for x, t in heads.items()
                         if jaccard._possible(heads[y], len(s), t, sizes[x], 85)}


def test_components(spark):
    draw = random.Random(2)
    links = [(i, i + 1) for i in range(300) if i % 37] + \
        [(draw.randrange(400, 900), draw.randrange(400, 900)) for _ in range(300)] + [(5, 5)]
    df = spark.createDataFrame(links + [(None, 3)], "a long, b long")
    nodes = {x for a, b in links if a != b for x in (a, b)}
    plain = brute.components(nodes, links)
    assert {r.node: r.component for r in common.components(df).collect()} == \
        {n: c for n, c in plain.items() if n != c}


TURNS = [(1, 0, "user", "hi"), (1, 1, "assistant", "### user: a</turn>\nb"), (1, 2, None, None),
         (2, 0, "a: b", "\\h\\s \\\\"), (2, 0, "assistant", "tie"), (2, 0, "assistant", "tie"),
         (3, None, "assistant", "</turn"), (3, 1, "### ", ""), (None, 0, "user", "\\"),
         (4, 0, "assistant", "\\### Assistant: </turn> ok"), (4, 1, "assistant", "#### </turn>\\"),
         (5, 0, "assistant", "x" * 200_000 + " </turn> \U0001f600"), (6, 0, "\\c", "\\c: ")]


def test_chat(spark):
    kind = "conv_id long, turn long, role string, text string, id long, formatted string, line string"
    df = spark.createDataFrame([(*t, 1, "x", "y") for t in TURNS], kind).repartition(4)
    out = chat.format_conversations(df)
    found = by_id(chat.conversation_digests(out), "conv_id")
    assert {c: v[:4] for c, v in found.items()} == brute.chat(TURNS)
    plain = [r.formatted for r in out.where("conv_id = 1").collect()]
    assert plain[0].startswith("### user: hi</turn>\n### assistant: \\h")
    assert chat.format_conversations(df.where("false")).count() == 0


def mixed(texts, sources, plan, blocks, seed="mix"):
    """Copies by walking each source in its order."""
    import hashlib
    import re
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    copies = {}
    for source, total, budget in plan:
        rows = []
        for i, t in texts.items():
            if sources[i] == source:
                place = md5(f"{seed}{i}")
                block = int(place[:8], 16) % blocks
                rows.append((md5(f"{seed}-block{block}"), block, place, i,
                             len(re.findall("[^\x20\x09-\x0d]+", t or ""))))
        full, rest = (budget // total, budget % total) if total else (1, 0)
        read = 0
        for _, _, _, i, n in sorted(rows):
            copies[i] = full + (read < rest)
            read += n
    return copies


@pytest.mark.parametrize("blocks", [3, 64])
def test_mixing(spark, docs, empty, blocks):
    sources = {i: "a" if i % 2 else None for i in TEXTS}
    for kw in ({"max_repetition": 2.0}, {"target_entropy": 0.9}, {"budget": 30_000}):
        plan = mixing.mixture(docs, **kw)
        found = by_id(mixing.mixed_ids(docs, plan, blocks=blocks))
        assert {i: v[2] for i, v in found.items()} == mixed(TEXTS, sources, plan, blocks)
        rows = mixing.mix(docs, plan, blocks=blocks)
        assert rows.columns == docs.columns
        assert rows.count() == sum(v[2] for v in found.values())
    assert mixing.mixture(empty, max_repetition=2.0) == []
    assert mixing.mix(empty, []).count() == 0


def test_exponent():
    tokens = [1000, 100, 10]
    a = mixing.solve_exponent(tokens, max_repetition=2.0)
    w = mixing._weights([t / 1110 for t in tokens], a)
    rates = [x / t for x, t in zip(w, tokens)]
    assert abs(max(rates) / min(rates) - 2) < 1e-6
    a = mixing.solve_exponent(tokens, target_entropy=0.8)
    assert abs(mixing._entropy(mixing._weights([t / 1110 for t in tokens], a)) - .8 * np.log(3)) < 1e-6
    assert mixing.solve_exponent(tokens) == 1.0 and mixing.solve_exponent([0, 5]) == 1.0


def test_contamination(spark, docs, empty, monkeypatch):
    start = " ".join(TEXTS[0].split()[40:55])
    items = [(1, start), (2, "x " + " ".join(LONG.split()[500:510]) + " y"), (3, "ONE, two"),
             (4, None), (5, "?!"), (None, " ".join(LONG.split()[500:509])), (1, start), (6, "é")]
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, spans long")
    named = [("null" if i is None else i, t) for i, t in items]
    wanted = dict(zip(TEXTS, brute.contamination(list(TEXTS.values()), named)))

    def found(d, b):
        return by_id(decontaminate.contamination(decontaminate.find_benchmark_spans(d, b)))
    assert found(docs, bench) == wanted
    assert found(docs, bench.where("false"))[0][1:3] == (0, 0)
    assert found(empty, bench) == {}
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 12)
    assert found(docs, bench) == wanted


def test_winnowing_guarantee():
    draw = np.random.default_rng(1)
    for _ in range(50):
        a, b, span = (draw.integers(0, 3, n).astype(np.uint64) for n in (60, 60, 10))
        a[20:30] = span
        b[35:45] = span
        ga, gb = words.gram_hashes(a, 5), words.gram_hashes(b, 5)
        assert set(ga[decontaminate.winnow(ga, 6)]) & set(gb[decontaminate.winnow(gb, 6)])


def test_token_files(spark, docs, empty, tmp_path):
    file = queries.tokenizer_file("word_bpe_49k.json")
    odd = {20: "<|endoftext|> x<|endoftext|>. <|ENDOFTEXT|>", 21: "It's I'LL don't. o'clock,", 22:
           "é Å. İ ΣΑΣ ﬁ", 23: "a b c\x1cd 12,345.67!?", 24: "'s. ''s,"}
    more = table(spark, [(i, t, None, None) for i, t in odd.items()])
    path = tokenfiles.write_token_files(docs.union(more), f"{tmp_path}/a", file, block_ids=500)
    found = sorted(tuple(r) for r in tokenfiles.read_documents(spark, path).collect())
    model = Tokenizer.from_file(file)
    assert found == brute.token_rows([*TEXTS.items(), *odd.items()], model)
    back = {r.doc_id: r.ids for r in tokenfiles.read_documents(spark, path, True).collect()}
    assert back[20] == model.encode(odd[20], add_special_tokens=False).ids + [2]
    again = tokenfiles.write_token_files(docs.union(docs), f"{tmp_path}/b", file)
    assert tokenfiles.read_documents(spark, again).count() == 2 * len(TEXTS)
    none = tokenfiles.write_token_files(empty, f"{tmp_path}/c", file)
    assert tokenfiles.read_documents(spark, none).count() == 0


def test_encoder_remembers_a_bounded_number_of_words():
    with open(queries.tokenizer_file("word_bpe_49k.json"), encoding="utf-8") as source:
        model = source.read()
    texts = [" ".join(f"x{i}y{j}" for j in range(5)).encode() for i in range(60)]
    coder, plain = (tokenfiles.TextEncoder(model, "<u2", n) for n in (20, 10_000))
    assert coder.texts(texts) == plain.texts(texts)
    words = coder.words
    assert max(len(words), len(words.older)) <= 2 * (20 + 3 * 5) < len(plain.words)
    assert coder.texts(texts[::-1]) == plain.texts(texts[::-1])


def test_encoder_goes_after_encoding():
    run = cloudpickle.loads(cloudpickle.dumps(tokenfiles._past_encoding(lambda batches: batches)))
    tokenfiles._ENCODERS["model"] = object()
    assert list(run(iter([1, 2]))) == [1, 2] and not tokenfiles._ENCODERS


def test_small_tables_need_no_python_tasks(spark, docs, tmp_path, monkeypatch):
    plan = mixing.mixture(docs, max_repetition=1.5)
    assert "ExistingRDD" not in mixing.realise(docs, plan)._jdf.queryExecution().toString()
    made, create = [], spark.createDataFrame
    monkeypatch.setattr(spark, "createDataFrame",
                        lambda *a, **b: made.append(create(*a, **b)) or made[-1])
    tokenfiles.write_token_files(docs, f"{tmp_path}/a", queries.tokenizer_file("word_bpe_49k.json"))
    assert [x._jdf.queryExecution().toString().count("ExistingRDD") for x in made] == [0]


def test_coder_round_trip_and_checkpoints():
    draw = np.random.default_rng(0)
    for n in (0, 1, 2047, 2048, 2049, 600_000):
        ids = np.minimum(draw.zipf(1.3, n), 40_000).astype("<u4")
        used, counts = np.unique(ids, return_counts=True) if n else (np.array([7]), np.array([1]))
        coder = tokenfiles.Coder.from_counts(used.astype(np.int64), counts)
        assert int(coder.freq.sum()) == 1 << coder.bits and coder.freq.min() >= 1
        points, packed = coder.encode(ids)
        assert (coder.decode(points, packed, n) == ids).all()
        if n == 600_000:
            step = tokenfiles.CHECK * tokenfiles.LANES
            assert (coder.decode(points, packed, n, 1, 2) == ids[step:2 * step]).all()
            p = counts / n
            assert 8 * len(packed) < 1.02 * n * -(p * np.log2(p)).sum() + 64 * tokenfiles.LANES


def test_damage_is_noticed(spark, docs, tmp_path):
    path = tokenfiles.write_token_files(docs, f"{tmp_path}/a",
                                        queries.tokenizer_file("word_bpe_49k.json"))
    row = spark.read.parquet(f"{path}/blocks").first().asDict()
    coder = tokenfiles.read_table(spark, path)
    words_ = bytearray(row["words"])
    words_[0] ^= 1
    with pytest.raises(ValueError):
        tokenfiles.decode_block(coder, row | {"words": bytes(words_)})


def test_secrets(spark, docs, empty, tmp_path):
    found = by_id(secrets.finding_digests(secrets.scan_versions(docs, f"{tmp_path}/ledger")))
    assert {i: v[:4] for i, v in found.items()} == {i: brute.secrets(t) for i, t in TEXTS.items()}
    assert found[11][:3] == (2, 1, 1)
    assert secrets.scan_versions(empty, f"{tmp_path}/none").count() == 0


def test_secrets_with_very_many_hits(spark, tmp_path):
    """The work per hit does not grow with the text: the text is cut once."""
    draw = random.Random(9)
    text = "\n".join(draw.choice([f"{draw.getrandbits(128):032x}", "api_key = abc", "é token:abcdef7",
                                  "AKIA" + "Z9" * 10, "plain"]) for _ in range(20_000))
    df = spark.createDataFrame([(1, text), (2, text[:50_000]), (3, "token=abcdef")],
                               "doc_id long, text string")
    found = by_id(secrets.finding_digests(secrets.scan_versions(df, f"{tmp_path}/many")))
    assert {i: v[:4] for i, v in found.items()} == \
        {1: brute.secrets(text), 2: brute.secrets(text[:50_000]), 3: brute.secrets("token=abcdef")}
    assert found[1][2] > 3000


def test_ledger_scans_only_unseen_blobs(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    old = [("a", "1", "token=abcdef"), ("a", "2", "clean"), ("b", "1", "token=abcdef")]
    df = spark.createDataFrame(old, "path string, rev string, text string")
    first = secrets.scan_versions(df, path, "path", version_col="rev").collect()
    assert sorted((r.path, r.rev, len(r.spans)) for r in first) == \
        [("a", "1", 1), ("a", "2", 0), ("b", "1", 1)]
    assert spark.read.parquet(path).count() == 2
    new = df.union(spark.createDataFrame([("c", "1", "token=abcdef"), ("c", "2", "x" * 30)],
                                         df.schema))
    assert secrets.scan_versions(new, path, "path", version_col="rev").count() == 5
    assert spark.read.parquet(path).count() == 3
    secrets.scan_versions(new, path, "path", version_col="rev", rule_version="2").count()
    assert spark.read.parquet(path).count() == 6


def test_more_kinds(spark, tmp_path):
    text = "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1B2" * 9 + " eyJ" + "a" * 12 + ".b" + \
        "c" * 12 + "." + "d" * 12
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = secrets.finding_digests(secrets.scan_versions(df, f"{tmp_path}/l")).first()
    assert [s.split(":")[0] for s in row.spans.split(",")] == ["pem", "forge", "webtoken"]
    assert (row.n_assign, row.n_access, row.n_hex) == (0, 0, 0)


def test_pipeline_stages(spark):
    """Each stage on the small tables, against the plain versions on that stage's own input."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    stages = dict(corpus_pipeline.STAGES)
    names = [n for n, _ in corpus_pipeline.STAGES]
    out = common.stored(stages[names[0]](spark, docs, folder), "t")
    ids = {r.doc_id for r in out.collect()}
    assert out.columns == docs.columns
    assert all((i in ids) == (y == 1) for i, y in labels.items())
    texts = {r.doc_id: r.text for r in out.collect()}
    out = common.stored(stages[names[1]](spark, out, folder), "t")
    wanted = {i for i, v in brute.jaccard(texts, 5, 80).items() if v[1] == i}
    assert {r.doc_id for r in out.collect()} == wanted and out.columns == docs.columns
    items = [(r.item_id, r.text) for r in
             spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    ids = sorted(wanted)
    hits = brute.contamination([texts[i] for i in ids], items)
    out = common.stored(stages[names[2]](spark, out, folder), "t")
    assert {r.doc_id for r in out.collect()} == {i for i, h in zip(ids, hits) if not h[4]}
    before, sizes = out.count(), {r.source: r.n for r in out.groupBy("source").agg(
        {"*": "count"}).toDF("source", "n").collect()}
    out = common.stored(stages[names[3]](spark, out, folder), "t")
    times = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert len(times) == before and set(times.values()) <= {1, 2} and max(times.values()) == 2
    last = stages[names[4]](spark, out, folder)
    assert last.count() == out.count() and sizes
