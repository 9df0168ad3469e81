"""Hashed maximum-entropy language model: n-gram and skip features, factored by trees of classes.

A word is predicted as P(class | history) * P(word | class, history). All words of the vocabulary's
head form about as many classes as a class has words. The classes, and the words of each class, are
the leaves of binary trees; each branching is a two-way maximum-entropy decision by weights that hashed
history features select, on top of the corpus shares of its two sides. So the work per token follows
the logarithm of the number of words. All other words fall into static classes by their shape, where a
word has its smoothed corpus count.
"""

from __future__ import annotations

import copy
import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from rtml.llm.common import prepare, stored

#: Classes and words of a class, at least.
CLASSES, WIDTH = 32, 32
SHAPES = 6
#: Weights per class and kind of decision (between classes, between the words of a class), at least.
BUCKETS = 1 << 13
FEATURES = 3
#: The end of a text as a token; no word holds white space.
END = b"\n"
#: A word is in the broadcast table if it has at least this share of all tokens, so at most
#: 1 / HEAD_SHARE words are.
HEAD_SHARE = 2.0 ** -18
ALPHA = 0.1
#: Tokens whose branchings are worked at once, and weights; both keep to a processor's cache.
_BATCH, _BLOCK = 8192, 1 << 15
_RATE = 0.18
_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_S = np.uint64(40)


def shape_of(word: bytes) -> int:
    """Static class of a word: ASCII or not, and a comma, another mark or neither at its end."""
    last = word[-1:]
    mark = 1 if last == b"," else 2 if last in b".!?;:" and last else 0
    return mark + (0 if word.isascii() else 3)


_SHAPE_SQL = """(CASE WHEN hex(word) RLIKE '2C$' THEN 1
    WHEN hex(word) RLIKE '(2E|21|3F|3B|3A)$' THEN 2 ELSE 0 END)
    + (CASE WHEN hex(word) RLIKE '^(..)*[89A-F]' THEN 3 ELSE 0 END)"""


_MARKS = np.array([1 if c == 44 else 2 if c in b".!?;:" else 0 for c in range(256)])


def shapes_of(words: pa.Array) -> np.ndarray:
    """``shape_of`` of each word; none is empty."""
    if not len(words):
        return np.zeros(0, np.int64)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
    raw = np.frombuffer(words.buffers()[2], np.uint8)[:ends[-1]]
    return _MARKS[raw[ends[1:] - 1]] + 3 * (np.maximum.reduceat(raw, ends[:-1]) > 127)


class Vocabulary:
    """Head words in order of falling count, their counts, and totals of the rest by shape."""

    def __init__(self, words: list[bytes], counts: list[int], tokens: int, distinct: int,
                 static: list[float], modelled: int = CLASSES * WIDTH):
        self.words, self.counts = words, counts
        self.tokens, self.distinct, self.static = tokens, distinct, static
        self.modelled = min(len(words), modelled)
        self.classes = max(CLASSES, math.isqrt(max(self.modelled - 1, 0)) + 1)
        self.width = max(WIDTH, -(-self.modelled // self.classes))


class Lookup(dict):
    """Columns of words; as a dict it numbers the words asked for, and ``tables`` has their columns."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        v = self.vocabulary = vocabulary
        self.head = {w: i for i, w in enumerate(v.words)}
        # the last one, at -1, is of words outside the head
        self.logs = np.log10(np.array([*v.counts, 1 - ALPHA]) + ALPHA)
        self.masses = np.log10(v.static)
        self.norm = math.log10(max(v.tokens, 0) + ALPHA * (v.distinct + 1))

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        return place

    def tables(self):
        return self.of(pa.array(list(self), pa.binary()))

    def of(self, words: pa.Array):
        """Class, slot there (-1: a shape class), hash, log of the count in the head (0: none), log of the
        share in the shape class (0: a class of the model) and place in the head (-1: none)."""
        n, classes = len(words), self.vocabulary.classes
        values = words.to_numpy(zero_copy_only=False).tolist()
        at = np.fromiter((self.head.get(w, -1) for w in values), np.int64, n)
        slot, label = np.divmod(at, classes)
        logc, static = self.logs[at], np.zeros(n)
        rest = np.flatnonzero((at < 0) | (at >= self.vocabulary.modelled))
        shape = shapes_of(words.take(pa.array(rest)))
        label[rest], slot[rest] = classes + shape, -1
        static[rest] = logc[rest] - self.masses[shape]
        return label, slot, np.fromiter(map(xxh3_64_intdigest, values), np.uint64, n), logc, static, at


def _bucket(x: np.ndarray) -> np.ndarray:
    """24 well mixed bits."""
    x = x * _A
    x ^= x >> np.uint64(29)
    x *= _B
    x >>= _S
    return x.astype(np.int64)


def history(names: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Feature hashes per token: the word before, the two before, and the second before (skip)."""
    one, two = np.ones_like(names), np.ones_like(names)
    one[1:], two[2:] = names[:-1], names[:-2]
    one[starts] = two[starts] = np.uint64(1)
    after = starts + 1
    two[after[after < len(names)]] = np.uint64(1)
    return [_bucket(one * np.uint64(3) + np.uint64(1)),
            _bucket((one ^ (two * _B)) * np.uint64(5) + np.uint64(2)),
            _bucket(two * np.uint64(7) + np.uint64(3))]


def tree_paths(masses: np.ndarray) -> list[list[tuple[int, int, int, float]]]:
    """For each leaf of a Huffman tree over ``masses`` its branchings from the root: the branching's block
    of four levels, its place there (1 to 15), side taken (1 or -1) and log of the mass of its 1 side over
    its -1 side."""
    heap = [(float(m), i, None) for i, m in enumerate(masses)]
    heapq.heapify(heap)
    paths: list = [[] for _ in masses]
    for name in range(len(masses), 2 * len(masses) - 1):
        one, other = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, (one[0] + other[0], name, (one, other)))
    stack = [(heap[0], [], 0, 1)] if heap else []
    while stack:
        (_, name, below), path, block, at = stack.pop()
        if below is None:
            paths[name] = path
            continue
        log = math.log(below[0][0] / below[1][0])
        if len(path) % 4 == 0:
            block, at = name - len(masses), 1
        stack += [(below[0], [*path, (block, at, 1, log)], block, 2 * at),
                  (below[1], [*path, (block, at, -1, log)], block, 2 * at + 1)]
    return paths


class Paths:
    """Branchings of many leaves, one after the other: ``first`` and ``count`` by leaf; hash of the
    branching, side and log ratio by place. Hashes of a block differ in four bits only, so that the
    weights of one feature there lie side by side."""

    def __init__(self, trees: list[np.ndarray], size: int):
        self.width = max(map(len, trees), default=0)
        self.first = np.zeros(len(trees) * self.width, np.int64)
        self.count = np.zeros(len(trees) * self.width, np.int64)
        blocks, places, sides, logs = [], [], [], []
        for t, masses in enumerate(trees):
            for leaf, path in enumerate(tree_paths(masses)):
                self.first[t * self.width + leaf] = len(blocks)
                self.count[t * self.width + leaf] = len(path)
                for block, at, side, log in path:
                    blocks.append(t * self.width + block + 1)
                    places.append(at)
                    sides.append(side)
                    logs.append(log)
        self.names = (_bucket(np.array(blocks, np.uint64)) << 4 | np.array(places, np.int64)) & (size - 1)
        self.sides, self.logs = np.array(sides, np.float32), np.array(logs, np.float32)

    def of(self, leaves: np.ndarray):
        """Places of all branchings of ``leaves``, whose leaf each is of, and where those of a leaf end."""
        n = self.count[leaves]
        ends = np.cumsum(n)
        own = np.repeat(np.arange(len(leaves)), n)
        return (self.first[leaves] - ends + n)[own] + np.arange(len(own)), own, ends


class Model:
    """Weights by hash of history feature and branching: between classes, and inside the classes."""

    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        size = min(1 << (BUCKETS * v.classes - 1).bit_length(), 1 << 24)
        self.w1, self.w2 = np.zeros(size, np.float32), np.zeros(size, np.float32)
        self._sums: np.ndarray | None = None
        mass = np.full(v.classes + SHAPES, 1e-3)
        words = [[] for _ in range(v.classes)]
        for i in range(v.modelled):
            mass[i % v.classes] += v.counts[i] + ALPHA
            words[i % v.classes].append(v.counts[i] + ALPHA)
        mass[v.classes:] += v.static
        self.classes, self.words = Paths([mass], size), Paths([np.array(w) for w in words], size)

    @property
    def sums(self) -> np.ndarray:
        """Zeros, as many as weights of a kind; made where training happens."""
        if self._sums is None:
            self._sums = np.zeros_like(self.w1)
        return self._sums


def _decisions(weights, paths: Paths, feats, leaves):
    """Rows of weights per branching, the score of the side taken, that side, and where leaves end."""
    at, own, ends = paths.of(leaves)
    names, sides, z = paths.names[at], paths.sides[at], paths.logs[at]
    rows = []
    for f in feats:
        row = (f & (len(weights) - 1))[own]
        row ^= names
        z += weights[row]
        rows.append(row)
    z *= sides
    np.clip(z, -60, 60, out=z)
    return rows, z, sides, ends


def _descend(weights, squares, sums, paths, feats, leaves) -> None:
    """Adaptive step on the touched weights; the gradients of equal ones are summed first, in ``sums``,
    which is all zeros before and after. The step walks all weights in order (an untouched one stays):
    for many tokens that costs less than to pick the touched ones."""
    for a in range(0, len(leaves), _BATCH):
        rows, z, sides, _ = _decisions(weights, paths, [f[a:a + _BATCH] for f in feats],
                                       leaves[a:a + _BATCH])
        error = sides / (-1 - np.exp(z, out=z))
        for row in rows:
            np.add.at(sums, row, error)
    for a in range(0, len(sums), _BLOCK):
        grad, square, weight = (x[a:a + _BLOCK] for x in (sums, squares, weights))
        square += grad * grad
        grad /= np.sqrt(square + np.float32(1e-3))
        grad *= np.float32(_RATE)
        weight -= grad
        grad[:] = 0


def step_tokens(seen: int, weights: int) -> int:
    """Tokens of the next step: few at first, then a sixteenth of those seen, up to one per 16 weights."""
    return min(max(seen // 16, _BATCH // 4), max(weights // 16, _BATCH))


def train_on(model: Model, squares, feats, labels, slots) -> None:
    _descend(model.w1, squares[0], model.sums, model.classes, feats, labels)
    own = np.flatnonzero(slots >= 0)
    if len(own):
        _descend(model.w2, squares[1], model.sums, model.words, [f[own] for f in feats],
                 labels[own] * model.words.width + slots[own])


def _log_leaves(weights, paths, feats, leaves) -> np.ndarray:
    """Natural log of the probability of each leaf."""
    _, z, _, ends = _decisions(weights, paths, feats, leaves)
    np.exp(np.negative(z, out=z), out=z)
    z += 1
    sums = np.cumsum(np.log(z, out=z), dtype=float)
    return np.diff(np.concatenate([[0.0], sums])[ends], prepend=0.0) * -1


def log_probabilities(model: Model, feats, labels, slots) -> np.ndarray:
    """Natural log of P(class | history), times P(word | class, history) for modelled words."""
    out = _log_leaves(model.w1, model.classes, feats, labels)
    own = np.flatnonzero(slots >= 0)
    out[own] += _log_leaves(model.w2, model.words, [f[own] for f in feats],
                            labels[own] * model.words.width + slots[own])
    return out


def _tokens(texts: pa.Array):
    """Distinct words (A-Z lowered, split at ASCII white space) and end of a batch's texts, the number of
    each token among them, and where each text starts."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string())))
    words = lists.flatten()
    ends = np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy(), dtype=np.int64)
    full = pc.binary_length(words).to_numpy() > 0
    if not full.all():    # white space at the edges of a text leaves empty words
        words = words.filter(pa.array(full))
        ends = np.concatenate([[0], np.cumsum(full)])[ends]
    coded = words.dictionary_encode()
    distinct = pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([END])])
    places = np.insert(coded.indices.to_numpy(), ends, len(distinct) - 1)
    return distinct, places, np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])


def count_words(rows: DataFrame) -> DataFrame:
    """(``word`` binary, ``c``) of column ``text``; tasks add up first and hold 300,000 words."""
    def count(batches):
        held: Counter = Counter()

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())],
                names=["word", "c"])

        for batch in batches:
            words, places, _ = _tokens(batch.column(0))
            values = words.to_numpy(zero_copy_only=False).tolist()
            held.update(dict(zip(values, np.bincount(places, minlength=len(values)).tolist())))
            if len(held) > 300_000:
                yield flush()
                held.clear()
        if held:
            yield flush()

    return rows.select("text").mapInArrow(count, "word binary, c long") \
        .groupBy("word").agg(F.sum("c").alias("c"))


def gather_vocabulary(counts: DataFrame) -> Vocabulary:
    """Totals, and the head: words with at least ``HEAD_SHARE`` of all tokens, a bounded number."""
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
                        F.count(F.lit(1)).alias("v")).first()
    head = counts.where(F.col("c") >= totals.n * HEAD_SHARE).collect() if totals.n else []
    head = sorted(((r.c, bytes(r.word)) for r in head), key=lambda x: (-x[0], x[1]))
    static = [ALPHA] * SHAPES
    shapes = counts.groupBy(F.expr(_SHAPE_SQL).alias("s")) \
        .agg(F.sum(F.col("c") + ALPHA).alias("m")).collect() if totals.n else []
    for r in shapes:
        static[r.s] += r.m
    for c, w in head:
        static[shape_of(w)] -= c + ALPHA
    return Vocabulary([w for _, w in head], [c for c, _ in head], totals.n, totals.v,
                      [max(s, ALPHA) for s in static], len(head))


def train(rows: DataFrame, vocabulary: Vocabulary, rounds: int = 2) -> Model:
    """Distributed gradient updates: in each round, every task takes adaptive gradient steps from the
    shared weights over its texts, and the changes are averaged by tokens, slice by slice. A round reads
    the texts whose key hash falls to it, so together the rounds read every text once. Tasks send their
    changes in two bytes a weight; beyond one task per core there are only so many tasks that all
    changes are half the size of full splits of the texts."""
    spark = rows.sparkSession
    model = Model(vocabulary)
    cuts, edge = 16, model.w1.size
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    tasks = max(spark.sparkContext.defaultParallelism,
                rows.rdd.getNumPartitions() * split // (2 * rounds * 2 * 2 * edge))

    for r in range(rounds):
        shared = spark.sparkContext.broadcast((model, vocabulary))

        def fit(batches, shared=shared):
            base, vocab = shared.value
            own = copy.copy(base)
            own.w1, own.w2 = base.w1.copy(), base.w2.copy()
            squares = [np.zeros_like(base.w1), np.zeros_like(base.w2)]
            lookup, seen = Lookup(vocab), 0
            for batch in batches:
                words, places, starts = _tokens(batch.column(0))
                label, slot, name, *_ = lookup.of(words)
                feats, a = history(name[places], starts[:-1]), 0
                while a < len(places):
                    b = a + step_tokens(seen + a, edge)
                    at = places[a:b]
                    train_on(own, squares, [f[a:b] for f in feats], label[at], slot[at])
                    a = b
                seen += len(places)
            if seen:
                pieces = np.array_split(np.concatenate([own.w1 - base.w1, own.w2 - base.w2]), cuts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(cuts), pa.int32()), pa.array([seen] * cuts, pa.int64()),
                     pa.array([p.astype("<f2").tobytes() for p in pieces], pa.binary())],
                    names=["cut", "seen", "change"])

        def add(batches):
            held: dict[int, list] = {}
            for batch in batches:
                for cut, seen, raw in zip(*[c.to_pylist() for c in batch.columns]):
                    value = np.frombuffer(raw, "<f2").astype("<f4") * np.float32(seen)
                    if cut in held:
                        held[cut][0] += seen
                        held[cut][1] += value
                    else:
                        held[cut] = [seen, value]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.int32()), pa.array([x[0] for x in held.values()], pa.int64()),
                 pa.array([x[1].tobytes() for x in held.values()], pa.binary())],
                names=["cut", "seen", "change"])

        kind = "cut int, seen long, change binary"
        part = rows.where(F.pmod(F.col("turn"), F.lit(rounds)) == r).select("text").coalesce(tasks)
        changes = part.mapInArrow(fit, kind).repartition(cuts, "cut").mapInArrow(add, kind).collect()
        if changes:
            seen = changes[0].seen
            total = np.concatenate([np.frombuffer(bytes(c.change), "<f4")
                                    for c in sorted(changes, key=lambda c: c.cut)]) / seen
            model.w1 += total[:edge]
            model.w2 += total[edge:]
        shared.destroy()
    return model


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                rounds: int = 2) -> DataFrame:
    """Train on the texts whose crc32 of the id is not divisible by 10 and score all texts.

    Per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (smoothed
    unigram) and ``score``, both as log10 of the text's probability. Unseen words share one slot of
    ``ALPHA`` per static class, as they share one in the base. Null texts are empty (one end token);
    a null id reads as an empty string; repeated rows count and score each; with no training text
    all words are unseen; other columns are ignored. Words below ``HEAD_SHARE`` are looked up by a
    join, in which no key has more than that share of the tokens.
    """
    spark = docs.sparkSession
    prepare(spark)
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       (F.crc32(name) % 10 == 0).alias("held_out"),
                       F.xxhash64(name).alias("turn"))
    training = rows.where("NOT held_out")
    counts = stored(count_words(training), "words")
    vocabulary = gather_vocabulary(counts)
    model = train(training.select("text", "turn"), vocabulary, rounds)
    shared = spark.sparkContext.broadcast((model, vocabulary))
    id_type = rows.schema["id"].dataType
    kind = f"key long, id {id_type.simpleString()}, held_out boolean, n_tokens long, " \
        "n_known long, base double, score double, tail array<struct<word:binary,tf:int>>"

    def score(batches):
        model, vocab = shared.value
        lookup, key = Lookup(vocab), TaskContext.get().partitionId() << 33
        for batch in batches:
            docs = len(batch)
            if not docs:
                continue
            words, places, starts = _tokens(batch.column(1))
            label, slot, names, logc, static, at = lookup.of(words)
            feats = history(names[places], starts[:-1])
            logp = static[places]
            for a in range(0, len(places), _BATCH):
                p = places[a:a + _BATCH]
                logp[a:a + _BATCH] += log_probabilities(
                    model, [f[a:a + _BATCH] for f in feats], label[p], slot[p]) / math.log(10)
            head = at >= 0
            base = np.where(head, logc, 0.0) - lookup.norm
            rare = np.flatnonzero(~head[places])
            owner = np.repeat(np.arange(docs), np.diff(starts))[rare]
            pairs, tf = np.unique(owner * len(words) + places[rare], return_counts=True)
            tails = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(pairs, np.arange(docs + 1) * len(words)), pa.int32()),
                pa.StructArray.from_arrays([words.take(pa.array(pairs % len(words))),
                                            pa.array(tf, pa.int32())], ["word", "tf"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(key, key + docs), pa.int64()), batch.column(0),
                 batch.column(2), pa.array(np.diff(starts)),
                 pa.array(np.add.reduceat(head[places].astype(np.int64), starts[:-1])),
                 pa.array(np.add.reduceat(base[places], starts[:-1])),
                 pa.array(np.add.reduceat(logp, starts[:-1])), tails],
                names=["key", "id", "held_out", "n_tokens", "n_known", "base", "score", "tail"])
            key += docs

    scored = stored(rows.select("id", "text", "held_out").mapInArrow(score, kind), "scores")
    tail = scored.select("key", F.explode("tail").alias("t")).select("key", "t.word", "t.tf")
    looked = tail.join(counts, "word", "left").groupBy("key").agg(
        F.sum(F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + ALPHA)).alias("rest"),
        F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).cast("long").alias("more"))
    rest = F.coalesce("rest", F.lit(0.0))
    return scored.drop("tail").join(looked, "key", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + rest).alias("base_score"), (F.col("score") + rest).alias("score"))
