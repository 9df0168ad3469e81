"""Language identification: a linear-chain conditional random field over the words of a text."""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from rtml.llm.common import prepare, stored

#: The field is fitted on at most so many segments a language, at most so many of one document,
#: each of up to so many words and letters; documents and segments are chosen by hash.
FIT_DOCS, FIT_SEGMENTS, DOC_SEGMENTS, SEGMENT_WORDS, SEGMENT_LETTERS = 1000, 1500, 8, 24, 600
#: Rows of feature weights and of word counts, and languages at most.
FEATURES, LEXICON, MAX_LANGS = 1 << 17, 1 << 16, 128
_BLOCK = 32
_WORD = re.compile(r"[^\W\d_]+")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_AFFIXES, _GRAMS = (1, 2, 3, 4), (2, 3, 4)


def _place(h: np.ndarray, kind: int) -> np.ndarray:
    h = (h ^ np.uint64(kind * 0x51ED27)) * _B
    h ^= h >> np.uint64(31)
    return (h * _A >> np.uint64(40)).astype(np.int64) % FEATURES


def _slot(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word) % LEXICON


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the weight table, and the word each belongs to, for lower-cased words.

    Beginnings and ends of one to four letters, letter n-grams of two to four with the borders,
    and the whole word.
    """
    flat = np.frombuffer(("^" + "$^".join(words) + "$").encode("utf-32-le"), np.uint32) \
        .astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    start = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(words)), size)
    places, owners, gram = [], [], (flat + np.uint64(1)) * _A
    for k in range(2, max(*_AFFIXES, *_GRAMS) + 2):
        gram = (gram[:-1] ^ (gram[:-1] >> np.uint64(29))) * _B + flat[k - 1:]
        inside = np.flatnonzero(owner[k - 1:] == owner[:len(gram)])
        if k in _GRAMS:
            places.append(_place(gram[inside], k))
            owners.append(owner[inside])
        if k - 1 in _AFFIXES:
            fits = np.flatnonzero(size >= k)
            for kind, at in ((16, start[fits]), (32, start[fits] + size[fits] - k)):
                places.append(_place(gram[at], kind + k))
                owners.append(fits)
    whole = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    places.append(_place(whole, 64))
    owners.append(np.arange(len(words)))
    return np.concatenate(places), np.concatenate(owners)


def lexicon_odds(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """How much more a word's share in each language is than its mean share, as a bounded log."""
    rate = (counts + 0.5) / (totals + 1.0)
    return np.clip(np.log(rate / rate.mean(axis=-1, keepdims=True)), -3.0, 3.0)


def _scaled(emitted: np.ndarray) -> np.ndarray:
    """Emission factors, the largest of each word 1 and none so small that products vanish."""
    return np.exp(np.maximum(emitted - emitted.max(axis=1, keepdims=True), -60.0))


class Field:
    """Weights of a linear-chain field: word features, lexicon weight, first label, transitions."""

    def __init__(self, langs: list[str], counts: np.ndarray, totals: np.ndarray):
        n = len(langs)
        self.langs, self.counts, self.totals = langs, counts, totals
        self.weights = np.zeros((FEATURES, n), np.float32)
        self.lexicon, self.first = 1.0, np.zeros(n)
        self.moves = np.full((n, n), -math.log(n + 1.0)) + np.eye(n) * 3

    def emissions(self, words: list[str]) -> np.ndarray:
        """Scores (word, language) of distinct lower-cased words."""
        odds = lexicon_odds(self.counts[[_slot(w) for w in words]], self.totals)
        rows, owner = word_features(words)
        out = self.lexicon * odds
        picked = self.weights[rows]
        for j in range(out.shape[1]):
            out[:, j] += np.bincount(owner, picked[:, j], len(words))
        return out

    def marginals(self, emitted: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Posterior (word, language) of sequences laid end to end."""
        ahead, behind = self.messages(emitted, lengths)
        both = ahead * behind
        return both / both.sum(axis=1, keepdims=True)

    def messages(self, emitted: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scaled forward (word included) and backward (word excluded) messages of every word.

        Sequences are cut into blocks of ``_BLOCK`` words that are worked on side by side: first the
        product of transfer matrices of every block, then the scaled messages from block to block,
        then all words inside their blocks. The result is that of the plain recursion.
        """
        n = emitted.shape[1]
        if not len(emitted):
            return emitted, emitted
        move = np.exp(self.moves - self.moves.max())
        e = _scaled(emitted)
        blocks = -(-lengths // _BLOCK)
        base = np.cumsum(blocks) - blocks
        starts = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(lengths)), lengths)
        offset = np.arange(len(emitted)) - starts[owner]
        slot = (base[owner] + offset // _BLOCK) * _BLOCK + offset % _BLOCK
        total = int(blocks.sum())
        cells = np.ones((total * _BLOCK, n))
        cells[slot] = e
        real = np.zeros(total * _BLOCK, bool)
        real[slot] = True
        cells, real = cells.reshape(total, _BLOCK, n), real.reshape(total, _BLOCK)
        heads = base[blocks > 0]
        head = np.zeros(total, bool)
        head[heads] = True
        first = np.exp(self.first - self.first.max())

        # transfer[b] maps the message before block b to the one after it
        transfer = np.broadcast_to(np.eye(n), (total, n, n)).copy()
        for t in range(_BLOCK):
            on = real[:, t] & ~head if t == 0 else real[:, t]
            step = transfer[on] @ move * cells[on, t][:, None, :]
            transfer[on] = step / step.max(axis=(1, 2), keepdims=True)
        start = first * cells[:, 0]
        into = np.empty((total, n))       # message before the block (at a head: after its first word)
        back = np.ones((total, n))        # message from everything after the block
        many, depth = base[blocks > 0], blocks[blocks > 0]
        into[many] = start[many]
        order = np.argsort(-depth, kind="stable")
        many, depth = many[order], depth[order]
        for d in range(1, int(depth[0]) if len(depth) else 0):
            live = many[:np.searchsorted(-depth, -d)] + d
            got = np.einsum("bi,bij->bj", into[live - 1], transfer[live - 1])
            into[live] = got / got.sum(axis=1, keepdims=True)
        for d in range(int(depth[0]) - 1 if len(depth) else 0, 0, -1):
            live = many[:np.searchsorted(-depth, -d)] + d
            got = np.einsum("bij,bj->bi", transfer[live], back[live])
            back[live - 1] = got / got.max(axis=1, keepdims=True)
        ahead = np.empty((total, _BLOCK, n))
        now = into
        for t in range(_BLOCK):
            step = now @ move * cells[:, t]
            if t == 0:
                step = np.where(head[:, None], start, step)
            now = np.where(real[:, t, None], step / step.sum(axis=1, keepdims=True), now)
            ahead[:, t] = now
        behind, now = np.empty((total, _BLOCK, n)), back
        for t in range(_BLOCK - 1, -1, -1):
            behind[:, t] = now
            step = (cells[:, t] * now) @ move.T
            now = np.where(real[:, t, None], step / step.max(axis=1, keepdims=True), now)
        return ahead.reshape(-1, n)[slot], behind.reshape(-1, n)[slot]


def fit_field(field: Field, segments: list[tuple[int, list[str]]], rounds: int = 6,
              batch: int = 256, chain: int = 4, rate: float = 0.3, ridge: float = 1e-6) -> Field:
    """Conditional likelihood of chains of ``chain`` segments, by adaptive gradient steps.

    ``segments`` are (language number, words) in random order; a chain of neighbours switches
    between languages as code-switched text does, which is what transitions are learned from.
    A word's own occurrence is taken out of its lexicon counts while fitting.
    """
    n = len(field.langs)
    chains = [segments[i:i + chain] for i in range(0, len(segments), chain)]
    grads = {k: np.full_like(v, 1e-4, dtype=np.float64) for k, v in
             (("w", field.weights), ("f", field.first), ("m", field.moves))}
    for turn in range(rounds):
        step = rate / (1 + turn)
        for at in range(0, len(chains), batch):
            part = chains[at:at + batch]
            words = [w for c in part for _, s in c for w in s]
            label = np.array([y for c in part for y, s in c for _ in s])
            lengths = np.array([sum(len(s) for _, s in c) for c in part])
            number = {w: i for i, w in enumerate(dict.fromkeys(words))}
            index = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
            rows, owner = word_features(list(number))
            counts = field.counts[[_slot(w) for w in number]][index]
            counts[np.arange(len(words)), label] = np.maximum(
                counts[np.arange(len(words)), label] - 1, 0)
            odds = lexicon_odds(counts, field.totals)
            picked = field.weights[rows]
            scores = np.stack([np.bincount(owner, picked[:, j], len(number)) for j in range(n)], 1)
            emitted = scores[index] + field.lexicon * odds
            ahead, behind = field.messages(emitted, lengths)
            gap = -ahead * behind
            gap /= -gap.sum(axis=1, keepdims=True)
            gap[np.arange(len(words)), label] += 1
            per_word = np.stack([np.bincount(index, gap[:, j], len(number)) for j in range(n)], 1)
            used, back = np.unique(rows, return_inverse=True)
            g = np.stack([np.bincount(back, per_word[owner, j], len(used)) for j in range(n)], 1) \
                / len(part) - ridge * field.weights[used]
            grads["w"][used] += g * g
            field.weights[used] += step * g / np.sqrt(grads["w"][used])
            field.lexicon = max(0.1, field.lexicon + 0.02 * step * float((gap * odds).sum())
                                / len(words))
            starts = np.cumsum(lengths) - lengths
            g = gap[starts].sum(axis=0) / len(part)
            grads["f"] += g * g
            field.first += step * g / np.sqrt(grads["f"])
            g = _move_gap(field, emitted, label, starts, ahead, behind) / len(part)
            grads["m"] += g * g
            field.moves += step * g / np.sqrt(grads["m"])
    return field


def _move_gap(field: Field, emitted, label, starts, ahead, behind) -> np.ndarray:
    """Observed less expected transitions of the chains."""
    n = len(field.langs)
    inner = np.ones(len(label), bool)
    inner[starts] = False
    at = np.flatnonzero(inner)
    seen = np.bincount(label[at - 1] * n + label[at], minlength=n * n).reshape(n, n)
    e = _scaled(emitted[at])
    pair = ahead[at - 1][:, :, None] * np.exp(field.moves - field.moves.max()) \
        * (e * behind[at])[:, None, :]
    return seen - (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    return [w.lower() for w in _WORD.findall(text) if w.isalpha() or any(map(str.isalpha, w))] \
        if text else []


class _Slots(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= 200_000:
            self.clear()
        value = self[word] = _slot(word)
        return value


def _count_lexicon(learn: DataFrame, langs: list[str]) -> np.ndarray:
    """Occurrences of all words of all learning rows, by slot and language."""
    number = {lang: i for i, lang in enumerate(langs)}

    def run(batches):
        counts, slots = np.zeros((len(number), LEXICON), np.int64), _Slots()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                at = np.fromiter(map(slots.__getitem__, words), np.int64, len(words))
                if len(at) * 8 < LEXICON:
                    np.add.at(counts[number[lang]], at, 1)
                else:
                    counts[number[lang]] += np.bincount(at, minlength=LEXICON)
        for i, row in enumerate(counts):
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i)), pa.array(at),
                                              pa.array(row[at])], names=["lang", "slot", "n"])

    found = learn.select("lang", "text").mapInArrow(run, "lang long, slot long, n long") \
        .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((LEXICON, len(langs)))
    out[found["slot"].to_numpy(), found["lang"].to_numpy()] = found["n"].to_numpy()
    return out


def _pick_segments(learn: DataFrame, rows: dict[str, int], langs: list[str]
                   ) -> list[tuple[int, list[str]]]:
    """Segments to fit on, in order of a hash of their words."""
    def run(batches):
        for batch in batches:
            out = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words, found = words_of(text.as_py()), []
                for at in range(0, len(words), SEGMENT_WORDS):
                    segment = " ".join(words[at:at + SEGMENT_WORDS])
                    if len(segment) <= SEGMENT_LETTERS:
                        found.append((xxhash.xxh3_64_intdigest(segment) >> 1, segment))
                out += [(lang, h, s) for h, s in sorted(set(found))[:DOC_SEGMENTS]]
            lang, h, segment = zip(*out) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(h, pa.int64()),
                 pa.array(segment, pa.string())], names=["lang", "h", "segment"])

    share = F.lit(0.0)
    for lang, n in rows.items():
        share = F.when(F.col("lang") == lang, F.lit(1.3 * FIT_DOCS / n)).otherwise(share)
    lot = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / float(1 << 30)
    order = Window.partitionBy("lang").orderBy("h", "segment")
    chosen = learn.where(lot < share).select("lang", "text") \
        .mapInArrow(run, "lang string, h long, segment string") \
        .withColumn("place", F.row_number().over(order)).where(F.col("place") <= FIT_SEGMENTS) \
        .select("lang", "h", "segment").toArrow().to_pylist()
    chosen.sort(key=lambda r: (r["h"], r["segment"], r["lang"]))
    return [(langs.index(r["lang"]), r["segment"].split(" ")) for r in chosen]


def train_field(docs: DataFrame, learn=None, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang") -> Field | None:
    """A field fitted on the rows of ``docs`` for which the column ``learn`` holds (default: all)
    and whose text and language are not null; None without such rows.

    The lexicon counts every word of every such row; feature weights and transitions are fitted on
    the driver on a sample bounded by ``FIT_DOCS`` and ``FIT_SEGMENTS`` per language. More than
    ``MAX_LANGS`` languages are refused.
    """
    prepare(docs.sparkSession)
    rows = docs if learn is None else docs.where(learn)
    rows = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.col(lang_col).cast("string").alias("lang")) \
        .where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r.lang: r["count"] for r in
             rows.groupBy("lang").count().limit(MAX_LANGS + 1).collect()}
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not sizes:
        return None
    langs = sorted(sizes)
    counts = _count_lexicon(rows, langs)
    return fit_field(Field(langs, counts, counts.sum(axis=0)), _pick_segments(rows, sizes, langs))


class _Tagger:
    """Posteriors of texts, with the scores of words met lately."""

    def __init__(self, field: Field):
        self.field, self.known, self.scores = field, {}, np.empty((0, len(field.langs)))

    def __call__(self, texts: list[list[str]]) -> np.ndarray:
        words = [w for t in texts for w in t]
        fresh = list(dict.fromkeys(w for w in words if w not in self.known))
        if len(self.known) + len(fresh) > 150_000:
            self.known, self.scores = {}, self.scores[:0]
            fresh = list(dict.fromkeys(words))
        if fresh:
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
            parts = [self.field.emissions(fresh[i:i + 20_000])
                     for i in range(0, len(fresh), 20_000)]
            self.scores = np.concatenate([self.scores, *parts])
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        return self.field.marginals(self.scores[at], np.array([len(t) for t in texts]))


def _groups(texts: list, words: int = 100_000):
    """Slices of neighbouring texts with about so many words together."""
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= words or i == len(texts) - 1:
            yield at, i + 1
            at, size = i + 1, 0


def identify(docs: DataFrame, field: Field | None, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Id, ``lang_pred`` and ``score`` of every row of ``docs``.

    ``lang_pred`` is the language with the largest share of the words' posterior mass (ties: the
    first in order of names) and ``score`` this share. A text that is null or without a letter, and
    every text if ``field`` is None, is ``und`` with score 0. Texts are labelled whole; repeated rows
    are labelled alike, ids may be null, an empty table gives no rows, other columns are not read.
    """
    return _applied(docs, field, id_col, text_col, "lang_pred string, score double", _whole)


def language_runs(docs: DataFrame, field: Field | None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Id and ``runs`` of every row: the stretches of one language in reading order.

    A run has ``lang``, ``start`` and ``stop`` (code points, stop exclusive), ``words`` and ``score``
    (mean posterior); every word has the language of its largest posterior. Texts without letters
    have no runs.
    """
    kind = "runs array<struct<lang:string,start:int,stop:int,words:int,score:double>>"
    return _applied(docs, field, id_col, text_col, kind, _runs)


def _applied(docs, field, id_col, text_col, kind, finish):
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(field)
    made = spark.createDataFrame([], kind).schema
    types = [to_arrow_type(f.dataType) for f in made]

    def run(batches):
        tagger = _Tagger(sent.value) if sent.value is not None else None
        for batch in batches:
            texts = batch.column(1).to_pylist()
            words = [words_of(t) if tagger else [] for t in texts]
            rows = []
            for a, b in _groups(words):
                post = tagger(words[a:b]) if tagger else np.empty((0, 1))
                ends = np.cumsum([0, *map(len, words[a:b])])
                rows += [finish(sent.value, texts[i], post[ends[i - a]:ends[i - a + 1]])
                         for i in range(a, b)]
            columns = [pa.array([r[j] for r in rows], t) for j, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns],
                                             names=[batch.schema.names[0], *made.names])

    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, StructType([rows.schema[0], *made.fields]))


def _whole(field, text, post):
    if not len(post):
        return "und", 0.0
    share = post.mean(axis=0)
    best = int(np.argmax(share))
    return field.langs[best], float(min(max(share[best], 0.0), 1.0))


def _runs(field, text, post):
    if not len(post):
        return ([],)
    at = [m.span() for m in _WORD.finditer(text) if any(map(str.isalpha, m.group()))]
    best = post.argmax(axis=1)
    cuts = np.append(np.flatnonzero(np.append(True, best[1:] != best[:-1])), len(best))
    return ([{"lang": field.langs[best[a]], "start": at[a][0], "stop": at[b - 1][1],
              "words": int(b - a), "score": float(post[a:b, best[a]].mean())}
             for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())],)
