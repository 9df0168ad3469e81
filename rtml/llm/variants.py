"""Spelling variants: words one letter apart, found by PartEnum signatures of letter multisets."""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rtml.llm.common import prepare, stored

#: Differing elements of two multisets after one insertion, deletion or replacement of a letter.
DISTANCE = 2
#: Letters A-Z lowered, À to ÿ as they are, all else blank; one byte of Latin-1 is one code point.
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 192 else 32
              for c in range(256))
_WORDS = 400_000
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def letter_runs(text: str | None) -> list[bytes]:
    """Maximal runs of ``[A-Za-zÀ-ÿ]`` in Latin-1, A-Z lowered."""
    return text.encode("latin-1", "replace").translate(_KEEP).split() if text else []


def _slipped(word: bytes, start: int, slip: int) -> bytes:
    """``word``, or in one of ``slip`` cases the word without one letter."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
    if h % slip:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_letters: int = 6, min_count: int = 5, slip: int | None = None) -> DataFrame:
    """``word`` and ``n`` of all letter runs that are long and frequent enough.

    With ``slip``, one of ``slip`` pairs of document and word loses a letter, by the CRC-32 of
    ``<id>:<word>``: slips of the pen whose right spelling is known.
    """
    def run(batches):
        counts = Counter()

        def flush():
            words, n = [w.decode("latin-1") for w in counts], list(counts.values())
            for at in range(0, len(words), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[at:at + (1 << 16)], pa.string()),
                     pa.array(n[at:at + (1 << 16)], pa.int64())], names=["word", "n"])
            counts.clear()

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, text in enumerate(batch.column(1)):
                runs = [w for w in letter_runs(text.as_py()) if len(w) >= min_letters]
                if slip is None:
                    counts.update(runs)
                    continue
                start = zlib.crc32(f"{ids[i]}:".encode())
                for word, n in Counter(runs).items():
                    word = _slipped(word, start, slip)
                    if len(word) >= min_letters:
                        counts[word] += n
            if len(counts) > _WORDS:
                yield from flush()
        yield from flush()

    prepare(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col))
    return rows.mapInArrow(run, "word string, n long").groupBy("word") \
        .agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _MIX[0]
    for m in _MIX[1:]:
        x = (x ^ (x >> np.uint64(29))) * m
    return x ^ (x >> np.uint64(32))


def signatures(words: list[str], parts: int) -> tuple[np.ndarray, np.ndarray]:
    """PartEnum signatures of ``words`` (none empty): keys, one row per word, and roles per column.

    A multiset is the binary vector of its elements (letter, how many-th of its kind). A hash deals
    the dimensions to ``parts`` parts; two vectors that differ in two of them agree on all parts
    but two at most, so they share the signature of one subset of ``parts - 2`` parts whole.
    One edit also leaves one half of the shorter word, its start or its end, untouched; with the
    shorter length this goes into the key, so that a key is shared by few words. Role 0: the word
    is the shorter one or of equal length; role 1: it is the longer one.
    """
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(words)), size)
    order = np.lexsort((flat, owner))
    letter = flat[order]
    new = np.append(True, (letter[1:] != letter[:-1]) | (owner[order][1:] != owner[order][:-1]))
    at = np.arange(len(flat))
    nth = at - np.maximum.accumulate(np.where(new, at, 0))
    element = _mixed(letter | nth.astype(np.uint64) << np.uint64(21))
    part = (element >> np.uint64(40)) % np.uint64(parts)
    sums = [_mixed(np.add.reduceat(np.where(part == p, element, np.uint64(0)), start) +
                   np.uint64(p + 1)) for p in range(parts)]
    subsets = [_mixed(sum((sums[p] for p in chosen), np.uint64(i)))
               for i, chosen in enumerate(combinations(range(parts), parts - DISTANCE))]
    place = at - np.repeat(start, size)
    powers = np.multiply.accumulate(np.full(int(size.max()) + 1, _MIX[0]))
    ahead = np.append(np.uint64(0), np.cumsum((flat + _MIX[2]) * powers[place]))
    back = np.append(np.uint64(0), np.cumsum((flat + _MIX[1]) *
                                             powers[np.repeat(size, size) - 1 - place]))
    keys, roles = [], []
    for role in (0, 1):
        short = size - role
        half = short // 2
        halves = (ahead[start + half] - ahead[start], back[start + size] - back[start + size - half])
        for side, kept in enumerate(halves):
            tag = _mixed(kept + np.uint64(side) + (short.astype(np.uint64) << np.uint64(1)))
            keys += [s ^ tag for s in subsets]
            roles += [role] * len(subsets)
    return np.stack(keys, 1).view(np.int64), np.array(roles, np.int8)


def near_pairs(words: DataFrame, parts: int = 4) -> DataFrame:
    """Pairs ``a, b, n_a, n_b`` of different words of ``words`` (word, n) one edit apart, each once.

    Signatures are joined by equality; every candidate is verified by its edit distance while the
    join streams, so only true pairs are shuffled. The join is one that adaptive execution splits
    if many words share a signature.
    """
    def run(batches):
        for batch in batches:
            found = batch.column(0).to_pylist()
            if not found:
                continue
            keys, roles = signatures(found, parts)
            k = keys.shape[1]
            at = pa.array(np.repeat(np.arange(len(found)), k))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.tile(roles, len(found))),
                 batch.column(0).take(at), batch.column(1).take(at)],
                names=["key", "role", "word", "n"])

    signed = words.select("word", "n").mapInArrow(run, "key long, role byte, word string, n long")
    a, b = signed.alias("a"), signed.alias("b").hint("merge")
    once = F.expr("a.role < b.role OR (a.role + b.role = 0 AND a.word < b.word)")
    one_edit = F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1
    return a.join(b, (F.col("a.key") == F.col("b.key")) & once & one_edit) \
        .select(F.col("a.word").alias("a"), F.col("b.word").alias("b"),
                F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b")).dropDuplicates(["a", "b"])


def variant_groups(words: DataFrame, ratio: float = 5, parts: int = 4) -> DataFrame:
    """Per word of ``words`` (word, n; distinct): ``form, root, n, n_near, form_n``.

    ``n_near`` words are one edit away. ``form`` is the most frequent of them (ties: the smallest in
    code-point order) if it is at least ``ratio`` times as frequent as the word, else null, and
    ``root`` the end of the chain of forms, the word itself if it has none. Chains are followed by
    joining the table of forms with itself, which doubles the steps each round; counts rise by
    ``ratio`` per step, so a chain is as long as the logarithm of the largest count.

    A null or empty word has no near words; an empty table gives no rows.
    """
    words = stored(words.select("word", "n"), "words")
    pairs = near_pairs(words.where("length(word) > 1"), parts)
    ends = F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))))
    best = pairs.select(ends.alias("e")).select("e.*").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("best"))
    found = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.col1") >= ratio * F.col("n"), F.col("best"))
        .alias("best")).select("word", "n", "n_near", F.col("best.near").alias("form"),
                               (-F.col("best.col1")).alias("form_n")), "forms")
    chain = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        on = chain.select(F.col("word").alias("root"), F.col("root").alias("further"))
        chain = stored(chain.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved")), "chains")
        if chain.where("moved").isEmpty():
            break
        chain = chain.drop("moved")
    return found.join(chain.drop("moved"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_letters: int = 6, min_count: int = 5, ratio: float = 5,
                      slip: int | None = None) -> DataFrame:
    """``variant_groups`` of the words of all whole texts.

    Null and empty texts have no words, a null id counts as an empty one (it matters with ``slip``
    only), repeated rows count each, and other columns are not read.
    """
    return variant_groups(count_words(docs, id_col, text_col, min_letters, min_count, slip), ratio)
