"""Benchmark decontamination by winnowing: sampled k-gram fingerprints, then extension of hits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rtml.llm.common import giving_back, prepare, stored
from rtml.llm.words import HashOfWord, gram_hashes, plain_words

#: Words of benchmark text in one block of the index; each block is one broadcast of about 24 MB.
BLOCK_WORDS = 1_000_000


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions whose hash is the least of some run of ``window`` k-grams (all of equal least)."""
    runs = len(grams) - window + 1
    if runs <= 0:
        return np.empty(0, np.int64)
    least = grams[:runs].copy()
    for i in range(1, window):
        np.minimum(least, grams[i:i + runs], out=least)
    taken = np.zeros(len(grams), bool)
    for i in range(window):
        taken[i:i + runs] |= grams[i:i + runs] == least
    return np.flatnonzero(taken)


class Index:
    """Fingerprints and word hashes of one block of items.

    Any ``span`` consecutive words hold a winnowed ``gram``-gram, on both sides the same one, since
    a run of ``span - gram + 1`` grams is ``span`` words long. Items of fewer words are kept whole.
    """

    def __init__(self, items: list[tuple[str, bytes | None]], span: int, gram: int):
        self.span, self.gram, self.window = span, gram, span - gram + 1
        hasher = HashOfWord()
        self.names, self.words, marks, self.short = [], [], [], {}
        for name, text in items:
            words = hasher.of(plain_words(text))
            if not len(words):
                continue
            at = len(self.names)
            self.names.append(name)
            self.words.append(words)
            if len(words) < span:
                whole = int(gram_hashes(words, len(words))[0])
                self.short.setdefault(len(words), {}).setdefault(whole, []).append(at)
                continue
            grams = gram_hashes(words, gram)
            marks += [(int(grams[q]), at, q) for q in winnow(grams, self.window)]
        marks.sort()
        self.marks = np.array([m[0] for m in marks], np.uint64)
        self.places = [m[1:] for m in marks]
        self.short = {n: (np.array(sorted(d), np.uint64), d) for n, d in self.short.items()}

    def search(self, words: np.ndarray, starts: np.ndarray,
               found: list[tuple[list[tuple[int, int]], set[str]]]) -> None:
        """Add spans and items to ``found`` (one entry per document; ``starts`` has the borders)."""
        grams = gram_hashes(words, self.gram)
        at = winnow(grams, self.window)
        for p in at[_member(self.marks, grams[at])] if len(self.marks) else ():
            doc = int(np.searchsorted(starts, p, "right")) - 1
            begin, end = int(starts[doc]), int(starts[doc + 1])
            low = np.searchsorted(self.marks, grams[p], "left")
            high = np.searchsorted(self.marks, grams[p], "right")
            spans, names = found[doc]
            for item, q in self.places[low:high]:
                span = self._extend(words, int(p), begin, end, item, q)
                if span:
                    spans.append((span[0] - begin, span[1] - begin))
                    names.add(self.names[item])
        for n, (keys, holders) in self.short.items():
            grams = gram_hashes(words, n)
            for p in np.flatnonzero(_member(keys, grams)):
                doc = int(np.searchsorted(starts, p, "right")) - 1
                if p + n <= starts[doc + 1]:
                    spans, names = found[doc]
                    spans.append((int(p - starts[doc]), int(p - starts[doc]) + n))
                    names.update(self.names[i] for i in holders[int(grams[p])])

    def _extend(self, words, p, begin, end, item, q):
        """The longest common run through one hit, if it has ``span`` words."""
        own = self.words[item]
        left = min(p - begin, q)
        back = words[p - left:p][::-1] != own[q - left:q][::-1]
        left = int(back.argmax()) if back.any() else left
        right = min(end - p, len(own) - q)
        ahead = words[p:p + right] != own[q:q + right]
        right = int(ahead.argmax()) if ahead.any() else right
        return (p - left, p + right) if left + right >= self.span else None


def _member(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(values), bool)
    return keys[np.minimum(np.searchsorted(keys, values), len(keys) - 1)] == values


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _index_blocks(items: DataFrame, span: int, gram: int) -> Iterator[Index]:
    block, words = [], 0
    for name, text in items.toLocalIterator():
        raw = None if text is None else text.encode("utf-8", "surrogatepass")
        block.append(("null" if name is None else str(name), raw))
        words += len(plain_words(raw))
        if words >= BLOCK_WORDS:
            yield Index(block, span, gram)
            block, words = [], 0
    if block:
        yield Index(block, span, gram)


def find_benchmark_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                         text_col: str = "text", item_col: str = "item_id",
                         item_text_col: str = "text", span: int = 10, gram: int = 5,
                         carry: list[Column] | None = None) -> DataFrame:
    """Per row of ``docs``: id, ``n_words``, ``spans`` (array of word ranges ``start``, ``end``)
    that lie inside an occurrence of ``span`` consecutive words of an item, and ``items`` (the ids of
    those items as strings, sorted).

    An item of fewer words counts as one window. Null or empty texts have no words and no hits; a
    null item id reads ``null``; repeated items count once, repeated documents keep a row each. Other
    columns of either table are not looked at. Documents are never shuffled: the benchmark is walked
    in blocks of ``BLOCK_WORDS`` words, each broadcast once, and further blocks add to the written
    result of the ones before. ``carry`` names further columns of ``docs`` to return.
    """
    if not 1 <= gram <= span:
        raise ValueError("gram must lie in 1..span")
    spark = docs.sparkSession
    prepare(spark)
    spans_type = T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                           T.StructField("end", T.LongType())]))
    empty = F.array().cast(spans_type)
    now = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                      F.lit(None).cast("long").alias("n_words"), empty.alias("spans"),
                      F.array().cast("array<string>").alias("items"), *(carry or []))
    wanted = items.select(F.col(item_col).alias("_i"), F.col(item_text_col).alias("_t"))
    first = True
    for index in _index_blocks(wanted, span, gram):
        if not first:
            now = stored(now, "decontaminate")
        now, first = _pass(now, index), False
    if first:
        now = _pass(now, Index([], span, gram))
    return now.drop("_text").withColumnRenamed("_id", id_col)


def _pass(now: DataFrame, index: Index) -> DataFrame:
    shared = now.sparkSession.sparkContext.broadcast(index)
    kind = now.schema

    def scan(batches):
        hasher, own = HashOfWord(), shared.value
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            lists = [plain_words(t) for t in texts]
            starts = np.zeros(len(lists) + 1, np.int64)
            np.cumsum([len(x) for x in lists], out=starts[1:])
            words = np.concatenate([hasher.of(x) for x in lists]) if lists else \
                np.empty(0, np.uint64)
            found = [([], set()) for _ in lists]
            own.search(words, starts, found)
            spans, items = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            for k, (more, names) in enumerate(found):
                if more:
                    before = [(s["start"], s["end"]) for s in spans[k]]
                    spans[k] = [{"start": a, "end": b} for a, b in _merged(before + more)]
                    items[k] = sorted(names.union(items[k]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(starts), pa.int64()),
                 pa.array(spans, batch.schema.field(3).type),
                 pa.array(items, batch.schema.field(4).type), *batch.columns[5:]],
                schema=batch.schema)

    return now.mapInArrow(giving_back(scan), kind)


def contamination(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of ``find_benchmark_spans``."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return spans.select(F.col(id_col), "n_words", hit.alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (hit > 0).alias("contaminated"))

