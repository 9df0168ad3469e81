"""Phrase collocations: frequency-ranked ids, pairs counted in tiles, frequent pairs ranked again."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rtml.llm.common import prepare, stored
from rtml.plans.prefix import CHUNK, running_totals, with_chunk

#: Entries of one dictionary that are sent to tasks; the rest is looked up by a shuffle join.
HEAD = 1 << 19
#: Side of a tile in ids, and how many blocks of ids on each axis are counted densely.
TILE_BITS, DENSE_BLOCKS = 9, 4
_TILE = 1 << TILE_BITS
_DENSE_TILES = 48
_BUFFERED, _COO, _WORDS = 1 << 21, 1 << 22, 300_000
_CUT = b"\xff"  # no byte of UTF-8
_KEEP = bytes(c + 32 if 65 <= c <= 90 else 255 if c in b".,;:!?" or 10 <= c <= 13 else c
              for c in range(256))


def piece_words(text: bytes | None) -> list[bytes]:
    """A-Z lowered words, with ``_CUT`` between pieces."""
    return text.translate(_KEEP).replace(_CUT, b" \xff ").split() if text else []


def _short(word: bytes) -> bytes:
    """Words over 64 bytes by their digest, so that a dictionary entry has a bounded size."""
    return word if len(word) <= 64 else _CUT + hashlib.sha256(word).digest()


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        return self.get(_short(word), 0) if len(word) > 64 else 0


def _by_lang(batch) -> dict:
    """Row numbers of an Arrow batch by its first column."""
    rows = defaultdict(list)
    for i, lang in enumerate(batch.column(0).to_pylist()):
        rows[lang].append(i)
    return rows


def _count_words(batches):
    counts = defaultdict(Counter)

    def flush():
        for lang, found in counts.items():
            words = [*found, None]
            n = [*found.values(), sum(found.values())]
            for at in range(0, len(words), 1 << 16):
                w = pa.array(words[at:at + (1 << 16)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(w), pa.string()), w,
                     pa.array(n[at:at + (1 << 16)], pa.int64())], names=["lang", "word", "n"])
        counts.clear()

    for batch in batches:
        texts = batch.column(1)
        for lang, rows in _by_lang(batch).items():
            for i in rows:
                counts[lang].update(piece_words(texts[i].as_py()))
            counts[lang].pop(_CUT, None)
        if sum(map(len, counts.values())) > _WORDS:
            yield from flush()
    yield from flush()


def trimmed(ids: np.ndarray) -> np.ndarray:
    """Runs of two or more ids above 0, each followed by one 0; nothing else can hold a pair."""
    if len(ids) < 2:
        return ids[:0]
    on = np.concatenate([[False], ids > 0, [False]])
    run = on[1:-1] & (on[:-2] | on[2:])
    last = np.flatnonzero(run & ~np.append(run[1:], False))
    return np.insert(ids[run], np.cumsum(run)[last], 0)


class PairTiles:
    """Counts of id pairs of one language.

    Ids rank words by frequency, so pairs of low ids fill their tiles: those are addressed directly
    and counted with ``bincount``. All other tiles are sparse and kept as sorted coordinates.
    """

    def __init__(self):
        self.dense, self.waiting, self.n_waiting = {}, [], 0
        self.keys, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        i, j = (a - 1) >> TILE_BITS, (b - 1) >> TILE_BITS
        low = (i < DENSE_BLOCKS) & (j < DENSE_BLOCKS)
        tile = (i * DENSE_BLOCKS + j)[low]
        cell = ((a - 1) % _TILE * _TILE + (b - 1) % _TILE)[low]
        for t in np.unique(tile):
            hits = np.bincount(cell[tile == t], minlength=_TILE * _TILE)
            self.dense[t] = self.dense[t] + hits if t in self.dense else hits
        high = ~low
        self.waiting.append(a[high].astype(np.int64) << 32 | b[high])
        self.n_waiting += len(self.waiting[-1])
        if self.n_waiting > _BUFFERED:
            self.merge()

    def merge(self) -> None:
        keys, counts = np.unique(np.concatenate([np.empty(0, np.int64), *self.waiting]),
                                 return_counts=True)
        self.waiting, self.n_waiting = [], 0
        keys, counts = np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else order
        self.keys = keys[first]
        self.counts = np.add.reduceat(counts, first) if len(first) else counts

    def drain(self):
        """All (key, count) arrays, key = first id << 32 | second id; empties the tiles."""
        self.merge()
        yield self.keys, self.counts
        for t, grid in self.dense.items():
            cell = np.flatnonzero(grid)
            a = (t // DENSE_BLOCKS << TILE_BITS) + cell // _TILE + 1
            b = (t % DENSE_BLOCKS << TILE_BITS) + cell % _TILE + 1
            yield a.astype(np.int64) << 32 | b, grid[cell]
        self.__init__()


def _row_ids(batch, rows: list[int]) -> np.ndarray:
    lists = batch.column(1)
    if len(rows) < len(lists):
        lists = lists.take(pa.array(rows, pa.int64()))
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _count_pairs(batches):
    tiles = defaultdict(PairTiles)

    def flush():
        for lang, t in tiles.items():
            for keys, counts in t.drain():
                for at in range(0, len(keys), 1 << 16):
                    k = keys[at:at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(k), pa.string()), pa.array(k, pa.int64()),
                         pa.array(counts[at:at + (1 << 16)], pa.int64())],
                        names=["lang", "key", "n"])
        tiles.clear()

    for batch in batches:
        for lang, rows in _by_lang(batch).items():
            ids = _row_ids(batch, rows)
            both = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
            tiles[lang].add(ids[both], ids[both + 1])
        if sum(len(t.dense) for t in tiles.values()) > _DENSE_TILES or \
                sum(len(t.keys) + t.n_waiting for t in tiles.values()) > _COO:
            yield from flush()
    yield from flush()


def _ranked(table: DataFrame, key: str) -> DataFrame:
    """``id``: 1-based rank by frequency within the language, ties by ``key``; in even chunks."""
    cut = with_chunk(table, "n")
    return running_totals(cut, ["lang"], [F.desc("n"), key], {"id": F.lit(1).cast("long")},
                          descending=True).drop(CHUNK)


def _head_count(table: DataFrame, limit: int) -> int:
    """Smallest count whose rows, and all more frequent ones, are at most ``limit``."""
    steps = table.groupBy(F.floor(F.log2("n") * 8).alias("s")) \
        .agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("low")).orderBy(F.desc("s")).collect()
    total, low = 0, 1 << 62
    for step in steps:
        total += step.rows
        if total > limit:
            return low
        low = step.low
    return 0


def _sent(table: DataFrame, key: str, build):
    """Broadcast of ``build(keys, ids)`` per language; at most ``HEAD`` fixed-size entries."""
    rows = table.select("lang", key, "id").toArrow()
    out, langs = {}, np.array(rows["lang"].to_pylist(), object)
    for lang in set(langs):
        mine = rows.filter(pa.array(langs == lang))
        out[lang] = build(mine[key], mine["id"])
    return table.sparkSession.sparkContext.broadcast(out)


def _word_lookup(keys, ids):
    return _Ids(zip(map(_short, keys.to_pylist()), ids.to_pylist()))


def _pair_lookup(keys, ids):
    keys, ids = keys.to_numpy(), ids.to_numpy()
    order = np.argsort(keys)
    return keys[order], ids[order].astype(np.int32)


def _encode_words(sent, tail: bool):
    def run(batches):
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1)
            out, miss = [], []
            for i, lang in enumerate(langs):
                words = piece_words(texts[i].as_py())
                known = sent.value.get(lang, _Ids())
                ids = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
                if tail:
                    gone = [(p, words[p]) for p in np.flatnonzero(ids == 0).tolist()
                            if words[p] != _CUT]
                    miss.append([{"pos": p, "key": w} for p, w in gone])
                out.append(ids if tail else trimmed(ids))
            yield _encoded(batch, out, miss if tail else None, pa.binary())
    return run


def _encode_pairs(sent, tail: bool):
    none = np.empty(0, np.int64), np.empty(0, np.int32)

    def run(batches):
        for batch in batches:
            langs, lists = batch.column(0).to_pylist(), batch.column(1)
            out, miss = [], []
            for i, lang in enumerate(langs):
                ids = lists[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
                pairs = np.where((ids[:-1] > 0) & (ids[1:] > 0), ids[:-1] << 32 | ids[1:], 0)
                keys, codes = sent.value.get(lang, none)
                at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
                found = np.where(keys[at] == pairs, codes[at], 0) if len(keys) else \
                    np.zeros(len(pairs), np.int32)
                if tail:
                    gone = np.flatnonzero((found == 0) & (pairs > 0))
                    miss.append([{"pos": int(p), "key": int(pairs[p])} for p in gone])
                out.append(found if tail else trimmed(found))
            yield _encoded(batch, out, miss if tail else None, pa.int64())
    return run


def _encoded(batch, rows, miss, kind):
    ends = np.cumsum([0, *map(len, rows)])
    flat = np.concatenate([np.empty(0, np.int32), *rows]).astype(np.int32)
    cols = [batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                                      pa.array(flat, pa.int32())), batch.column(2)]
    names = ["lang", "ids", "row"]
    if miss is not None:
        cols.append(pa.array(miss, pa.list_(pa.struct([("pos", pa.int32()), ("key", kind)]))))
        names.append("miss")
    return pa.RecordBatch.from_arrays(cols, names=names)


def _patch(batches):
    for batch in batches:
        out = []
        for ids, found in zip(batch.column(1), batch.column(3)):
            ids = ids.values.to_numpy(zero_copy_only=False).copy()
            if found.is_valid:
                ids[found.values.field("pos").to_numpy()] = found.values.field("id").to_numpy()
            out.append(trimmed(ids))
        yield _encoded(batch, out, None, None)


def _encode(stream: DataFrame, table: DataFrame, key: str, words: bool, head: int) -> DataFrame:
    """``stream`` (lang, words or ids, row) in the ids of ``table``, only runs that can hold pairs.

    Up to ``head`` entries, the most frequent ones, are looked up inside the tasks. If there are
    more, what they leave is joined with the rest by a shuffle: those entries are rare, so none is
    a hot key, and the answers go back to their rows by row number.
    """
    kind = "lang string, ids array<int>, row long"
    least = _head_count(table, head)
    sent = _sent(table.where(F.col("n") >= least), key, _word_lookup if words else _pair_lookup)
    run = (_encode_words if words else _encode_pairs)(sent, least > 0)
    if not least:
        return stored(stream.mapInArrow(run, kind).where("size(ids) > 0"), "encoded")
    kind_of = "binary" if words else "long"
    part = stored(stream.mapInArrow(run, f"{kind}, miss array<struct<pos:int,key:{kind_of}>>"),
                  "encoded")
    rest = table.where(F.col("n") < least).select("lang", F.col(key).alias("key"),
                                                  F.col("id").cast("int").alias("id"))
    found = part.select("lang", "row", F.explode("miss").alias("m")) \
        .select("lang", "row", "m.pos", "m.key").join(rest, ["lang", "key"]) \
        .groupBy("row").agg(F.collect_list(F.struct("pos", "id")).alias("found"))
    both = part.drop("miss").join(found, "row", "left").select("lang", "ids", "row", "found")
    return stored(both.mapInArrow(_patch, kind).where("size(ids) > 0"), "encoded")


def phrase_tables(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                  min_count: int = 100, max_words: int = 5, head: int = HEAD
                  ) -> tuple[DataFrame, list[DataFrame]]:
    """Words per language (lang, total) and, per phrase length from 1, all frequent phrases.

    A phrase row has ``lang, id, n, phrase`` (binary), ``first`` and ``rest`` (ids of the phrases
    without the last and the first word; null for words), and ``heads`` and ``ends``: counts of its
    leading and trailing parts of 1, 2, .. words.
    """
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.col(text_col).cast("binary").alias("text"),
                        F.monotonically_increasing_id().alias("row"))
    counted = stored(
        texts.select("lang", "text").mapInArrow(_count_words, "lang string, word binary, n long")
        .groupBy("lang", "word").agg(F.sum("n").alias("n"))
        .where((F.col("n") >= min_count) | F.col("word").isNull()), "words")
    totals = counted.where("word IS NULL").select("lang", F.col("n").alias("total"))
    last = stored(_ranked(counted.where("word IS NOT NULL"), "word").select(
        "lang", "id", "n", F.col("word").alias("phrase"), F.col("word").alias("tail"),
        F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("rest"),
        F.array("n").alias("heads"), F.array("n").alias("ends")), "phrases")
    tables, stream, key = [last], texts, "phrase"
    for length in range(2, max_words + 1):
        stream = _encode(stream, last, key, length == 2, head)
        pairs = stored(stream.select("lang", "ids")
                       .mapInArrow(_count_pairs, "lang string, key long, n long")
                       .groupBy("lang", "key").agg(F.sum("n").alias("n"))
                       .where(F.col("n") >= min_count), "pairs")
        left = last.select("lang", F.col("id").alias("first"), F.col("phrase").alias("lead"), "heads")
        right = last.select("lang", F.col("id").alias("rest"), "tail", "ends")
        split = _ranked(pairs, "key").withColumn("first", F.shiftright("key", 32)) \
            .withColumn("rest", F.col("key").bitwiseAND(F.lit((1 << 32) - 1)))
        last = stored(split.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).select(
            "lang", "id", "n", F.concat("lead", F.lit(b" "), "tail").alias("phrase"), "tail",
            "first", "rest", F.concat("heads", F.array("n")).alias("heads"),
            F.concat("ends", F.array("n")).alias("ends"), "key"), "phrases")
        tables.append(last)
        key = "key"
        if last.isEmpty():
            break
    return totals, tables


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                 min_count: int = 100, max_words: int = 5, top: int = 2000,
                 head: int = HEAD) -> DataFrame:
    """The ``top`` phrases of 2 to ``max_words`` words per language by how much more often their
    words stand together than their parts would by chance.

    Columns ``lang, rank, phrase, a, l, r, n, score``: ``a`` occurrences of the phrase, ``l`` and
    ``r`` those of the two parts at the lowest-scoring cut (ties: the first), ``n`` words of the
    language, ``score`` = floor(1000 a n / (l r)) in exact decimals. A phrase is left out if one
    more word can be added, before or after, without losing an occurrence; with counts that never
    rise with length this covers any longer phrase.

    Every level counts pairs of neighbouring ids: words at first, then the frequent pairs of the
    level before, ranked again. All texts and all occurrences count; nothing is capped. Per-task
    counts are merged before the shuffle, so a frequent word or passage is one row per task.

    Null texts are empty, null languages are ``und``; repeated rows count each; texts of any length
    are read whole; an empty table, or one without frequent phrases, gives no rows; only the two
    named columns are read.
    """
    totals, tables = phrase_tables(docs, text_col, lang_col, min_count, max_words, head)
    found = None
    for i, table in enumerate(tables[1:], 1):
        longer = tables[i + 1] if i + 1 < len(tables) else None
        rows = table
        if longer is not None:
            whole = longer.select("lang", "n", F.explode(F.array("first", "rest")).alias("id")) \
                .groupBy("lang", "id").agg(F.max("n").alias("most"))
            rows = rows.join(whole, ["lang", "id"], "left") \
                .where(F.col("most").isNull() | (F.col("most") < F.col("n")))
        rows = rows.select("lang", "phrase", F.col("n").alias("a"), "heads", "ends",
                           F.lit(i + 1).alias("size"))
        found = rows if found is None else found.union(rows)
    wide = "decimal(19,0)"
    cuts = F.expr(f"""array_min(transform(sequence(1, size - 1), k -> named_struct(
        'score', (cast(1000 as decimal(4,0)) * cast(a as decimal(15,0)) * cast(total as {wide}))
                 div (cast(heads[k - 1] as {wide}) * cast(ends[size - k - 1] as {wide})),
        'k', k, 'l', heads[k - 1], 'r', ends[size - k - 1])))""")
    scored = found.join(totals, "lang").withColumn("cut", cuts)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return scored.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
                         F.col("total").alias("n"), F.col("cut.score").alias("score")) \
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top) \
        .select("lang", F.col("rank").cast("long").alias("rank"),
                F.col("phrase").cast("string").alias("phrase"), "a", "l", "r", "n", "score")
