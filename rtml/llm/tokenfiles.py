"""Token-id files: interleaved range asymmetric numeral system (rANS) blocks with static tables.

A dataset folder holds ``table`` (one row: the shared frequency table and its parameters) and
``blocks`` (one row per block). A block covers whole documents, at least ``block_ids`` ids of them,
and can be decoded alone; inside it, checkpoints carry the coder states so that any stretch of
``CHECK`` steps can be decoded alone too.
"""

from __future__ import annotations

import json
import zlib
from array import array

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from rtml.llm.common import broadcast_checked, give_back, giving_back, prepare, stored

LANES = 2048
CHECK = 128
BLOCK_IDS = 524_288
_LOW = np.uint64(1 << 31)
_W = np.uint64(32)
_FULL = np.uint64(0xFFFFFFFF)

BLOCK_SCHEMA = T.StructType([
    T.StructField("part", T.LongType()), T.StructField("block", T.LongType()),
    T.StructField("n_ids", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("doc_lengths", T.ArrayType(T.LongType())),
    T.StructField("checkpoints", T.BinaryType()), T.StructField("words", T.BinaryType()),
    T.StructField("payload_crc32", T.LongType()), T.StructField("ids_crc32", T.LongType())])
_BLOCK_ARROW = pa.schema([
    ("part", pa.int64()), ("block", pa.int64()), ("n_ids", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64())),
    ("checkpoints", pa.binary()), ("words", pa.binary()), ("payload_crc32", pa.int64()),
    ("ids_crc32", pa.int64())])


class Coder:
    """Static table: cumulative frequencies that sum to ``2 ** bits``; ids without count get none."""

    def __init__(self, ids: np.ndarray, freqs: np.ndarray, bits: int):
        self.ids, self.bits = ids.astype(np.uint32), bits
        self.freq = freqs.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(freqs)]).astype(np.uint64)
        self.slot_of = np.full(int(ids.max()) + 1 if len(ids) else 1, -1, np.int64)
        self.slot_of[ids] = np.arange(len(ids))
        self._at = None

    @classmethod
    def from_counts(cls, ids: np.ndarray, counts: np.ndarray) -> Coder:
        """Scale counts to a power of two at least 16 times the number of ids; each keeps >= 1."""
        order = np.argsort(ids)
        ids, counts = ids[order], counts[order].astype(np.int64)
        bits = max(12, int(max(len(ids), 1) - 1).bit_length() + 4)
        total = 1 << bits
        if not len(ids):
            return cls(ids, counts, bits)
        share = counts * ((total - len(ids)) / counts.sum())
        freqs = 1 + np.floor(share).astype(np.int64)
        rest = total - int(freqs.sum())
        freqs[np.argsort(-(share - np.floor(share)), kind="stable")[:rest]] += 1
        return cls(ids, freqs, bits)

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """Checkpoints and words of one block."""
        slots = self.slot_of[ids]
        freq, cum = self.freq[slots], self.cum[slots]
        steps = -(-len(ids) // LANES)
        state = np.full(LANES, _LOW, np.uint64)
        limit = freq << np.uint64(63 - self.bits)
        bits = np.uint64(self.bits)
        groups, marks, emitted = [], [], 0
        for t in range(steps - 1, -1, -1):
            a, b = t * LANES, min((t + 1) * LANES, len(ids))
            x, f = state[:b - a], freq[a:b]
            over = x >= limit[a:b]
            if over.any():
                out = x[over]
                groups.append((out & _FULL).astype(np.uint32))
                emitted += len(out)
                x[over] = out >> _W
            high = x // f
            state[:b - a] = (high << bits) + (x - high * f) + cum[a:b]
            if t % CHECK == 0:
                marks.append((emitted, state.copy()))
        words = np.concatenate(groups[::-1]) if groups else np.empty(0, np.uint32)
        points = b"".join(int(emitted - n).to_bytes(8, "little") + s.astype("<u8").tobytes()
                          for n, s in reversed(marks))
        return points, words.astype("<u4").tobytes()

    def decode(self, points: bytes, words: bytes, n_ids: int, first: int = 0,
               last: int | None = None) -> np.ndarray:
        """Ids of checkpoints ``first`` up to ``last`` (all by default)."""
        if self._at is None:
            kind = np.uint16 if len(self.freq) <= 1 << 16 else np.uint32
            self._at = np.repeat(np.arange(len(self.freq), dtype=kind), self.freq.astype(np.int64))
        size = 8 + 8 * LANES
        steps = -(-n_ids // LANES)
        count = len(points) // size
        last = count if last is None else min(last, count)
        stream = np.frombuffer(words, "<u4").astype(np.uint64)
        mask, bits = np.uint64((1 << self.bits) - 1), np.uint64(self.bits)
        parts = []
        for c in range(first, last):
            raw = points[c * size:(c + 1) * size]
            at = int.from_bytes(raw[:8], "little")
            state = np.frombuffer(raw[8:], "<u8").astype(np.uint64)
            for t in range(c * CHECK, min((c + 1) * CHECK, steps)):
                n = min((t + 1) * LANES, n_ids) - t * LANES
                x = state[:n]
                low = x & mask
                slot = self._at[low]
                parts.append(slot)
                x = self.freq[slot] * (x >> bits) + low - self.cum[slot]
                under = x < _LOW
                k = int(under.sum())
                if k:
                    x[under] = (x[under] << _W) | stream[at:at + k]
                    at += k
                state[:n] = x
        slots = np.concatenate(parts) if parts else np.empty(0, np.int64)
        return self.ids[slots]


class WordIds(dict):
    """Ids of a word as little-endian bytes; two generations of up to ``limit`` words are remembered."""

    def __init__(self, model, code: str, limit: int):
        super().__init__()
        self.encode, self.pieces, self.code = model.encode, model.model.tokenize, code
        self.limit, self.older = limit, {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            core = word.rstrip(b".,!?;:%$&*#|")
            if core and len(core) < len(word) and self._letters(core) is not None:
                ids = self[core] + self[word[len(core):]]
            else:
                ids = self._letters(word)
                ids = self._plain(word) if ids is None else \
                    array(self.code, [t.id for t in self.pieces(ids)]).tobytes()
        self[word] = ids
        return ids

    @staticmethod
    def _letters(word: bytes) -> str | None:
        """A word of letters only in the model's byte alphabet: such a word is one pre-token, and up
        to U+024F its normal form is its lower case. None for any other word."""
        if word.isalpha():  # ASCII letters
            return word.decode().lower()
        if word.isascii():
            return None
        text = word.decode("utf-8", "replace")
        if not text.isalpha() or max(text) > "\u024f" or "\u0130" in text:
            return None
        return text.lower().encode().decode("latin-1").translate(_BYTE_CHARS)

    def _plain(self, word: bytes) -> bytes:
        found = self.encode(word.decode("utf-8", "replace"), add_special_tokens=False)
        return array(self.code, found.ids).tobytes()


class TextEncoder:
    """Ids of a text as little-endian bytes, through a bounded memory of encoded words.

    White space always ends a pre-token of the given word-level vocabulary, and so does the border
    between letters and the punctuation behind them, so words are encoded one by one; special-token
    strings hold no white space. ASCII capitals are lowered first, as the tokenizer does, except near
    combining marks (lower-case letters have more composed forms) and special-token strings. The
    tests hold this against encoding whole texts.
    """

    def __init__(self, tokenizer_json: str, dtype: str, limit: int = 150_000):
        from tokenizers import Tokenizer
        self.words = WordIds(Tokenizer.from_str(tokenizer_json), "H" if dtype == "<u2" else "I",
                             limit)

    def texts(self, texts: list[bytes | None]) -> list[bytes]:
        words, out = self.words, []
        get = words.__getitem__
        for t in texts:
            if len(words) > words.limit:  # at each text: a batch may bring half as many new words
                words.older = {}
                words.older = dict(words)
                words.clear()
            out.append(b"".join(map(get, self._lowered(t).split())) if t else b"")
        return out

    @staticmethod
    def _lowered(text: bytes) -> bytes:
        return text if b"<|" in text or b"\xcc" in text or b"\xcd" in text else text.lower()


def _byte_chars() -> dict[int, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 0x100 + i for i, b in enumerate(hidden)}


_BYTE_CHARS = _byte_chars()
_ENCODERS: dict[int, TextEncoder] = {}


def _encoder(shared, dtype: str) -> TextEncoder:
    """One per worker process, kept between its tasks."""
    key = shared._jid if hasattr(shared, "_jid") else id(shared)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = TextEncoder(shared.value, dtype)
    return _ENCODERS[key]


def _drop_encoder() -> None:
    """Free this worker's encoder. Called by name, so that it is the worker's own that goes."""
    _ENCODERS.clear()
    give_back()


def _past_encoding(run):
    """``run`` for ``mapInArrow``, for tasks after the encoding ones, in the same workers."""
    def wrapped(batches):
        _drop_encoder()
        yield from giving_back(run)(batches)
    return wrapped


def _id_type(tokenizer_json: str, end_id: int) -> str:
    model = json.loads(tokenizer_json)
    ids = list(model["model"]["vocab"].values()) + [t["id"] for t in model.get("added_tokens", [])]
    return "<u2" if max(ids + [end_id]) < 1 << 16 else "<u4"


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int = 2,
                      block_ids: int = BLOCK_IDS) -> str:
    """Encode every text (null: empty), append ``end_id``, and write the files in ascending id order.

    Ids must fit a long; a null id sorts first; rows with equal ids are kept, ordered by their token
    ids. Other columns are ignored. The tokenizer file is read on the driver and sent to the workers.
    Texts are encoded once, into a working table of packed ids; one pass over it counts ids for the
    shared table (a row per id and task), and a range partitioning of it feeds the coder in streams,
    one file per partition. Tasks hold one block and one batch.
    """
    spark = docs.sparkSession
    prepare(spark)
    with open(tokenizer_path, encoding="utf-8") as source:
        text = source.read()
    dtype = _id_type(text, end_id)
    shared = spark.sparkContext.broadcast(text)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    end = np.array([end_id], dtype).tobytes()

    def tokenize(batches):
        coder, pack = _encoder(shared, dtype), zstandard.ZstdCompressor(1).compress
        for batch in batches:
            coded = coder.texts(batch.column(1).cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([pack(c + end) for c in coded], pa.binary())],
                names=["id", "ids"])

    def count(batches):
        totals, unpack = np.zeros(1, np.int64), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            ids = np.frombuffer(b"".join(map(unpack, batch.column(0).to_pylist())), dtype)
            more = np.bincount(ids)
            if len(more) > len(totals):
                more[:len(totals)] += totals
                totals = more
            else:
                totals[:len(more)] += more
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(totals[used])],
                                         names=["id", "n"])

    packed = stored(rows.mapInArrow(giving_back(tokenize), "id long, ids binary"), "packed")
    counts = packed.select("ids").mapInArrow(_past_encoding(count), "id long, n long") \
        .groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    coder = Coder.from_counts(counts["id"].to_numpy(np.int64), counts["n"].to_numpy(np.int64))
    # from Arrow: plain rows would be read by Python tasks, whose idle workers stay in memory
    whole, many = pa.int32(), pa.list_(pa.int64())
    spark.createDataFrame(pa.table({
        "bits": pa.array([coder.bits], whole), "ids": pa.array([coder.ids.astype(np.int64)], many),
        "freqs": pa.array([coder.freq.astype(np.int64)], many), "lanes": pa.array([LANES], whole),
        "check": pa.array([CHECK], whole)})) \
        .coalesce(1).write.parquet(f"{path}/table")
    table = spark.sparkContext.broadcast(coder)

    def encode(batches):
        part, block = TaskContext.get().partitionId(), 0
        coder, unpack = table.value, zstandard.ZstdDecompressor().decompress
        held, names, lengths, size = [], [], [], 0

        def flush():
            ids = np.frombuffer(b"".join(held), dtype).astype("<u4")
            points, words = coder.encode(ids)
            return pa.RecordBatch.from_pylist([{
                "part": part, "block": block, "n_ids": len(ids), "doc_ids": names,
                "doc_lengths": lengths, "checkpoints": points, "words": words,
                "payload_crc32": zlib.crc32(words, zlib.crc32(points)),
                "ids_crc32": zlib.crc32(ids.tobytes())}], schema=_BLOCK_ARROW)

        for batch in batches:
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = unpack(raw)
                held.append(ids)
                n = len(ids) // len(end)
                names.append(key)
                lengths.append(n)
                size += n
                if size >= block_ids:
                    yield flush()
                    block += 1
                    held, names, lengths, size = [], [], [], 0
        if names:
            yield flush()

    packed.repartitionByRange("id").sortWithinPartitions("id", "ids") \
        .mapInArrow(_past_encoding(encode), BLOCK_SCHEMA) \
        .write.option("compression", "none").parquet(f"{path}/blocks")
    return path


def read_table(spark: SparkSession, path: str) -> Coder:
    row = spark.read.parquet(f"{path}/table").first()
    if (row.lanes, row.check) != (LANES, CHECK):
        raise ValueError("written with other lane settings")
    return Coder(np.array(row.ids, np.int64), np.array(row.freqs, np.int64), row.bits)


def decode_block(coder: Coder, row: dict) -> np.ndarray:
    """Ids of one block, checked twice."""
    points, words = row["checkpoints"], row["words"]
    if zlib.crc32(words, zlib.crc32(points)) != row["payload_crc32"]:
        raise ValueError(f"damaged block {row['part']}/{row['block']}")
    ids = coder.decode(points, words, row["n_ids"]).astype("<u4")
    if zlib.crc32(ids.tobytes()) != row["ids_crc32"]:
        raise ValueError(f"wrong ids in block {row['part']}/{row['block']}")
    return ids


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Read files back, blocks in parallel: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens``, ``ids_crc32`` and, on request, ``ids``. Damaged blocks raise an error."""
    prepare(spark)
    table = spark.sparkContext.broadcast(read_table(spark, path))
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    fields = [("part", pa.int64()), ("block", pa.int64()), ("doc_id", pa.int64()),
              ("offset", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int64())))
    kind = pa.schema(fields)

    def decode(batches):
        coder = table.value
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(i)[k].as_py() for i, n in enumerate(batch.schema.names)}
                ids = decode_block(coder, row)
                ends = np.cumsum(np.array(row["doc_lengths"], np.int64))
                begins = ends - row["doc_lengths"]
                cols = [[row["part"]] * len(ends), [row["block"]] * len(ends), row["doc_ids"],
                        begins, row["doc_lengths"],
                        [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins, ends)]]
                if with_ids:
                    cols.append([ids[a:b].tolist() for a, b in zip(begins, ends)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, (_, t) in zip(cols, fields)], schema=kind)

    types = "part long, block long, doc_id long, offset long, n_tokens long, ids_crc32 long" + \
        (", ids array<long>" if with_ids else "")
    docs = blocks.mapInArrow(_past_encoding(decode), types)
    sizes = blocks.select("part", "block", "n_ids")
    # one row per written file, so the order of files is a small window
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("p0"))
    inside = Window.partitionBy("part").orderBy("block") \
        .rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "block",
                          F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("b0")) \
        .join(parts, "part").select("part", "block", (F.col("p0") + F.col("b0")).alias("s0"))
    out = docs.join(broadcast_checked(stored(starts, "starts")), ["part", "block"])
    return out.select("doc_id", (F.col("s0") + F.col("offset")).alias("start"), "n_tokens",
                      "ids_crc32", *(["ids"] if with_ids else []))
