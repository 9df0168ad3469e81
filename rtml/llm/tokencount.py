"""Token counts with a linear longest-match automaton over a word-piece vocabulary."""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rtml.llm.common import prepare

#: Mark of a word's beginning in the vocabulary, U+2581.
WORD_MARK = "▁"


class Automaton:
    """Trie of the pieces with failure links; only the *number* of popped pieces is kept.

    Where the trie has no edge for the next character, the node's text is given up: ``pops[node]``
    pieces leave it from the front, as greedy longest match would cut them, and ``fail[node]`` is the
    node of what remains. Each node is left at most once per character read, so time is linear in
    the text. A character that is no piece costs its UTF-8 bytes (byte fallback).
    """

    def __init__(self, pieces: list[str]):
        self.next: list[dict[str, int]] = [{}]
        cost: list[int] = [0]
        alphabet = sorted({c for p in pieces for c in p})
        for piece, price in [(c, len(c.encode("utf-8", "surrogatepass"))) for c in alphabet] + \
                [(p, 1) for p in pieces if p]:
            node = 0
            for c in piece:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    cost.append(0)
                node = self.next[node][c]
            cost[node] = price
        self.pops, self.fail = [0] * len(cost), [0] * len(cost)
        queue = deque((0, c, v) for c, v in self.next[0].items())
        while queue:
            parent, c, node = queue.popleft()
            if cost[node]:
                self.pops[node] = cost[node]
            else:
                at, popped = self.fail[parent], self.pops[parent]
                while c not in self.next[at]:  # ends: every single character is a node
                    popped += self.pops[at]
                    at = self.fail[at]
                self.pops[node], self.fail[node] = popped, self.next[at][c]
            queue.extend((node, d, v) for d, v in self.next[node].items())

    def count(self, word: str) -> int:
        """Number of pieces of greedy longest match."""
        node = total = 0
        step, pops, fail = self.next, self.pops, self.fail
        for c in word:
            while c not in step[node]:
                if not node:
                    total += len(c.encode("utf-8", "surrogatepass"))
                    break
                total += pops[node]
                node = fail[node]
            else:
                node = step[node][c]
        while node:
            total += pops[node]
            node = fail[node]
        return total


class CountOfWord(dict):
    """Remembers the counts of up to ``limit`` short words."""

    def __init__(self, automaton: Automaton, limit: int = 400_000):
        super().__init__()
        self.automaton, self.limit = automaton, limit

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(WORD_MARK + word.decode("utf-8", "replace"))
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = n
        return n


def sentencepiece_vocabulary(path: str) -> list[str]:
    """Ordinary pieces of a sentencepiece model (no control, unknown or byte pieces)."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


def count_tokens(docs: DataFrame, pieces: list[str], id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_words`` and ``n_tokens``, one row for each row of ``docs``.

    A text is split at ASCII white space; each word, with the mark U+2581 in front, is cut by greedy
    longest match. Null and empty texts have 0 of both. Any length of word or text is read in one
    linear pass. Other columns are ignored. The vocabulary is a list given by the caller and goes to
    the workers once; documents are not shuffled.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(Automaton(pieces))

    def run(batches):
        counts = CountOfWord(shared.value)
        get = counts.__getitem__
        for batch in batches:
            words = [t.split() if t else [] for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(w) for w in words], pa.int64()),
                 pa.array([sum(map(get, w)) for w in words], pa.int64())],
                names=[id_col, "n_words", "n_tokens"])

    rows = docs.select(F.col(id_col), F.col(text_col))
    id_type = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, n_words long, n_tokens long")
