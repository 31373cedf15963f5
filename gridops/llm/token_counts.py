"""Greedy longest-match token counts in linear time.

The vocabulary is a trie. A node's failure link leads to the node for what is left of its
string after the greedy pieces that surely start it have been split off, and the number of
these popped pieces is kept with the node. Reading a word then takes one step a character
plus the links, and adds up the popped counts; the pieces themselves are never built, and
a word of any length costs time in proportion to it.

A word is a run outside ``\\x20\\x09-\\x0D``, matched with the vocabulary's mark for a word
start in front; at each place the longest piece of the vocabulary is taken. A character
that starts no piece counts as its UTF-8 bytes (the vocabulary's byte pieces). Null and
empty texts have no words and no tokens; every input row gives one output row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridops.llm import common as c

#: Words whose counts a task remembers; beyond that it starts afresh.
MEMORY = 1 << 20
WORD_START = "▁"


class Automaton:
    """Trie with failure links and popped-piece counts."""

    def __init__(self, pieces: list[str]):
        self.next: list[dict[str, int]] = [{}]
        ends: list[bool] = [False]
        for piece in pieces:
            at = 0
            for ch in piece:
                to = self.next[at].get(ch)
                if to is None:
                    to = self.next[at][ch] = len(self.next)
                    self.next.append({})
                    ends.append(False)
                at = to
            ends[at] = at > 0
        self.link, self.popped = [0] * len(ends), [0] * len(ends)
        level = [(0, ch, v) for ch, v in self.next[0].items()]
        for _, ch, v in level:
            self.popped[v] = 1 if ends[v] else len(ch.encode())
        level = [v for _, _, v in level]
        while level:
            deeper = []
            for u in level:
                for ch, v in self.next[u].items():
                    deeper.append(v)
                    if ends[v]:
                        self.popped[v] = 1
                    else:
                        self.popped[v], self.link[v] = self._step(self.popped[u], self.link[u], ch)
            level = deeper

    def _step(self, n: int, at: int, ch: str) -> tuple[int, int]:
        while True:
            to = self.next[at].get(ch)
            if to is not None:
                return n, to
            if not at:
                return n + len(ch.encode()), 0
            n += self.popped[at]
            at = self.link[at]

    def count(self, word: str) -> int:
        n, at = 0, 0
        for ch in word:
            n, at = self._step(n, at, ch)
        while at:
            n += self.popped[at]
            at = self.link[at]
        return n


def pieces_of(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


def _count(pieces):
    def run(batches):
        machine = Automaton(pieces.value)
        known: dict[int, int] = {}
        for batch in batches:
            for lo, hi, data, offsets in c.chunks(batch.column(1)):
                words = c.Words(data, offsets)
                distinct, at, back = np.unique(words.hash, return_index=True, return_inverse=True)
                raw, counts = data.tobytes(), np.zeros(len(distinct), np.int64)
                if len(known) > MEMORY:
                    known.clear()
                for j, (h, w) in enumerate(zip(distinct.tolist(), at.tolist(), strict=True)):
                    n = known.get(h)
                    if n is None:
                        n = known[h] = machine.count(WORD_START + raw[words.start[w] : words.end[w]].decode())
                    counts[j] = n
                total = np.concatenate([[0], np.cumsum(counts[back])])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(np.diff(words.first), pa.int64()),
                        pa.array(total[words.first[1:]] - total[words.first[:-1]], pa.int64()),
                    ],
                    names=["doc_id", "n_words", "n_tokens"],
                )

    return run


def token_counts(docs: DataFrame, pieces: list[str]) -> DataFrame:
    """doc_id, n_words, n_tokens of every document. ``pieces`` is a vocabulary, a fixed list
    that is broadcast."""
    c.small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(list(pieces))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_count(held), "doc_id long, n_words long, n_tokens long")
