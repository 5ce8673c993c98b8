"""Order-preserving packing of documents into sequences by dynamic programming over window cuts."""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quarry.llm.shared import in_order
from quarry.llm.tokens import Encoder, encoder

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cut_windows(at: np.ndarray, penalty: np.ndarray, size: int, open_end: bool = False) -> list[int]:
    """Indices of the cuts into windows of at most `size` tokens that minimise padding plus penalties.

    at: ascending positions where a cut may be, from the start to the end of the tokens, with steps
    of at most `size`; penalty: what a cut there costs in tokens. A window from i to k costs
    size - (at[k] - at[i]) + penalty[k], so the best i for k is the least best[i] + at[i] over the
    positions within `size` before k: the head of a queue in which these values rise. open_end: the
    last window can still be filled, so it costs nothing.
    """
    n = len(at)
    where, cost = at.tolist(), penalty.tolist()
    best, back = [0] * n, [0] * n
    queue: deque[tuple[int, int]] = deque([(where[0], 0)])
    for k in range(1, n):
        p = where[k]
        least = p - size
        while where[queue[0][1]] < least:
            queue.popleft()
        value, i = queue[0]
        back[k] = i
        best[k] = b = cost[k] + size - p + value
        value = b + p
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, k))
    if open_end:
        near = range(bisect_left(where, where[-1] - size), n - 1)
        back[n - 1] = min(near, key=lambda i: (best[i], -i))
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


class Packer:
    """Packs a stream of documents, a chunk of some windows at a time; the last window of a chunk opens the next."""

    def __init__(self, ends: np.ndarray, size: int, sentence: int, inside: int, first_sequence: int, chunk: int):
        self.ends, self.size, self.sentence, self.inside = ends, size, sentence, inside
        self.sequence, self.chunk = first_sequence, chunk
        self.docs: list[tuple] = []  # doc_id, ids not yet out, those before them, all
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        if len(ids):
            self.docs.append((doc_id, ids, 0, len(ids)))
            self.held += len(ids)
        if self.held >= self.chunk:
            yield from self.flush(last=False)

    def _cuts(self, last: bool) -> list[int]:
        """Positions of the cuts over the ids held."""
        ids = np.concatenate([d[1] for d in self.docs])
        ends = np.cumsum([len(d[1]) for d in self.docs])
        cost = np.full(len(ids) + 1, -1, dtype=np.int32)
        cost[1:][self.ends[ids]] = self.sentence
        cost[ends] = 0
        cost[0] = 0
        at = np.flatnonzero(cost >= 0)
        # where no sentence ends for long, a cut may also be inside one
        step = self.size // 8
        for i in np.flatnonzero(np.diff(at) > step):
            cost[at[i] + step : at[i + 1] : step] = self.inside
        at = np.flatnonzero(cost >= 0)
        return at[cut_windows(at, cost[at], self.size, not last)].tolist()

    def flush(self, last: bool = True) -> Iterator[tuple]:
        if not self.docs:
            return
        cuts = self._cuts(last)
        if not last:
            if len(cuts) < 3:
                return
            cuts.pop()
        k, begin = 0, 0  # the document at hand and where it begins
        for a, b in zip(cuts, cuts[1:], strict=False):
            while a < b:
                doc_id, ids, before, every = self.docs[k]
                to = min(b, begin + len(ids))
                piece = ids[a - begin : to - begin]
                yield doc_id, before + a - begin, len(piece), zlib.crc32(piece.tobytes()), every, self.sequence, a - self._window
                a = to
                if to == begin + len(ids):
                    k, begin = k + 1, to
            self.sequence += 1
            self._window = b
        self._window = 0
        self.docs = self.docs[k:]
        if self.docs and cuts[-1] > begin:
            doc_id, ids, before, every = self.docs[0]
            used = cuts[-1] - begin
            self.docs[0] = (doc_id, ids[used:], before + used, every)
        self.held = sum(len(d[1]) for d in self.docs)

    _window = 0


def sentence_ends(tokens: Encoder) -> np.ndarray:
    """For each id, whether its token closes a sentence: punctuation alone, with one of . ! ?"""
    size = tokens.tokenizer.get_vocab_size()
    ends = np.zeros(size, dtype=bool)
    for token, i in tokens.tokenizer.get_vocab().items():
        token = token.removesuffix("</w>")
        ends[i] = any(c in ".!?" for c in token) and not any(c.isalnum() for c in token)
    return ends


def pack(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 4096,
    end: int = 2,
    sentence_penalty: int = 32,
    inside_penalty: int = 256,
    block_bytes: int = 16 << 20,
    chunk: int = 1 << 19,
) -> DataFrame:
    """The pieces of documents in sequences of at most `size` tokens, one row per piece.

    The documents, each with the id `end` after its ids, are taken in ascending doc_id order and cut
    into windows, each of which is a sequence. Cuts are best at the end of a document, cost
    sentence_penalty tokens at the end of a sentence and inside_penalty elsewhere, where they are
    allowed only in runs of more than size/8 tokens without either. The order is kept by ranges of
    doc_id of about block_bytes of text; only the last sequence of a range is left short. A task
    holds about `chunk` tokens or its longest document. tokenizer: the path of a tokenizers file that
    every executor has.

    Null or empty text: the end id alone. Null doc_ids come first; rows of one doc_id are documents
    of their own, one after another as they are read. An empty table gives an empty table. Other
    columns, whatever their names, are ignored.
    """
    ordered = in_order(docs, doc_id, text, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer)
        packer = Packer(sentence_ends(tokens), size, sentence_penalty, inside_penalty, TaskContext.get().partitionId() << 32, chunk)
        schema = pa.schema([(x, pa.int64()) for x in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    yield from packer.add(i, np.frombuffer(tokens.ids(t.as_py(), end), dtype="<u4"))
            yield from packer.flush()

        out: list[tuple] = []
        for row in rows():
            out.append(row)
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)

    return ordered.mapInArrow(run, PIECES)
