"""Op 8: pack documents into training sequences of at most ``size`` tokens by dynamic programming, in order.

The documents of a partition form one stream of ids, each document ended by ``end_id``. A sequence is a window of
the stream. Its price is its padding plus a penalty for where it is cut: none at the end of a document, little
at the end of a sentence, more inside one. With x the positions where a cut may fall,

    best[j] = min over i, x[j] - size <= x[i] < x[j], of best[i] + size - (x[j] - x[i]) + penalty[j]

and the minimum of best[i] + x[i] over the sliding range comes from a monotone queue, so the work is linear.
A stream is taken in blocks of BLOCK_TOKENS with LOOK_AHEAD tokens kept back for the next one. The last, short
sequence of a partition is split into powers of two, which need no padding, where that costs less.

There is no shuffle: every scan partition is packed alone. Sequence ids carry the partition's number, and a task
that is run again gives the same rows. A null text is empty (only ``end_id``); repeated rows are packed
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envgrade.llm.bpe import Encoder, Vocabulary, WORD_PATTERN
from envgrade.llm.common import content, small_batches, table

SENTENCE_PENALTY = 4
TOKEN_PENALTY = 32
# Where sentences are longer than GAP tokens, a cut may also fall after every STEP tokens.
GAP, STEP = 48, 16
BLOCK_TOKENS = 1 << 18
LOOK_AHEAD = 1 << 12
LONG_TEXT = 1 << 20


class TokenStream:
    """Ids of texts; long ones and those with special tokens by the encoder of op 2, others by a library."""

    def __init__(self, path: str) -> None:
        import tiktoken

        self.path, self.vocabulary, self.slow = path, Vocabulary(path), None
        plain = {t: i for i, t in enumerate(self.vocabulary.tokens) if t.decode("utf-8", "ignore") not in self.vocabulary.special}
        self.fast = tiktoken.Encoding("file", pat_str=WORD_PATTERN, mergeable_ranks=plain, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if len(text) > LONG_TEXT or any(s in text for s in self.vocabulary.special):
            self.slow = self.slow or Encoder(self.path)
            return next(iter(self.slow.encode([text])))
        return np.array(self.fast.encode_ordinary(text), np.uint32)

    def sentence_ends(self) -> np.ndarray:
        """For each id, whether its token ends a sentence or a line."""
        return np.array([t.rstrip(b" \"')")[-1:] in (b".", b"!", b"?", b"\n") for t in self.vocabulary.tokens])


def candidates(ids: np.ndarray, doc_ends: np.ndarray, sentence: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a cut may fall, with 0 first, and the penalty of each."""
    penalty = np.full(len(ids) + 1, TOKEN_PENALTY)
    penalty[1:][sentence[ids]] = SENTENCE_PENALTY
    penalty[doc_ends] = 0
    penalty[0] = 0
    natural = np.flatnonzero(penalty < TOKEN_PENALTY)
    gap = np.diff(natural)
    step = min(STEP, size)
    extra = np.where(gap > min(GAP, size), (gap - 1) // step, 0)
    nth = np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra)
    between = np.repeat(natural[:-1], extra) + (nth + 1) * step
    at = np.sort(np.concatenate([natural, between]))
    return at, penalty[at]


def best_cuts(at: list[int], penalty: list[int], size: int, more: bool = False) -> list[int]:
    """Positions of the cuts of the cheapest packing that ends at the last candidate.

    If ``more`` of the stream follows, it ends at the cheapest candidate within ``size`` of the last one, as the end
    of what is known so far is no reason to pad.
    """
    key, back, queue, head = [0] * len(at), [0] * len(at), [], 0
    key[0] = at[0]
    for j in range(1, len(at)):
        x, k = at[j], key[j - 1]
        while len(queue) > head and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j - 1)
        while at[queue[head]] < x - size:
            head += 1
        i = queue[head]
        back[j] = i
        # key is best + x, and best[j] = key[i] + size - x + penalty.
        key[j] = key[i] + size + penalty[j]
    j = len(at) - 1
    if more:
        near = [i for i in range(j, 0, -1) if at[i] > at[j] - size]
        j = min(near, key=lambda i: key[i] - at[i])
    cuts = []
    while j > 0:
        cuts.append(at[j])
        j = back[j]
    return cuts[::-1]


def split_rest(length: int, size: int) -> list[int]:
    """Lengths of the last sequences of a stream."""
    parts = [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]
    return parts if (len(parts) - 1) * TOKEN_PENALTY < size - length else [length]


class Packer:
    """Takes documents in order and gives back pieces as their sequences are settled."""

    def __init__(self, size: int, sentence: np.ndarray, first_sequence: int) -> None:
        self.size, self.sentence, self.sequence = size, sentence, first_sequence
        self.docs: list[tuple[object, np.ndarray, int]] = []  # id, ids, ids already given out
        self.held = 0

    def add(self, doc_id: object, ids: np.ndarray) -> Iterator[tuple]:
        self.docs.append((doc_id, ids, 0))
        self.held += len(ids)
        if self.held >= BLOCK_TOKENS + LOOK_AHEAD:
            yield from self.settle(False)

    def settle(self, last: bool) -> Iterator[tuple]:
        """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset) of the settled sequences."""
        if not self.docs:
            return
        left = np.array([len(ids) - given for _, ids, given in self.docs])
        stream = np.concatenate([ids[given:] for _, ids, given in self.docs])
        ends = np.cumsum(left)
        at, penalty = candidates(stream, ends, self.sentence, self.size)
        cuts = best_cuts(at.tolist(), penalty.tolist(), self.size, more=not last)
        if last:
            begin = cuts[-2] if len(cuts) > 1 else 0
            cuts[-1:] = (begin + np.cumsum(split_rest(len(stream) - begin, self.size))).tolist()
        else:
            cuts = [c for c in cuts if c <= len(stream) - LOOK_AHEAD]
        upto = cuts[-1]
        bounds = np.unique(np.concatenate([ends[ends < upto], cuts]))
        starts = np.concatenate([[0], bounds[:-1]])
        doc = np.searchsorted(ends, starts, "right")
        seq = np.searchsorted(cuts, starts, "right")
        seq_start, doc_start = np.concatenate([[0], cuts])[seq], np.concatenate([[0], ends])[doc]
        stream = stream.astype("<u4")
        for s, e, d, q, s0, d0 in zip(*(x.tolist() for x in (starts, bounds, doc, seq, seq_start, doc_start))):
            doc_id, ids, given = self.docs[d]
            yield doc_id, given + s - d0, e - s, stream[s:e].tobytes(), len(ids), self.sequence + q, s - s0
        self.sequence += len(cuts)
        kept = int(np.searchsorted(ends, upto, "right"))
        rest = self.docs[kept:]
        if rest:
            doc_id, ids, given = rest[0]
            rest[0] = (doc_id, ids, given + upto - int(ends[kept] - left[kept]))
        self.docs, self.held = rest, len(stream) - upto


def pack(
    docs: DataFrame, vocabulary: str, size: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary), doc_tokens, sequence_id, offset."""
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = TokenStream(vocabulary)
        packer = Packer(size, tokens.sentence_ends(), TaskContext.get().partitionId() << 33)
        kinds = [None, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*pieces))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            kinds[0] = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if pieces := list(packer.add(doc_id, np.append(tokens.ids(text.as_py()), np.uint32(end_id)))):
                    yield rows(pieces)
        while packer.docs:
            if pieces := list(packer.settle(True)):
                yield rows(pieces)

    return docs.select(F.col(id_col).alias("doc_id"), content(text_col).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
