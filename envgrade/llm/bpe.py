"""Op 2: byte-level BPE, encoding by batched numpy merge rounds, and decoding.

The symbols of many words lie in one flat array. A round looks up all adjacent pairs by binary search over the
sorted pair keys of the vocabulary, takes the lowest rank within each word, and merges it everywhere in that
word. Words without a mergeable pair leave. Words repeat, so each task keeps the ids of words it has met, up to
a bound on their number, after which it starts anew; results do not depend on it. A word of more than LONG_WORD
bytes, such as a page of base64, would need thousands of rounds; it takes its pairs from a heap instead.

Rows are handled alone: no shuffle, and a lost task repeats its own split only. A null text is empty (no ids);
repeated rows give equal results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envgrade.llm.common import content, small_batches, table, utf8

# The pre-tokenisation pattern of the byte-level vocabularies.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KNOWN_WORDS = 400_000
LONG_TEXT = 1 << 20
LONG_WORD = 1024
GATHER_WORDS = 1 << 20


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = [], 256
    for b in range(256):
        letters.append(chr(b if b in printable else extra))
        extra += b not in printable
    return letters


class Vocabulary:
    """Ids, merge ranks and token bytes of a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        ids: dict[str, int] = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        self.size = max(*ids.values(), *self.special.values()) + 1
        tokens = [b""] * self.size
        for token, i in ids.items():
            tokens[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            tokens[i] = token.encode()
        self.tokens = tokens
        self.first = np.array([ids[letter] for letter in byte_letters()], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.pair_rank = dict(zip(keys.tolist(), range(len(keys))))
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, or the number of merges for a pair that has none."""
        want = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.ranks[at], len(self.keys))

    def merge_long(self, word: bytes) -> list[int]:
        """The ids of one long word: its pairs in a heap by rank and place, its symbols in a linked list."""
        ids = self.first[np.frombuffer(word, np.uint8)]
        ranks = self.rank(ids[:-1], ids[1:])
        none, end = len(self.keys), len(ids)
        symbols: list[int] = ids.tolist()
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = [(int(ranks[i]), i, symbols[i], symbols[i + 1]) for i in np.flatnonzero(ranks < none).tolist()]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            a, b = symbols[i], symbols[after[i]]
            if (r := self.pair_rank.get(a * self.size + b)) is not None:
                heapq.heappush(heap, (r, i, a, b))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= end or symbols[j] != b:
                continue
            symbols[i], symbols[j] = int(self.merged[r]), -1
            after[i] = after[j]
            if after[i] < end:
                before[after[i]] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [s for s in symbols if s >= 0]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, end to end, and the number of ids of each word."""
        long = {i: self.merge_long(w) for i, w in enumerate(words) if len(w) > LONG_WORD}
        if long:
            words = [b"" if i in long else w for i, w in enumerate(words)]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        none = len(self.keys)
        done_ids = [np.array(x, np.int64) for x in long.values()]
        done_word = [np.full(len(x), i) for i, x in long.items()]
        while len(ids):
            rank = np.full(len(ids), none)
            inside = np.flatnonzero(word[:-1] == word[1:])
            rank[inside] = self.rank(ids[inside], ids[inside + 1])
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(ids)]))
            over = lowest == none
            done_ids.append(ids[over])
            done_word.append(word[over])
            hit = (rank == lowest) & ~over
            # In a run of one repeated symbol every pair hits; the merge takes every other one from the left.
            at = np.flatnonzero(hit)
            run = np.flatnonzero(np.r_[True, np.diff(at) != 1]) if len(at) else at
            nth = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
            at = at[nth % 2 == 0]
            ids[at] = self.merged[rank[at]]
            keep = ~over
            keep[at + 1] = False
            ids, word = ids[keep], word[keep]
        ids, word = np.concatenate([*done_ids, ids]), np.concatenate([*done_word, word])
        order = np.argsort(word, kind="stable")
        return ids[order].astype(np.uint32), np.bincount(word, minlength=len(words))


class _Known(dict):
    """Number of each word met so far; a new word gets the next number and waits to be encoded."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = len(self)
        return self[word]


class Encoder:
    """Encodes texts with the words of earlier texts kept."""

    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        self.pattern = regex.compile(WORD_PATTERN)
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.vocabulary.special)) + ")")
        self.forget()

    def forget(self) -> None:
        self.known = _Known()
        self.ids = np.empty(0, np.uint32)
        self.start, self.length = np.empty(0, np.int64), np.empty(0, np.int64)

    def words(self, text: str) -> np.ndarray:
        """Numbers of the words of a text; -1 - id for a special token."""
        parts, special = [], self.vocabulary.special
        for piece in self.split.split(text) if any(s in text for s in special) else (text,):
            if piece in special:
                parts.append(np.array([-1 - special[piece]]))
            elif len(piece) > LONG_TEXT:
                found = (m[0] for m in self.pattern.finditer(piece))
                parts.append(np.fromiter(map(self.known.__getitem__, found), np.int64))
            else:
                found = self.pattern.findall(piece)
                parts.append(np.fromiter(map(self.known.__getitem__, found), np.int64, len(found)))
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def learn(self) -> None:
        """Encode the words that wait."""
        if new := self.known.new:
            ids, length = self.vocabulary.merge([utf8(w) for w in new])
            start = len(self.ids) + np.cumsum(length) - length
            self.ids = np.concatenate([self.ids, ids])
            self.start = np.concatenate([self.start, start])
            self.length = np.concatenate([self.length, length])
            self.known.new = []

    def gather(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a row of words, and how many each word has."""
        special = words < 0
        plain = np.where(special, 0, words)
        length = np.where(special, 1, self.length[plain] if len(self.length) else 1)
        start = self.start[plain] if len(self.start) else np.zeros(len(plain), np.int64)
        before = np.cumsum(length) - length
        at = np.repeat(start - before, length)
        at += np.arange(len(at))
        if special.any():
            at[before[special]] = 0
            ids = self.ids[at] if len(self.ids) else np.zeros(len(at), np.uint32)
            ids[before[special]] = -1 - words[special]
            return ids, length
        return self.ids[at], length

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        waiting: list[np.ndarray] = []
        held = 0
        for text in texts:
            waiting.append(self.words(text))
            held += len(waiting[-1])
            if held >= GATHER_WORDS:
                yield from self._flush(waiting)
                waiting, held = [], 0
        yield from self._flush(waiting)

    def _flush(self, waiting: list[np.ndarray]) -> Iterator[np.ndarray]:
        if not waiting:
            return
        self.learn()
        ids, length = self.gather(np.concatenate(waiting))
        ends = np.concatenate([[0], np.cumsum(length)])[np.cumsum([len(w) for w in waiting])]
        yield from np.split(ids, ends[:-1])
        if len(self.known) > KNOWN_WORDS:
            self.forget()

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids.tolist())).decode("utf-8", "replace")


def encode_and_decode(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit) and the text decoded from them."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                ids = list(encoder.encode(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                        pa.array([encoder.decode(x) for x in ids], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), content(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids binary, decoded string"
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = encode_and_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
