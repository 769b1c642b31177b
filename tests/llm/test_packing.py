import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from envgrade.llm import packing
from envgrade.llm.packing import Packer, TokenStream, best_cuts, candidates, op8_packing, pack, split_rest

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_cuts_are_the_cheapest():
    draw = np.random.default_rng(2)
    for _ in range(60):
        at = [0, *sorted(draw.choice(np.arange(1, 60), 9, replace=False).tolist())]
        while max(b - a for a, b in zip(at, at[1:])) > 20:
            at = sorted({*at, *[(a + b) // 2 for a, b in zip(at, at[1:]) if b - a > 20]})
        penalty = [0, *draw.integers(0, 12, len(at) - 1).tolist()]

        def price(cuts):
            ends = [0, *cuts]
            gaps = [b - a for a, b in zip(ends, ends[1:])]
            return None if max(gaps) > 20 else sum(20 - g for g in gaps) + sum(penalty[at.index(c)] for c in cuts)

        inner = at[1:-1]
        best = min(
            p for n in range(len(inner) + 1) for c in itertools.combinations(inner, n) if (p := price([*c, at[-1]])) is not None
        )
        assert price(best_cuts(at, penalty, 20)) == best


def test_candidates_leave_no_wide_gap():
    sentence = np.zeros(10, bool)
    sentence[3] = True
    ids = np.array([1] * 500 + [3] + [1] * 30 + [0], np.uint32)
    at, penalty = candidates(ids, np.array([532]), sentence, 1024)
    assert at[0] == 0 and at[-1] == 532 and np.diff(at).max() <= packing.GAP
    assert penalty[at == 501] == packing.SENTENCE_PENALTY and penalty[-1] == 0


def test_rest_is_split_where_that_is_cheaper():
    assert split_rest(256, 1024) == [256] and split_rest(1020, 1024) == [1020]
    assert sum(split_rest(300, 1024)) == 300 and all(x & (x - 1) == 0 for x in split_rest(300, 1024))


def _check(rows, texts, library):
    ids = {d: [*library.encode(t, add_special_tokens=False).ids, 0] for d, t in texts.items()}
    sequences = {}
    for r in rows:
        piece = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(piece.tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc_id, x in ids.items():
        parts = sorted((r["start"], r["length"]) for r in rows if r["doc_id"] == doc_id)
        assert [s for s, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]] and sum(n for _, n in parts) == len(x)
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]] and sum(n for _, n in parts) <= 1024
    return [sum(n for _, n in p) for p in sequences.values()]


def test_query(spark, edge_docs, write_tables):
    docs = edge_docs.dropDuplicates(["doc_id"])
    rows = op8_packing(spark, write_tables(documents=docs)).collect()
    _check(rows, {r["doc_id"]: r["text"] or "" for r in docs.collect()}, Tokenizer.from_file(PATH))


def test_blocks_carry_on(monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_TOKENS", 5000)
    library = TokenStream(PATH)
    packer, draw, rows = Packer(1024, library.sentence_ends(), 0), np.random.default_rng(7), []
    docs = {i: draw.integers(1, 50_000, draw.integers(1, 4000)).astype(np.uint32) for i in range(40)}
    for i, ids in docs.items():
        rows += list(packer.add(i, ids))
    while packer.docs:
        rows += list(packer.settle(True))
    for i, ids in docs.items():
        assert b"".join(r[3] for r in sorted(rows, key=lambda r: (r[0], r[1])) if r[0] == i) == ids.astype("<u4").tobytes()
    totals = np.bincount([r[5] for r in rows], [r[2] for r in rows]).astype(int)
    padding = [0 if n & (n - 1) == 0 else 1024 - n for n in totals.tolist()]
    assert totals.max() <= 1024 and sum(padding) / totals.sum() < 0.04


def test_empty_table_and_long_text(no_docs, spark, monkeypatch):
    assert pack(no_docs, PATH).count() == 0
    monkeypatch.setattr(packing, "LONG_TEXT", 10)
    stream, library = TokenStream(PATH), Tokenizer.from_file(PATH)
    for text in ("a text of more than ten letters", "<|endoftext|> é", "short"):
        assert stream.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("size", [1, 7])
def test_repeated_rows_are_packed_each(spark, size):
    docs = spark.createDataFrame([(1, "some words here")] * 3, "doc_id long, text string").coalesce(1)
    rows = pack(docs, PATH, size=size).collect()
    assert sum(r["length"] for r in rows) == 3 * rows[0]["doc_tokens"]
