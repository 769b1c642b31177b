import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from envgrade.llm import bpe
from envgrade.llm.bpe import Encoder, encode_and_decode, op2_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", "a", " leading and  double  spaces \n\n\tand tabs ", "it's we'll THEY'RE", "é́ ñ 日本語 ٣٤ \U0001f469‍\U0001f680",
    "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "aaaaaaaaaaaaaaaa" * 9, "x" * 3000, "1234567890" * 30, "\u0085\u001c  ﻿",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _ids(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_library(library):
    encoder = Encoder(PATH)
    for text, ids in zip(TEXTS, encoder.encode(TEXTS)):
        assert ids.tolist() == _ids(library, text), text
        assert encoder.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False) == text


def test_words_beyond_the_bound_are_forgotten(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 3)
    monkeypatch.setattr(bpe, "GATHER_WORDS", 4)
    texts = [f"word{i} and another{i} one" for i in range(40)]
    assert [x.tolist() for x in Encoder(PATH).encode(texts)] == [_ids(library, t) for t in texts]


def test_long_words_take_the_heap(library, monkeypatch):
    monkeypatch.setattr(bpe, "LONG_WORD", 6)
    texts = ["unbelievable antidisestablishmentarianism aaaaaaaa", "abcabcabcabcabcabc" * 20]
    assert [x.tolist() for x in Encoder(PATH).encode(texts)] == [_ids(library, t) for t in texts]


def test_query(spark, edge_docs, write_tables, library):
    rows = op2_bpe(spark, write_tables(documents=edge_docs)).collect()
    texts = {(r["doc_id"], r["text"] or "") for r in edge_docs.collect()}
    assert len(rows) == edge_docs.count()
    got = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows}
    want = set()
    for doc_id, text in texts:
        ids = _ids(library, text)
        want.add((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                  hashlib.sha256(text.encode()).hexdigest()))
    assert got == want


def test_empty_table(no_docs):
    assert encode_and_decode(no_docs, PATH).count() == 0
