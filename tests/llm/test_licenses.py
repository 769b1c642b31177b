import random
import re

import pytest
from pyspark.sql import functions as F

from envgrade.llm.licenses import BASE, NOTICES, Template, document_frequencies, op11_licenses, scan

TEXTS = [
    "Released under the MIT License.", "under the mit license under the MIT  license", "under the mitlicense",
    "Apache License, Version 2.0; apache license version 22", "CC BY-NC 4.0 cc_by_nc cc by nc", "cc by", "",
    "under the under the mit license mit license", "licensed under the GNU General Public License, version 3.",
    "GNU General Public License version 2 and GNU Lesser General Public License",
    "Permission is hereby granted, free of charge, to any person getting a copy of this software and associated"
    " documentation files (the Software)",
    "permission is hereby granted free of charge and associated documentation files",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met:",
    "under the mit license", "Kelvin under the MIT license \U0001f600 under the \U0001f600 mit license",
    "cc by nc " * 4000, "license " * 20000 + "under the mit license", "the " * 5000,
]


def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(text, templates):
    words, found = plain_words(text), []
    for t in templates:
        for o in range(len(words)):
            if all(words[o + at : o + at + len(p)] == p for at, p in t.phrases()):
                there = sum(o + i < len(words) and words[o + i] == w for i, w in enumerate(t.words))
                found.append((t.label, o, there / len(t.words)))
    return sorted(found)


def _check(rows, texts):
    for r in rows:
        text = texts[r["doc_id"]]
        got = sorted((p["label"], p["start"], p["share"]) for p in r["places"])
        assert r["n_words"] == len(plain_words(text))
        assert got == plain(text, (*BASE, *NOTICES)), text[:80]


def test_places_equal_a_search_at_every_word(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    _check(scan(rows).collect(), TEXTS)


def test_places_of_texts_made_of_template_words(spark):
    dice = random.Random(11)
    words = "under the mit license apache version 2 cc by nc gnu general public 3 and".split()
    texts = [" ".join(dice.choice(words) for _ in range(dice.randrange(200))) for _ in range(150)]
    texts += [t.replace("cc by", "cc by nc under the mit license") for t in texts]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _check(scan(rows).collect(), texts)


def test_query_digests(spark, write_tables):
    docs = spark.createDataFrame([(1, TEXTS[1]), (2, TEXTS[8]), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in op11_licenses(spark, write_tables(documents=docs)).collect()}
    assert got[1] == (8, 2, 0, 4, "mit", "mit", 1.0)
    assert got[2] == (9, 0, None, None, "", "gpl-3", 1.0)
    assert got[3] == (0, 0, None, None, "", "", 0.0)


def test_edge_rows(edge_docs, no_docs):
    out = scan(edge_docs.withColumns({c: F.lit("?") for c in ("words", "hits", "places", "n_words", "start")}))
    assert out.columns == ["doc_id", "n_words", "places"] and out.count() == edge_docs.count()
    assert scan(no_docs).count() == 0
    assert document_frequencies(no_docs, BASE).count() == 0


def test_a_mandatory_phrase_outside_its_template_is_refused():
    with pytest.raises(ValueError):
        Template("x", "some words", ("other words",)).phrases()
