import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from envgrade.llm.spelling import compose, near_words, op12_spelling, roots, variants, vocabulary


def near(x, y):
    """Exactly one code point inserted, deleted or replaced."""
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1 or x == y:
        return False
    at = next((i for i, (c, d) in enumerate(zip(x, y)) if c != d), len(x))
    return x[at:] == y[at + 1 :] or len(x) == len(y) and x[at + 1 :] == y[at + 1 :]


def plain(counts):
    form, n_near = {}, {}
    for w in counts:
        around = [v for v in counts if abs(len(v) - len(w)) < 2 and near(w, v)]
        n_near[w] = len(around)
        best = min(around, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], n_near[w], None if form[w] is None else counts[form[w]])
    return out


def plain_vocabulary(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def _table(df):
    return {r["word"]: tuple(r)[1:] for r in df.collect()}


def _frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


@pytest.mark.parametrize("seed", range(40))
def test_composition_equals_all_pairs(seed):
    dice = random.Random(seed)
    length, alphabet = dice.randrange(7, 11), "abcé"[: dice.randrange(2, 5)]
    a = dice.randrange(0, length)
    b = dice.randrange(a + 1, length + 2)
    words = set()
    for _ in range(dice.randrange(1, 200)):
        w = [dice.choice(alphabet) for _ in range(length + dice.randrange(2))]
        w[:a] = alphabet[0] * a
        words.add("".join(w))
    words = sorted(words, key=lambda w: dice.random())
    bucket = np.array([dice.randrange(2) for _ in words], np.int64)
    size = np.array([len(w) for w in words])
    n = np.array([dice.randrange(1, 5) for _ in words])
    rows = np.array([w.encode("latin-1") for w in words], f"S{length + 1}").view(np.uint8).reshape(len(words), length + 1)
    order, count, preferred, best = compose(rows, bucket, size, n, length, a, b)
    got = {words[i]: (int(c), words[order[preferred[k]]] if c else None) for i, c, k in zip(order, count, np.minimum(best, len(words) - 1))}
    for i, w in enumerate(words):
        around = []
        for j, v in enumerate(words):
            x, y = sorted((w, v), key=len)
            at = next((k for k, (c, d) in enumerate(zip(x, y)) if c != d), len(x))
            if bucket[i] == bucket[j] and len(x) == length and near(w, v) and a <= at < b:
                around.append((-n[j], v))
        assert got[w] == (len(around), min(around)[1] if around else None)


@pytest.mark.parametrize("rows", [1, 5, 8192])
def test_variants_equal_all_pairs_however_partitions_are_split(spark, rows):
    dice = random.Random(12)
    words = {"".join(dice.choice("abzÿ") for _ in range(dice.randrange(7, 10))): 0 for _ in range(500)}
    base = "".join(dice.choice("ab") for _ in range(30))
    words |= {base[:i] + c + base[i + k :]: 0 for i in range(30) for c in "abc" for k in (0, 1)}
    counts = {w: dice.choice((2, 3, 20, 40, 500, 6000)) for w in words}
    assert _table(variants(_frame(spark, counts), rows)) == plain(counts)


def test_query_on_damaged_documents(spark, write_tables):
    dice = random.Random(7)
    stems = ["".join(dice.choice("abcdeéß×ÿ") for _ in range(dice.randrange(6, 12))) for _ in range(60)]
    rows = [(i, " ".join(dice.choice(stems).title() + dice.choice(("", "", ".", "1x")) for _ in range(300))) for i in range(120)]
    rows += [(None, "Übermäßig übermäßig ÜBERMÄSSIG"), (500, None), (501, ""), (502, "x" * 6000 + " " + "y" * 6000 + "z")] * 2
    rows += [(600 + i, "x" * 6000 + " " + "y" * 6000 + "z") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("?") for c in ("word", "n", "run", "key")})
    got = _table(op12_spelling(spark, write_tables(documents=docs)))
    counts = plain_vocabulary(rows)
    assert {w: v[2] for w, v in got.items()} == counts
    assert got == plain(counts)


def test_chains_of_forms(spark):
    chain = [("a" * 7 + "b" * i, "a" * 7 + "b" * (i + 1)) for i in range(11)]
    got = {r["word"]: r["root"] for r in roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "a" * 7 + "b" * 11 for w, _ in chain}


def test_empty_tables(spark, no_docs):
    assert vocabulary(no_docs).count() == 0
    assert variants(vocabulary(no_docs)).count() == 0
    assert near_words(_frame(spark, {"alonesome": 3})).count() == 0
