import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from envgrade.llm import toxicity
from envgrade.llm.toxicity import fit, op9_toxicity, reject, score, scorer_of, train

BAD = ["grumblex", "snarkface", "vilemop", "toadbrain"]


def _rows(n=900):
    draw = random.Random(6)
    words = ["".join(draw.choice("aeioulnrst") for _ in range(draw.randint(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        text = [draw.choice(words) for _ in range(draw.randint(5, 120))]
        toxic = i % 5 == 0
        if toxic:
            text.insert(draw.randrange(len(text)), draw.choice(BAD))
            text.insert(draw.randrange(len(text)), draw.choice(BAD))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark, write_tables):
    rows, labels = _rows()
    sf_dir = write_tables(
        documents=spark.createDataFrame(rows, "doc_id long, text string"),
        labels=spark.createDataFrame(labels, "doc_id long, toxic int"),
    )
    out = op9_toxicity(spark, sf_dir).collect()
    assert len(out) == len(rows)
    truth = dict(labels)
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in out if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) >= 0.95


def test_held_out_labels_change_nothing(spark):
    rows, labels = _rows(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    models = [train(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, turned)]
    assert np.array_equal(models[0][0], models[1][0]) and np.allclose(models[0][1], models[1][1])


def test_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (3, 0), (7, 0), (None, 1), (8, None), (5, 0), (5, 1), (99, 1)], "doc_id long, toxic int")
    model = train(edge_docs, labels)
    out = score(edge_docs, model).collect()
    assert len(out) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in out)
    kept = reject(edge_docs, model)
    assert kept.columns == edge_docs.columns and kept.count() <= edge_docs.count()
    assert score(no_docs, model).count() == 0 and reject(no_docs, model).count() == 0


@pytest.mark.parametrize("labels", [[], [0, 0], [1, 1]])
def test_one_class_gives_its_share(labels):
    model = fit(["some text"] * len(labels), np.array(labels, np.int64))
    assert scorer_of(model)("any text") == pytest.approx(np.mean(labels) if labels else 0.0, abs=2e-3)
    assert len(model[0]) == 0


def test_no_labels_at_all(spark, edge_docs):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert reject(edge_docs, train(edge_docs, empty)).count() == edge_docs.count()


def _plain_buckets(text):
    data, found = f" {text.lower()} ".encode(), set()
    for n in toxicity.SIZES:
        for i in range(len(data) - n + 1):
            h = data[i]
            for byte in data[i + 1 : i + n]:
                h = (h * 16777619 & 0xFFFFFFFF) ^ byte
            h = (h ^ n * 0x3779B1) * 0x85EBCA6B & 0xFFFFFFFF
            found.add((h ^ h >> 15) >> 32 - toxicity.BUCKET_BITS)
    return found


def _plain_scores(texts, labels):
    """Log-count ratios and the regression over them, one text, one n-gram at a time."""
    grams = [_plain_buckets(t) for t in texts]
    n = Counter(labels)
    seen = {k: Counter(g for s, label in zip(grams, labels) if label == k for g in s) for k in (0, 1)}
    ratio = {g: math.log((seen[1][g] + 1) / (n[1] + 1) / ((seen[0][g] + 1) / (n[0] + 1))) for g in seen[0] | seen[1]}
    least = min(toxicity.SEEN_IN, max(1, len(texts) // 20))
    ratio = {g: r for g, r in ratio.items() if seen[0][g] + seen[1][g] >= least and abs(r) >= toxicity.LEAST_RATIO}
    weight, squares = dict.fromkeys(ratio, 0.0), dict.fromkeys(ratio, 1e-8)
    bias, bias_squares = 0.0, 1e-8

    def chance(found):
        return 1 / (1 + math.exp(-(bias + sum(weight[g] * ratio[g] for g in found if g in ratio))))

    for _ in range(toxicity.ROUNDS):
        errors = [(chance(s) - label) * 0.5 / n[label] for s, label in zip(grams, labels)]
        slope = Counter()
        for s, e in zip(grams, errors):
            for g in s & ratio.keys():
                slope[g] += ratio[g] * e
        for g in ratio:
            squares[g] += slope[g] ** 2
            step = toxicity.STEP / math.sqrt(squares[g])
            moved = weight[g] - step * slope[g]
            weight[g] = math.copysign(max(abs(moved) - step * toxicity.L1, 0.0), moved)
        bias_squares += sum(errors) ** 2
        bias -= toxicity.STEP / math.sqrt(bias_squares) * sum(errors)
    return [chance(s) for s in grams]


def test_scores_equal_a_plain_fit():
    rows, labels = _rows(60)
    texts = [t[:150] for _, t in rows] + ["", "é\U0001f600", "a" * 3000]
    known = [label for _, label in labels] + [0, 1, 0]
    model = fit(texts, np.array(known, np.int64))
    scorer = scorer_of(model)
    assert [scorer(t) for t in texts] == pytest.approx(_plain_scores(texts, known), abs=1e-4)


def test_a_very_long_text(spark):
    rows, labels = _rows(300)
    model = train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    long = rows[1][1] * 3000
    out = score(spark.createDataFrame([(1, long), (2, long + " grumblex")], "doc_id long, text string"), model).collect()
    assert len(long) > 500_000 and all(0 <= r["score"] <= 1 for r in out)
    assert out[1]["score"] != out[0]["score"]
