"""Op 9: toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text becomes the set of its hashed character n-grams (lower case, in UTF-8 bytes, with a space at either end).
From labelled texts come log-count ratios r, one per n-gram; a logistic regression over the features
presence * r, with an L1 penalty, gives weights. What is kept is a sparse vector of weight * r and a bias, so
scoring adds up a few numbers per text.

Learning takes at most SAMPLE_ROWS labelled rows of either class, those with the smallest hash of doc_id, and runs in
one task. Scoring covers all rows, whole texts, without a shuffle. The model is broadcast: at most BUCKETS
weights.

Rows: a null or empty text scores what the bias says; a label that is null, or whose document is missing, is not
used; labels of one document that disagree count as toxic; without both classes every score is the share of
toxic labels (0 without labels). Repeated rows score alike; an empty table gives no rows; other columns are
ignored by `score` and kept by `reject`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envgrade.llm.common import content, small_batches, table, utf8

SIZES = (3, 4, 5, 6)
BUCKET_BITS = 20
# Labelled rows learnt from, at most, by label.
SAMPLE_ROWS = {0: 3000, 1: 1500}
SEEN_IN = 4
# Log-count ratios below this say little and are left out.
LEAST_RATIO = 0.4
ROUNDS = 50
STEP = 0.1
L1 = 3e-3


def ngrams(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of the n-grams of a text, one array per size; repeats stay."""
    letters = np.frombuffer(utf8(f" {text.lower()} "), np.uint8).astype(np.uint32)
    rolling = letters
    for n in range(2, max(SIZES) + 1):
        if len(letters) < n:
            return
        rolling = (rolling[:-1] * np.uint32(16777619)) ^ letters[n - 1 :]
        if n in SIZES:
            mixed = (rolling ^ np.uint32(n * 0x3779B1)) * np.uint32(0x85EBCA6B)
            yield (mixed ^ (mixed >> np.uint32(15))) >> np.uint32(32 - BUCKET_BITS)


def fit(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Buckets with a weight, their weights, and the bias."""
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        p = min(max(share, 1e-3), 1 - 1e-3)
        return np.empty(0, np.int32), np.empty(0, np.float64), float(np.log(p / (1 - p)))
    def grams(text: str) -> np.ndarray:
        return np.unique(np.concatenate([*ngrams(text), np.empty(0, np.uint32)]))

    # Two passes over the texts, so that only n-grams that tell the classes apart are held.
    n_toxic, n_clean = int(labels.sum()), int(len(labels) - labels.sum())
    counts = np.zeros((2, 1 << BUCKET_BITS))
    for text, label in zip(texts, labels.tolist()):
        counts[label][grams(text)] += 1
    ratio = np.log((counts[1] + 1) / (n_toxic + 1) / ((counts[0] + 1) / (n_clean + 1)))
    seen = counts.sum(0) >= min(SEEN_IN, max(1, len(texts) // 20))
    used = np.flatnonzero(seen & (np.abs(ratio) >= LEAST_RATIO))
    number = np.full(len(seen), -1, np.int32)
    number[used] = np.arange(len(used))
    ratio = ratio[used]
    sets = [g[g >= 0] for g in (number[grams(t)] for t in texts)]
    feature = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])
    value = ratio[feature].astype(np.float32)
    even = np.where(labels == 1, 0.5 / n_toxic, 0.5 / n_clean)
    weight, bias = np.zeros(len(used)), 0.0
    squares, bias_squares = np.full(len(used), 1e-8), 1e-8
    for _ in range(ROUNDS):
        z = np.bincount(row, value * weight[feature], len(sets)) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) * even
        slope = np.bincount(feature, value * error[row], len(used))
        squares += slope * slope
        step = STEP / np.sqrt(squares)
        weight = weight - step * slope
        weight = np.sign(weight) * np.maximum(np.abs(weight) - step * L1, 0)
        bias_squares += error.sum() ** 2
        bias -= STEP / np.sqrt(bias_squares) * error.sum()
    kept = np.flatnonzero(weight)
    return used[kept].astype(np.int32), weight[kept] * ratio[kept], float(bias)


def id_remainder(doc_id: str) -> Column:
    """crc32 of the id as text, modulo 5; rows with remainder 0 are held out."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """The model, learnt from labelled rows that are not held out: (buckets, weights, bias)."""
    small_batches(docs.sparkSession)
    known = (
        labels.where("toxic is not null and doc_id is not null").where(id_remainder("doc_id") != 0)
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    )
    picked = [
        known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        for label, rows in SAMPLE_ROWS.items()
    ]
    # Bounded: SAMPLE_ROWS ids of each class.
    chosen = F.broadcast(picked[0].union(picked[1]))
    texts = docs.select(F.col(id_col).alias("doc_id"), content(text_col).alias("text"))
    rows = texts.join(chosen, "doc_id").orderBy(F.xxhash64("doc_id", "text")).limit(sum(SAMPLE_ROWS.values()))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            labels += batch.column(1).to_pylist()
        bucket, weight, bias = fit(texts, np.array(labels, np.int64))
        yield pa.RecordBatch.from_pylist(
            [{"bucket": bucket.tobytes(), "weight": weight.astype("<f8").tobytes(), "bias": bias}]
        )

    model = rows.select("text", "toxic").coalesce(1).mapInArrow(learn, "bucket binary, weight binary, bias double").first()
    if model is None:
        return fit([], np.empty(0))
    return np.frombuffer(model["bucket"], np.int32), np.frombuffer(model["weight"], "<f8"), model["bias"]


def scorer_of(model):
    """A function from a text to its score."""
    bucket, weight, bias = model
    weights = np.zeros(1 << BUCKET_BITS)
    weights[bucket] = weight
    matters = weights != 0

    def one(text: str) -> float:
        found = [g[matters[g]] for g in ngrams(text)]
        z = bias + (float(weights[np.unique(np.concatenate(found))].sum()) if found else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -700, 700))))

    return one


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's doc_id and score, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(shared.value)
        for batch in batches:
            scores = pa.array([scorer(t.as_py()) for t in batch.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], ["doc_id", "score"])

    id_type = docs.schema[id_col].dataType.simpleString()
    kept = docs.select(F.col(id_col).alias("doc_id"), content(text_col).alias("text"))
    return kept.mapInArrow(run, f"doc_id {id_type}, score double")


def reject(docs: DataFrame, model, limit: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, whole, that score below ``limit``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index(text_col)
    # By place, as a name may hold a dot.
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(shared.value)
        for batch in batches:
            keep = [scorer(t.as_py() or "") < limit for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*names)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select(
        "doc_id", (id_remainder("doc_id") == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
