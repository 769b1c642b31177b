"""The pipeline against a plain version, stage by stage, each judged on its own input."""

import corpus_pipeline
import pytest
from tests.llm.test_jaccard import plain as plain_links
from tests.llm.test_packing import PATH, _check
from tests.llm.test_suffixes import plain as plain_repeats
from tests.llm.test_toxicity import _rows
from tokenizers import Tokenizer

from envgrade.llm.common import components, cut
from envgrade.llm.toxicity import scorer_of, train


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, labels = _rows(240)
    passage = "a passage that many documents share, word for word, over more than one hundred bytes of text, and on it goes "
    rows += [(1000 + i, rows[2][1] + f" tail{i}") for i in range(6)] + [(2000 + i, f"start {i} of it {passage} end {i}") for i in range(8)]
    rows += [(3000, "mail me.now@mail.example.com or +1 (555) 555-0100"), (3001, None), (3002, "")]
    path = tmp_path_factory.mktemp("corpus")
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def _texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = docs
        docs = cut(stage(spark, docs, folder), name)
        if name != "packing":
            assert docs.columns == columns and docs.where("coalesce(n_chars, 0) <> coalesce(char_length(text), 0)").count() == 0
    raw, clean = _texts(seen["toxicity"]), _texts(seen["near_copies"])
    scorer = scorer_of(train(seen["toxicity"], spark.read.parquet(f"{folder}/labels.parquet")))
    assert clean == {d: t for d, t in raw.items() if scorer(t or "") < 0.5}
    assert len(clean) > 0.7 * len(raw)
    single = _texts(seen["repeats"])
    assert single == {d: clean[d] for d, (_, root) in plain_links(list(clean.items())).items() if d == root}
    unique = _texts(seen["personal_data"])
    want = {d: kept.decode("utf-8", "ignore") for d, *_, kept in plain_repeats(list(single.items()))}
    assert {d: t or "" for d, t in unique.items()} == want
    masked = _texts(seen["packing"])
    assert masked[3000] == "mail [EMAIL] or [PHONE]"
    assert {d: t for d, t in masked.items() if d != 3000} == {d: t for d, t in unique.items() if d != 3000}
    from pyspark.sql import functions as F

    rows = docs.withColumn("ids_crc32", F.crc32("ids")).collect()
    _check(rows, {d: t or "" for d, t in masked.items()}, Tokenizer.from_file(PATH))


def test_run_gives_the_last_stage(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns) and out.count() > 0


def test_components(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (7, 7), (500, 400), (400, 300)] + [(1000, 1000 + i) for i in range(1, 60)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in (100, 101, 102)} | {i: 300 for i in (300, 400, 500)} | {1000 + i: 1000 for i in range(60)}
    assert got == want
