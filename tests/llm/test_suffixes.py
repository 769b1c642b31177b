import hashlib
import random

import pytest

from envgrade.llm import suffixes
from envgrade.llm.suffixes import op4_suffix_dedup, remove_repeats, repeats


def plain(rows, length=100):
    """(n_bytes, n_removed, n_spans, kept) per row, string by string; rows of one id do not see each other."""
    first, out = {}, []
    for doc_id, text in rows:
        body = (text or "").encode()
        for s in range(len(body) - length + 1):
            key = (doc_id is not None, doc_id or 0)
            first[body[s : s + length]] = min(first.get(body[s : s + length], (True, 1 << 62)), key)
    for doc_id, text in rows:
        body, seen = (text or "").encode(), set()
        mark = bytearray(len(body))
        for s in range(len(body) - length + 1):
            part = body[s : s + length]
            if part in seen or first[part] < (doc_id is not None, doc_id or 0):
                mark[s : s + length] = b"\1" * length
            seen.add(part)
        spans = sum(mark[i] and not (i and mark[i - 1]) for i in range(len(mark)))
        out.append((doc_id, len(body), sum(mark), spans, bytes(b for b, m in zip(body, mark) if not m)))
    return sorted(out, key=repr)


def sample():
    draw = random.Random(4)

    def prose(n):
        return "".join(draw.choice("abcdefgh ") for _ in range(n))

    shared, other = prose(150), prose(400)
    rows = [(i, prose(draw.randint(0, 300))) for i in range(20)]
    rows += [(100 + i, prose(draw.randint(0, 90)) + shared + prose(draw.randint(0, 90))) for i in range(30)]
    rows += [(200 + i, other[: 200 + i] + str(i) + other[200 + i :]) for i in range(12)]
    rows += [(300, other), (301, other), (302, "ab" * 400), (303, "a" * 99), (304, "a" * 350), (305, "é" * 120)]
    rows += [(306, shared + "x" + shared + other[:130]), (None, shared + "null"), (307, None), (308, "")]
    return rows + [(308, shared), (309, other), (309, other), (309, prose(200) + other[50:250])]


@pytest.mark.parametrize("bucket_runs", [1 << 15, 2])
def test_equals_a_plain_search(spark, monkeypatch, bucket_runs):
    monkeypatch.setattr(suffixes, "BUCKET_RUNS", bucket_runs)
    rows = sample()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(
        ((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in repeats(docs).collect()), key=repr
    )
    assert got == plain(rows)


@pytest.mark.parametrize("bucket_runs", [1 << 15, 2])
@pytest.mark.parametrize("doc_id", [5, None])
@pytest.mark.parametrize("shared", [24, 99])
def test_repeated_rows_keep_bytes_found_nowhere_else(spark, monkeypatch, bucket_runs, doc_id, shared):
    """Equal rows around a passage shared with another document, too short to be removed."""
    monkeypatch.setattr(suffixes, "BUCKET_RUNS", bucket_runs)
    draw = random.Random(shared)

    def prose(n):
        return "".join(draw.choice("abcdefgh ") for _ in range(n))

    passages, own = [prose(shared) for _ in range(8)], prose(120)
    text = "".join(f"{prose(120)}<{p}>" for p in passages) + f"1{own}2{prose(40)}3{own}4"
    rows = [(doc_id, text)] * 3 + [(9, "".join(f"{prose(120)}[{p}]" for p in passages))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(
        ((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in repeats(docs).collect()), key=repr
    )
    assert got == plain(rows)
    assert sorted(r[2] for r in got) == [0, 120, 120, 120]


def test_lists_do_not_grow_with_repeated_rows(spark):
    draw = random.Random(6)
    part = "".join(draw.choice("abcdefgh ") for _ in range(150))
    text = part + "x" + part[:140] + "y" + part
    frames = [spark.createDataFrame([(1, text)] * k, "doc_id long, text string") for k in (1, 20)]
    sizes = []
    for docs in frames:
        texts = suffixes._texts(docs, "doc_id", "text")
        sizes.append({len(r["starts"]) for r in suffixes._with_runs(texts, texts).collect()})
    assert sizes[0] == sizes[1] and len(sizes[0]) == 1


def test_small_pieces_and_sorts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE_BYTES", 64)
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 500)
    monkeypatch.setattr(suffixes, "SORT_BYTES", 2000)
    rows = sample()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_removed"], r["n_spans"]) for r in repeats(docs).where("doc_id is not null").collect())
    assert got == sorted((d, m, s) for d, _, m, s, _ in plain(rows) if d is not None)


def test_edge_rows(spark, edge_docs, write_tables):
    rows = op4_suffix_dedup(spark, write_tables(documents=edge_docs)).collect()
    want = plain([(r["doc_id"], r["text"]) for r in edge_docs.collect()])
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows), key=repr)
    assert got == sorted(((*w[:4], hashlib.sha256(w[4]).hexdigest()) for w in want), key=repr)


def test_removal_keeps_rows_and_columns(edge_docs, no_docs):
    out = remove_repeats(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == edge_docs.count()
    assert remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("ids", [(None, None), (1, 1), (1, 2)])
def test_texts_of_one_checksum(spark, one_checksum, ids):
    """Only the passage that its own text repeats goes, from that text."""
    rows = spark.createDataFrame(list(zip(ids, one_checksum)), "doc_id long, text string")
    assert sorted(r["n_removed"] for r in repeats(rows).collect()) == [0, 150]
    kept = {r["text"] for r in remove_repeats(rows).collect()}
    assert one_checksum[1] in kept and one_checksum[0] not in kept
