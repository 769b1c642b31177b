import random

import pytest

from envgrade.llm import jaccard
from envgrade.llm.jaccard import first_of_group, near_copies, op10_jaccard, runs_for


def plain(rows, threshold=0.8):
    """doc_id: (n_links, class_id) by comparing all pairs."""
    sets = {}
    for doc_id, text in rows:
        words = (text or "").split()
        sets[doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    links, root = dict.fromkeys(sets, 0), {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if sets[a] and both >= threshold * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (links[d], find(d)) for d in ids}


def sample():
    draw = random.Random(9)

    def words(n):
        return [draw.choice("abcdefghij") + str(draw.randint(0, 900)) for _ in range(n)]

    rows, passage = [], words(40)
    for g in range(12):
        base = words(draw.randint(6, 160))
        for i in range(12):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = draw.choice(words(3))
            rows.append((g * 100 + i, " ".join(copy)))
    rows += [(5000 + i, " ".join(words(30) + passage + words(30))) for i in range(60)]
    rows += [(6000 + i, rows[0][1]) for i in range(25)]
    return rows + [(7000, ""), (7001, None), (7002, "two words"), (7003, "two words"), (7004, " \n ")]


@pytest.mark.parametrize("leaf, tile", [(128, 1024), (3, 4)])
def test_finds_all_links(spark, monkeypatch, leaf, tile):
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    monkeypatch.setattr(jaccard, "TILE", tile)
    rows = sample()
    got = near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_links"], r["class_id"]) for r in got.collect()} == plain(rows)


def test_runs_grow_with_the_recall():
    assert 1 <= runs_for(0.5, 0.8) < runs_for(0.99, 0.8) < runs_for(0.9999, 0.8)


def test_edge_rows(spark, edge_docs, no_docs, write_tables):
    rows = op10_jaccard(spark, write_tables(documents=edge_docs)).collect()
    assert len(rows) == edge_docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert [r["n_links"] for r in by_id[5]] == [2, 2] and by_id[1][0]["n_links"] == 2
    assert by_id[1][0]["kept"] and not any(r["kept"] for r in by_id[5])
    assert by_id[2][0]["n_links"] == 0 and by_id[3][0]["class_id"] == 3
    kept = first_of_group(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 2, 3, 7, 8, 9, 10]
    assert near_copies(no_docs).count() == 0 and first_of_group(no_docs).count() == 0


def test_texts_of_one_checksum_without_ids(spark, one_checksum):
    rows = spark.createDataFrame([(None, t) for t in one_checksum], "doc_id long, text string")
    assert sorted(r["text"] for r in first_of_group(rows).collect()) == sorted(one_checksum)
    assert [r["n_links"] for r in near_copies(rows).collect()] == [0, 0]
