import numpy as np
import pytest

from envgrade.llm import mtree
from envgrade.llm.mtree import MTree, op3_top_k


def _plain(rows, k=5):
    """Every row that is a query against every other row, repeated ids included; a null id is the last of a tie."""
    out = []
    for i, (q, x) in enumerate(rows):
        if q is not None and q % 50 == 0:
            others = [(c, y) for j, (c, y) in enumerate(rows) if j != i and len(y) == len(x)]
            best = sorted((-int(np.dot(x, y)), c is None, c or 0) for c, y in others)[:k]
            out += [(q, rank, None if none else c, -s) for rank, (s, none, c) in enumerate(best, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("spread", [1, 5, 200])
def test_search_equals_a_scan(spread):
    draw = np.random.default_rng(spread)
    x = draw.integers(-spread, spread + 1, (3000, 9))
    x[500:900] = x[500]
    ids = draw.permutation(3000)
    tree = MTree(ids, x)
    rows = list(zip(ids.tolist(), x.tolist()))
    by_id = dict(rows)
    for q in range(0, 3000, 300):
        best = sorted((-int(np.dot(by_id[q], y)), c) for c, y in rows if c != q)[:5]
        assert tree.search(q, np.array(by_id[q]), 5) == [(-s, c) for s, c in best]


def test_clustered_vectors_open_few_pages():
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(60, 12)) * 4
    x = np.rint(256 * (np.repeat(centres, 100, 0) + draw.normal(size=(6000, 12)) * 0.02))
    tree = MTree(np.arange(6000), x)
    tree.search(int(np.argmax((x * x).sum(1))), x[np.argmax((x * x).sum(1))], 5)
    assert tree.opened < 20


def test_query_in_blocks(spark, write_tables, monkeypatch):
    monkeypatch.setattr(mtree, "BLOCK_ROWS", 70)
    monkeypatch.setattr(mtree, "QUERY_ROWS", 3)
    draw = np.random.default_rng(3)
    rows = [(i, draw.integers(-500, 500, 6) / 256) for i in range(400)]
    table = [(i, [float(v) for v in x], "?") for i, x in rows]
    table += [(1000, None, "?"), (1050, [], "?"), (1100, [1.0, None, 2.0, 3.0, 4.0, 5.0], "?"), (None, [1.0] * 6, "?"),
              (1150, [float("nan")] + [1.0] * 5, "?"), (1200, [float("inf")] + [1.0] * 5, "?"), (1250, [0.0] * 6, "?")]
    table += table[:51] + [(100, [9.0] * 6, "?"), (100, [9.0] * 5, "?"), (None, [1.0] * 6, "?")]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>, score string")
    got = sorted((tuple(r) for r in op3_top_k(spark, write_tables(embeddings=df)).collect()), key=repr)
    sound = [(i, x) for i, x, _ in table if x and None not in x and np.isfinite(x).all()]
    assert got == _plain([(i, np.floor(256 * np.array(x)).astype(int)) for i, x in sound])


def test_rows_that_repeat_an_id_all_count(spark, write_tables):
    df = spark.createDataFrame([(1, [5.0, 0.0]), (1, [9.0, 1.0]), (50, [1.0, 0.0])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in op3_top_k(spark, write_tables(embeddings=df)).orderBy("rank").collect()]
    assert got == [(50, 1, 1, 9 * 65536), (50, 2, 1, 5 * 65536)]


def test_empty_table(spark, write_tables):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert op3_top_k(spark, write_tables(embeddings=df)).count() == 0
