import numpy as np
import pytest

from envgrade.llm import neardup
from envgrade.llm.neardup import op6_neardup, quantise


def plain(rows, threshold=0.95):
    """One result per row, in their order."""
    x = np.array([v for _, v in rows])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    linked = unit @ unit.T >= threshold
    np.fill_diagonal(linked, False)
    root, changed = list(range(len(rows))), True
    while changed:
        changed = False
        for a, b in zip(*np.nonzero(linked)):
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    least = {r: min((i for (i, _), s in zip(rows, root) if s == r and i is not None), default=None) for r in set(root)}
    return [(i, int(n), least[r], i == least[r]) for (i, _), n, r in zip(rows, linked.sum(1), root)]


def test_bound_holds():
    x = np.random.default_rng(0).normal(size=(200, 17))
    q, scale, error, unit = quantise(x)
    approx = (q.astype(float) * scale[:, None]) @ (q.astype(float) * scale[:, None]).T
    bound = (1 + error[:, None]) * error + error[:, None] * (1 + error) + error[:, None] * error
    assert (np.abs(unit @ unit.T - approx) <= bound).all()


@pytest.mark.parametrize("tile", [8192, 40])
def test_query_equals_all_pairs(spark, write_tables, monkeypatch, tile):
    monkeypatch.setattr(neardup, "TILE_ROWS", tile)
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(12, 16))
    rows = [(int(i), centres[i % 12] + draw.normal(size=16) * 0.05 * (i % 7)) for i in draw.permutation(240)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)]
    table = [(i, [float(v) for v in x], "?") for i, x in rows]
    odd = [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] * 16), (2004, []), (2005, [1.0, 2.0])]
    # Rows that repeat an id, with the same vector or another, and rows without one.
    rows += rows[:20] + [(rows[0][0], rows[5][1]), (None, rows[0][1]), (None, np.arange(16.0)), (None, np.arange(16.0))]
    table = [(i, [float(v) for v in x], "?") for i, x in rows] + [(i, x, "?") for i, x in odd]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>, root string")
    got = [tuple(r[c] for c in ("vec_id", "n_links", "component_id", "kept")) for r in op6_neardup(spark, write_tables(embeddings=df)).collect()]
    assert sorted(got, key=repr) == sorted(plain(rows) + [(i, 0, i, True) for i, _ in odd], key=repr)


def test_empty_table(spark, write_tables):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert op6_neardup(spark, write_tables(embeddings=df)).count() == 0
