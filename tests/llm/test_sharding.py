import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from envgrade.llm import sharding
from envgrade.llm.sharding import capacities, op1_sharding, ring_points, shard_rows, walk


def _check(rows, shards):
    per = {}
    for r in rows:
        per.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(per.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in per.values())


def test_every_row_gets_a_slot(spark, edge_docs, write_tables):
    rows = op1_sharding(spark, write_tables(documents=edge_docs)).collect()
    assert len(rows) == edge_docs.count()
    _check(rows, 24)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2]["size"] == 8 and by_id[2]["text_crc32"] == 0
    text = "été <|endoftext|> \U0001f600    1234567890123456789012".encode()
    assert by_id[10]["size"] == len(text) + 8 and by_id[10]["text_crc32"] == zlib.crc32(text)


def test_empty_table(no_docs):
    assert shard_rows(no_docs).count() == 0


def test_hot_text_is_split_and_spills_clockwise(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", (5, 5))
    docs = spark.range(300).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('t', id)) as text")
    rows = shard_rows(docs, shards=7).collect()
    _check(rows, 7)
    assert Counter(r["shard"] for r in rows).total() == 300


def test_walk_keeps_to_the_room_and_loses_nothing():
    points = ring_points(5, 16)
    counts = [(i * 7) % 11 for i in range(len(points))]
    counts[3] = 500
    room = capacities(sum(counts), 5, 0.0)
    placed = walk(points, counts, room)
    assert sum(end - start for _, start, end, _, _ in placed) == sum(counts)
    for arc, n in enumerate(counts):
        taken = sorted((s, e) for a, s, e, _, _ in placed if a == arc)
        assert [s for s, _ in taken] == [0, *[e for _, e in taken][:-1]][: len(taken)]
        assert not n or taken[-1][1] == n


def test_bounded_loads_move_few_rows(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "concat('text ', id) as text")
    before = {r["doc_id"]: r["shard"] for r in shard_rows(docs, shards=8, overload=0.25).collect()}
    after = {r["doc_id"]: r["shard"] for r in shard_rows(docs, shards=9, overload=0.25).collect()}
    assert max(Counter(after.values()).values()) <= 4000 / 9 * 1.25 + 1
    assert sum(before[d] != after[d] for d in before) < 4000 * 0.35


def _plain_walk(points, positions, room):
    """Every row by itself: the next point clockwise, its shard if it has room there, else on around the ring. Rows
    that found room in their own shard come first; (arc, shard) of each row."""
    room, out, left = list(room), [], []
    arc_of = [next((i for i, (p, _) in enumerate(points) if p >= at), 0) for at in positions]
    for arc, (_, shard) in enumerate(points):
        for _row in range(arc_of.count(arc)):
            if room[shard]:
                room[shard] -= 1
                out.append((arc, shard))
            else:
                left.append(arc)
    waiting = []
    for step in range(2 * len(points)):
        arc = step % len(points)
        if step < len(points):
            waiting += [a for a in left if a == arc]
        while waiting and room[points[arc][1]]:
            room[points[arc][1]] -= 1
            out.append((waiting.pop(0), points[arc][1]))
    return Counter(out), arc_of


@pytest.mark.parametrize("overload", [0.0, 0.2])
def test_every_row_goes_where_a_plain_walk_puts_it(spark, monkeypatch, overload):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", (5, 5))
    docs = spark.range(600).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('t', id % 250)) as text")
    got = shard_rows(docs, shards=7, vnodes=8, overload=overload).collect()
    bits = 64 - sharding.RING_BITS
    at = {r.doc_id: r.p for r in docs.select("doc_id", F.shiftrightunsigned(F.xxhash64("text"), bits).alias("p")).collect()}
    points, order = ring_points(7, 8), sorted(at)
    want, arcs = _plain_walk(points, [at[d] for d in order], capacities(600, 7, overload))
    arc_of = dict(zip(order, arcs))
    assert Counter((arc_of[r["doc_id"]], r["shard"]) for r in got) == want


def test_equal_texts_lie_together_where_there_is_room(spark):
    docs = spark.range(900).selectExpr("id as doc_id", "concat('t', id % 300) as text")
    found = {}
    for r in shard_rows(docs, shards=6, overload=2.0).collect():
        found.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert len(found) == 300 and all(len(shards) == 1 for shards in found.values())
