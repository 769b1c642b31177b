"""Op 1: a consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions only.

Every shard owns ``vnodes`` points of a ring of 63-bit positions. A row's position is the hash of its key (its
text, so equal texts lie together where there is room), and it belongs to the next point clockwise. A shard
holds a bounded number of rows. What does not fit goes on clockwise to the next shard that has room.

The walk needs only counts: rows per arc of the ring. They are at most shards * vnodes numbers, whatever the
size of the input, and the walk over them runs on the driver. Ranks within an arc come from row numbers in
sub-buckets of bounded size, so an arc that a third of all rows share is spread over many tasks.

Rows: a null text is empty (8 bytes, checksum 0); a null doc_id is a key like any other; repeated rows each get
a slot of their own; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import deque
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from envgrade.llm.common import content, cut, table

RING_BITS = 63
CELL_BITS = 12
# Rows ranked by one task at most, and at least when an arc is split.
BUCKET_ROWS = (64, 250_000)


def ring_points(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, clockwise."""
    points = []
    for shard in range(shards):
        for v in range(vnodes):
            digest = hashlib.blake2b(f"{shard}/{v}".encode(), digest_size=8).digest()
            points.append((int.from_bytes(digest, "big") >> (64 - RING_BITS), shard))
    return sorted(points)


def ring_cells(points: list[tuple[int, int]]) -> list[tuple[int, list[tuple[int, int]]]]:
    """For each of 2**CELL_BITS equal cells: the points in it and the next one, as (last position, arc)."""
    positions, width = [p for p, _ in points], RING_BITS - CELL_BITS
    cells = []
    for cell in range(1 << CELL_BITS):
        first, last = cell << width, ((cell + 1) << width) - 1
        lo, hi = bisect_left(positions, first), bisect_left(positions, last + 1)
        inside = [(positions[i], i) for i in range(lo, hi)]
        cells.append((cell, inside + [((1 << RING_BITS) - 1, hi % len(points))]))
    return cells


def capacities(rows: int, shards: int, overload: float) -> list[int]:
    """Rows each shard may hold: exactly even without overload, else (1 + overload) times the mean."""
    if overload > 0:
        return [ceil(rows / shards * (1 + overload))] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(points: list[tuple[int, int]], counts: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Place ranks of arcs in shards: (arc, from rank, to rank, shard, first slot).

    Each shard first takes from its own arcs, in ring order. The rest is carried clockwise, first come first
    served, until a shard has room.
    """
    room, used, placed, excess = list(room), [0] * len(room), [], [0] * len(counts)

    def take(arc: int, start: int, n: int, shard: int) -> None:
        placed.append((arc, start, start + n, shard, used[shard]))
        used[shard] += n
        room[shard] -= n

    for arc, (_, shard) in enumerate(points):
        n = min(counts[arc], room[shard])
        if n:
            take(arc, 0, n, shard)
        excess[arc] = counts[arc] - n
    carried: deque[tuple[int, int, int]] = deque()
    for step in range(2 * len(points)):
        arc = step % len(points)
        shard = points[arc][1]
        if step < len(points) and excess[arc]:
            carried.append((arc, counts[arc] - excess[arc], excess[arc]))
        while carried and room[shard]:
            of, start, n = carried.popleft()
            m = min(n, room[shard])
            take(of, start, m, shard)
            if m < n:
                carried.appendleft((of, start + m, n - m))
    return placed


def shard_rows(
    docs: DataFrame, shards: int = 24, vnodes: int = 128, overload: float = 0.0,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, shard and its gapless slot there."""
    spark = docs.sparkSession
    points = ring_points(shards, vnodes)
    cells = spark.createDataFrame(
        ring_cells(points), "cell long, points array<struct<last: long, arc: int>>"
    )
    body = content(text_col)
    width = RING_BITS - CELL_BITS
    keyed = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(body) + F.lit(8)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(body), 64 - RING_BITS).alias("position"),
        # Written once below, so it is the same for every later reader.
        F.monotonically_increasing_id().alias("row"),
    )
    keyed = keyed.withColumn("cell", F.shiftrightunsigned("position", width))
    # Bounded: 2**CELL_BITS cells, shards * vnodes points.
    placed = keyed.join(F.broadcast(cells), "cell").select(
        "doc_id", "size", "text_crc32", F.xxhash64("row").alias("salt"),
        F.expr("element_at(filter(points, p -> p.last >= position), 1).arc").alias("arc"),
    )
    placed = cut(placed, "ring")
    counts = [0] * len(points)
    for arc, n in placed.groupBy("arc").count().collect():
        counts[arc] = n
    moves = walk(points, counts, capacities(sum(counts), shards, overload))
    most = min(max(BUCKET_ROWS[0], 2 * sum(counts) // len(points)), BUCKET_ROWS[1])
    per_arc: dict[int, list] = {arc: [] for arc in range(len(points))}
    for arc, start, end, shard, slot in moves:
        per_arc[arc].append((start, end, shard, slot))
    arcs = spark.createDataFrame(
        [(arc, max(1, ceil(counts[arc] / most)), parts) for arc, parts in per_arc.items()],
        T._parse_datatype_string(
            "arc int, split int, parts array<struct<start: long, end: long, shard: int, slot: long>>"
        ),
    )
    # Bounded: one row per arc; a part is an arc or a place where a shard became full.
    spread = placed.join(F.broadcast(arcs), "arc").withColumn("bucket", F.expr("pmod(salt, split)"))
    sizes = spread.groupBy("arc", "bucket").agg(F.count("*").alias("n"))
    before = sizes.select(
        "arc", "bucket",
        F.expr("coalesce(sum(n) over (partition by arc order by bucket rows between unbounded preceding"
               " and 1 preceding), 0)").alias("before"),
    )
    ranked = spread.withColumn(
        "nth", F.expr("row_number() over (partition by arc, bucket order by doc_id, text_crc32, salt)")
    )
    return (
        ranked.join(before, ["arc", "bucket"])
        .withColumn("rank", F.col("before") + F.col("nth") - 1)
        .withColumn("part", F.expr("element_at(filter(parts, p -> p.start <= rank and rank < p.end), 1)"))
        .select("doc_id", "size", "text_crc32", "part.shard", (F.expr("part.slot + rank - part.start")).alias("slot"))
    )


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_rows(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
