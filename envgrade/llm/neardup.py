"""Op 6: near-duplicate vectors by cosine, from int8 tile products with error bounds.

Equal vectors first become one class with a count, so copies are never compared. Classes are dealt into tiles of
about TILE_ROWS; every pair of tiles is one group. A unit vector u is kept as s * q with q of int8, and
e = |u - s q| is stored with it. For two of them

    |cos - s t (q . p)| <= (1 + e) f + e (1 + f) + e f,

so the product of two int8 tiles decides most pairs, and only pairs whose interval holds the threshold are computed
again in double precision. A tile pair gives sums of links and a spanning forest of its links, not its pairs.
Components follow from the forests by distributed rounds.

Rows: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of
different lengths do not link. Rows are told apart by a number written down once: one row is returned for each, those
that repeat an id or have none included. A component is named by the smallest id in it, null where none has an id; a row
without an id is kept only there. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envgrade.llm.common import components, cut, numbered, table
from envgrade.llm.mtree import _matrix, usable

TILE_ROWS = 8192
STRIP = 1024


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, scales, error norms and unit vectors."""
    unit = vectors / np.abs(vectors).max(1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
    scale = np.abs(unit).max(1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.sqrt(((unit - q * scale[:, None]) ** 2).sum(1))
    return q, scale, error + 1e-12, unit


def union(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of i and j, pair by pair; ``label`` holds the smallest member of each set."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while not np.array_equal(label, label[label]):
            label[:] = label[label]


def compare_tiles(a, b, a_copies, b_copies, same: bool, threshold: float):
    """Links of each row of either tile, weighted by copies, and the labels of the joined rows (a first, then b)."""
    qa, sa, ea, ua = quantise(a)
    qb, sb, eb, ub = (qa, sa, ea, ua) if same else quantise(b)
    links_a, links_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    label = np.arange(len(a) + (0 if same else len(b)))
    shift = 0 if same else len(a)
    # Integer products are exact in single precision up to 2**24.
    kind = np.float32 if 127 * 127 * a.shape[1] < 1 << 24 else np.float64
    right, scale_b = qb.astype(kind).T, sb.astype(np.float64)
    for at in range(0, len(a), STRIP):
        rows = slice(at, at + STRIP)
        product = (qa[rows].astype(kind) @ right) * sa[rows, None] * scale_b
        bound = ea[rows, None] * (1 + 2 * eb) + eb + ea[rows, None] * eb
        i, j = np.nonzero(product + bound >= threshold)
        near = product[i, j]
        unsure = near - bound[i, j] < threshold
        i += at
        keep = np.ones(len(i), bool)
        for part in np.array_split(np.flatnonzero(unsure), max(1, unsure.sum() // 200_000)):
            keep[part] = np.einsum("ij,ij->i", ua[i[part]], ub[j[part]]) >= threshold
        if same:
            keep &= i < j
        i, j = i[keep], j[keep]
        links_a += np.bincount(i, b_copies[j], len(a)).astype(np.int64)
        links_b += np.bincount(j, a_copies[i], len(b)).astype(np.int64)
        union(label, i, j + shift)
    return links_a, links_b, label


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept."""
    every = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    sound = usable("vector") & F.expr("exists(vector, x -> x <> 0)")
    every = every.withColumn("vector", F.when(sound, F.col("vector")))
    rows = numbered(every.withColumns({"k1": F.xxhash64("vector"), "k2": F.xxhash64(F.lit(1), "vector")}), "vectors")
    classes = (
        rows.where("vector is not null").groupBy("k1", "k2")
        .agg(F.min("row").alias("class_id"), F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    )
    classes = cut(classes, "classes")
    n = classes.count()
    tiles = max(1, -(-n // TILE_ROWS))
    held = rows.join(classes.select(F.col("class_id").alias("row"), "copies"), "row").select(
        F.col("row").alias("class_id"), "copies", "vector", F.size("vector").alias("dim"),
        F.pmod(F.xxhash64("row"), F.lit(tiles)).alias("tile"),
    )
    # Tile t meets every tile: as the left one up to the last, as the right one from the first.
    left = held.withColumns({"a": F.col("tile"), "b": F.explode(F.sequence("tile", F.lit(tiles - 1).cast("long")))})
    right = held.withColumns({"b": F.col("tile"), "a": F.explode(F.sequence(F.lit(0).cast("long"), F.col("tile")))})
    right = right.where("a < b").select(*[F.col(c).alias(c) for c in right.columns])

    def run(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        a_id, a_copies, a = np.asarray(mine["class_id"]), np.asarray(mine["copies"]), mine["vector"]
        same = mine.num_rows > 0 and mine["a"][0] == mine["b"][0]
        other = mine if same else theirs
        if not mine.num_rows or not other.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("class_id", "links", "root")})
        b_id, b_copies = np.asarray(other["class_id"]), np.asarray(other["copies"])
        links_a, links_b, label = compare_tiles(
            _matrix(a), _matrix(other["vector"]), a_copies, b_copies, same, threshold
        )
        ids = a_id if same else np.concatenate([a_id, b_id])
        links = links_a + links_b if same else np.concatenate([links_a, links_b])
        out = np.flatnonzero(links)
        return pa.table({"class_id": ids[out], "links": links[out], "root": ids[label[out]]})

    key = ["dim", "a", "b"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, "class_id long, links long, root long")
    found = cut(found, "links")
    sums = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("class_id").alias("a"), F.col("root").alias("b")))
    per_class = (
        classes.join(sums, "class_id", "left")
        .join(roots.select(F.col("id").alias("class_id"), "root"), "class_id", "left")
        .select("k1", "k2", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("root", "class_id").alias("root"))
    )
    named = per_class.groupBy("root").agg(F.min("least").alias("component_id"))
    per_class = cut(per_class.join(named, "root").select("k1", "k2", "n_links", "component_id"), "per_class")
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull())
    return rows.where("vector is not null").select("vec_id", "k1", "k2").join(per_class, ["k1", "k2"]).select(
        "vec_id", "n_links", "component_id", kept.alias("kept")
    ).union(
        rows.where("vector is null").select(
            "vec_id", F.lit(0).cast("long"), F.col("vec_id"), F.lit(True)
        )
    )


def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
