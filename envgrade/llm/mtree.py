"""Op 3: exact top-k by inner product, with M-trees searched best first.

With M the largest norm of a block, a vector x gets the extra coordinate sqrt(M^2 - |x|^2) and a query the
coordinate 0. Then |q - x|^2 = |q|^2 + M^2 - 2 q.x, so the nearest in this metric space are the highest
inner products, and the triangle inequality holds.

Vectors are dealt into blocks of about BLOCK_ROWS; queries, a stated set, into blocks of about QUERY_ROWS. Each
pair of blocks is one group: its task bulk-loads an M-tree over the vectors (pages of entries with covering radius
and distance to their parent) and runs the queries. A page whose bound is worse than the k-th best is never
opened, an entry whose stored parent distance already rules it out is never computed. Scores are integers, so
ranks and ties are exact while they stay below 2^53. The best k of all blocks meet in a ranked window of which
each task sends k rows per query at most.

Rows: vectors that are null, empty or hold null or non-finite components take no part. Every other row is a candidate,
its own query's aside: rows are told apart by a number written down once, so that rows that repeat an id all count, and
each of them that is a query gets its own k. A null id comes after all others in ties. Vectors of different lengths
are never compared; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envgrade.llm.common import numbered, table

BLOCK_ROWS = 8192
QUERY_ROWS = 4096
PAGE = 128
FANOUT = 24


def usable(vector: str) -> Column:
    """Whether a vector has components and all of them are finite numbers."""
    return F.expr(
        f"coalesce(size({vector}) > 0 and forall({vector}, x -> x is not null and not isnan(x)"
        f" and abs(cast(x as double)) < double('infinity')), false)"
    )


class Page:
    """A node: entry objects, their distances to the node's own object, covering radii, and child pages."""

    __slots__ = ("objects", "to_parent", "radius", "children")

    def __init__(self, objects, to_parent, radius=None, children=None):
        self.objects, self.to_parent, self.radius, self.children = objects, to_parent, radius, children


class MTree:
    """An M-tree over integer vectors in the space of the module text."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.x = ids, vectors.astype(np.float64)
        squares = (self.x * self.x).sum(1)
        self.most = float(squares.max())
        self.full = np.hstack([self.x, np.sqrt(self.most - squares)[:, None]])
        self.slack = 1e-6 * (1.0 + self.most**0.5)
        self.draw = np.random.default_rng(len(ids))
        self.root, _ = self._load(np.arange(len(ids)), None)

    def _distance(self, rows: np.ndarray, to: int) -> np.ndarray:
        return np.sqrt(((self.full[rows] - self.full[to]) ** 2).sum(1))

    def _load(self, rows: np.ndarray, own: int | None) -> tuple[Page, float]:
        """The page of some rows under a routing object, and the radius that covers them."""
        far = self._distance(rows, own) if own is not None else np.zeros(len(rows))
        radius = float(far.max()) if len(far) else 0.0
        if len(rows) <= PAGE:
            return Page(rows, far), radius
        fanout = min(FANOUT, -(-len(rows) // PAGE))
        seeds = self.draw.choice(rows, fanout, replace=False)
        # All vectors have one norm here, so the nearest seed is the one with the largest product.
        nearest = (self.full[rows] @ self.full[seeds].T).argmax(1)
        if np.bincount(nearest, minlength=fanout).max() > 0.9 * len(rows):
            # Copies crowd around one seed: deal the rows out evenly, so that pages stay small.
            nearest = np.arange(len(rows)) * fanout // len(rows)
        objects, children, radii = [], [], []
        for f in range(fanout):
            members = rows[nearest == f]
            if len(members):
                routing = int(seeds[f]) if seeds[f] in members else int(members[0])
                child, child_radius = self._load(members, routing)
                objects.append(routing)
                children.append(child)
                radii.append(child_radius)
        objects = np.array(objects)
        to_parent = self._distance(objects, own) if own is not None else np.zeros(len(objects))
        return Page(objects, to_parent, np.array(radii), children), radius

    def search(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (score, id) by score, ties to the smaller id, without the query's own id."""
        q = query.astype(np.float64)
        base = float(q @ q) + self.most
        best: list[tuple[int, int]] = []  # heap of (score, -id), the worst first
        worst = np.inf
        opened = 0
        queue = [(0.0, 0, None, self.root)]
        count = 1
        while queue:
            bound, _, to_parent, page = heapq.heappop(queue)
            if bound > worst + self.slack:
                break
            opened += 1
            pick = None
            if to_parent is not None and worst < np.inf:
                least = np.abs(to_parent - page.to_parent)
                if page.radius is not None:
                    least = least - page.radius
                pick = np.flatnonzero(least <= worst + self.slack)
            objects = page.objects if pick is None else page.objects[pick]
            scores = self.x[objects] @ q
            if page.children is None:
                if len(best) == k:
                    near = scores >= best[0][0]
                    objects, scores = objects[near], scores[near]
                for o, s in zip(self.ids[objects].tolist(), scores.tolist()):
                    if o == query_id:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (int(s), -o))
                    elif (int(s), -o) > best[0]:
                        heapq.heapreplace(best, (int(s), -o))
                if len(best) == k:
                    worst = max(base - 2 * best[0][0], 0.0) ** 0.5
                continue
            away = np.sqrt(np.maximum(base - 2 * scores, 0.0))
            radii = page.radius if pick is None else page.radius[pick]
            lower = np.maximum(away - radii, 0.0)
            for i in np.flatnonzero(lower <= worst + self.slack).tolist():
                child = page.children[i if pick is None else int(pick[i])]
                heapq.heappush(queue, (float(lower[i]), count, float(away[i]), child))
                count += 1
        self.opened = opened
        return sorted(((s, -o) for s, o in best), key=lambda p: (-p[0], p[1]))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks])
    return np.asarray(flat).reshape(len(column), -1)


def top_k(
    vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "vector"
) -> DataFrame:
    """For the rows that ``queries`` selects: query_id, rank, vec_id, score and query_row of their k best among all other rows.

    ``vector`` is an array of integers; ``queries`` is a condition on the column ``vec_id``.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = numbered(rows.where(usable("vector")), "vectors")
    n, n_queries = rows.agg(F.count("*"), F.count_if(queries)).first()
    blocks, query_blocks = max(1, -(-n // BLOCK_ROWS)), max(1, -(-n_queries // QUERY_ROWS))
    spot = F.xxhash64("row")
    keyed = rows.withColumns({
        "dim": F.size("vector"), "block": F.pmod(spot, F.lit(blocks)),
        "query_block": F.pmod(spot, F.lit(query_blocks)),
    })
    data = keyed.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)).cast("array<long>")))
    asked = keyed.where(queries).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>"))
    )
    key = ["dim", "block", "query_block"]

    def run(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        out = {c: [] for c in ("query_id", "query_row", "vec_id", "row", "score")}
        if mine.num_rows and theirs.num_rows:
            # In order of ids, so that the smaller place is the smaller id.
            mine = mine.sort_by([("vec_id", "ascending"), ("row", "ascending")])
            ids, rows_ = mine["vec_id"].to_pylist(), mine["row"].to_pylist()
            own = {row: place for place, row in enumerate(rows_)}
            tree = MTree(np.arange(len(ids)), _matrix(mine["vector"]))
            asked = zip(theirs["vec_id"].to_pylist(), theirs["row"].to_pylist(), _matrix(theirs["vector"]))
            for query_id, query_row, query in asked:
                for score, place in tree.search(own.get(query_row, -1), query, k):
                    for c, v in zip(out, (query_id, query_row, ids[place], rows_[place], score)):
                        out[c].append(v)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    found = data.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(
        run, "query_id long, query_row long, vec_id long, row long, score long"
    )
    best = "row_number() over (partition by query_row order by score desc, vec_id nulls last, row)"
    return (
        found.withColumn("rank", F.expr(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score", "query_row")
    )


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(usable("embedding"))
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    return top_k(rows.select("vec_id", scaled.alias("vector")), F.col("vec_id") % 50 == 0).drop("query_row")


ORACLE_SQL = """
with v as (
  select vec_id, row_number() over () as r, [floor(256 * cast(x as double)) for x in embedding] as e from embeddings
  where len(embedding) > 0
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (
  select q.r as query_row, q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and q.r <> c.r and len(q.e) = len(c.e))
select query_id, cast(row_number() over (partition by query_row order by score desc, vec_id) as integer) as rank,
  vec_id, score
from s qualify rank <= 5
"""
