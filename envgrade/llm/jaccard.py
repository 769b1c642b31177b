"""Op 10: all pairs of documents whose word n-grams have a Jaccard similarity of at least a threshold, by chosen paths.

A document is the set of 64-bit names of its five-word shingles (of all its words, if it has fewer). Equal sets are
one class and are never compared. Each class walks RUNS random trees. At a node it follows each of its shingles
whose hash at that node is below FOLLOW / size: about FOLLOW children, and two similar sets choose mostly the
same ones. A path ends at the first node with at most LEAF classes, or at depth DEPTH. RUNS follows from the
recall wanted for a pair just at the threshold (see `runs_for`).

Ends are the buckets. A bucket is compared in tiles of TILE classes, so a bucket that a third of all documents
share is spread over many tasks. Sizes and 64-bin sketches rule out most pairs; a pair that shares several buckets
is counted in the smallest only. Then the sets of the classes that still have a partner are fetched and
compared exactly. A tile pair gives sums of links and a spanning forest, never its pairs.

Rows: a null text, or one without words, has no shingles and links with nothing; a null doc_id is joined like any other
and never gives a group its id unless all are null; repeated rows are copies; an empty table gives no rows; other
columns are ignored by `near_copies` and kept by `first_of_group`.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, exp, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envgrade.llm.common import components, content, cut, release, small_batches, table, utf8
from envgrade.llm.neardup import union

WORDS = 5
THRESHOLD = 0.8
FOLLOW = 1.75
DEPTH = 3
RECALL = 0.999
LEAF = 128
TILE = 1024
BINS = 64
STRIP = 128
STRIP_NAMES = 1 << 20
# Buckets of up to so many classes are compared many at a time.
SMALL = 64
KNOWN_WORDS = 200_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def runs_for(recall: float, threshold: float) -> int:
    """Runs that find a pair at the threshold with the probability wanted, even if its paths go to full depth."""
    # Of the larger set, at least this share is common to both.
    common, reach = threshold, 1.0
    for _ in range(DEPTH):
        reach = 1 - exp(-FOLLOW * common * reach)
    return ceil(log(1 - recall) / log(1 - reach))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Shingler:
    """Sorted shingle names of texts. Keeps the hashes of words it has met, up to a bound on their number."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def _word(self, word: str) -> int:
        h = self.known.get(word)
        if h is None:
            if len(self.known) >= KNOWN_WORDS:
                self.known.clear()
            h = self.known[word] = xxhash.xxh3_64_intdigest(utf8(word))
        return h

    def shingles(self, text: str) -> np.ndarray:
        words = text.split()
        if not words:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(self._word, words), np.uint64, len(words))
        size = min(WORDS, len(words))
        count = len(words) - size + 1
        out = h[:count]
        for i in range(1, size):
            out = out * _MIX + h[i : i + count]
        return np.unique(mixed(out))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """For each of BINS equal ranges of names, eight bits of the smallest name in it; 0 for an empty range."""
    bounds = np.arange(BINS, dtype=np.uint64) << np.uint64(58)
    first = np.searchsorted(shingles, bounds)
    stop = np.r_[first[1:], len(shingles)]
    found = shingles[np.minimum(first, len(shingles) - 1)]
    return np.where(first < stop, found % np.uint64(255) + np.uint64(1), 0).astype(np.uint8)


def paths(shingles: np.ndarray, runs: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of all runs and depths, and the index of each node's parent (-1 at depth 1)."""
    limit = np.uint64(int(min(FOLLOW / len(shingles), 1.0) * (2**64 - 2048)))
    node = mixed(np.arange(1, runs + 1, dtype=np.uint64) * _MIX)
    nodes, parents, known = [], [], 0
    for depth in range(DEPTH):
        # Names are uniform, so a product with an odd number that the node gives is hash enough. In strips, as a
        # long text has many names.
        found, owner = [], []
        step = max(1, STRIP_NAMES // len(shingles))
        for at in range(0, len(node), step):
            odd = node[at : at + step, None] | np.uint64(1)
            i, j = np.nonzero(shingles * odd <= limit)
            found.append(mixed(node[at + i] + shingles[j]))
            owner.append(i + at)
        last, node = known - len(node), np.concatenate([*found, np.empty(0, np.uint64)])
        owner = np.concatenate([*owner, np.empty(0, np.int64)])
        nodes.append(node)
        parents.append(np.full(len(node), -1) if depth == 0 else owner + last)
        known += len(node)
    return np.concatenate(nodes).view(np.int64), np.concatenate(parents)


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def _alike(i, j, sketch_a: np.ndarray, sketch_b: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs (i, j) their sketches do not rule out (by five standard deviations)."""
    ok = np.ones(len(i), bool)
    for part in np.array_split(np.arange(len(i)), max(1, len(i) // 100_000)):
        a, b = sketch_a[i[part]], sketch_b[j[part]]
        equal = ((a == b) & (a > 0)).sum(1)
        used = ((a > 0) | (b > 0)).sum(1)
        ok[part] = equal >= used * threshold - 5 * np.sqrt(used * threshold * (1 - threshold)) - 1
    return ok


def _likely(size_a, size_b, sketch_a, sketch_b, threshold: float) -> np.ndarray:
    """Matrix of the pairs of two strips that their sizes and sketches do not rule out."""
    ok = np.minimum(size_a[:, None], size_b) >= threshold * np.maximum(size_a[:, None], size_b)
    i, j = np.nonzero(ok)
    ok[i, j] = _alike(i, j, sketch_a, sketch_b, threshold)
    return ok


def small_pairs(rows: pa.Table, first: np.ndarray, count: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """`likely_pairs` of many small buckets, that start at ``first`` and have ``count`` rows, as rows of the table."""
    size, sketches = np.asarray(rows["size"]), _sketches(rows)
    left, right = [], []
    for n in np.unique(count).tolist():
        i, j = np.triu_indices(n, 1)
        start = first[count == n]
        left.append((start[:, None] + i).ravel())
        right.append((start[:, None] + j).ravel())
    i, j = np.concatenate([*left, np.empty(0, np.int64)]), np.concatenate([*right, np.empty(0, np.int64)])
    near = np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j])
    i, j = i[near], j[near]
    alike = _alike(i, j, sketches, sketches, threshold)
    i, j = i[alike], j[alike]
    buckets_, ends = np.asarray(rows["bucket"])[i], rows["ends"]
    known = {r: set(ends[r].as_py()) for r in np.unique(np.concatenate([i, j])).tolist()}
    mine = [min(known[p] & known[q]) == b for p, q, b in zip(i.tolist(), j.tolist(), buckets_.tolist())]
    return i[np.array(mine, bool)], j[np.array(mine, bool)]


def _shared_before(bucket: int, ends_a: list, ends_b: list) -> tuple[np.ndarray, np.ndarray] | None:
    """Membership of either side in buckets smaller than this one that occur on both sides."""
    flat_a = np.array([e for ends in ends_a for e in ends if e < bucket], np.int64)
    flat_b = np.array([e for ends in ends_b for e in ends if e < bucket], np.int64)
    both = np.intersect1d(flat_a, flat_b)
    if not len(both):
        return None

    def member(flat: np.ndarray, ends: list) -> np.ndarray:
        row = np.repeat(np.arange(len(ends)), [sum(e < bucket for e in x) for x in ends])
        at = np.minimum(np.searchsorted(both, flat), len(both) - 1)
        hit = both[at] == flat
        out = np.zeros((len(ends), len(both)), np.float32)
        out[row[hit], at[hit]] = 1
        return out

    return member(flat_a, ends_a), member(flat_b, ends_b)


def likely_pairs(bucket: int, same: bool, a: dict, b: dict, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of one tile pair of a bucket that must be compared exactly here, strip by strip."""
    before = _shared_before(bucket, a["ends"], b["ends"])
    for at in range(0, len(a["size"]), STRIP):
        rows = slice(at, at + STRIP)
        ok = _likely(a["size"][rows], b["size"], a["sketch"][rows], b["sketch"], threshold)
        if before is not None and ok.any():
            ok &= (before[0][rows] @ before[1].T) == 0
        i, j = np.nonzero(ok)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        if len(i):
            yield i, j


def overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (i, j) of sets."""
    rows, i_at = np.unique(i, return_inverse=True)
    columns, j_at = np.unique(j, return_inverse=True)
    if len(i) * 8 < len(rows) * len(columns) or len(i) < 64:
        return np.array(
            [len(np.intersect1d(sets[p], sets[q], assume_unique=True)) for p, q in zip(i, j)], np.int64
        )
    flat_a, flat_b = np.concatenate([sets[r] for r in rows]), np.concatenate([sets[c] for c in columns])
    row = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
    column = np.repeat(np.arange(len(columns)), [len(sets[c]) for c in columns])
    shared = np.intersect1d(flat_a, flat_b)
    total = np.zeros((len(rows), len(columns)), np.float32)
    at_a, at_b = np.searchsorted(shared, flat_a), np.searchsorted(shared, flat_b)
    in_a = shared[np.minimum(at_a, len(shared) - 1)] == flat_a if len(shared) else np.zeros(len(flat_a), bool)
    in_b = shared[np.minimum(at_b, len(shared) - 1)] == flat_b if len(shared) else np.zeros(len(flat_b), bool)
    # Shingles a few thousand at a time, as a product of two membership matrices.
    for lo in range(0, len(shared), 4096):
        width = min(4096, len(shared) - lo)
        left, right = np.zeros((len(rows), width), np.float32), np.zeros((len(columns), width), np.float32)
        here = in_a & (at_a >= lo) & (at_a < lo + width)
        left[row[here], at_a[here] - lo] = 1
        here = in_b & (at_b >= lo) & (at_b < lo + width)
        right[column[here], at_b[here] - lo] = 1
        total += left @ right.T
    return total[i_at, j_at].astype(np.int64)


def _sketches(rows: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint8).reshape(-1, BINS)


def _side(rows: pa.Table) -> dict:
    return {
        "class": np.asarray(rows["class"]), "size": np.asarray(rows["size"]), "sketch": _sketches(rows),
        "ends": rows["ends"].to_pylist(),
    }


def _whole_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that arrive by (bucket, a, b), in tables that hold whole tile pairs."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        key = np.stack([np.asarray(batch[c]) for c in ("bucket", "a", "b")], 1)
        whole = np.flatnonzero((key != key[-1]).any(1))
        cut_at = int(whole[-1]) + 1 if len(whole) else 0
        new = bool(held) and any(held[-1][c][-1].as_py() != batch[c][0].as_py() for c in ("bucket", "a", "b"))
        if cut_at or new:
            yield pa.Table.from_batches([*held, batch.slice(0, cut_at)])
            held = []
        held.append(batch.slice(cut_at))
    if held:
        yield pa.Table.from_batches(held)


def _parts(rows: pa.Table):
    """Of a table of whole tile pairs: starts and sizes of the small buckets, and of the other tile pairs the
    bucket, whether its tiles are one, and the rows of either tile."""
    if not rows.num_rows:
        return np.empty(0, np.int64), np.empty(0, np.int64), []
    key = np.stack([np.asarray(rows[c]) for c in ("bucket", "a", "b")], 1)
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
    count = np.diff(np.r_[first, len(key)])
    small = (count <= SMALL) & (key[first, 1] == key[first, 2])
    tile, large = np.asarray(rows["tile"]), []
    for lo, n in zip(first[~small].tolist(), count[~small].tolist()):
        bucket, a, b = key[lo].tolist()
        left = np.flatnonzero(tile[lo : lo + n] == a) + lo
        right = left if a == b else np.flatnonzero(tile[lo : lo + n] == b) + lo
        if len(left) and len(right):
            large.append((bucket, a == b, left, right))
    return first[small], count[small], large


def _digest(body: Column) -> Column:
    return F.unhex(F.md5(body.cast("binary"))).alias("digest")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents with a digest of 128 bits; with the id, it tells rows of different texts apart."""
    body = content(F.col(f"`{text_col}`"))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), _digest(body), body.alias("text"))


def described(texts: DataFrame, runs: int) -> DataFrame:
    """Per row: doc_id, digest, name1 and name2 (128 bits that name its set; null if empty), size, sketch, nodes and parents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in _slices(batches, 1024):
            out = {c: [] for c in ("name1", "name2", "size", "sketch", "nodes", "parents")}
            for text in batch.column(2):
                s = shingler.shingles(text.as_py())
                if len(s):
                    nodes, parents = paths(s, runs)
                    name = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                    values = (*name, len(s), sketch(s).tobytes(), nodes, parents)
                else:
                    values = (None, None, 0, None, [], [])
                for c, v in zip(out, values):
                    out[c].append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()))
            columns = [pa.array(v, k) for v, k in zip(out.values(), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "digest", *out])

    return texts.mapInArrow(
        run,
        "doc_id long, digest binary, name1 long, name2 long, size long, sketch binary, nodes array<long>, parents array<int>",
    )


def buckets(classes: DataFrame) -> DataFrame:
    """(class, bucket, n) for the ends of all paths that at least two classes share."""
    tree = "transform(nodes, (v, i) -> named_struct('at', i, 'node', v, 'parent', parents[i]))"
    level = classes.select("class", F.explode(F.expr(f"filter({tree}, t -> t.parent < 0)")).alias("t"))
    ends = []
    for depth in range(1, DEPTH + 1):
        level = level.select("class", "t.at", "t.node")
        counts = level.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
        shared = cut(level.join(counts, "node"), "nodes")
        ends.append(shared if depth == DEPTH else shared.where(F.col("n") <= LEAF))
        large = shared.where(F.col("n") > LEAF).groupBy("class").agg(F.collect_list("at").alias("large"))
        level = classes.join(large, "class").select(
            "class", F.explode(F.expr(f"filter({tree}, t -> array_contains(large, t.parent))")).alias("t")
        )
    out = ends[0]
    for more in ends[1:]:
        out = out.union(more)
    return out.select("class", F.col("node").alias("bucket"), "n")


ROW = "bucket long, a long, b long, tile long, class long, size long, sketch binary, ends array<long>, copies long"


def _tile_rows(classes: DataFrame, ends: DataFrame) -> DataFrame:
    """One row per class, bucket and tile pair that it takes part in."""
    lists = ends.groupBy("class").agg(F.collect_list("bucket").alias("ends"))
    wide = ends.join(classes.select("class", "size", "sketch", "copies").join(lists, "class"), "class")
    tiles = F.expr(f"cast(ceil(n / {TILE}) as long)")
    wide = wide.withColumn("tile", F.pmod(F.xxhash64("class"), tiles)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1))
    )
    names_ = [c.split()[0] for c in ROW.split(", ")]
    return wide.withColumns({"a": F.least("tile", "other"), "b": F.greatest("tile", "other")}).select(*names_)


def _by_tiles(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket", "a", "b").sortWithinPartitions("bucket", "a", "b")


def linked_classes(texts: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """(class, links, root): partial sums of links and links to a root, from every tile pair with a link."""
    spark = texts.sparkSession
    ends = cut(buckets(classes), "buckets")
    release(spark)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_ in _whole_tiles(batches):
            first, count, large = _parts(rows_)
            hit = np.zeros(rows_.num_rows, bool)
            for pair in small_pairs(rows_, first, count, threshold):
                hit[pair] = True
            for bucket, same, left, right in large:
                a = _side(rows_.take(pa.array(left)))
                b = a if same else _side(rows_.take(pa.array(right)))
                for i, j in likely_pairs(bucket, same, a, b, threshold):
                    hit[left[i]] = True
                    hit[right[j]] = True
            yield from rows_.filter(pa.array(hit)).combine_chunks().to_batches()

    rows = _by_tiles(_tile_rows(classes, ends)).mapInArrow(find, ROW)
    rows = cut(rows, "likely")
    release(spark)
    wanted = rows.select("class").distinct().join(classes.select("class", "rep"), "class").select(
        "class", F.col("rep.doc_id").alias("doc_id"), F.col("rep.digest").alias("digest")
    )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in _slices(batches, 512):
            sets = [shingler.shingles(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["class", "shingles"])

    # An id may be null, and null-safe equality still joins by key.
    at = texts.alias("t").join(
        wanted.alias("w"), F.expr("t.doc_id <=> w.doc_id and t.digest = w.digest")
    ).select("w.class", "t.text")
    sets = cut(at.mapInArrow(fetch, "class long, shingles binary"), "sets").dropDuplicates(["class"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_ in _whole_tiles(batches):
            first, count, large = _parts(rows_)
            ids, size, copies = (np.asarray(rows_[c]) for c in ("class", "size", "copies"))
            sets = [np.frombuffer(x, np.uint64) for x in rows_["shingles"].to_pylist()]
            label, links = np.arange(len(ids)), np.zeros(len(ids), np.int64)

            def settle(i: np.ndarray, j: np.ndarray) -> None:
                both = overlaps(sets, i, j)
                hit = both >= threshold * (size[i] + size[j] - both) - 1e-9
                i, j = i[hit], j[hit]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                union(label, i, j)

            settle(*small_pairs(rows_, first, count, threshold))
            for bucket, same, left, right in large:
                a = _side(rows_.take(pa.array(left)))
                b = a if same else _side(rows_.take(pa.array(right)))
                for i, j in likely_pairs(bucket, same, a, b, threshold):
                    settle(left[i], right[j])
            out = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[out]), pa.array(links[out]), pa.array(ids[label[out]])], ["class", "links", "root"]
            )

    return cut(
        _by_tiles(rows.join(sets, "class").select(*rows.columns, "shingles"))
        .mapInArrow(compare, "class long, links long, root long"),
        "linked",
    )


def near_copies(
    docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, digest, n_links (other documents at the threshold or above), class_id (the smallest
    doc_id reachable by links, itself included), copy_of (the smallest doc_id with an equal set) and kept
    (true for one row of each class)."""
    small_batches(docs.sparkSession)
    texts = _texts(docs, id_col, text_col)
    rows = cut(
        described(texts, runs_for(recall, threshold)).withColumn("row", F.monotonically_increasing_id()), "described"
    )
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest", "row")
    named = rows.where("name1 is not null").groupBy("name1", "name2").agg(F.min(first).alias("rep"), F.count("*").alias("copies"))
    # A class is known by the row that stands for it.
    named = cut(named.withColumn("class", F.col("rep.row")), "classes")
    classes = named.join(rows.select("row", "size", "sketch", "nodes", "parents"), F.col("class") == F.col("row"))
    classes = classes.drop("row", "name1", "name2")
    classes = cut(classes, "sketched")
    linked = linked_classes(texts, classes, threshold)
    sums = linked.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(linked.select(F.col("class").alias("a"), F.col("root").alias("b")))
    grouped = (
        named.join(sums, "class", "left").join(roots.withColumnRenamed("id", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    heads = grouped.groupBy("root").agg(F.min("rep").alias("head"))
    per_class = grouped.join(heads, "root").select(
        "name1", "name2", "rep", "head", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    return rows.select("doc_id", "digest", "name1", "name2", "row").join(per_class, ["name1", "name2"], "left").select(
        "doc_id", "digest", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("head.doc_id", "doc_id").alias("class_id"), F.coalesce("rep.doc_id", "doc_id").alias("copy_of"),
        F.coalesce(F.col("head.row") == F.col("row"), F.lit(True)).alias("kept"),
    )


def first_of_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, whole, of which one stays from each group of near copies: the one with the smallest id.

    Rows that repeat both id and text are one document.
    """
    kept = near_copies(docs, id_col=id_col, text_col=text_col).where("kept").select(
        F.col("doc_id").alias("kept_id"), F.col("digest").alias("kept_digest")
    )
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(f"`{id_col}`").cast("long").alias("own_id"), _digest(content(F.col(f"`{text_col}`"))),
    )
    joined = keyed.join(kept, F.expr("own_id <=> kept_id and digest = kept_digest")).dropDuplicates(["own_id", "digest"])
    return joined.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents")).drop("digest")
