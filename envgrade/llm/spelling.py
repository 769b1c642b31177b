"""Op 12: group spelling variants by composing the vocabulary's acceptor, a one-edit transducer and the acceptor again.

Two words are near if one inserted, deleted or replaced code point turns one into the other. The composition reads a
common front, makes its one edit where the words first differ, and reads a common rest; so a pair of words is accepted
once, by the place of its first difference. An accepted pair is a pair of words, named by their places in the sorted
vocabulary, which the acceptor's arcs count (each carries the number of words that sort before it in its state).

The vocabulary may be of any size, so the composition is enumerated by partitions of its initial state. A partition
(l, a, b, key) holds words of l code points, and of one more, which agree in their first a code points and in their
last l - b: every pair whose first difference lies in the places a to b - 1 is in exactly one. A word is in up to four,
the halves of its own length and of the length below. Partitions of more than ROWS words or BYTES are split
again, by halving the places; one with a single place has at most as many words as the alphabet allows.

Within a task, whole partitions with one (l, a, b) are taken together. Each is an arc from the initial state. The
acceptor is minimised from the end, states with equal arcs becoming one, for words of both lengths alike, so that an edit
that leads into one state accepts all of its words without reading on. Only counts and the best neighbour of each
word leave the task, never pairs.

Rows: a null text has no words; a null doc_id is written as nothing in the key of the damage; repeated rows count as
often as they stand there; of near words with equal counts the smallest in code-point order is the form; an empty table
gives no rows; other columns are ignored. Time for a run of letters grows with its length, not with its square.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envgrade.llm.common import cut, table
from envgrade.llm.licenses import LOWER, UPPER

SHORTEST = 7
TIMES = 10
ROWS = 1 << 13
BYTES = 1 << 21
BATCH_ROWS = 1 << 15
# Fixed value: runs of letters are what stands between these.
NO_LETTERS = r"[^A-Za-zÀ-ÿ]++"
WIDE = 256


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: bool = True) -> DataFrame:
    """Words of at least SHORTEST code points that occur at least twice: word, n."""
    text = F.translate(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), UPPER, LOWER)
    owner = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    runs = docs.select(owner.alias("owner"), F.explode(F.split(text, NO_LETTERS)).alias("run"))
    runs = runs.where(F.char_length("run") >= SHORTEST)
    if damage:
        hashed = runs.withColumn("h", F.crc32(F.concat("owner", F.lit(":"), "run")))
        at = F.expr("cast(h % char_length(run) as int)")
        struck = F.concat(F.substring("run", 1, at), F.substring("run", at + 2, F.char_length("run")))
        runs = hashed.select(F.when(F.col("h") % 31 == 0, struck).otherwise(F.col("run")).alias("run"))
    counts = runs.groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return counts.where((F.char_length("word") >= SHORTEST) & (F.col("n") >= 2))


def _keyed(rows: DataFrame) -> DataFrame:
    """The partition's key. Different ones that share a hash only make a partition larger."""
    rest = F.greatest(F.col("l") - F.col("b"), F.lit(0))
    front, back = F.substring("letters", F.lit(1), F.col("a")), F.substring("letters", F.col("size") - rest + 1, rest)
    return rows.withColumn("key", F.xxhash64("l", "a", "b", front, back))


def _halves(a: Column, middle: Column, b: Column) -> Column:
    return F.explode(F.array(F.struct(a.alias("a"), middle.alias("b")), F.struct(middle.alias("a"), b.alias("b"))))


def partitions(words: DataFrame, rows: int = ROWS, size: int = BYTES) -> DataFrame:
    """Each word in its partitions: letters (Latin-1 bytes), n, size, l, a, b, key. None is too large for a task."""
    letters = words.select(F.encode("word", "ISO-8859-1").alias("letters"), "n", F.char_length("word").alias("size"))
    lengths = F.explode(F.array("size", F.col("size") - 1)).alias("l")
    level = letters.select("*", lengths).where(F.col("l") >= SHORTEST)
    start = _halves(F.lit(0), (F.col("l") / 2).cast("int"), F.col("l") + 1).alias("at")
    level = _keyed(level.select("*", start).select("letters", "n", "size", "l", "at.a", "at.b"))
    group, done = ["l", "a", "b", "key"], None
    while True:
        sizes = level.groupBy(*group).agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))
        large = cut(sizes.where(f"b - a > 1 and (rows > {rows} or bytes > {size})").select(*group), "large")
        if large.isEmpty():
            return level if done is None else done.union(level)
        small = level.join(large, group, "left_anti").select(level.columns)
        done = small if done is None else done.union(small)
        split = level.join(large, group).select("letters", "n", "size", "l", "a", "b")
        middle = F.expr("(a + b) div 2").cast("int")
        split = split.select("letters", "n", "size", "l", _halves(F.col("a"), middle, F.col("b")).alias("at"))
        level = cut(_keyed(split.select("letters", "n", "size", "l", "at.a", "at.b")), "split")


class Level(NamedTuple):
    """States of the minimised acceptor with one number of symbols to go: arcs by state and symbol."""

    degree: np.ndarray
    first: np.ndarray
    symbol: np.ndarray
    child: np.ndarray
    skip: np.ndarray
    key: np.ndarray
    words: np.ndarray


class Trie:
    """Sorted words of one length, by fronts: a node of depth d is a run of words that agree in d symbols."""

    def __init__(self, rows: np.ndarray, shared: np.ndarray) -> None:
        self.rows, self.shared = rows, shared
        self._starts: dict[int, np.ndarray] = {}

    def starts(self, depth: int) -> np.ndarray:
        if depth not in self._starts:
            self._starts[depth] = np.flatnonzero(self.shared < depth)
        return self._starts[depth]

    def arcs(self, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the arcs that leave nodes of this depth: node, symbol, words."""
        below = self.starts(depth + 1)
        node = np.searchsorted(self.starts(depth), below, "right") - 1
        return node, self.rows[below, depth].astype(np.int64), np.diff(np.r_[below, len(self.rows)])


def _ranges(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The owner of each element, and the element, of ranges laid end to end."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, first[owner] + np.arange(len(owner)) - (np.cumsum(count) - count)[owner]


def _minimised(node: np.ndarray, symbol: np.ndarray, words: np.ndarray, child: np.ndarray, below: int) -> tuple[np.ndarray, Level]:
    """States of nodes, equal where all arcs are equal, and the arcs of each state."""
    degree = np.bincount(node)
    first = np.cumsum(degree) - degree
    token = child * WIDE + symbol
    state = np.unique(token[first], return_inverse=True)[1]
    for j in range(1, int(degree.max())):
        more = np.flatnonzero(degree > j)
        state[more] = np.unique(state[more] * (below * WIDE) + token[first[more] + j], return_inverse=True)[1]
    _, one, state = np.unique(degree * (len(degree) + 1) + state, return_index=True, return_inverse=True)
    owner, arc = _ranges(first[one], degree[one])
    before = np.cumsum(words) - words
    return state, Level(
        degree[one], np.cumsum(degree[one]) - degree[one], symbol[arc], child[arc], before[arc] - before[first[one]][owner],
        owner * WIDE + symbol[arc], np.bincount(owner, words[arc], len(one)).astype(np.int64),
    )


class Pairs:
    """Accepted pairs as they come: how many each word has, and its best by rank."""

    def __init__(self, rank: np.ndarray) -> None:
        self.rank, self.count = rank, np.zeros(len(rank), np.int64)
        self.best = np.full(len(rank), len(rank), np.int64)

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        for u, v in ((x, y), (y, x)):
            self.count += np.bincount(u, minlength=len(self.count))
            np.minimum.at(self.best, u, self.rank[v])


def compose(rows: np.ndarray, bucket: np.ndarray, size: np.ndarray, n: np.ndarray, length: int, a: int, b: int):
    """Near pairs of words (rows of symbols, 0 after the end) of one bucket whose first difference is in a to b - 1.

    Returns the order of the words it used, how many near words each has there, and which is the best.
    """
    head = bucket.astype(">u4").view(np.uint8).reshape(-1, 4)
    whole = np.ascontiguousarray(np.hstack([head, rows]))
    order = np.argsort(whole.view(f"S{whole.shape[1]}").ravel(), kind="stable")
    whole = whole[order]
    differ = whole[1:] != whole[:-1]
    shared = np.r_[-1, np.where(differ.any(1), differ.argmax(1), whole.shape[1]) - 4]
    shared = np.maximum(shared, -1)
    is_short = size[order] == length
    tries, at = [], []
    for mine in (is_short, ~is_short):
        # What two words share is the least that successive ones between them share.
        where = np.flatnonzero(mine)
        least = shared[:0]
        if len(where):
            least = np.minimum.reduceat(shared[: where[-1] + 1], np.r_[0, where[:-1] + 1])
            least[0] = -1
        tries.append(Trie(whole[where, 4:], least))
        at.append(where)
    short, long = tries
    used = np.r_[at[0], at[1]]
    offset = len(at[0])
    order = order[used]
    # By falling count, then by the alphabet, which is the order of the bytes.
    text = np.ascontiguousarray(rows[order]).view(f"S{rows.shape[1]}").ravel()
    preferred = np.lexsort((text, -n[order]))
    rank = np.empty(len(order), np.int64)
    rank[preferred] = np.arange(len(order))
    pairs = Pairs(rank)

    levels = {0: Level(*[np.zeros(1, np.int64)] * 2, *[np.zeros(0, np.int64)] * 4, np.ones(1, np.int64))}
    of_short = {0: np.zeros(len(short.rows), np.int64)}
    of_long = {0: np.zeros(len(long.rows), np.int64)}
    arcs_short, arcs_long = {}, {}
    for left in range(1, length + 2 - a):
        parts, nodes = [], 0
        for trie, depth, of, arcs in ((short, length - left, of_short, arcs_short), (long, length + 1 - left, of_long, arcs_long)):
            if depth >= a and len(trie.rows):
                node, symbol, words = arcs[depth] = trie.arcs(depth)
                parts.append((node + nodes, symbol, words, of[left - 1]))
                nodes += len(trie.starts(depth))
        if not parts:
            break
        state, levels[left] = _minimised(*[np.concatenate(c) for c in zip(*parts)], len(levels[left - 1].words))
        if length - left >= a and len(short.rows):
            of_short[left], state = np.split(state, [len(short.starts(length - left))])
        if len(long.rows):
            of_long[left] = state

    none = np.empty(0, np.int64)
    x, y, p, q, ban = none, none, none, none, none
    for depth in range(a, length + 1):
        left = length - depth
        if depth < b and len(short.rows) and len(long.rows):
            # The edit inserts: a long word goes on from a front that it shares with a short one.
            node = np.cumsum(shared < depth)
            s, g = short.starts(depth), long.starts(depth)
            _, u, v = np.intersect1d(node[at[0][s]], node[at[1][g]], assume_unique=True, return_indices=True)
            arc_node, symbol, _ = arcs_long[depth]
            degree = np.bincount(arc_node, minlength=len(g))
            owner, arc = _ranges((np.cumsum(degree) - degree)[v], degree[v])
            owner = u[owner]
            if left:
                own, own_symbol, _ = arcs_short[depth]
                many = np.bincount(own, minlength=len(s))
                go = (many[owner] > 1) | (own_symbol[(np.cumsum(many) - many)[owner]] != symbol[arc])
                owner, arc = owner[go], arc[go]
            x, y = np.r_[x, s[owner]], np.r_[y, offset + long.starts(depth + 1)[arc]]
            p, q = np.r_[p, of_short[left][owner]], np.r_[q, of_long[left][arc]]
            # The next symbol differs, or the words would first differ later.
            ban = np.r_[ban, symbol[arc] if left else np.zeros(len(arc), np.int64)]
        level = levels.get(left)
        if len(x):
            met = (p == q) & (ban == 0)
            if met.any():
                owner, place = _ranges(np.zeros(int(met.sum()), np.int64), level.words[p[met]])
                pairs.add(x[met][owner] + place, y[met][owner] + place)
                x, y, p, q, ban = (c[~met] for c in (x, y, p, q, ban))
            if not left:
                break
            fewer = level.degree[q] < level.degree[p]
            x, y, p, q = np.where(fewer, y, x), np.where(fewer, x, y), np.where(fewer, q, p), np.where(fewer, p, q)
            owner, arc = _ranges(level.first[p], level.degree[p])
            wanted = q[owner] * WIDE + level.symbol[arc]
            found = np.minimum(np.searchsorted(level.key, wanted), len(level.key) - 1)
            go = (level.key[found] == wanted) & (level.symbol[arc] != ban[owner])
            owner, arc, found = owner[go], arc[go], found[go]
            x, y = x[owner] + level.skip[arc], y[owner] + level.skip[found]
            p, q, ban = level.child[arc], level.child[found], np.zeros(len(owner), np.int64)
        if depth < b and left and len(short.rows):
            # The edit replaces: two arcs of one node.
            node, _, _ = arcs_short[depth]
            degree = np.bincount(node)
            last = np.cumsum(degree)[node]
            mine = np.arange(len(node))
            one, other = _ranges(mine + 1, last - mine - 1)
            s, of = short.starts(depth + 1), of_short[left - 1]
            x, y, p, q = np.r_[x, s[one]], np.r_[y, s[other]], np.r_[p, of[one]], np.r_[q, of[other]]
            ban = np.r_[ban, np.zeros(len(one), np.int64)]
    return order, pairs.count, preferred, pairs.best


NEAR_KIND = "word string, n_near long, best_n long, best string"


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partitions arrive sorted by (l, a, b, key). Whole ones with one (l, a, b) are taken until they fill a batch."""
    held: list[pa.RecordBatch] = []

    def settle(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts)
        key, size = np.asarray(rows["key"]), np.asarray(rows["size"]).astype(np.int64)
        length, a, b = (rows[c][0].as_py() for c in ("l", "a", "b"))
        bucket = np.cumsum(np.r_[False, key[1:] != key[:-1]])
        # Without a short word, or alone, words have no pair here.
        usable = (np.bincount(bucket, size == length) > 0) & (np.bincount(bucket) > 1)
        mine = np.flatnonzero(usable[bucket])
        if not len(mine):
            return
        letters = rows["letters"].take(pa.array(mine)).to_pylist()
        symbols = np.array(letters, f"S{length + 1}").view(np.uint8).reshape(len(mine), length + 1)
        n = np.asarray(rows["n"])[mine]
        order, count, preferred, best = compose(symbols, bucket[mine], size[mine], n, length, a, b)
        some = np.flatnonzero(count)
        chosen = order[preferred[best[some]]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([letters[i].decode("latin-1") for i in order[some]], pa.string()), pa.array(count[some]),
                pa.array(n[chosen]), pa.array([letters[i].decode("latin-1") for i in chosen], pa.string()),
            ],
            ["word", "n_near", "best_n", "best"],
        )

    size, last = 0, None
    for batch in batches:
        if not len(batch):
            continue
        columns = [np.asarray(batch.column(c)) for c in ("l", "a", "b", "key")]
        new = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
        starts = np.r_[0, new]
        groups = zip(starts.tolist(), np.diff(np.r_[starts, len(batch)]).tolist(), *[c[starts].tolist() for c in columns])
        taken = 0
        for start, count, *kind in groups:
            full = size >= BATCH_ROWS or size * kind[0] >= BYTES
            if last and (kind[:3] != last[:3] or full and kind != last):
                yield from settle([*held, batch.slice(taken, start - taken)])
                held, size, taken = [], 0, start
            last = kind
            size += count
        held.append(batch.slice(taken))
    if held:
        yield from settle(held)


def near_words(words: DataFrame, rows: int = ROWS) -> DataFrame:
    """Per word that has near words: word, n_near, best_n and best (largest n, then first in code-point order)."""
    spread = partitions(words, rows).repartition("l", "a", "b", "key").sortWithinPartitions("l", "a", "b", "key")
    found = spread.select("letters", "n", "size", "l", "a", "b", "key").mapInArrow(_near, NEAR_KIND)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("b.less")).alias("best_n"), "b.best"
    )


def roots(forms: DataFrame) -> DataFrame:
    """Where forms lead to in the end: word, root. Counts grow tenfold with each step, so few doublings do."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        now = cut(now, "roots")
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        met = now.join(on, "root", "left")
        if met.where("next is not null").isEmpty():
            return now
        now = met.select("word", F.coalesce("next", "root").alias("root"))


def variants(words: DataFrame, rows: int = ROWS) -> DataFrame:
    """word, form, root, n, n_near, form_n of a vocabulary of (word, n)."""
    near = near_words(words, rows)
    formed = F.col("best_n") >= TIMES * F.col("n")
    joined = cut(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"),
        ),
        "variants",
    )
    ends = roots(joined.where("form is not null").select("word", "form"))
    return joined.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(cut(vocabulary(table(spark, sf_dir, "documents")), "vocabulary"))
