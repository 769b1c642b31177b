"""Op 4: remove every byte that a 100-byte string covers which also starts earlier in the corpus.

Suffixes are compared to a depth of LENGTH bytes, one bucket at a time, with ranks (here: names) of a cover sample.
A sample by position alone, as of a difference cover, takes a tenth of all positions, and all of them must be
shuffled. This one is chosen by content and has the property that matters of a difference cover: any two equal strings of
LENGTH bytes hold a sample position at the same place in both. The sample position of a string is its
GRAM-byte substring with the smallest hash; that hash is the name of its bucket.

1. Successive strings of a document with one sample position form a run (start, n) with the bucket's name and a
   name for the whole content. About one position in forty starts a run.
2. Bucket names are counted, and only runs in buckets with at least two go on.
3. Runs with equal content need no comparison: all but the earliest are covered whole. They combine map-side, so
   a passage that a third of all documents share costs one row per task.
4. Buckets that still hold different runs are sorted one at a time: their runs' bytes are fetched, the strings
   in them named and sorted, and all but the first of each name are covered. A bucket of more than BUCKET_RUNS
   runs is spread over the cluster instead, one row per string, with minima that combine map-side.
5. Each document gets its list of covered runs, cuts them out and hashes what is left.

Names are 64-bit hashes and are only ever compared within a bucket. Lists per document are bounded by its length.

Rows: a null text is empty; a null doc_id sorts before all others; rows that share a doc_id, or have none, are judged
each against smaller ids and their own text, and told apart by 128 bits of their text; an empty table gives no rows;
other columns, of any name, are ignored by `repeats` and kept by `remove_repeats`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envgrade.llm.common import content, cut, release, small_batches, table

LENGTH = 100
GRAM = 24
CHUNK_BYTES = 1 << 19
PIECE_BYTES = 1 << 22
BUCKET_RUNS = 1 << 15
# What tells a row: its id as a number that sorts, and two hashes of its text.
OWN = ["ord", "h1", "h2"]
SORT_BYTES = 1 << 22

_BYTE = np.random.default_rng(20240101).integers(1, 1 << 62, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0xD6E8FEB86659FD93
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def names(letters: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit name for each substring of ``size`` bytes, by doubling."""
    count = len(letters) - size + 1
    levels, width, base = [(1, _BYTE[letters], _BASE)], 1, _BASE
    while 2 * width <= size:
        _, h, base = levels[-1]
        levels.append((2 * width, h[:-width] * np.uint64(base) + h[width:], base * base % (1 << 64)))
        width *= 2
    out, at = None, 0
    for width, h, base in reversed(levels):
        if size - at >= width:
            part = h[at : at + count]
            out = part if out is None else out * np.uint64(base) + part
            at += width
    return _mixed(out)


def least(values: np.ndarray, size: int) -> np.ndarray:
    """The minimum of each ``size`` successive values."""
    count, width, low = len(values) - size + 1, 1, values
    while 2 * width <= size:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    return np.minimum(low[:count], low[size - width : size - width + count])


def runs_of(pieces: list[bytes]) -> tuple[np.ndarray, ...]:
    """Runs of all pieces: piece number, start in it, number of strings, bucket name, content name."""
    letters = np.frombuffer(b"".join(pieces), np.uint8)
    none = np.empty(0, np.int64)
    if len(letters) < LENGTH:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ends = np.cumsum(lengths)
    piece = np.repeat(np.arange(len(pieces)), lengths)[: len(letters) - LENGTH + 1]
    grams = names(letters, GRAM)
    bucket = least(grams, LENGTH - GRAM + 1)
    whole = names(letters, LENGTH)
    at = np.flatnonzero(np.arange(len(piece)) + LENGTH <= ends[piece])
    if not len(at):
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    # A string that begins with its sample position (of equal ones the leftmost) is the last of its run.
    ended = grams[at] == bucket[at]
    bucket, piece = bucket[at], piece[at]
    first = np.flatnonzero(np.r_[True, ended[:-1] | (bucket[1:] != bucket[:-1]) | (piece[1:] != piece[:-1])])
    n = np.diff(np.r_[first, len(at)])
    nth = np.arange(len(at), dtype=np.uint64) - np.repeat(first.astype(np.uint64), n)
    text = np.add.reduceat(_mixed(whole[at] + nth * _MIX), first)
    start = at[first] - (ends - lengths)[piece[first]]
    return piece[first], start, n, bucket[first], text


def document_runs(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """`runs_of` many documents in chunks: document number, start, strings, bucket, content, and whether a run
    repeats an earlier one of its document."""
    pieces, owner, offset, held = [], [], [], 0

    def flush():
        piece, start, n, bucket, text = runs_of(pieces)
        doc, start = np.array(owner)[piece], start + np.array(offset)[piece]
        order = np.lexsort((start, text, bucket, doc))
        same = np.zeros(len(doc), bool)
        a, b = order[1:], order[:-1]
        same[a] = (doc[a] == doc[b]) & (bucket[a] == bucket[b]) & (text[a] == text[b])
        return doc, start, n, bucket.view(np.int64), text.view(np.int64), same

    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - LENGTH + 1, 0), PIECE_BYTES):
            pieces.append(text[at : at + PIECE_BYTES + LENGTH - 1])
            owner.append(i)
            offset.append(at)
            held += len(pieces[-1])
        if held >= CHUNK_BYTES:
            yield flush()
            pieces, owner, offset, held = [], [], [], 0
    if pieces:
        yield flush()


def _body(text_col: str) -> Column:
    return content(F.col(f"`{text_col}`")).cast("binary")


def _own_key(id_col: str, body: Column) -> list[Column]:
    order = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(1 << 63)).cast("long"))
    return [order.alias("ord"), F.xxhash64(body).alias("h1"), F.xxhash64(F.lit(1), body).alias("h2")]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents with what identifies a row: a sortable id and two hashes of the text."""
    body = _body(text_col)
    return docs.select(*_own_key(id_col, body), body.alias("body"))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def _count_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        for *_, bucket, _, _ in document_runs(batch.column(0).to_pylist()):
            key, n = np.unique(bucket, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "runs"])


def _list_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        own = [np.asarray(batch.column(i)) for i in range(3)]
        for doc, start, n, bucket, text, again in document_runs(batch.column(3).to_pylist()):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (*(o[doc] for o in own), bucket, text, start, n, again)],
                [*OWN, "key", "text", "start", "n", "again"],
            )


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs that a document is asked for."""
    for batch in _slices(batches, 64):
        out = {c: [] for c in ("key", *OWN, "start", "bytes", "large")}
        for row in batch.to_pylist():
            for want in row["wanted"]:
                out["key"].append(want["key"])
                for c in OWN:
                    out[c].append(row[c])
                out["start"].append(want["start"])
                out["bytes"].append(row["body"][want["start"] : want["start"] + want["n"] + LENGTH - 1])
                out["large"].append(want["large"])
        kinds = (*[pa.int64()] * 5, pa.binary(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))


def _strings(table_: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All strings of some runs: run number, place in the run, and name, for which the bucket counts too."""
    texts = table_["bytes"].to_pylist()
    letters = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = lengths - LENGTH + 1
    run = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.repeat(np.cumsum(lengths) - lengths, counts) + nth
    key = np.asarray(table_["key"]).view(np.uint64)
    return run, nth, _mixed(names(letters, LENGTH)[at] + key[run] * _MIX)


def _covered(table_: pa.Table, run: np.ndarray, nth: np.ndarray) -> pa.RecordBatch:
    """Successive strings joined to runs again."""
    place = np.asarray(table_["start"])[run] + nth
    first = np.flatnonzero(np.r_[True, (run[1:] != run[:-1]) | (place[1:] != place[:-1] + 1)]) if len(run) else run
    n = np.diff(np.r_[first, len(run)])
    own = run[first]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(table_[c])[own]) for c in OWN] + [pa.array(place[first]), pa.array(n)],
        [*OWN, "start", "n"],
    )


def _sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs arrive by bucket, id and start. Whole buckets are taken until they fill SORT_BYTES, then sorted."""
    held: list[pa.RecordBatch] = []
    size = 0

    def settle(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts)
        run, nth, name = _strings(rows)
        order = np.argsort(name, kind="stable")
        ids, h1, h2 = (np.asarray(rows[c]) for c in OWN)
        sorted_name, owner = name[order], run[order]
        place = (np.asarray(rows["start"])[run] + nth)[order]
        changed = sorted_name[1:] != sorted_name[:-1]
        group = np.flatnonzero(np.r_[True, changed])
        lowest = np.repeat(ids[owner[group]], np.diff(np.r_[group, len(order)]))
        # Repeated rows bring a string of one place more than once; only a later place is a repeat.
        other = [c[owner[1:]] != c[owner[:-1]] for c in (ids, h1, h2)]
        own = np.flatnonzero(np.r_[True, np.logical_or.reduce([changed, *other])])
        first_place = np.repeat(np.minimum.reduceat(place, own), np.diff(np.r_[own, len(order)]))
        hit = np.sort(order[(ids[owner] > lowest) | (place > first_place)])
        return _covered(rows, run[hit], nth[hit])

    for batch in _slices(batches, 2048):
        key = np.asarray(batch.column(0))
        # Rows of the last bucket seen stay until it is known to be whole.
        last = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
        ends_before = bool(held) and held[-1].column(0)[-1].as_py() != key[0]
        if last or ends_before:
            head = [*held, batch.slice(0, last)] if last else held
            if size + batch.slice(0, last).nbytes >= SORT_BYTES:
                yield settle(head)
                held, size = [], 0
                batch = batch.slice(last)
        held.append(batch)
        size += batch.nbytes
    if held:
        yield settle(held)


def _spread_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per string of the runs of large buckets, the first of a name per document of a batch."""
    for batch in _slices(batches, 512):
        rows = pa.Table.from_batches([batch])
        run, nth, name = _strings(rows)
        out = [*(np.asarray(rows[c])[run] for c in OWN), np.asarray(rows["start"])[run] + nth, name.view(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], [*OWN, "place", "name"])


def covered_runs(texts: DataFrame) -> DataFrame:
    """Runs (ord, h1, h2, start, n) of strings that also start earlier; they may overlap."""
    spark = texts.sparkSession
    small_batches(spark)
    counts = texts.select("body").mapInArrow(_count_buckets, "key long, runs long")
    # Names of shared buckets are written down, so that the join below has two plain inputs and adaptive
    # execution can split a bucket that holds a large part of all runs. So are the tables after it.
    shared = cut(counts.groupBy("key").agg(F.sum("runs").alias("runs")).where("runs > 1").select("key"), "shared")
    runs = texts.mapInArrow(
        _list_runs, "ord long, h1 long, h2 long, key long, text long, start long, n long, again boolean"
    ).join(shared, "key")
    runs = cut(runs, "runs")
    release(spark)
    contents = cut(runs.groupBy("key", "text").agg(F.min("ord").alias("first")), "contents")
    kinds = cut(contents.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1"), "kinds")
    whole = F.expr("again or ord > first")
    judged = cut(
        runs.join(contents, ["key", "text"]).select(
            *OWN, F.when(~whole, F.col("key")).alias("key"), "start", "n", whole.alias("whole")
        ),
        "judged",
    )
    release(spark)
    wanted = judged.where("not whole").join(kinds, "key").groupBy(*OWN).agg(
        F.collect_set(F.struct("key", "start", "n", (F.col("kinds") > BUCKET_RUNS).alias("large"))).alias("wanted")
    )
    fetched = cut(
        texts.join(wanted, OWN).select(*OWN, "body", "wanted").mapInArrow(
            _fetch, "key long, ord long, h1 long, h2 long, start long, bytes binary, large boolean"
        ),
        "fetched",
    )
    release(spark)
    kind = "ord long, h1 long, h2 long, start long, n long"
    small = (
        fetched.where("not large").drop("large").repartition("key").sortWithinPartitions("key", *OWN, "start")
        .mapInArrow(_sort_buckets, kind)
    )
    strings = fetched.where("large").drop("large").mapInArrow(
        _spread_strings, "ord long, h1 long, h2 long, place long, name long"
    )
    # Per string and document its first place, per string the smallest document.
    places = strings.groupBy("name", *OWN).agg(F.min("place").alias("first_place"))
    lowest = places.groupBy("name").agg(F.min("ord").alias("lowest"))
    large = (
        strings.join(places.join(lowest, "name"), ["name", *OWN])
        .where("ord > lowest or place > first_place")
        .select(*OWN, F.col("place").alias("start"), F.lit(1).cast("long").alias("n"))
    )
    found = judged.where("whole").select(*OWN, "start", "n").union(small).union(large)
    return cut(found, "covered")


def _removed(size: int, starts: list[int], counts: list[int]) -> np.ndarray:
    """Bounds of the maximal removed spans of a text, as rows (start, stop)."""
    if not starts:
        return np.empty((0, 2), np.int64)
    begin = np.array(starts)
    stop = begin + np.array(counts) + LENGTH - 1
    order = np.argsort(begin, kind="stable")
    begin, stop = begin[order], np.maximum.accumulate(stop[order])
    new = np.flatnonzero(np.r_[True, begin[1:] > stop[:-1]])
    return np.stack([begin[new], stop[np.r_[new[1:] - 1, len(stop) - 1]]], 1)


def _kept(body: bytes, spans: np.ndarray) -> bytes:
    bounds = [0, *spans.reshape(-1).tolist(), len(body)]
    return b"".join(body[a:b] for a, b in zip(bounds[::2], bounds[1::2]))


def _with_runs(docs: DataFrame, texts: DataFrame) -> DataFrame:
    # Once per place, or the lists of a row repeated k times would be k times as long, for each of the k.
    places = covered_runs(texts).groupBy(*OWN, "start").agg(F.max("n").alias("n"))
    lists = places.groupBy(*OWN).agg(
        F.collect_list("start").alias("starts"), F.collect_list("n").alias("counts")
    )
    release(texts.sparkSession)
    return docs.join(lists, OWN, "left")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, spans (array of start and stop) and kept (binary)."""
    texts = _texts(docs, id_col, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = _with_runs(texts, texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 512):
            out = []
            for row in batch.to_pylist():
                spans = _removed(len(row["body"]), row["starts"] or [], row["counts"] or [])
                out.append({
                    "ord": row["ord"], "n_bytes": len(row["body"]), "n_removed": int((spans[:, 1] - spans[:, 0]).sum()),
                    "n_spans": len(spans), "spans": spans.tolist(), "kept": _kept(row["body"], spans),
                })
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("ord", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                ("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.binary()),
            ]))

    out = rows.mapInArrow(
        run, "ord long, n_bytes long, n_removed long, n_spans long, spans array<array<long>>, kept binary"
    )
    own = F.when(F.col("ord") != F.lit(-(1 << 63)).cast("long"), F.col("ord")).cast(id_type)
    return out.select(own.alias("doc_id"), "n_bytes", "n_removed", "n_spans", "spans", "kept")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the repeated bytes cut from their texts; a character cut in part goes whole."""
    texts = _texts(docs, id_col, text_col)
    names_, at = docs.columns, docs.columns.index(text_col)
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names_]).alias("doc"), *_own_key(id_col, _body(text_col))
    )
    rows = _with_runs(keyed, texts).select("doc", "starts", "counts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 512):
            out = []
            columns = batch.column(0).flatten()
            for text, starts, counts in zip(columns[at], batch.column(1), batch.column(2)):
                text = text.as_py()
                if text is not None and starts.is_valid:
                    body = text.encode("utf-8", "replace")
                    text = _kept(body, _removed(len(body), starts.as_py(), counts.as_py())).decode("utf-8", "ignore")
                out.append(text)
            columns[at] = pa.array(out, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names_)

    return rows.mapInArrow(run, docs.schema)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
