"""Op 13: repair the structure of damaged conversations at least cost, by Hirschberg's divide and conquer.

A repaired conversation has role initials of the form (s?(ua)+)?: four states tell what may follow (nothing yet,
after s, after u, after a). Each row is kept, given another role or deleted, and empty rows may be inserted; the letters
of the edits (K, R, D, I) in order are the audit. Of the cheapest audits the ASCII-least is wanted.

In the middle of a stretch of rows, the costs of reaching each state from the front meet the costs of finishing from
it. The stretch is cut at the best crossing, and both halves are solved alike, so that space is linear. Of equally
cheap crossings the one with the least audit in front is taken: front vectors carry, beside each state's cost, the
rank of its least audit among the four. Audits of the same rows end with the letter of the last row and none is the
front of another, so ranks of longer ones follow from the ranks so far and the letters added.

Conversations of any length are spread the same way. Rows are ordered over the cluster and cut into blocks of at most
BLOCK_ROWS rows or BLOCK_BYTES of text, within the parts that Spark makes of the order. A block of a conversation that is
split stands for its rows as 4 x 4 costs and ranks. The chain of these is solved like rows; then all blocks are solved
apart, between the states they start and end in. What meets in one task per conversation is a chain element per
block, and, streamed in order, the repaired bytes and the audit, as hash and audit are one value of the result.

Rows: nulls in role and text, and in the key of the damage, are one space; a null conv_id is a conversation of its own;
null turns come first; rows of one turn are ordered by role and text; copies of one row are carried as a count, at most
COPIES to a row; a conversation that lost all rows has zeros, an empty audit and the hash of the empty text; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envgrade.llm.common import cut, small_batches, table

BLOCK_ROWS = 4096
BLOCK_BYTES = 1 << 22
COPIES = 1024

START, AFTER_S, AFTER_U, AFTER_A = range(4)
INITIALS = "sua"
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)
SPACES = " \t\n\x0b\f\r"
NEXT_TURN = {START: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}
ROLE = {AFTER_U: "user", AFTER_A: "assistant"}
# What finishes a conversation in each state.
TRAILING = {START: "", AFTER_S: "II", AFTER_U: "I", AFTER_A: ""}
ENDING = [2.0 * len(TRAILING[s]) for s in range(4)]
LETTER_COST = {"D": 3, "I": 2, "K": 0, "R": 2}

#: Ways of a row, or of a block of rows, from a state: (state after, cost, key that orders ways of one start).
Ways = list[list[tuple[int, int, object]]]


def code_of(initial: str, fault: int) -> int:
    return (INITIALS.find(initial) if initial else -1) % 4 + 4 * fault


def _row_ways(code: int) -> Ways:
    initial, fault = code % 4, code // 4
    ways: Ways = []
    for start in range(4):
        best: dict[int, tuple[int, str]] = {}
        state, inserted = start, ""
        # More than two insertions in a row come back to a state at a higher cost.
        for _ in range(3):
            options = [(state, 3, "D")]
            if fault < BLANK:
                kept = {0: AFTER_S if state == START else None, 1: AFTER_U if state != AFTER_U else None,
                        2: AFTER_A if state == AFTER_U else None}.get(initial)
                if kept is not None:
                    options.append((kept, fault, "K"))
                options.append((NEXT_TURN[state], 2 + fault, "R"))
            for after, cost, letter in options:
                found = (cost + 2 * len(inserted), inserted + letter)
                best[after] = min(best.get(after, found), found)
            state, inserted = NEXT_TURN[state], inserted + "I"
        ways.append([(after, *found) for after, found in sorted(best.items())])
    return ways


ROW_WAYS = [_row_ways(code) for code in range(16)]


def forward(items: Sequence[Ways], start: list) -> list:
    """(cost, rank of the least audit) of every state after the items, None where it is out of reach."""
    front = start
    for ways in items:
        best: list = [None] * 4
        for state, reached in enumerate(front):
            if reached:
                for after, cost, key in ways[state]:
                    found = (reached[0] + cost, reached[1], key)
                    if best[after] is None or found < best[after]:
                        best[after] = found
        order = {key: i for i, key in enumerate(sorted({b[1:] for b in best if b}))}
        front = [b and (b[0], order[b[1:]]) for b in best]
    return front


def backward(items: Sequence[Ways], ending: list[float]) -> list[float]:
    """Cost of finishing from every state before the items."""
    rest = ending
    for ways in reversed(items):
        rest = [min(cost + rest[after] for after, cost, _ in ways[s]) if ways[s] else float("inf") for s in range(4)]
    return rest


def only(state: int) -> list[float]:
    return [0.0 if s == state else float("inf") for s in range(4)]


def entered(state: int) -> list:
    return [(0, 0) if s == state else None for s in range(4)]


def trace(items: Sequence[Ways], state: int, ending: list[float]) -> list[tuple[object, int]]:
    """The cheapest, then audit-least way through the items: each one's key and the state after it."""
    if not items:
        return []
    if len(items) == 1:
        _, key, after = min((cost + ending[after], key, after) for after, cost, key in items[0][state])
        return [(key, after)]
    middle = len(items) // 2
    front = forward(items[:middle], entered(state))
    rest = backward(items[middle:], ending)
    _, _, crossing = min((reached[0] + rest[s], reached[1], s) for s, reached in enumerate(front) if reached)
    return trace(items[:middle], state, only(crossing)) + trace(items[middle:], crossing, ending)


def block_ways(codes: bytes) -> Ways:
    """A block as one item: its costs, and the ranks of its least audits, from each state."""
    items = [ROW_WAYS[c] for c in codes]
    return [[(after, *r) for after, r in enumerate(forward(items, entered(state))) if r] for state in range(4)]


def repair(codes: bytes, kept: list[tuple[str, str]], state: int, ending: list[float], last: bool):
    """Audit, cost and repaired lines of a block; ``kept`` has role and text of its rows that may stay."""
    steps = trace([ROW_WAYS[c] for c in codes], state, ending)
    audit = "".join(key for key, _ in steps)
    if last:
        audit += TRAILING[steps[-1][1] if steps else state]
    cost, lines, row, candidate = 0, [], 0, 0
    for letter in audit:
        cost += LETTER_COST[letter]
        role, text = "", ""
        if letter != "I":
            fault = codes[row] // 4
            initial = codes[row] % 4
            row += 1
            if fault < BLANK:
                role, text = kept[candidate]
                candidate += 1
            if letter == "D":
                continue
            cost += fault
        if letter == "K":
            state = {0: AFTER_S, 1: AFTER_U, 2: AFTER_A}[initial]
        else:
            state = NEXT_TURN[state]
            role = ROLE[state]
        lines.append(f"{role}:{text}")
    return audit, cost, lines


def damaged(rows: DataFrame) -> DataFrame:
    """The rows after damage: conv_id, turn, role, text, copies."""
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    text = F.coalesce("text", F.lit(" "))
    return (
        rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", (F.crc32(key) % 20).alias("kind"))
        .where("kind <> 0")
        .select(
            "conv_id", "turn",
            F.when(F.col("kind") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
            F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies"),
        )
    )


def judged(rows: DataFrame) -> DataFrame:
    """Rows with equal ones counted, and whether role and text are new: one row per COPIES copies.

    New is what has the smallest turn of its role and text; of copies, the first.
    """
    content = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    counted = cut(
        rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
        .withColumn("content", F.unhex(content)),
        "turns",
    )
    first = counted.groupBy("conv_id", "content").agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("first"))
    first = first.select(F.col("conv_id").alias("c"), F.col("content").alias("t"), F.col("first.turn").alias("first"))
    met = counted.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("content") == F.col("t")))
    return met.select(
        "conv_id", "turn", "role", "text", F.col("turn").eqNullSafe(F.col("first")).alias("new"),
        F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES})")).alias("piece"), "copies",
    ).select(
        "conv_id", "turn", "role", "text", "piece", (F.col("new") & (F.col("piece") == 0)).alias("new"),
        F.least(F.col("copies") - F.col("piece") * COPIES, F.lit(COPIES)).cast("int").alias("copies"),
    )


def _row_codes(role: str, text: str, new: bool, copies: int) -> bytes:
    solid = text.rstrip(SPACES)
    if not solid:
        fault = again = BLANK
    else:
        fault, again = (TRUNCATED if solid[-1] not in ".!?" else SOUND) if new else DUPLICATE, DUPLICATE
    return bytes([code_of(role[:1], fault)]) + bytes([code_of(role[:1], again)]) * (copies - 1)


class _Blocks:
    """Cuts one part's ordered rows into blocks, a list of rows for the result."""

    def __init__(self, part: int, most: int) -> None:
        self.part, self.most, self.number, self.runs = part, most, 0, 0
        self.conv, self.out, self.held = None, [], []
        self._clear()

    def _clear(self) -> None:
        self.codes, self.roles, self.texts, self.size, self.turns = bytearray(), [], [], 0, []

    def add(self, conv, turn, role, text, new, copies) -> None:
        if self.conv is None or self.conv[0] != conv:
            self.end_run()
            self.conv = (conv,)
        elif len(self.codes) >= self.most or self.size >= BLOCK_BYTES:
            self.end_block()
        codes = _row_codes(role, text, new, copies)
        self.codes += codes
        if codes[0] // 4 < BLANK:
            self.roles.append(role)
            self.texts.append(text)
            self.size += len(text)
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)

    def end_block(self) -> None:
        if self.codes:
            self.held.append({
                "conv_id": self.conv[0], "part": self.part, "block": self.number, "whole": False,
                "codes": bytes(self.codes), "roles": self.roles, "texts": self.texts, "n_turns": len(self.turns),
                "first_turn": self.turns[0] if self.turns else None, "last_turn": self.turns[-1] if self.turns else None,
                "ways": None,
            })
            self.number += 1
            self._clear()

    def end_run(self, last: bool = False) -> None:
        """A conversation has ended here. It is whole if it is one block and neither the part's first nor its last."""
        self.end_block()
        whole = len(self.held) == 1 and self.runs > 0 and not last
        for row in self.held:
            row["whole"] = whole
            if not whole:
                ways = block_ways(row["codes"])
                row["ways"] = [[s, after, cost, rank] for s in range(4) for after, cost, rank in ways[s]]
        self.runs += bool(self.held)
        self.out += self.held
        self.held = []


def _schema(conv: pa.DataType) -> pa.Schema:
    return pa.schema([
        ("conv_id", conv), ("part", pa.int32()), ("block", pa.int32()), ("whole", pa.bool_()), ("codes", pa.binary()),
        ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("n_turns", pa.int64()),
        ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("ways", pa.list_(pa.list_(pa.int64()))),
    ])


def _cut_blocks(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.RecordBatch]:
    blocks, schema = _Blocks(TaskContext.get().partitionId(), block_rows), None
    for batch in batches:
        schema = schema or _schema(batch.schema.field("conv_id").type)
        for row in batch.to_pylist():
            blocks.add(*[row[c] for c in ("conv_id", "turn", "role", "text", "new", "copies")])
            if len(blocks.out) >= 500:
                yield pa.RecordBatch.from_pylist(blocks.out, schema=schema)
                blocks.out = []
    blocks.end_run(last=True)
    if blocks.out:
        yield pa.RecordBatch.from_pylist(blocks.out, schema=schema)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[dict]]:
    """Successive rows of one conversation, as iterators that must be used up in turn."""
    rows = (row for batch in batches for at in range(0, len(batch), 64) for row in batch.slice(at, 64).to_pylist())
    ahead = next(rows, None)

    def run() -> Iterator[dict]:
        nonlocal ahead
        conv = ahead["conv_id"]
        while ahead is not None and ahead["conv_id"] == conv:
            row, ahead = ahead, next(rows, None)
            yield row

    while ahead is not None:
        yield run()


def _solve_chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the blocks of a conversation in order: the states each starts and ends in, and which is the last."""
    out: list[dict] = []
    kind = pa.schema([("p", pa.int32()), ("b", pa.int32()), ("before", pa.int32()), ("after", pa.int32()), ("last", pa.bool_())])
    for run in _runs(batches):
        places, items = [], []
        for row in run:
            ways: Ways = [[], [], [], []]
            for start, after, cost, rank in row["ways"]:
                ways[start].append((after, cost, rank))
            places.append((row["part"], row["block"]))
            items.append(ways)
        before = START
        for i, (_, after) in enumerate(trace(items, START, ENDING)):
            out.append({"p": places[i][0], "b": places[i][1], "before": before, "after": after, "last": i + 1 == len(items)})
            before = after
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, schema=kind)
            out = []
    yield pa.RecordBatch.from_pylist(out, schema=kind)


def _repair_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept_columns = ("conv_id", "part", "block", "n_turns", "first_turn", "last_turn")
    for batch in batches:
        fields = [batch.schema.field(c) for c in kept_columns]
        for at in range(0, len(batch), 64):
            out = []
            for row in batch.slice(at, 64).to_pylist():
                codes, kept = row["codes"], list(zip(row["roles"], row["texts"]))
                whole = row["before"] is None
                audit, cost, lines = repair(
                    codes, kept, START if whole else row["before"], ENDING if whole else only(row["after"]), whole or row["last"]
                )
                faults = np.bincount(np.frombuffer(codes, np.uint8) // 4, minlength=4)
                initials = np.frombuffer(codes, np.uint8) % 4
                pairs = initials[:-1] * 4 + initials[1:]
                out.append({c: row[c] for c in kept_columns} | {
                    "blank": int(faults[BLANK]), "duplicate": int(faults[DUPLICATE]), "truncated": int(faults[TRUNCATED]),
                    "illegal": int((~np.isin(pairs, LEGAL)).sum()), "head": int(initials[0]), "tail": int(initials[-1]),
                    "cost": cost, "audit": audit, "n_lines": len(lines), "repaired": "\n".join(lines),
                })
            kinds = [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "head", "tail", "cost")]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                *fields, *kinds, ("audit", pa.string()), ("n_lines", pa.int64()), ("repaired", pa.string()),
            ]))


#: Codes of the pairs su, ua and au.
LEGAL = [0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1]
SUMS = ("blank", "duplicate", "truncated", "illegal", "cost")
REPAIRED = ", ".join(
    ["part int, block int, n_turns long, first_turn long, last_turn long"]
    + [f"{c} long" for c in ("blank", "duplicate", "truncated", "illegal", "head", "tail", "cost")]
    + ["audit string, n_lines long, repaired string"]
)
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _join_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its blocks in order; bytes are hashed as they come."""
    out, schema = [], None

    def typed(batches):
        nonlocal schema
        for batch in batches:
            schema = schema or pa.schema([
                pa.field("conv_id", batch.schema.field("conv_id").type),
                *[pa.field(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                pa.field("audit", pa.string()), pa.field("repaired_sha256", pa.string()),
            ])
            yield batch

    for run in _runs(typed(batches)):
        sums, audit, digest, lines = dict.fromkeys(SUMS, 0), [], hashlib.sha256(), 0
        lowest = highest = tail = None
        turns, conv = 0, None
        for row in run:
            conv = row["conv_id"]
            for c in SUMS:
                sums[c] += row[c]
            if tail is not None and tail * 4 + row["head"] not in LEGAL:
                sums["illegal"] += 1
            tail = row["tail"]
            if row["first_turn"] is not None:
                turns += row["n_turns"] - (highest == row["first_turn"])
                lowest, highest = row["first_turn"] if lowest is None else lowest, row["last_turn"]
            if row["n_lines"]:
                digest.update((b"\n" if lines else b"") + row["repaired"].encode("utf-8", "replace"))
                lines += row["n_lines"]
            audit.append(row["audit"])
        gaps = 0 if lowest is None else highest - lowest + 1 - turns
        out.append({"conv_id": conv, "gaps": gaps, **sums, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()})
        if len(out) >= 500:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def repaired_blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Repaired blocks of rows after damage, of whole conversations and of those that are split; each with part and
    block number, audit, cost, faults and repaired lines."""
    spark = rows.sparkSession
    small_batches(spark)
    conv = rows.schema["conv_id"].dataType.simpleString()
    # Equal rows and copies of a row meet in one part, as do texts that start alike; only keys of bounded size are sampled.
    ordered = (
        judged(rows)
        .repartitionByRange("conv_id", "turn", F.substring("role", 1, 64), F.substring("text", 1, 64), "piece")
        .sortWithinPartitions("conv_id", "turn", "role", "text", "piece")
    )
    blocks = cut(
        ordered.select("conv_id", "turn", "role", "text", "new", "copies").mapInArrow(
            lambda batches: _cut_blocks(batches, block_rows),
            f"conv_id {conv}, part int, block int, whole boolean, codes binary, roles array<string>, texts array<string>,"
            " n_turns long, first_turn long, last_turn long, ways array<array<long>>",
        ),
        "blocks",
    )
    chains = (
        blocks.where("not whole").select("conv_id", "part", "block", "ways").repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "block")
        .mapInArrow(_solve_chain, "p int, b int, before int, after int, last boolean")
    )
    kept = blocks.drop("ways")
    states = ("before", "after", "last")
    split = kept.where("not whole").join(chains, (F.col("part") == F.col("p")) & (F.col("block") == F.col("b")))
    whole = kept.where("whole").withColumns({c: F.lit(None).cast("boolean" if c == "last" else "int") for c in states})
    return tuple(
        df.drop("p", "b", "whole").mapInArrow(_repair_blocks, f"conv_id {conv}, {REPAIRED}") for df in (whole, split)
    )


def repair_conversations(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per conv_id of rows after damage: gaps, faults, cost, audit and the hash of the repaired conversation."""
    whole, split = repaired_blocks(rows, block_rows)
    kind = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {RESULT}"
    split = split.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    return whole.mapInArrow(_join_blocks, kind).union(split.mapInArrow(_join_blocks, kind))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    done = repair_conversations(damaged(rows)).withColumnRenamed("conv_id", "own")
    every = rows.select("conv_id").distinct()
    none = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("gaps", *SUMS)}
    none |= {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))}
    out = every.join(done, F.col("conv_id").eqNullSafe(F.col("own")), "left").drop("own")
    order = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return out.select("conv_id", *[none[c].alias(c) for c in order])
