import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from envgrade.llm.conversations import damaged, op13_conversations, repair_conversations

SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\f\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))


def plain_repair(rows):
    """Every state of every row, whole audits compared as strings."""
    seen, faults = set(), []
    for _, _, role, text in rows:
        solid = text.strip(SPACES)
        if not solid:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if text.rstrip(SPACES)[-1] in ".!?" else "truncated")
        seen.add((role, text))
    # What may follow: "" nothing yet, or the last initial; and what an empty or changed row becomes there.
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}
    n, best = len(rows), {}
    for i in range(n, -1, -1):
        level = {s: (0, "", ()) if i == n and s in ("", "a") else None for s in follows}
        for _ in range(4):
            for s in follows:
                options = []
                if i < n:
                    _, _, role, text = rows[i]
                    late = faults[i] == "truncated"
                    ways = [("D", 3, s, None)]
                    if faults[i] not in ("blank", "duplicate"):
                        if role[:1] == "s" and s == "" or role[:1] == follows[s]:
                            ways.append(("K", late, role[:1], (role, text)))
                        ways.append(("R", 2 + late, follows[s], ({"u": "user", "a": "assistant"}[follows[s]], text)))
                    for letter, cost, after, line in ways:
                        rest = best[i + 1][after]
                        if rest:
                            options.append((cost + rest[0], letter + rest[1], ((line,) if line else ()) + rest[2]))
                rest = level[follows[s]]
                if rest:
                    role = {"u": "user", "a": "assistant"}[follows[s]]
                    options.append((2 + rest[0], "I" + rest[1], ((role, ""),) + rest[2]))
                for o in options:
                    if level[s] is None or o[:2] < level[s][:2]:
                        level[s] = o
        best[i] = level
    cost, audit, lines = best[0][""]
    turns = [t for _, t, _, _ in rows if t is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest(),
    )


def expected(rows, damage=True):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    done = {c: plain_damage(v) for c, v in by.items()} if damage else by
    return {c: plain_repair(v) for c, v in done.items()}


def made(dice, convs, longest, roles=("user", "assistant", "system", "tool", None, "")):
    rows = []
    for conv in convs:
        turn = 0
        for _ in range(dice.randrange(1, longest)):
            turn += dice.choice((0, 1, 1, 1, 1, 3))
            text = dice.choice(("Yes.", "No", "What?", " ", "", None, "And so on. \n", "a b c!", "Grün. ", f"t{turn}.", f"{turn}"))
            rows.append((conv, dice.choice((turn,) * 9 + (None,)), dice.choice(roles), text))
    return rows


def _table(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def test_query_equals_the_plain_repair(spark, write_tables):
    rows = made(random.Random(13), [*range(300), None], 14)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("?") for c in ("n", "part", "block", "audit", "kind")})
    got = _table(op13_conversations(spark, write_tables(conversations=df)))
    assert got == expected(rows)


@pytest.mark.parametrize("block_rows", [1, 2, 7])
def test_conversations_cut_into_many_blocks(spark, block_rows):
    rows = made(random.Random(block_rows), range(12), 90, roles=("user", "assistant", "system", None))
    rows += [(99, i // 2, "user" if i % 2 else "assistant", "ok." if i % 3 else "ok") for i in range(700)]
    damage = damaged(spark.createDataFrame(rows, SCHEMA))
    got = _table(repair_conversations(damage, block_rows))
    assert got == {c: v for c, v in expected(rows).items() if c in got} and len(got) >= 12 and 99 in got


def test_many_copies_of_one_row(spark):
    rows = [(1, 5, "user", "Hello.")] * 3000 + [(1, 6, "assistant", "Yes.")] + [(1, i, "user", "Hello.") for i in range(10, 2000)]
    rows = [r for r in rows if zlib.crc32(f"{r[0]}:{r[1]}".encode()) % 20 > 4]
    got = _table(repair_conversations(damaged(spark.createDataFrame(rows, SCHEMA)), 500))
    assert got == expected(rows)


def test_a_very_long_conversation_and_long_texts(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"Turn {i}." + "x" * (i % 7)) for i in range(12000)]
    rows += [(2, 0, "user", "word " * 200_000), (2, 1, "assistant", "fine. " * 100_000)]
    assert _table(repair_conversations(damaged(spark.createDataFrame(rows, SCHEMA)))) == expected(rows)


def test_empty_tables_and_conversations_without_rows(spark, write_tables):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    folder = write_tables(conversations=spark.createDataFrame([(lost, 0, "user", "Hi.")], SCHEMA))
    assert _table(op13_conversations(spark, folder)) == {lost: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert repair_conversations(damaged(spark.createDataFrame([], SCHEMA))).count() == 0
