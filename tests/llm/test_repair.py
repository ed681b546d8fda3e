"""Conversation repair against a plain forward search over whole conversations."""

import hashlib
import random
import re
import zlib

import pytest

from candlewick.llm import repair
from candlewick.llm.queries import QUERIES, SQL
from compare import connect, difference

SCHEMA = "conv_id long, turn long, role string, text string, part int, c string, key string"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def cheapest(rows, faults):
    """(cost, audit, repaired rows), the least of all that end well; a step for each row and each state."""
    best = {"": (0, "", ())}

    def with_inserts(best):
        best = dict(best)
        for _ in range(4):
            for state, (cost, audit, rows) in list(best.items()):
                to = NEXT[state]
                new = (cost + 2, audit + "I", rows + ((NAMES[to], ""),))
                if to not in best or new[:2] < best[to][:2]:
                    best[to] = new
        return best

    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit, done) in with_inserts(best).items():
            options = [(state, (cost + 3, audit + "D", done))]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if role[:1] and (role[:1] == NEXT[state] or state == "" and role[:1] == "s"):
                    options.append((role[:1], (cost + more, audit + "K", done + ((role, text),))))
                options.append((NEXT[state], (cost + 2 + more, audit + "R", done + ((NAMES[NEXT[state]], text),))))
            for to, new in options:
                if to not in after or new[:2] < after[to][:2]:
                    after[to] = new
        best = after
    best = with_inserts(best)
    return min((best[x] for x in ("", "a") if x in best), key=lambda x: x[:2])


def expected(rows):
    conversations, out = {}, {}
    for conv, *row in rows:
        conversations.setdefault(conv, []).append(row)
    for conv, own in conversations.items():
        left = []
        for turn, role, text in own:
            role, text = (" " if x is None else x for x in (role, text))
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            left += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        left.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        turns, seen, faults = {x[0] for x in left if x[0] is not None}, set(), []
        for _, role, text in left:
            bare = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit, done = cheapest(left, faults)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(x) for x in ("blank", "duplicate", "truncated")),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(left, left[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{role}:{text}" for role, text in done).encode()).hexdigest())
    return out


def conversations(seed):
    pick = random.Random(seed)
    texts = ["Fine.", "Cut", "", " \n", None, "So?", "Yes!", "no end", "é.", "A line.\nand one"] + [f"Text {i}." for i in range(40)]
    out = []
    for conv in [*range(60), None]:
        if conv and conv % 3 == 0:  # well formed but for a few rows
            out += [(conv, t, "system" if t == 0 else ("user", "assistant")[t % 2 - 1], f"Turn {t} of {conv}.") for t in range(pick.randrange(1, 12))]
            continue
        roles = pick.choice([["user", "assistant"], ["user", "assistant", "system", "tool", "", None, "sudo"], ["tool", "x"], ["system"]])
        for _ in range(pick.randrange(1, 30)):
            out.append((conv, pick.choice([None, *range(20)]), pick.choice(roles), pick.choice(texts)))
    out += [(900, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(700)]
    out += [(901, t, "tool", f"Turn {t}") for t in range(500)]  # its vectors never forget where they began
    out += [(902, t, "user", "The same.") for t in range(300)] + [(903, 1, "user", "Equal rows.")] * 200
    out += [(904, t, "user" if t % 7 else "system", "word " * 3000 + f"{t}.") for t in range(12)]
    pick.shuffle(out)
    return out


@pytest.mark.parametrize("seed, chunk, parts", [(1, 4096, 4), (2, 3, 25), (3, 1, 7)])
def test_repairs_match_a_plain_search(spark, seed, chunk, parts):
    rows = conversations(seed)
    turns = spark.createDataFrame([(*x, 1, "c", "k") for x in rows], SCHEMA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that conversations cross partitions
    try:
        got = {x[0]: tuple(x[1:]) for x in repair.damage_repaired(turns, chunk).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = expected(rows)
    assert {k: (got.get(k), v) for k, v in want.items() if got.get(k) != v} == {} and len(got) == len(want)


def test_no_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.damage_repaired(empty).count() == 0
    lost = next(t for t in range(99) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    row = repair.damage_repaired(spark.createDataFrame([(7, lost, "user", "Gone.", 1, "c", "k")], SCHEMA)).collect()
    assert [tuple(x) for x in row] == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_turns_far_apart(spark):
    rows = [(1, t, "user", f"At {t}.") for t in (-(1 << 63), 0, (1 << 63) - 1)] + [(2, t, "user", f"At {t}.") for t in (-5, 1 << 62)]
    found = repair.Repair(spark.createDataFrame([(*x, 1, "c", "k") for x in rows], SCHEMA)).conversations().collect()
    assert {x.c: x.gaps for x in found} == {1: (1 << 63) - 1, 2: (1 << 62) + 5 + 1 - 2}


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "One."), (1, 1, "tool", "Two."), (1, 2, "user", ""), (1, 3, "user", "Three.")]
    turns = spark.createDataFrame([(*x, 1, "c", "k") for x in rows], SCHEMA)
    fixed = repair.Repair(turns).turns().orderBy("part", "seq", "place").collect()
    assert [(x.role, x.text) for x in fixed] == [("user", "One."), ("assistant", "Two."), ("user", "Three."), ("assistant", "")]
    assert repair.Repair(turns).conversations().first()["audit"] == "KRDKI"


def test_speculation_is_put_right(spark):
    """Vectors of a conversation over many partitions equal those of one sweep, wherever the speculation was wrong."""
    rows = [(1, t, "tool" if t % 3 else "user", f"Turn {t}.") for t in range(200)]
    turns = spark.createDataFrame([(*x, 1, "c", "k") for x in rows], SCHEMA)
    audits = set()
    for parts in ("1", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        row = repair.Repair(turns, 2).conversations().first()
        audits.add((row["audit"], row["cost"]))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(audits) == 1


def test_query_matches_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert difference(QUERIES["op11_conversation_repair"](spark, folder), connect(folder), SQL["op11_conversation_repair"]) is None
