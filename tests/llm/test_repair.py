"""Conversation repair against a row-by-row search that keeps whole audits."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from textloom.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NEXT = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}


def faults_of(rows):
    """Fault letter of each ordered ``turn, role, text``."""
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        own = "b" if not bare else "d" if (role, text) in seen else "" if bare[-1] in ".!?" else "t"
        seen.add((role, text))
        out.append(own)
    return out


def best_audit(rows, faults):
    """``cost, audit``: the cheapest, then the ASCII-least, over all edit sequences."""

    @lru_cache(None)
    def best(i, state, inserted):
        found = []
        if i == len(rows) and state in (0, 3):
            found.append((0, ""))
        if inserted < 3:
            cost, rest = best(i, NEXT[state][1], inserted + 1)
            found.append((cost + 2, "I" + rest))
        if i < len(rows):
            initial, cut = rows[i][1][:1], int(faults[i] == "t")
            moves = [("D", 3, state)]
            if faults[i] not in ("b", "d"):
                moves.append(("R", 2 + cut, NEXT[state][1]))
                if initial == "s" and state == 0:
                    moves.append(("K", cut, 1))
                if initial == NEXT[state][0][0]:
                    moves.append(("K", cut, NEXT[state][1]))
            for letter, paid, to in moves:
                cost, rest = best(i + 1, to, 0)
                found.append((cost + paid, letter + rest))
        return min(found, default=(10**9, ""))

    for i in range(len(rows), -1, -1):  # keeps the recursion shallow
        for state in range(4):
            best(i, state, 0)
    return best(0, 0, 0)


def expected(rows):
    """The whole result row of one conversation of ordered ``turn, role, text``."""
    faults = faults_of(rows)
    cost, audit = best_audit(rows, faults)
    numbers = [t for t, _, _ in rows if t is not None]
    out, state, at = [], 0, 0
    for letter in audit:
        role, text = ("", "") if letter == "I" else rows[at][1:]
        at += letter != "I"
        if letter == "D":
            continue
        role = role if letter == "K" else NEXT[state][0]
        state = 1 if letter == "K" and role[:1] == "s" else NEXT[state][1]
        out.append(f"{role}:{text}")
    pairs = zip(rows, rows[1:], strict=False)
    return (
        max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        faults.count("b"), faults.count("d"), faults.count("t"),
        sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs), cost, audit,
        hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def ordered(rows, conv):
    """A conversation's rows in the operator's order: turn, nulls first, then a hash of the content."""
    own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
    name = " " if conv is None else str(conv)
    mark = lambda r, x: hashlib.sha256(f"{name}:{len(r)}:{r}:{x}".encode()).digest()
    return sorted(own, key=lambda row: (row[0] is not None, row[0] or 0, mark(row[1], row[2])))


def result(frame):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {row["conv_id"]: tuple(row[n] for n in names) for row in frame.collect()}


def made(seed, conv, n):
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "and then", "", " \t", "é.", "open é", None]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    return [
        (conv, draw.choice([None, *range(n)]) if draw.random() < 0.2 else i, draw.choice(roles),
         draw.choice(texts) if draw.random() < 0.5 else f"t{draw.randrange(n * 2)}{draw.choice('.!?,')}")
        for i in range(n)
    ]


def test_small_conversations(spark):
    rows = [row for conv in range(300) for row in made(conv, conv, 1 + conv % 9)]
    rows += [(None, i, "user", "Hi.") for i in range(3)] + [(-1, None, "user", "A."), (-1, None, "assistant", "B.")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"audit": F.lit("x"), "slot": F.lit(1), "digest": F.lit(2)})
    got = result(repair.repair_conversations(frame))
    assert got == {conv: expected(ordered(rows, conv)) for conv in {r[0] for r in rows}}


@pytest.mark.parametrize("kind", ["mixed", "one symbol", "all alike"])
def test_conversation_over_many_partitions(spark, kind):
    """One conversation holds nearly all rows and lies in every partition; runs are longer than what is unrolled at once."""
    n = 6000
    if kind == "mixed":
        rows = made(5, 7, n)
    elif kind == "one symbol":
        rows = [(7, i, "user", f"text {i}.") for i in range(n)]
    else:
        rows = [(7, None, "user", "same.") for _ in range(n)]
    rows += [row for conv in range(5) for row in made(conv, conv, 4)] + made(9, 99, 5)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(8)
    parts = repair._parts(
        repair._with_faults(repair._narrow(repair.turns_of(frame))).repartitionByRange(8, "conv_id", "turn", "digest", "row")
        .sortWithinPartitions("conv_id", "turn", "digest", "row")
    )
    assert parts.where("conv_id = 7").count() > 4
    got = result(repair.repair_conversations(frame))
    assert got == {conv: expected(ordered(rows, conv)) for conv in {r[0] for r in rows}}


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "So?"), (1, 2, "user", "So?"), (1, 3, "assistant", "Yes"), (2, 0, "user", "")]
    frame = spark.createDataFrame(rows, SCHEMA)
    plan = repair.repair_plan(frame)
    assert {r["conv_id"]: r["audit"] for r in plan.collect()} == {1: "IKKDK", 2: "D"}
    turns = [tuple(r) for r in repair.repaired_turns(frame, plan).orderBy("conv_id", "place").collect()]
    assert turns == [
        (1, 0, "I", None, "user", ""), (1, 1, "K", 0, "assistant", "Hi."), (1, 2, "K", 1, "user", "So?"),
        (1, 3, "K", 3, "assistant", "Yes"),
    ]


def test_no_rows_and_lost_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair_conversations(empty).count() == 0
    ids = spark.createDataFrame([(4,), (4,), (None,)], "conv_id bigint")
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert result(repair.repair_conversations(empty, ids)) == {4: none, None: none}


def test_damage(spark):
    rows = [(c, t, None if t == 1 else "assistant", None if t == 2 else "One. Two!") for c in range(40) for t in (None, 1, 2, 3)]
    want = []
    for c, t, role, text in rows:
        draw = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        own = (c, t, "user" if draw == 4 else role, "" if draw == 1 else text.replace(".", "").replace("!", "") if draw == 2 else text)
        want += [own] * (0 if draw == 0 else 2 if draw == 3 else 1)
    got = [tuple(r) for r in repair.damaged(spark.createDataFrame(rows, SCHEMA)).collect()]
    key = lambda r: (r[0], r[1] is not None, r[1] or 0)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_runs_equal_single_rows():
    draw = random.Random(3)
    for _ in range(200):
        runs = tuple((draw.randrange(9), draw.choice([1, 2, 3, 17])) for _ in range(draw.randrange(6)))
        single = tuple((s, 1) for s, n in runs for _ in range(n))
        assert repair.solve(runs) == repair.solve(single)
        matrix = repair.matrix_of(runs)
        assert repair._ahead(matrix, repair._END)[0] == repair.solve(runs)[0]
