"""Conversations brought back to ``(s?(ua)+)?`` at the least cost, with an audit of the edits.

The turns of a conversation, in order, are symbols: the role's initial and the row's fault. Equal symbols beside each
other are one run. Reading a row takes the four states of the wanted order (nothing yet, behind the system turn, behind
a user, behind an assistant) to one another at a cost, which is a 4 x 4 min-plus matrix; a run of n rows is the n-th
power of its matrix, put together from cached powers of two. The costs of what is still to come, worked out from the
end, then tell at each row which edits are among the cheapest, and the ASCII-least of them is taken.

Matrices can be multiplied in parts, so a conversation of any length is cut where Spark's range partitions cut it: its
parts give matrices, these give what each part still has before it, each part works out its edits for the four states
it may begin in, and the chain of states picks one. Almost all conversations lie whole in a partition and are done there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.tables import Workspace

KEEP, REROLE, DELETE, INSERT, OPEN_TURN = 0, 2, 3, 2, 1
BLANKS = " \t\n\x0b\x0c\r"
_SENTENCE_ENDS = (".", "!", "?")
#: Faults, in the order in which they count.
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Role initials by number; every other initial is one number more.
INITIALS = "sua"
_FAR = 1 << 40
_STATES = range(4)
#: What an inserted or renamed turn is in a state, and the state behind it.
_NEXT_ROLE = ("user", "user", "assistant", "user")
_NEXT_STATE = (2, 2, 3, 2)
_LEGAL = {(0, 1), (1, 2), (2, 1)}
#: Rows that are unrolled at once; longer runs are halved first.
_UNROLLED = 1024

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]
Runs = tuple[tuple[int, int], ...]


def symbol_of(initial: int, fault: int) -> int:
    """0 must go; others are told apart by role and by whether the turn is cut off."""
    return 0 if fault in (BLANK, DUPLICATE) else 1 + 2 * initial + (fault == TRUNCATED)


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in _STATES) for j in _STATES) for i in _STATES)


def _ahead(a: Matrix, v: Vector) -> Vector:
    """What is to be paid before ``a``, when ``v`` is to be paid behind it."""
    return tuple(min(a[i][k] + v[k] for k in _STATES) for i in _STATES)


_UNIT: Matrix = tuple(tuple(0 if i == j else _FAR for j in _STATES) for i in _STATES)
_ONE_MORE: Matrix = tuple(tuple(INSERT if j == _NEXT_STATE[i] else _FAR for j in _STATES) for i in _STATES)


def _either(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(x, y) for x, y in zip(p, q, strict=True)) for p, q in zip(a, b, strict=True))


#: Any number of insertions; more than two never pay.
_INSERTIONS = _either(_either(_UNIT, _ONE_MORE), _times(_ONE_MORE, _ONE_MORE))
#: Behind the last row: insertions up to a state in which the conversation may end.
_END: Vector = _ahead(_INSERTIONS, (0, _FAR, _FAR, 0))


def _kept_state(initial: int, state: int) -> int | None:
    """The state behind a turn that stays as it is, if it may stand there."""
    if initial == 0:
        return 1 if state == 0 else None
    if initial < len(INITIALS) and _NEXT_ROLE[state][0] == INITIALS[initial]:
        return _NEXT_STATE[state]
    return None


@lru_cache(None)
def _edits(symbol: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """``letter, cost, state behind it`` of the edits of one row, in ASCII order."""
    out = [("D", DELETE, state)]
    if symbol:
        initial, cut = divmod(symbol - 1, 2)
        kept = _kept_state(initial, state)
        if kept is not None:
            out.append(("K", KEEP + cut * OPEN_TURN, kept))
        out.append(("R", REROLE + cut * OPEN_TURN, _NEXT_STATE[state]))
    return tuple(out)


@lru_cache(None)
def _power(symbol: int, k: int) -> Matrix:
    """The matrix of ``2 ** k`` rows of one symbol, insertions before each of them included."""
    if k:
        half = _power(symbol, k - 1)
        return _times(half, half)
    row = [[_FAR] * 4 for _ in _STATES]
    for state in _STATES:
        for _, cost, behind in _edits(symbol, state):
            row[state][behind] = min(row[state][behind], cost)
    return _times(_INSERTIONS, tuple(map(tuple, row)))


def _before_run(symbol: int, rows: int, v: Vector) -> Vector:
    k = 0
    while rows:
        if rows & 1:
            v = _ahead(_power(symbol, k), v)
        rows, k = rows >> 1, k + 1
    return v


def matrix_of(runs: Runs) -> Matrix:
    out = _UNIT
    for symbol, rows in runs:
        k = 0
        while rows:
            if rows & 1:
                out = _times(out, _power(symbol, k))
            rows, k = rows >> 1, k + 1
    return out


def _unroll(symbol: int, rows: int, state: int, v: Vector, out: list[str]) -> int:
    """The edits of a run that begins in ``state`` and leaves ``v`` to be paid; returns the state behind it."""
    if rows > _UNROLLED:
        half = rows // 2
        state = _unroll(symbol, half, state, _before_run(symbol, rows - half, v), out)
        return _unroll(symbol, rows - half, state, v, out)
    behind = [v]
    for _ in range(rows):
        behind.append(_ahead(_power(symbol, 0), behind[-1]))
    for left in range(rows - 1, -1, -1):
        after, now = behind[left], behind[left + 1]
        while True:
            options = [(letter, to) for letter, cost, to in _edits(symbol, state) if cost + after[to] == now[state]]
            if INSERT + now[_NEXT_STATE[state]] == now[state] and (not options or options[0][0] > "I"):
                out.append("I")
                state = _NEXT_STATE[state]
                continue
            letter, state = options[0]
            out.append(letter)
            break
    return state


def unrolled(runs: Runs, state: int, v: Vector, last: bool) -> tuple[str, int]:
    """The audit of a part of a conversation and the state behind it; ``last`` adds the insertions that end it."""
    ahead = [v]
    for symbol, rows in reversed(runs):
        ahead.append(_before_run(symbol, rows, ahead[-1]))
    out: list[str] = []
    for (symbol, rows), after in zip(runs, reversed(ahead[:-1]), strict=True):
        state = _unroll(symbol, rows, state, after, out)
    if last:
        while _END[state]:
            out.append("I")
            state = _NEXT_STATE[state]
    return "".join(out), state


@lru_cache(1 << 16)
def _solved(runs: Runs) -> tuple[int, str]:
    v = _END
    for symbol, rows in reversed(runs):
        v = _before_run(symbol, rows, v)
    return v[0], unrolled(runs, 0, _END, True)[0]


def solve(runs: Runs) -> tuple[int, str]:
    """Least cost and audit of a whole conversation. Short ones come again and again and are remembered."""
    return _solved(runs) if len(runs) <= 16 else _solved.__wrapped__(runs)


# --- tables --------------------------------------------------------------------------

_PART = (
    "conv_id bigint, slot int, whole boolean, turns bigint, symbols array<int>, lengths array<bigint>, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_initial int, last_initial int, "
    "least_turn bigint, most_turn bigint, distinct_turns bigint, first_turn bigint, last_turn bigint, "
    "cost bigint, audit string, matrix array<bigint>"
)
_PART_TYPES = [
    ("conv_id", pa.int64()), ("slot", pa.int32()), ("whole", pa.bool_()), ("turns", pa.int64()),
    ("symbols", pa.list_(pa.int32())), ("lengths", pa.list_(pa.int64())), ("blank", pa.int64()), ("duplicate", pa.int64()),
    ("truncated", pa.int64()), ("illegal", pa.int64()), ("first_initial", pa.int32()), ("last_initial", pa.int32()),
    ("least_turn", pa.int64()), ("most_turn", pa.int64()), ("distinct_turns", pa.int64()), ("first_turn", pa.int64()),
    ("last_turn", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("matrix", pa.list_(pa.int64())),
]


def turns_of(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` only, so that no other column can clash; a null role or text is one space."""
    blank = F.lit(" ")
    return rows.select(
        F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role).cast("string"), blank).alias("role"), F.coalesce(F.col(text).cast("string"), blank).alias("text"),
    )


def _own_digest() -> Column:
    """Stands for a conversation's role and text; a null conversation is told from any number."""
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))
    return F.unhex(F.sha2(F.concat_ws(":", conv, F.length("role"), "role", "text"), 256))


def _narrow(turns: DataFrame) -> DataFrame:
    """What the edits depend on, without the texts: order, role, and faults that a row has by itself."""
    trimmed = F.rtrim("text", F.lit(BLANKS))
    place = F.array_position(F.array(*[F.lit(c) for c in INITIALS]), F.substring("role", 1, 1)).cast("int")
    return turns.select(
        "conv_id", "turn", _own_digest().alias("digest"), F.monotonically_increasing_id().alias("row"),
        F.when(place == 0, len(INITIALS)).otherwise(place - 1).alias("initial"),
        (trimmed == "").alias("blank"), (~F.right(trimmed, F.lit(1)).isin(*_SENTENCE_ENDS)).alias("cut"),
    )


def _with_faults(rows: DataFrame) -> DataFrame:
    """Adds ``fault``. Only contents that stand more than once are joined back, one row each."""
    again = (
        rows.groupBy("digest").agg(F.min(F.struct("turn", "row")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("digest", F.col("first.row").alias("first_row"))
    )
    fault = (
        F.when(F.col("blank"), BLANK).when(F.col("first_row") != F.col("row"), DUPLICATE)
        .when(F.col("cut"), TRUNCATED).otherwise(NONE)
    )
    return rows.join(again, "digest", "left").select("conv_id", "turn", "digest", "row", "initial", fault.alias("fault"))


class _Part:
    """One conversation's rows in one partition, as runs and counts."""

    def __init__(self, conv: int | None):
        self.conv, self.runs, self.turns = conv, [], 0
        self.faults = [0, 0, 0, 0]
        self.illegal = self.distinct = 0
        self.first_initial = self.last_initial = -1
        self.least = self.most = self.first_turn = self.last_turn = None

    def add(self, turn: int | None, initial: int, fault: int) -> None:
        symbol = symbol_of(initial, fault)
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1][1] += 1
        else:
            self.runs.append([symbol, 1])
        if self.turns == 0:
            self.first_initial, self.first_turn = initial, turn
        elif (self.last_initial, initial) not in _LEGAL:
            self.illegal += 1
        if turn is not None:
            # Turns come in order, nulls first.
            if self.least is None:
                self.least = turn
            self.distinct += turn != self.most
            self.most = turn
        self.faults[fault] += 1
        self.last_initial, self.last_turn = initial, turn
        self.turns += 1

    def row(self, slot: int, whole: bool) -> tuple:
        runs = tuple(map(tuple, self.runs))
        cost, audit = solve(runs) if whole else (None, None)
        matrix = None if whole else [x for line in matrix_of(runs) for x in line]
        symbols, lengths = ([], []) if whole else ([s for s, _ in runs], [n for _, n in runs])
        return (
            self.conv, slot, whole, self.turns, symbols, lengths, *self.faults[1:], self.illegal,
            self.first_initial, self.last_initial, self.least, self.most, self.distinct, self.first_turn, self.last_turn,
            cost, audit, matrix,
        )


def _batch(rows: list[tuple], types: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, types, strict=True)], [n for n, _ in types])


def _parts(ordered: DataFrame) -> DataFrame:
    """A row for each conversation and partition; ``whole`` if no other partition can hold any of its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, part, first, out = TaskContext.get().partitionId(), None, True, []
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("conv_id", "turn", "initial", "fault")]
            for conv, turn, initial, fault in zip(*columns, strict=True):
                if part is None or conv != part.conv:
                    if part is not None:
                        out.append(part.row(slot, not first))
                        first = False
                    part = _Part(conv)
                part.add(turn, initial, fault)
            if len(out) >= 4096:
                yield _batch(out, _PART_TYPES)
                out = []
        if part is not None:
            out.append(part.row(slot, False))
        if out:
            yield _batch(out, _PART_TYPES)

    return ordered.select("conv_id", "turn", "initial", "fault").mapInArrow(run, _PART)


def _aheads(parts):
    """What is to be paid behind each part, from the last to the first; a row per partition at most."""
    out, v, last = [], _END, True
    for part in reversed(parts):
        out.append((part["slot"], list(v), last))
        flat = part["matrix"]
        v, last = _ahead(tuple(tuple(flat[i * 4 : i * 4 + 4]) for i in _STATES), v), False
    return out


def _choices(symbols, lengths, ahead, last):
    """The part's audit and end for each state that it may begin in; null where no way leads on."""
    runs = tuple(zip(symbols, lengths, strict=True))
    v = tuple(ahead)
    for symbol, rows in reversed(runs):
        v = _before_run(symbol, rows, v)
    return [unrolled(runs, state, tuple(ahead), last) if v[state] < _FAR else None for state in _STATES]


def _starts(parts):
    out, state = [], 0
    for part in parts:
        out.append((part["slot"], state))
        state = part["ends"][state]
    return out


def _joined(edges: DataFrame, ws: Workspace) -> DataFrame:
    """``conv_id, cost, audit`` of the conversations that several partitions may share; few rows, two a partition."""
    aheads = F.udf(_aheads, "array<struct<slot:int,ahead:array<bigint>,last:boolean>>")
    choices = F.udf(_choices, "array<struct<audit:string,state:int>>")
    begin = F.udf(_starts, "array<struct<slot:int,state:int>>")
    chains = edges.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("slot", "matrix"))).alias("parts"))
    ahead = chains.select(F.col("conv_id").alias("_conv"), F.inline(aheads("parts"))).withColumnRenamed("slot", "_slot")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("slot") == F.col("_slot"))
    options = ws.stage(
        edges.join(ahead, same).select(
            "conv_id", "slot", "ahead", choices("symbols", "lengths", "ahead", "last").alias("choices"), "matrix"
        ),
        "options",
    )
    ends = F.transform("choices", lambda c: c["state"])
    chain = options.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("slot", ends.alias("ends")))).alias("parts"))
    starts = chain.select(F.col("conv_id").alias("_conv"), F.inline(begin("parts"))).withColumnRenamed("slot", "_slot")
    # The first part's matrix and what lies behind it give the cost of the whole.
    least = F.array_min(F.zip_with(F.slice("matrix", 1, 4), "ahead", lambda a, b: a + b))
    chosen = options.join(starts, same).select(
        "conv_id", "slot", least.alias("cost"), F.element_at("choices", F.col("state") + 1)["audit"].alias("audit")
    )
    return chosen.groupBy("conv_id").agg(
        F.min_by("cost", "slot").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("slot", "audit"))), lambda p: p["audit"]), "").alias("audit"),
    )


def _counts(parts: DataFrame) -> DataFrame:
    """Counts of the conversations that several partitions may share, with the pairs and turns where parts meet."""
    order = Window.partitionBy("conv_id").orderBy("slot")
    before, turn = F.lag("last_initial").over(order), F.lag("last_turn").over(order)
    legal = F.array(*[F.lit(10 * a + b) for a, b in sorted(_LEGAL)])
    met = parts.withColumns(
        {
            "_pair": F.when(before.isNotNull() & ~F.array_contains(legal, before * 10 + F.col("first_initial")), 1).otherwise(0),
            "_same": F.when(turn == F.col("first_turn"), 1).otherwise(0),
        }
    )
    return met.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.sum(F.col("illegal") + F.col("_pair")).alias("illegal"),
        _gaps(F.min("least_turn"), F.max("most_turn"), F.sum(F.col("distinct_turns") - F.col("_same"))).alias("gaps"),
    )


def _gaps(least: Column, most: Column, distinct: Column) -> Column:
    return F.coalesce(most - least + 1 - distinct, F.lit(0).cast("bigint"))


AUDIT_COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_plan(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.

    Turns are read in their order, nulls first, rows of one turn by a hash of their content. A null role or text is
    one space, a null conversation is one of its own; an empty table gives no rows. Rows that repeat a row of their
    conversation count as duplicates whatever their turn. A conversation may be of any length.
    """
    ws = Workspace(rows.sparkSession, "repair")
    return ws.finish(_plan(ws, rows, conv, turn, role, text))


def _plan(ws: Workspace, rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    narrow = ws.stage(_narrow(turns_of(rows, conv, turn, role, text)), "rows")
    keys = ("conv_id", "turn", "digest", "row")
    ordered = _with_faults(narrow).repartitionByRange(*keys).sortWithinPartitions(*keys)
    parts = ws.stage(_parts(ordered), "parts")
    done = parts.where("whole").select(
        "conv_id", _gaps(F.col("least_turn"), F.col("most_turn"), F.col("distinct_turns")).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit",
    )
    edges = ws.stage(parts.where("NOT whole"), "edges")
    counts, solved = _counts(edges), _joined(edges, ws)
    solved = solved.withColumnRenamed("conv_id", "_conv")
    shared = counts.join(solved, F.col("conv_id").eqNullSafe(F.col("_conv"))).select("conv_id", *AUDIT_COLUMNS, "audit")
    return done.unionByName(shared)


class _Repaired:
    """A conversation's audit, applied row by row."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def inserted(self) -> Iterator[str]:
        """Roles of the empty turns that come next."""
        while self.audit[self.at : self.at + 1] == "I":
            yield _NEXT_ROLE[self.state]
            self.at, self.state = self.at + 1, _NEXT_STATE[self.state]

    def row(self, role: str) -> tuple[str, str | None]:
        """The edit of the next row, and the role it goes on with; none if it goes."""
        letter = self.audit[self.at]
        self.at += 1
        if letter == "D":
            return letter, None
        if letter == "R":
            role = _NEXT_ROLE[self.state]
        self.state = 1 if letter == "K" and role[:1] == INITIALS[0] else _NEXT_STATE[self.state]
        return letter, role


def _with_texts(turns: DataFrame, plan: DataFrame) -> DataFrame:
    """Conversation by conversation: its plan first, then its rows in their order. Each text moves once."""
    carried = [c for c in plan.columns if c not in ("conv_id", "audit")]
    heads = plan.select("conv_id", F.lit(False).alias("is_turn"), "audit", *carried)
    own = turns.select("conv_id", F.lit(True).alias("is_turn"), "turn", _own_digest().alias("digest"), "role", "text")
    keys = ("conv_id", "is_turn", "turn", "digest")
    return heads.unionByName(own, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions(*keys)


def repaired_turns(
    rows: DataFrame, plan: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The repaired conversations: ``conv_id, place, edit, turn, role, text``, ``place`` from 0, inserted turns without a number.

    A conversation streams through one task, a batch of rows at a time, whatever its length.
    """
    types = [("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()),
             ("role", pa.string()), ("text", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id = plan_of = None
        place = 0
        out: list[tuple] = []

        def added() -> None:
            nonlocal place
            for name in plan_of.inserted():
                out.append((conv_id, place, "I", None, name, ""))
                place += 1

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "is_turn", "audit", "turn", "role", "text")]
            for own, is_turn, audit, number, name, content in zip(*columns, strict=True):
                if not is_turn:
                    if plan_of is not None:
                        added()
                    conv_id, plan_of, place = own, _Repaired(audit), 0
                    continue
                added()
                letter, new = plan_of.row(name)
                if new is not None:
                    out.append((conv_id, place, letter, number, new, content))
                    place += 1
            yield _batch(out, types)
            out = []
        if plan_of is not None:
            added()
            yield _batch(out, types)

    sorted_rows = _with_texts(turns_of(rows, conv, turn, role, text), plan.select("conv_id", "audit"))
    return sorted_rows.mapInArrow(run, "conv_id bigint, place bigint, edit string, turn bigint, role string, text string")


def with_digests(
    rows: DataFrame, plan: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``plan`` with ``repaired_sha256``: of the repaired turns as ``role:text``, newline-joined.

    Such a hash is a sequence, so a conversation's texts stream through one task, a batch at a time.
    """
    names = ["conv_id", *AUDIT_COLUMNS, "audit"]
    types = [(n, pa.string() if n == "audit" else pa.int64()) for n in names] + [("repaired_sha256", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = plan_of = total = None
        begun = False
        out: list[tuple] = []

        def put(turn_text: str) -> None:
            nonlocal begun
            total.update((("\n" if begun else "") + turn_text).encode("utf-8", "surrogatepass"))
            begun = True

        def ended() -> None:
            for name in plan_of.inserted():
                put(f"{name}:")
            out.append((*head, total.hexdigest()))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*names, "is_turn", "role", "text")]
            for *own, is_turn, name, content in zip(*columns, strict=True):
                if not is_turn:
                    if head is not None:
                        ended()
                    head, plan_of, total, begun = own, _Repaired(own[-1]), hashlib.sha256(), False
                    continue
                for added in plan_of.inserted():
                    put(f"{added}:")
                letter, new = plan_of.row(name)
                if new is not None:
                    put(f"{new}:{content}")
            if len(out) >= 4096:
                yield _batch(out, types)
                out = []
        if head is not None:
            ended()
            yield _batch(out, types)

    sorted_rows = _with_texts(turns_of(rows, conv, turn, role, text), plan.select(*names))
    schema = ", ".join(f"{n} {'string' if t == pa.string() else 'bigint'}" for n, t in types)
    return sorted_rows.mapInArrow(run, schema)


def damaged(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Rows broken on purpose, by crc32 of ``conv:turn`` mod 20: dropped, emptied, left without ends, repeated, or all ``user``."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    draw = F.col("_draw")
    broken = turns_of(rows, conv, turn, role, text).withColumn("_draw", F.crc32(name) % 20).where(draw != 0)
    return broken.select(
        "conv_id", "turn",
        F.when(draw == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(draw == 1, "").when(draw == 2, F.translate("text", "".join(_SENTENCE_ENDS), "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(draw == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def repair_conversations(
    rows: DataFrame, ids: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``repair_plan`` with digests; ``ids`` (``conv_id``) adds conversations of which no row is left: zeros, an empty audit."""
    ws = Workspace(rows.sparkSession, "repair")
    plan = ws.stage(_plan(ws, rows, conv, turn, role, text), "plan")
    if ids is not None:
        wanted = ids.select(F.col("conv_id").cast("bigint").alias("_wanted")).distinct()
        zero = {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in AUDIT_COLUMNS}
        plan = (
            wanted.join(plan, F.col("_wanted").eqNullSafe(F.col("conv_id")), "left")
            .withColumns({**zero, "audit": F.coalesce("audit", F.lit("")), "conv_id": F.col("_wanted")}).drop("_wanted")
        )
    return ws.finish(with_digests(rows, plan, conv, turn, role, text))
