"""Repair of the turn structure of conversations by iterative-deepening A*.

A conversation is well formed when the initials of its roles read
``(s?(ua)+)?``: an optional system turn, then user and assistant in turn. Edits:
Keep a row (free), Rerole it to user or assistant (2), Delete it (3; blank and
repeated rows must go), Insert an empty user or assistant turn (2); a truncated
row that stays costs 1 more. The cheapest edits are searched depth first, in the
ASCII order of their initials (D, I, K, R), under a bound on cost plus an
admissible estimate of the rest; the bound rises to the least value that passed
it until a path is accepted, so the first accepted path is the ASCII-least of the
cheapest. States that failed are remembered with the budget they failed under.

A state is the place in the conversation and what may follow (nothing yet, after
system, after user, after assistant). A conversation longer than ``SEGMENT`` rows
is searched segment by segment from its end: each segment from each of the four
states, with the cheapest completion of the next segments as its exit cost. That
is exact, also for ties, since a segment's path ends with the edit of its last
row, so none is the beginning of another.

Rows are shuffled once, by conversation. Every conversation passes its task twice
in order: first a byte a row for the search, then the texts for the repaired rows
and their digest, so a task holds some bytes a row and never the texts of a
conversation. One conversation stays one task, as its digest is read in order.

Defined results: null roles and texts are one space, in the key of the damage too
null ids and turns; a null conversation id is one conversation; rows equal in
turn stand by role, fault and text; roles are told by their first character, a role
without one fits nowhere; a conversation without rows needs no edits; an empty
table gives an empty result. Other columns are left out.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import batch_column
from tessera.session import ship_package

KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
SEGMENT = 32
START, SYSTEM, USER, ASSISTANT = range(4)
TURN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}    # the state after one more turn
TAIL = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}
FAULTS = {"none": 0, "truncated": 1, "blank": 2, "duplicate": 3}
INITIALS = {"u": 1, "a": 2, "s": 3}
NAMES = {USER: "user", ASSISTANT: "assistant"}
BLANK = r"\A[\x20\x09-\x0D]*\z"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"


def spaced(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, dropped): the rows damaged by crc32(conv_id:turn)
    mod 20. 0 marks the row dropped, 1 empties its text, 2 takes out ``.!?``, 3
    repeats the row, 4 makes it the user's."""
    t = turns.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                     F.col(f"`{role_col}`").alias("role"), F.col(f"`{text_col}`").alias("text"))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    t = t.withColumn("role", spaced("role")).withColumn("text", spaced("text")).withColumn("kind", kind)
    t = t.withColumn("role", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")))
    t = t.withColumn("text", F.when(F.col("kind") == 1, F.lit("")).when(
        F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    t = t.withColumn("again", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1)))
                                        .otherwise(F.array(F.lit(0)))))
    return t.select("conv_id", "turn", "role", "text", (F.col("kind") == 0).alias("dropped"))


def search(rows, state: int, leave: dict[int, int]) -> tuple[int, str, int]:
    """(cost, audit, state after it) of the cheapest edits of ``rows``, the
    ASCII-least of them. A row is (initial, must go, truncated); ``leave`` is the
    cost of what follows by the state it starts in."""
    n = len(rows)
    if n == 0:
        return leave[state], "", state
    least = min(leave.values())
    rest = [least] * (n + 1)                  # never more than the true cost of what is left
    for i in range(n - 1, -1, -1):
        initial, must, cut = rows[i]
        rest[i] = rest[i + 1] + (DELETE if must else min(DELETE, cut * CUT + (KEEP if initial else REROLE)))

    def edits(i, q):
        """(initial of the edit, cost, next row, next state), in ASCII order."""
        out = []
        if i < n:
            out.append(("D", DELETE, i + 1, q))
        if i < n:
            out.append(("I", INSERT, i, TURN[q]))
            initial, must, cut = rows[i]
            if not must:
                if (initial == 3 and q == START) or initial == TURN[q] - 1:
                    out.append(("K", KEEP + cut * CUT, i + 1, SYSTEM if initial == 3 else TURN[q]))
                if initial != TURN[q] - 1:
                    out.append(("R", REROLE + cut * CUT, i + 1, TURN[q]))
        return out

    bound = rest[0]
    while True:
        failed: dict[tuple[int, int], int] = {}
        beyond = None
        path: list = []
        stack = [(0, state, 0, iter(edits(0, state)))]

        def on_path(i, q):
            """True if inserts alone led back to a state: cost for nothing."""
            return any(s[1] == q for s in stack[-3:] if s[0] == i)

        while stack:
            i, q, spent, todo = stack[-1]
            step = next(todo, None)
            if step is None:
                failed[i, q] = max(bound - spent, failed.get((i, q), -1))
                stack.pop()
                if path:
                    path.pop()
                continue
            mark, cost, j, r = step
            g = spent + cost
            f = g + (leave[r] if j == n else rest[j])
            if f > bound:
                beyond = f if beyond is None else min(beyond, f)
            elif j == n:
                return g + leave[r], "".join(path) + mark, r
            elif failed.get((j, r), -1) < bound - g and not (mark == "I" and on_path(j, r)):
                path.append(mark)
                stack.append((j, r, g, iter(edits(j, r))))
        bound = beyond


def unpack(codes) -> list:
    """Rows of the search from their bytes: initial + 4 * fault."""
    return [(c & 3, c >> 2 >= 2, int(c >> 2 == 1)) for c in codes]


def cheapest(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    leave = {q: c for q, (c, _) in TAIL.items()}
    starts = list(range(0, len(codes), SEGMENT))
    plans = []
    for a in reversed(starts):
        rows = unpack(codes[a:a + SEGMENT])
        plan = {q: search(rows, q, leave) for q in ((START,) if a == 0 else TURN)}
        plans.append(plan)
        leave = {q: p[0] for q, p in plan.items()}
    state, audit = START, []
    for plan in reversed(plans):
        _, part, state = plan[state]
        audit.append(part)
    return leave[START], "".join(audit) + TAIL[state][1]


class Repairer:
    """Applies an audit to the rows of a conversation, given in order."""

    def __init__(self, audit: str):
        self.marks, self.at, self.state = audit, 0, START

    def inserted(self):
        while self.at < len(self.marks) and self.marks[self.at] == "I":
            self.at += 1
            self.state = TURN[self.state]
            yield "I", NAMES[self.state], ""

    def row(self, role: str, text: str):
        yield from self.inserted()
        mark = self.marks[self.at]
        self.at += 1
        if mark != "D":
            self.state = SYSTEM if mark == "K" and role[:1] == "s" else TURN[self.state]
            yield mark, (role if mark == "K" else NAMES[self.state]), text


def prepared(rows: DataFrame) -> DataFrame:
    """(conv_id, pass, turn, role, text, code): each conversation twice, sorted;
    in pass 0 with a code a row and no texts, in pass 1 with them."""
    text = F.col("text")
    first = Window.partitionBy("conv_id", "dropped", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    fault = (F.when(text.rlike(BLANK), FAULTS["blank"]).when(F.row_number().over(first) > 1, FAULTS["duplicate"])
             .when(~text.rlike(ENDED), FAULTS["truncated"]).otherwise(FAULTS["none"]))
    initial = F.lit(0)
    for k, v in INITIALS.items():
        initial = F.when(F.col("role").startswith(k), v).otherwise(initial)
    out = rows.select("conv_id", "turn", "role", "text", "dropped").repartition("conv_id")
    out = out.withColumn("code", F.when(F.col("dropped"), -1).otherwise(initial + 4 * fault))
    light = F.struct(F.lit(0).alias("pass"), F.lit(None).cast("string").alias("body"))
    full = F.struct(F.lit(1).alias("pass"), F.when(~F.col("dropped"), text).alias("body"))
    out = out.withColumn("of", F.explode(F.array(light, full)))
    out = out.select("conv_id", F.col("of.pass").alias("pass"), "turn", "role", F.col("of.body").alias("body"), "code")
    return out.sortWithinPartitions("conv_id", "pass", F.col("turn").asc_nulls_first(), "role", "code", "body")


def _conversations(batches):
    """Stream sorted rows as (conv_id, is new, pass, turn, role, body, code)."""
    last = object()
    for b in batches:
        cols = [batch_column(b, c).to_pylist() for c in ("conv_id", "pass", "turn", "role", "body", "code")]
        for conv, which, turn, role, body, code in zip(*cols):
            yield conv, conv != last, which, turn, role, body, code
            last = conv


class _State:
    """What is kept of the conversation that passes."""

    def __init__(self, conv):
        self.conv, self.codes, self.illegal, self.before = conv, bytearray(), 0, None
        self.low = self.high = self.seen = None
        self.distinct, self.repair, self.audit, self.cost = 0, None, "", 0
        self.hash, self.any = hashlib.sha256(), False

    def note(self, turn, role, code):
        if code < 0:
            return
        self.codes.append(code)
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.distinct += turn != self.high
            self.high = turn

    def solve(self):
        if self.repair is None:
            self.cost, self.audit = cheapest(bytes(self.codes))
            self.repair = Repairer(self.audit)

    def add(self, rows):
        for _, role, text in rows:
            self.hash.update((("\n" if self.any else "") + f"{role}:{text}").encode())
            self.any = True

    def result(self):
        self.solve()
        self.add(self.repair.inserted())
        faults = [c >> 2 for c in self.codes]
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (self.conv, gaps, faults.count(2), faults.count(3), faults.count(1), self.illegal, self.cost,
                self.audit, self.hash.hexdigest())


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``damage``: gaps, faults, cost, audit and the
    digest of the repaired rows."""
    ship_package(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    schema = f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, " \
             "audit string, repaired_sha256 string"

    def run(batches):
        def flush(done):
            return pa.RecordBatch.from_pydict(
                dict(zip(names, map(list, zip(*done)))),
                schema=pa.schema([(n, id_type[0] if n == "conv_id" else
                                   pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in names]))

        id_type: list = []

        def typed():
            for b in batches:
                id_type[:] = [b.schema.field("conv_id").type]
                yield b

        now, done, size = None, [], 0
        for conv, new, which, turn, role, body, code in _conversations(typed()):
            if new:
                if now is not None:
                    done.append(now.result())
                    size += len(done[-1][7])
                    if len(done) >= 5000 or size > 1 << 24:
                        yield flush(done)
                        done, size = [], 0
                now = _State(conv)
            if which == 0:
                now.note(turn, role, code)
            elif code >= 0:
                now.solve()
                now.add(now.repair.row(role, body))
        if now is not None:
            done.append(now.result())
            yield flush(done)

    return prepared(rows).mapInArrow(run, schema)


def repaired_rows(rows: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, place from 0, edit K, R or I, role, text)."""
    ship_package(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        names = ["conv_id", "place", "edit", "role", "text"]
        out, size, id_type, now, place = [], 0, None, None, 0

        def flush(done):
            types = [id_type, pa.int64(), pa.string(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*done), types)], names=names)

        def put(edited):
            nonlocal place, size
            for mark, role, text in edited:
                out.append((now.conv, place, mark, role, text))
                place += 1
                size += len(text)

        def typed():
            nonlocal id_type
            for b in batches:
                id_type = b.schema.field("conv_id").type
                yield b

        for conv, new, which, turn, role, body, code in _conversations(typed()):
            if new:
                if now is not None:
                    now.solve()
                    put(now.repair.inserted())
                now, place = _State(conv), 0
            if which == 0:
                now.note(turn, role, code)
            elif code >= 0:
                now.solve()
                put(now.repair.row(role, body))
            if len(out) >= 5000 or size > 1 << 24:
                yield flush(out)
                out, size = [], 0
        if now is not None:
            now.solve()
            put(now.repair.inserted())
        if out:
            yield flush(out)

    return prepared(rows).mapInArrow(
        run, f"conv_id {kind}, place long, edit string, role string, text string")
