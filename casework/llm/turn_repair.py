"""Repair of conversations whose roles don't alternate, by the cheapest edits.

Rows are sorted by conversation and turn over key ranges, and each task streams its
range: it carries the state of a dynamic program from one Arrow batch to the next and
keeps one small number per row to walk back. A conversation must get the role initials
``(s?(ua)+)?``. Rows are kept (K), given another role (R) or deleted (D), and empty
turns inserted (I); blank and repeated rows must be deleted. Of equally cheap edits the
ASCII-least string of initials counts.

The program has four states: nothing yet, after s, after u, after a. Given a state, each
edit leads to one next state, so a string of edits names its result. Per state the
cheapest, least string is carried as its cost and its rank among the four: no string
that ends in the same row is the beginning of another, so ranks settle all later ties.
Costs count from the cheapest state on, and a state that another beats by more than
any repair is dropped, which leaves few combinations; a step is looked up in a table of
those met, and the table's entry is the row's backpointer.

A conversation may be larger than a task. Ranges cut it between rows. The first and the
last conversation of a range are not finished there: their chunk is run from every state
it may begin in and gives, per begin and end, the cost and the rank. The chunks' tables,
at most two per task, are composed on the driver, which fixes the state between chunks,
and each chunk is then replayed alone from there. Rows and backpointers beyond ``HELD``
bytes go to a temporary file of the task, which nobody else reads. The digest of a
conversation in several pieces is taken in one task, piece by piece, as the hash is
defined in order.

Defined results: a null conversation is one of its own; a null turn stands first; null
role and text are one space; rows of equal turn are ordered by role and text, and equal
ones are merged with their number first, so copies cost no more to move than one row; a
role's initial decides, whatever follows; a conversation without rows has zeros, an empty
audit and the hash of the empty text; an empty table gives an empty one. Columns besides
``conv_id``, ``turn``, ``role`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.llm.common import key_columns, ship, stage

#: Bytes of rows, of backpointers or of a repaired text that a task holds before it spills or cuts.
HELD = 1 << 20
#: What a row is, as the stream sees it.
BLANK, REPEATED, WHOLE, CUT = range(4)
INITIALS = "sua"
#: States of the program; the roles it takes next and where an inserted or new role leads.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT_ROLE = ("user", "user", "assistant", "user")
STEP = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
CLOSING = ("", "II", "I", "")
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3
#: No repair from one of the states u or a costs this much more than from another state.
MARGIN = 10


# Damage and faults, as columns.


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage, with ``copies``: 0 stands for a conversation whose row was dropped."""
    place = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.crc32(place.cast("binary")) % 20).alias("_harm"),
    )
    harm, gone = F.col("_harm"), F.col("_harm") == 0
    return rows.select(
        "conv_id",
        F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone | (harm == 1), "")
        .when(harm == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.when(gone, 0).when(harm == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _kind(text: Column, later: Column) -> Column:
    finished = text.rlike(r"[.!?][\x20\x09-\x0D]*\z")
    return (
        F.when(~text.rlike(r"[^\x20\x09-\x0D]"), BLANK)
        .when(later, REPEATED)
        .otherwise(F.when(finished, WHOLE).otherwise(CUT))
    )


def faulty_rows(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn merged, with ``kind``, their first fault, and ``initial``.

    ``rows`` has conv_id, turn, role, text and copies. Of merged copies the first has the
    fault and the others are repeated.
    """
    merged = stage(
        rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")), "turn_rows"
    )
    said = merged.where("copies > 0").select(*key_columns("conv_id", "role", "text"), "turn")
    first = (
        said.groupBy("_k1", "_k2")
        .agg(F.min(F.struct(F.col("turn").isNotNull().alias("has"), "turn"))["turn"].alias("_first"), F.count("*").alias("_n"))
        .where("_n > 1")
    )
    joined = merged.select("*", *key_columns("conv_id", "role", "text")).join(first, ["_k1", "_k2"], "left")
    later = F.col("_n").isNotNull() & ~F.col("_first").eqNullSafe(F.col("turn"))
    initial = F.substring("role", 1, 1)
    return joined.select(
        "conv_id",
        "turn",
        "role",
        "text",
        "copies",
        _kind(F.col("text"), later).cast("int").alias("kind"),
        (F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)).cast("int").alias("initial"),
    )


# The dynamic program.


Ranked = tuple[tuple[int, int] | None, ...]


def _moves(state: int, kind: int, initial: int) -> Iterator[tuple[int, int, str]]:
    """Edits that use up a row: next state, cost, initials. Insertions after it belong to later rows.

    Deleting before inserting is as cheap and ASCII-less than after it.
    """
    yield state, DELETE, "D"
    if kind in (BLANK, REPEATED):
        return
    late = UNFINISHED if kind == CUT else 0
    for inserted in range(3):
        spent, written = INSERT * inserted + late, "I" * inserted
        wanted = "a" if state == AFTER_U else "u"
        if INITIALS[initial : initial + 1] == wanted:
            yield STEP[state], spent + KEEP, written + "K"
        elif initial == 0 and state == START:
            yield AFTER_S, spent + KEEP, written + "K"
        yield STEP[state], spent + REROLE, written + "R"
        state = STEP[state]


class Automaton:
    """The steps met so far: from a combination of states by a row's class to the next one."""

    def __init__(self) -> None:
        self.combinations: dict[Ranked, int] = {}
        self.values: list[Ranked] = []
        self.steps: dict[int, int] = {}
        #: Per step: next combination, what the cheapest cost grew by, per state (state before, initials).
        self.after: list[tuple[int, int, tuple]] = []

    def number(self, values: Ranked) -> int:
        if values not in self.combinations:
            self.combinations[values] = len(self.values)
            self.values.append(values)
        return self.combinations[values]

    def begin(self, state: int) -> int:
        return self.number(tuple((0, 0) if s == state else None for s in range(4)))

    def step(self, combination: int, kind: int, initial: int) -> int:
        key = combination * 16 + kind * 4 + initial
        if key not in self.steps:
            self.steps[key] = len(self.after)
            self.after.append(self._step(self.values[combination], kind, initial))
        return self.steps[key]

    def _step(self, values: Ranked, kind: int, initial: int) -> tuple[int, int, tuple]:
        best: dict[int, tuple[int, int, str, int]] = {}
        for state, value in enumerate(values):
            if value is None:
                continue
            for to, cost, edits in _moves(state, kind, initial):
                found = (value[0] + cost, value[1], edits, state)
                if to not in best or found < best[to]:
                    best[to] = found
        bound = min((best[s][0] for s in (AFTER_U, AFTER_A) if s in best), default=1 << 60) + MARGIN
        best = {s: b for s, b in best.items() if b[0] <= bound}
        least = min(b[0] for b in best.values())
        order = sorted(best, key=lambda s: best[s][1:3])
        after = tuple((best[s][0] - least, order.index(s)) if s in best else None for s in range(4))
        back = tuple((best[s][3], best[s][2]) if s in best else None for s in range(4))
        return self.number(after), least, back


def compose(before: list[tuple[int, int] | None], table: list[list[tuple[int, int] | None]]):
    """Costs and ranks per state after a chunk, and per state the one it came from."""
    best: dict[int, tuple[int, int, int, int]] = {}
    for state, value in enumerate(before):
        for to, part in enumerate(table[state] if value is not None else ()):
            if part is not None:
                found = (value[0] + part[0], value[1], part[1], state)
                if to not in best or found < best[to]:
                    best[to] = found
    order = sorted(best, key=lambda s: best[s][1:3])
    return [(best[s][0], order.index(s)) if s in best else None for s in range(4)], {s: best[s][3] for s in best}


def close(values: Iterable[tuple[int, int] | None]) -> tuple[int, int]:
    """Least cost with the closing insertions, and the state they begin in."""
    found = min(
        (v[0] + INSERT * len(CLOSING[s]), v[1], s) for s, v in enumerate(values) if v is not None
    )
    return found[0], found[2]


# What a task holds of a conversation.


class Numbers:
    """Numbers in order of arrival, read back from the last one; full blocks go to a file of the task."""

    BLOCK = HELD // 4

    def __init__(self) -> None:
        self.last, self.file, self.blocks = array("I"), None, 0

    def push(self, number: int) -> None:
        self.last.append(number)
        if len(self.last) == self.BLOCK:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(self.blocks * self.BLOCK * 4)
            self.file.write(self.last.tobytes())
            self.blocks += 1
            self.last = array("I")

    def backwards(self) -> Iterator[int]:
        yield from reversed(self.last)
        for block in range(self.blocks - 1, -1, -1):
            self.file.seek(block * self.BLOCK * 4)
            held = array("I")
            held.frombytes(self.file.read(self.BLOCK * 4))
            yield from reversed(held)


class Rows:
    """Rows in order of arrival, in a file of the task beyond HELD bytes."""

    def __init__(self) -> None:
        self.held, self.size, self.file = [], 0, None

    def push(self, row: tuple) -> None:
        self.held.append(row)
        self.size += len(row[3]) + 64
        if self.size > HELD:
            self.file = self.file or tempfile.TemporaryFile()
            pickle.dump(self.held, self.file, protocol=5)
            self.held, self.size = [], 0

    def __iter__(self) -> Iterator[tuple]:
        if self.file:
            self.file.seek(0)
            end = self.file.seek(0, 2)
            self.file.seek(0)
            while self.file.tell() < end:
                yield from pickle.load(self.file)
        yield from self.held


def edited(edits: Iterable[str], rows: Iterable[tuple], state: int, closing: str = "") -> Iterator[tuple[str, list[str]]]:
    """Initials and repaired lines of each row's edits, then of the closing insertions.

    ``rows`` has the role and the text, once for each edit that uses up a row.
    """
    for initials, (role, text) in zip(edits, rows, strict=True):
        lines = []
        for initial in initials:
            if initial == "K":
                lines.append(f"{role}:{text}")
                state = AFTER_S if state == START and role[:1] == "s" else STEP[state]
            elif initial == "R":
                lines.append(f"{NEXT_ROLE[state]}:{text}")
                state = STEP[state]
            elif initial == "I":
                lines.append(f"{NEXT_ROLE[state]}:")
                state = STEP[state]
        yield initials, lines
    lines = []
    for _ in closing:
        lines.append(f"{NEXT_ROLE[state]}:")
        state = STEP[state]
    yield closing, lines


def pieces(changes: Iterable[tuple[str, list[str]]]) -> Iterator[tuple[str, str | None]]:
    """Audit and repaired text in pieces of about HELD bytes; a piece without a line has no text."""
    audit, lines, size = [], [], 0
    for initials, new in changes:
        audit.append(initials)
        lines += new
        size += sum(map(len, new)) + 1
        if size > HELD:
            yield "".join(audit), "\n".join(lines) if lines else None
            audit, lines, size = [], [], 0
    yield "".join(audit), "\n".join(lines) if lines else None


@dataclass
class Tally:
    """What is counted of a run of rows; runs of one conversation add up in order."""

    rows: int = 0
    blank: int = 0
    repeated: int = 0
    cut: int = 0
    illegal: int = 0
    turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    first: int | None = None
    last: int | None = None

    def add(self, other: Tally) -> None:
        if not other.rows:
            return
        if self.rows:
            self.illegal += (self.last, other.first) not in LEGAL
        else:
            self.first = other.first
        if other.turns:
            self.turns += other.turns - (self.turns > 0 and self.last_turn == other.first_turn)
            self.first_turn = other.first_turn if self.first_turn is None else self.first_turn
            self.last_turn = other.last_turn
        for name in ("rows", "blank", "repeated", "cut", "illegal"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        self.last = other.last

    def row(self, turn: int | None, kind: int, initial: int, copies: int) -> None:
        if not copies:
            return
        again = copies - 1
        if self.rows:
            self.illegal += (self.last, initial) not in LEGAL
        else:
            self.first = initial
        self.illegal += again * ((initial, initial) not in LEGAL)
        self.rows += copies
        self.blank += copies * (kind == BLANK)
        self.repeated += copies * (kind == REPEATED) + again * (kind in (WHOLE, CUT))
        self.cut += kind == CUT
        self.last = initial
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    @property
    def counts(self) -> tuple[int, ...]:
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return gaps, self.blank, self.repeated, self.cut, self.illegal


#: Pairs of role initials that may follow each other: su, ua, au.
LEGAL = {(0, 1), (1, 2), (2, 1)}


class Conversation:
    """A conversation, or a chunk of one, as it streams by."""

    def __init__(self, conv, automaton: Automaton, begins: tuple[int, ...]) -> None:
        self.conv, self.automaton = conv, automaton
        self.begins = begins
        self.now = [automaton.begin(s) for s in begins]
        self.cost = [0] * len(begins)
        self.rows, self.back, self.tally = Rows(), Numbers(), Tally()

    def row(self, turn, role: str, kind: int, text: str, copies: int, initial: int) -> None:
        self.tally.row(turn, kind, initial, copies)
        self.rows.push((turn, role, kind, text, copies, initial))
        for copy in range(copies):
            shown = kind if not copy else REPEATED
            for i, now in enumerate(self.now):
                step = self.automaton.step(now, shown, initial)
                self.now[i], grown, _ = self.automaton.after[step]
                self.cost[i] += grown
                if not i:
                    self.back.push(step)

    def table(self) -> list[list[tuple[int, int] | None]]:
        """Per state it may begin in and end in: cost and rank."""
        out: list[list] = [[None] * 4 for _ in range(4)]
        for state, now, cost in zip(self.begins, self.now, self.cost, strict=True):
            out[state] = [v and (v[0] + cost, v[1]) for v in self.automaton.values[now]]
        return out

    def changes(self, end: int, closing: str) -> Iterator[tuple[str, list[str]]]:
        """Edits from the first state it may begin in to ``end``, walked back and read forwards."""
        taken, state, known, numbers = Numbers(), end, [], {}
        for step in self.back.backwards():
            state, edits = self.automaton.after[step][2][state]
            if edits not in numbers:
                numbers[edits] = len(known)
                known.append(edits)
            taken.push(numbers[edits])
        edits = (known[n] for n in taken.backwards())
        lines = ((role, text) for _, role, _, text, copies, _ in self.rows for _ in range(copies))
        return edited(edits, lines, self.begins[0], closing)


# The stream.


#: Rows that the first pass returns.
DONE, GIANT, PIECE, CHUNK, ROW = range(5)
STREAM = [
    ("tag", pa.int32()),
    ("conv_id", None),
    ("part", pa.int32()),
    ("place", pa.int64()),
    *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
    ("audit", pa.string()),
    ("text", pa.string()),
    ("chunk", pa.binary()),
    *((c, t) for c, t in (("turn", pa.int64()), ("role", pa.string()), ("kind", pa.int32()), ("copies", pa.int64()), ("initial", pa.int32()))),
]
NAMES = [n for n, _ in STREAM]
REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _stream_schema(kind: str) -> str:
    sql = {pa.int32(): "int", pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(f"{n} {kind if t is None else sql[t]}" for n, t in STREAM)


class Out:
    """Rows to return, in batches of bounded size."""

    def __init__(self, conv_type: pa.DataType) -> None:
        self.types = [conv_type if t is None else t for _, t in STREAM]
        self.rows: list[tuple] = []
        self.size = 0

    def put(self, **values) -> None:
        self.rows.append(tuple(values.get(n) for n in NAMES))
        self.size += 200 + len(values.get("text") or "") + len(values.get("audit") or "")

    def batches(self, least: int = 2 * HELD) -> Iterator[pa.RecordBatch]:
        if self.rows and self.size >= least:
            columns = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, self.types, strict=True)], names=NAMES)
            self.rows, self.size = [], 0


def _finish(out: Out, told: Conversation, part: int) -> Iterator[pa.RecordBatch]:
    """Return a conversation that begins and ends in this task."""
    end_cost, end = close(told.table()[START])
    report = dict(zip(REPORT, (*told.tally.counts, end_cost), strict=True))
    found = pieces(told.changes(end, CLOSING[end]))
    audit, text = next(found)
    following = next(found, None)
    if following is None:
        out.put(tag=DONE, conv_id=told.conv, part=part, place=0, audit=audit, text=text or "", **report)
        return
    out.put(tag=GIANT, conv_id=told.conv, part=part, **report)
    place = 0
    while True:
        out.put(tag=PIECE, conv_id=told.conv, part=part, place=place, audit=audit, text=text)
        yield from out.batches()
        if following is None:
            return
        (audit, text), following, place = following, next(found, None), place + 1


def _hand_on(out: Out, told: Conversation, part: int) -> Iterator[pa.RecordBatch]:
    """Return a chunk of a conversation that may go on in another task: its table and its rows."""
    out.put(tag=CHUNK, conv_id=told.conv, part=part, chunk=pickle.dumps((told.table(), told.tally)))
    for place, (turn, role, kind, text, copies, initial) in enumerate(told.rows):
        out.put(tag=ROW, conv_id=told.conv, part=part, place=place, turn=turn, role=role, kind=kind, text=text, copies=copies, initial=initial)
        yield from out.batches()


def _streamed(sorted_rows: DataFrame) -> DataFrame:
    """First pass over rows sorted by conversation and turn within key ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, automaton = TaskContext.get().partitionId(), Automaton()
        told, first, out = None, True, None
        for batch in batches:
            out = out or Out(batch.schema.field(0).type)
            for conv, turn, role, text, copies, kind, initial in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if told is None or conv != told.conv:
                    if told is not None:
                        yield from (_hand_on if first else _finish)(out, told, part)
                        yield from out.batches()
                        first = False
                    told = Conversation(conv, automaton, (0, 1, 2, 3) if told is None else (START,))
                told.row(turn, role, kind, text, copies, initial)
        if told is not None:
            yield from _hand_on(out, told, part)
            yield from out.batches(0)

    kind = dict(sorted_rows.dtypes)["conv_id"]
    return sorted_rows.mapInArrow(run, _stream_schema(kind))


def _settled(chunks: DataFrame) -> tuple[list[tuple], list[tuple]]:
    """Compose the chunks: (conversation, counts, cost) and (part, conversation, begin, end, closing)."""
    by_conv: dict = {}
    for part, conv, chunk in sorted(chunks.select("part", "conv_id", "chunk").collect(), key=lambda r: r.part):
        by_conv.setdefault(conv, []).append((part, *pickle.loads(chunk)))
    reports, replays = [], []
    for conv, parts in by_conv.items():
        values, came, total = [(0, 0), None, None, None], [], Tally()
        for _, table, tally in parts:
            values, origin = compose(values, table)
            came.append(origin)
            total.add(tally)
        cost, end = close(values)
        reports.append((conv, *total.counts, cost))
        closing = CLOSING[end]
        for (part, _, _), origin in zip(reversed(parts), reversed(came), strict=True):
            replays.append((part, conv, origin[end], end, closing))
            end, closing = origin[end], ""
    return reports, replays


def _replayed(rows: DataFrame) -> DataFrame:
    """Second pass: pieces of the chunks, each from its begin to its end, sorted by chunk and place."""
    kind = dict(rows.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, told, key, out = Automaton(), None, None, None

        def finish() -> Iterator[pa.RecordBatch]:
            for place, (audit, text) in enumerate(pieces(told.changes(key[3], key[4]))):
                out.put(tag=PIECE, conv_id=key[1], part=key[0], place=place, audit=audit, text=text)
                yield from out.batches()

        for batch in batches:
            out = out or Out(batch.schema.field(1).type)
            for *mine, turn, role, text, copies, kind, initial in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if mine != key:
                    if told is not None:
                        yield from finish()
                    key, told = mine, Conversation(mine[1], automaton, (mine[2],))
                told.row(turn, role, kind, text, copies, initial)
        if told is not None:
            yield from finish()
            yield from out.batches(0)

    order = ["part", "conv_id", "place"]
    dealt = rows.repartition("part", "conv_id").sortWithinPartitions(*order)
    columns = ["part", "conv_id", "begin", "end", "closing", "turn", "role", "text", "copies", "kind", "initial"]
    return dealt.select(*columns).mapInArrow(run, _stream_schema(kind))


def _passes(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of the first pass, reports of the conversations that span tasks, and their pieces."""
    spark = conversations.sparkSession
    ship(spark)
    rows = faulty_rows(damaged(conversations))
    # The first characters of a text are enough to part a turn with very many rows.
    dealt = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32))
    in_order = dealt.sortWithinPartitions("conv_id", "turn", "role", "text")
    passed = stage(
        _streamed(in_order.select("conv_id", "turn", "role", "text", "copies", "kind", "initial")), "turn_stream"
    )
    reports, replays = _settled(passed.where(F.col("tag") == CHUNK))
    kind = dict(passed.dtypes)["conv_id"]
    counts = ", ".join(f"{c} long" for c in REPORT)
    settled = spark.createDataFrame(reports, f"conv_id {kind}, {counts}")
    fixed = spark.createDataFrame(replays, f"part int, _conv {kind}, begin int, end int, closing string")
    open_rows = passed.where(F.col("tag") == ROW).join(fixed, "part").where(F.col("conv_id").eqNullSafe(F.col("_conv")))
    return passed, settled, stage(_replayed(open_rows), "turn_replay")


def repaired(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The repaired conversations: a report per conversation, and its repaired text.

    The report has conv_id, gaps, blank, duplicate, truncated, illegal, cost. The second
    frame has conv_id, part, place, audit and text; a conversation of several rows is read
    in the order of part and place, and a null text is no line at all.
    """
    passed, settled, replayed = _passes(conversations)
    shown = ["conv_id", "part", "place", "audit", "text"]
    texts = passed.where(F.col("tag").isin(DONE, PIECE)).select(*shown).union(replayed.select(*shown))
    return passed.where(F.col("tag").isin(DONE, GIANT)).select("conv_id", *REPORT).union(settled), texts


def _digests(texts: DataFrame) -> DataFrame:
    """Audit and digest of conversations in several pieces, read in order."""
    kind = dict(texts.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, digest, lines, out, began = None, [], None, False, [], False

        def end() -> None:
            out.append((conv, "".join(audit), digest.hexdigest()))

        for batch in batches:
            conv_type = batch.schema.field(0).type
            for mine, more, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not began or mine != conv:
                    if began:
                        end()
                    conv, audit, digest, lines, began = mine, [], hashlib.sha256(), False, True
                audit.append(more)
                if text is not None:
                    digest.update(("\n" if lines else "").encode() + text.encode())
                    lines = True
        if began:
            end()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (conv_type, pa.string(), pa.string()), strict=True)],
                names=["conv_id", "audit", "repaired_sha256"],
            )

    dealt = texts.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    return dealt.select("conv_id", "audit", "text").mapInArrow(run, f"conv_id {kind}, audit string, repaired_sha256 string")


def repair_report(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its report, audit and the digest of its repaired text."""
    passed, settled, replayed = _passes(conversations)
    done = passed.where(F.col("tag") == DONE).select(
        "conv_id", *REPORT, "audit", F.sha2("text", 256).alias("repaired_sha256")
    )
    shown = ["conv_id", "part", "place", "audit", "text"]
    several = passed.where(F.col("tag") == PIECE).select(*shown).union(replayed.select(*shown))
    reports = passed.where(F.col("tag") == GIANT).select("conv_id", *REPORT).union(settled)
    ends = _digests(several).withColumnRenamed("conv_id", "_conv")
    joined = reports.join(ends, F.col("conv_id").eqNullSafe(F.col("_conv")))
    return done.union(joined.select(*done.columns))
