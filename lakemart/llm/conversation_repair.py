"""Conversations mended into ``(s?(ua)+)?`` at the least cost, streamed with constant memory.

A finite automaton over role initials says what may follow: an optional system
turn, then pairs of user and assistant. Keeping a row is free, changing its
role to user or assistant costs 3, deleting it 4, inserting an empty user or
assistant turn 3; a truncated row that stays costs 3 more; blank and repeated
rows must go. Of the cheapest edits the one whose initials (``D I K R``, in
order) are ASCII-least is taken.

Rows are shuffled once, by conversation. Sorted from the last turn to the first
they stream through a task that carries the cost-to-go of the automaton's four
states across Arrow batches and writes one byte for each row: for each state,
in two bits, the least edit that a cheapest repair can take there. Spark sorts
the rows back, spilling as it must, and a second stream walks the bytes from
the first turn on. So neither a task nor a row ever holds a conversation, however
long. Its edits are a chain, so one conversation is one task's work. The edits
determine the result: each state admits one role of user and assistant, and
the parity of the result's length tells whether it starts with a system turn.

Defined cases: a null role or text is one space (so such a text is blank); an
empty role, like any that starts otherwise, fits nowhere and is changed or deleted;
a null conversation id is a conversation of its own; null turns come first;
turns that tie are ordered by role and text; repeated rows are repeats of the
first; conversations whose rows are all absent (``present``) come out as one
row without an edit; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where the one role of user and assistant that a state admits leads, and that role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = ("user", "user", "assistant", "user")
#: Where a kept row leads, by state and initial.
KEEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: Cost-to-go when no rows are left; the start and an answered question are ends.
END = (0, 2 * INSERT, INSERT, 0)
LEGAL = {"su", "ua", "au"}
FAULTS = ("", "blank", "duplicate", "truncated")
SPACE = "\\x20\\x09-\\x0D"


def step_back(after: tuple[int, ...], initial: str, fault: int) -> tuple[tuple[int, ...], int]:
    """Cost-to-go before a row and its byte of choices, from the cost-to-go after it."""
    extra = TRUNCATED if fault == 3 else 0
    ways: list[tuple[int, int | None, int]] = []  # delete, keep, change the role
    for q in range(4):
        if fault in (1, 2):
            ways.append((DELETE + after[q], None, 1 << 60))
        else:
            kept = KEEP[q].get(initial)
            ways.append((DELETE + after[q], None if kept is None else extra + after[kept], REROLE + extra + after[NEXT[q]]))
    best = [min(w for w in way if w is not None) for way in ways]
    user, assistant = best[USER], best[ASSISTANT]
    best[USER], best[ASSISTANT] = min(user, INSERT + assistant), min(assistant, INSERT + user)
    for q in (START, SYSTEM):
        best[q] = min(best[q], INSERT + best[USER])
    choices = 0
    for q, (drop, keep, _) in enumerate(ways):
        if drop == best[q]:
            choice = 0
        elif INSERT + best[NEXT[q]] == best[q]:
            choice = 1
        else:
            choice = 2 if keep == best[q] else 3
        choices |= choice << 2 * q
    return tuple(best), choices


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _choose(schema: pa.Schema):
    """Rows from last to first: adds ``seq`` (0 for the last) and ``choices``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, costs, seq, begun = None, END, 0, False
        for batch in batches:
            made = []
            for own, initial, fault in zip(*(batch.column(c).to_pylist() for c in ("conv", "initial", "fault"))):
                if not begun or own != conv:
                    conv, costs, seq, begun = own, END, 0, True
                choices = 0
                if fault is not None:
                    costs, choices = step_back(costs, initial, fault)
                made.append((seq, choices))
                seq += 1
            seqs, bytes_ = zip(*made) if made else ((), ())
            columns = [batch.column(f.name) for f in schema if f.name not in ("seq", "choices")]
            yield pa.record_batch([*columns, pa.array(seqs, pa.int64()), pa.array(bytes_, pa.int16())], schema=schema)

    return run


def _walk(schema: pa.Schema):
    """Rows from first to last: the edits of the cheapest repair, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, number, begun, live = None, START, 0, False, False

        def closing() -> list[tuple]:
            """Turns still to be inserted after the last row, and the mark of a conversation without rows."""
            nonlocal state, number
            if not begun:
                return []
            if not live:
                return [(None, conv, 0, None, None, None, None, None)]
            out = []
            while state not in (START, ASSISTANT):
                out.append((None, conv, number, "I", None, None, None, ROLE[state]))
                state, number = NEXT[state], number + 1
            return out

        for batch in batches:
            rows: list[tuple] = []  # row of the batch, then the output's columns but for the text
            columns = (batch.column(c).to_pylist() for c in ("conv", "turn", "role", "fault", "choices"))
            for i, (own, turn, role, fault, choices) in enumerate(zip(*columns)):
                if not begun or own != conv:
                    rows += closing()
                    conv, state, number, begun, live = own, START, 0, True, False
                if fault is None:
                    continue
                live = True
                while (choice := choices >> 2 * state & 3) == 1:
                    rows.append((None, conv, number, "I", None, None, None, ROLE[state]))
                    state, number = NEXT[state], number + 1
                if choice == 0:
                    rows.append((i, conv, number, "D", FAULTS[fault], turn, role, None))
                elif choice == 2:
                    rows.append((i, conv, number, "K", FAULTS[fault], turn, role, role))
                    state = KEEP[state][role[0]]
                else:
                    rows.append((i, conv, number, "R", FAULTS[fault], turn, role, ROLE[state]))
                    state = NEXT[state]
                number += 1
            if rows:
                texts = batch.column("text").take(pa.array([r[0] for r in rows], pa.int64()))
                yield _with_texts(rows, texts)
        if rows := closing():
            yield _with_texts(rows, pa.nulls(len(rows), pa.string()))

    def _with_texts(rows: list[tuple], texts: pa.Array) -> pa.RecordBatch:
        columns = [pa.array(list(c), f.type) for c, f in zip(list(zip(*rows))[1:], schema)]
        return pa.record_batch([*columns, texts], schema=schema)

    return run


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def repair_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present: Column | None = None,
) -> DataFrame:
    """The edits of each conversation's cheapest repair, in order.

    ``conv, step, edit (D, I, K or R), fault, turn, role_before, role, text``.
    Rows with an edit other than ``D`` are the mended conversation (``role``,
    and ``text``, null for an inserted turn); rows with a ``turn`` or
    ``role_before`` are the conversation as given. A conversation's rows are
    neighbours, in order, in one partition. Rows for which ``present`` is not
    true only name their conversation.
    """
    live = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.when(live, F.coalesce(F.col(role_col), F.lit(" "))).alias("role"),
        F.when(live, F.coalesce(F.col(text_col), F.lit(" "))).alias("text"),
    )
    same = Window.partitionBy("conv", "role", "text").orderBy("turn")
    last = F.regexp_extract("text", f"([^{SPACE}])[{SPACE}]*\\z", 1)
    judged = (
        rows.repartition("conv")
        .withColumn("nth", F.row_number().over(same))  # sorted where the rows are: no second shuffle
        .withColumn("last", last)
        .select(
            "conv", "turn", "role", "text", "nth",
            F.substring("role", 1, 1).alias("initial"),
            F.when(F.col("text").isNull(), F.lit(None))
            .when(F.col("last") == "", 1).when(F.col("nth") > 1, 2).when(~F.col("last").isin(".", "!", "?"), 3)
            .otherwise(0).cast("short").alias("fault"),
        )
        .sortWithinPartitions("conv", F.desc_nulls_last("turn"), F.desc("role"), F.desc("text"), F.desc("nth"))
    )
    given = T.StructType([*(judged.schema[c] for c in ("conv", "turn", "role", "text", "fault")), T.StructField("seq", T.LongType()), T.StructField("choices", T.ShortType())])
    given = T.StructType([T.StructField(f.name, f.dataType) for f in given])
    edits = T.StructType([
        T.StructField("conv", given["conv"].dataType),
        T.StructField("step", T.LongType()),
        T.StructField("edit", T.StringType()),
        T.StructField("fault", T.StringType()),
        T.StructField("turn", given["turn"].dataType),
        T.StructField("role_before", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ])
    chosen = judged.mapInArrow(_choose(_arrow(given)), given)
    return chosen.sortWithinPartitions("conv", F.desc("seq")).mapInArrow(_walk(_arrow(edits)), edits)


def mended(edits: DataFrame) -> DataFrame:
    """The mended conversations: ``conv, step, role, text``; inserted texts are empty."""
    return edits.filter(F.col("edit") != "D").select("conv", "step", "role", F.coalesce("text", F.lit("")).alias("text"))


COUNTED = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
AUDIT = T.StructType([*(T.StructField(c, T.LongType()) for c in COUNTED), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])


class _Audit:
    """What is known of one conversation so far."""

    def __init__(self) -> None:
        self.faults = dict.fromkeys(FAULTS, 0)
        self.letters: list[str] = []
        self.sha = hashlib.sha256()
        self.illegal = self.cost = self.distinct = 0
        self.before = self.low = self.high = None
        self.first = True

    def add(self, edit: str, fault: str | None, turn: int | None, was: str | None, role: str | None, text: str | None) -> None:
        self.letters.append(edit)
        if edit != "I":
            self.faults[fault] += 1
            if self.before is not None and self.before + was[:1] not in LEGAL:
                self.illegal += 1
            self.before = was[:1]
            if turn is not None:
                self.distinct += turn != self.high
                self.low = turn if self.low is None else self.low
                self.high = turn
        self.cost += {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[edit] + (TRUNCATED if edit != "D" and fault == "truncated" else 0)
        if edit != "D":
            self.sha.update(f"{'' if self.first else chr(10)}{role}:{text or ''}".encode())
            self.first = False

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        faults = (self.faults[f] for f in FAULTS[1:])
        return (gaps, *faults, self.illegal, self.cost, "".join(self.letters), self.sha.hexdigest())


def audit(edits: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation from the edits of ``repair_conversations``.

    ``gaps`` counts turn numbers missing between the least and the greatest;
    ``blank, duplicate, truncated`` rows by first fault; ``illegal`` neighbours
    among the given rows; then the cost, the edits and the mended text's digest.
    """
    schema = T.StructType([T.StructField(conv_col, edits.schema["conv"].dataType), *AUDIT])
    out = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("conv", "edit", "fault", "turn", "role_before", "role", "text")
        rows = (r for b in batches for r in zip(*(b.column(n).to_pylist() for n in names)))
        ready, held = [], 0
        for conv, own in itertools.groupby(rows, key=lambda r: r[0]):
            found = _Audit()
            for r in own:
                if r[1] is not None:
                    found.add(*r[1:])
            ready.append((conv, *found.row()))
            held += len(found.letters)
            if len(ready) >= 1000 or held > 4_000_000:
                yield _batch(ready, out)
                ready, held = [], 0
        if ready:
            yield _batch(ready, out)

    return edits.mapInArrow(run, schema)


def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations spoilt in a fixed way, for ``repair_conversations``: ``conv_id, turn, role, text, dropped``.

    ``crc32("conv:turn") % 20``, nulls as one space: 0 drops the row, 1 empties
    its text, 2 takes its full stops, exclamation and question marks, 3 repeats
    it, 4 makes it a user's.
    """

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        spaced(role_col).alias("role"),
        spaced(text_col).alias("text"),
        (F.crc32(F.concat_ws(":", spaced(conv_col), spaced(turn_col))) % 20).alias("kind"),
    )
    kind = F.col("kind")
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (kind == 0).alias("dropped"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
