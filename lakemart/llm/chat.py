"""Conversations rendered through a compiled template, with loss spans, and read back.

Rows are shuffled by conversation and sorted by turn; each task then streams
its rows through the template's closures. A conversation comes out as one or
more parts cut between turns, each with the spans of generated text, so that
neither a task nor a row ever holds a conversation whole, however long it is.
Digests need a conversation's turns in order, so one conversation is one
task's work; it is streamed in constant memory.

Texts and roles are escaped: a backslash goes after the first character of
each control string and each backslash is doubled. ``unescape`` undoes it.

Defined cases: null text and null role are empty; a null conversation id is a
conversation of its own; turns that tie are ordered by role and text, null
turns first; repeated rows are rendered each; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .template import compile_template

#: Control strings of common chat formats; ``<|`` opens this template's own.
CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TEMPLATE = (
    "{% for m in messages %}<|turn|>{{ m.role | escape }}<|text|>"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}<|end|>{% endfor %}"
)
#: Characters after which a part ends at the next turn.
PART_CHARS = 1_000_000

_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(.)", re.S)
_MARKS = re.compile(r"<\|(turn|text|end)\|>")

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], (text or "").replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parts_of(pieces: Iterator[tuple[str | None, bool]], part_chars: int) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """(text, spans of generated text) of each part; parts end between turns."""
    out: list[str] = []
    spans: list[tuple[int, int]] = []
    size = 0
    for text, generated in pieces:
        if text is None:
            if size >= part_chars:
                yield "".join(out), spans
                out, spans, size = [], [], 0
            continue
        if generated and text:
            spans.append((size, size + len(text)))
        out.append(text)
        size += len(text)
    if out:
        yield "".join(out), spans


def _render(template: str, names: tuple[str, str, str], part_chars: int, out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, {"escape": escape})
        rows = (r for b in batches for r in zip(*(b.column(n).to_pylist() for n in names)))
        ready: list[tuple] = []
        held = 0
        for conv, turns in itertools.groupby(rows, key=lambda r: r[0]):
            messages = ({"role": role or "", "text": text or ""} for _, role, text in turns)
            for i, (text, spans) in enumerate(parts_of(render(messages=messages), part_chars)):
                ready.append((conv, i, text, [{"start": a, "end": b} for a, b in spans]))
                held += len(text)
                if held > 4_000_000 or len(ready) >= 512:
                    yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*ready), out)], schema=out)
                    ready, held = [], 0
        if ready:
            yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*ready), out)], schema=out)

    return run


def format_conversations(
    turns: DataFrame,
    template: str = TEMPLATE,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """``conv_col, part, formatted, loss_spans``: the rendered text, part by part.

    Parts of a conversation are neighbours, in order, in one partition.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    compile_template(template, {"escape": escape})  # a bad template fails here, not in the tasks
    schema = T.StructType([turns.schema[conv_col], T.StructField("part", T.IntegerType()), T.StructField("formatted", T.StringType()), T.StructField("loss_spans", SPANS)])
    dealt = (
        turns.select(conv_col, turn_col, role_col, text_col)
        .repartition(F.col(conv_col))
        .sortWithinPartitions(conv_col, turn_col, role_col, text_col)
        .select(conv_col, role_col, text_col)
    )
    return dealt.mapInArrow(_render(template, (conv_col, role_col, text_col), part_chars, to_arrow_schema(schema)), schema)


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn in rendered text, unescaped."""
    marks = list(_MARKS.finditer(formatted))
    for a, b, c in zip(marks[0::3], marks[1::3], marks[2::3]):
        assert (a[1], b[1], c[1]) == ("turn", "text", "end")
        yield unescape(formatted[a.end() : b.start()]), unescape(formatted[b.end() : c.start()])


DIGESTS = [("n_turns", "long"), ("turns_sha256", "string"), ("loss_chars", "long"), ("loss_sha256", "string"), ("formatted_chars", "long")]


def conversation_digests(parts: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation, read back from the parts of ``format_conversations``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([parts.schema[conv_col], *(T.StructField(n, T.LongType() if t == "long" else T.StringType()) for n, t in DIGESTS)])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(n).to_pylist() for n in (conv_col, "formatted", "loss_spans"))))
        ready = []
        for conv, own in itertools.groupby(rows, key=lambda r: r[0]):
            n = loss = chars = 0
            turns_sha, loss_sha = hashlib.sha256(), hashlib.sha256()
            for _, text, spans in own:
                chars += len(text)
                for role, said in read_turns(text):
                    n += 1
                    turns_sha.update(f"{role}\n{said}\n".encode())
                for s in spans:
                    said = unescape(text[s["start"] : s["end"]])
                    loss += len(said)
                    loss_sha.update(said.encode())
            ready.append((conv, n, turns_sha.hexdigest(), loss, loss_sha.hexdigest(), chars))
            if len(ready) >= 1000:
                yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*ready), out)], schema=out)
                ready = []
        if ready:
            yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*ready), out)], schema=out)

    return parts.mapInArrow(run, schema)
