"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors (at-signs, scheme separators,
plus signs, digits and identifier cues such as ``token`` or ``iban``). At each
anchor a local parser grows the span to its boundary and validates it; text
without anchors costs nothing more. Offsets are code points, ends exclusive.

Kinds, in the order of the result: ``email``, ``ip``, ``card``, ``phone`` (the
base, equal to leftmost non-overlapping matches of the documented patterns,
failing matches dropped without a retry), then ``url`` (scheme and host),
``account`` (IBAN after its cue, checked modulo 97) and ``secret`` (a value of
eight or more characters with a digit and a letter, assigned to a credential cue).

Defined cases: a null or empty text has no spans, a null id is passed through,
repeated rows each give a row, an empty table gives an empty result, other
columns are ignored by ``find_pii`` and kept by ``mask_pii``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, slices

KINDS = ("email", "ip", "card", "phone", "url", "account", "secret")
BASE = KINDS[:4]
CUES = {"token": "secret", "password": "secret", "passwd": "secret", "api_key": "secret", "apikey": "secret", "secret": "secret", "iban": "account"}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_REST = re.compile(r"[^\s<>\"'|]+")
_ASSIGNED = re.compile(r"[\x20\t]{0,3}[:=][\x20\t]{0,3}[\"']?([A-Za-z0-9_+/=.-]{8,})")
_IBAN = re.compile(r"[\x20\t]{0,3}[:=]?[\x20\t]{0,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})")
_NOT_DIGIT = re.compile(r"[^0-9]+")

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])


def _automaton() -> ahocorasick.Automaton:
    auto = ahocorasick.Automaton()
    for mark in ("@", "://", "+", *"0123456789"):
        auto.add_word(mark, (mark if mark in "@+://" else "0", 1))
    for cue, kind in CUES.items():
        for form in (cue, cue.upper(), cue.capitalize()):
            auto.add_word(form, (kind, len(form)))
    auto.make_automaton()
    return auto


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _iban(value: str) -> bool:
    v = value.replace(" ", "")
    return 15 <= len(v) <= 34 and int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and (not part or int(part) <= 255)


def spans_in(text: str, auto: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All spans of one text, by kind and then by start."""
    found: dict[str, list[tuple[str, int, int]]] = {k: [] for k in KINDS}
    over = dict.fromkeys(("email", "ip", "card", "phone", "url", "account", "secret"), 0)
    digits_from = -1  # end of the digit run that was already looked at
    for last, (what, size) in auto.iter(text):
        if what == "@":
            start = last
            while start > over["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < last and (m := _DOMAIN.match(text, last + 1)):
                found["email"].append(("email", start, m.end()))
                over["email"] = m.end()
        elif what == "0":
            if last >= over["card"]:
                if m := _CARD.match(text, last):
                    over["card"] = m.end()
                    digits = _NOT_DIGIT.sub("", m.group()) if len(m.group()) <= 40 else ""
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        found["card"].append(("card", last, m.end()))
                else:
                    over["card"] = last + 1
            if last >= over["ip"] and last > digits_from:
                if m := _IP.match(text, last):
                    over["ip"] = m.end()
                    if all(map(_octet, m.group().split("."))):
                        found["ip"].append(("ip", last, m.end()))
                end = last + 1
                while end < len(text) and "0" <= text[end] <= "9":
                    end += 1
                digits_from = end - 1
        elif what == "+":
            if last >= over["phone"] and (m := _PHONE.match(text, last)):
                over["phone"] = m.end()
                if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                    found["phone"].append(("phone", last, m.end()))
        elif what == "://":
            start = last - 2
            while start > over["url"] and (c := text[start - 1]).isascii() and (c.isalnum() or c in "+.-"):
                start -= 1
            m = _REST.match(text, last + 1)
            if m and start < last - 2 and text[start].isalpha():
                end = m.end()
                while text[end - 1] in ".,;:!?)]}":
                    end -= 1
                if end > last + 1:
                    found["url"].append(("url", start, end))
                    over["url"] = end
        else:
            start = last + 1 - size
            if start and (text[start - 1].isalnum() or text[start - 1] == "_"):
                continue
            m = (_IBAN if what == "account" else _ASSIGNED).match(text, last + 1)
            if m and m.start(1) >= over[what]:
                value = m.group(1)
                good = _iban(value) if what == "account" else any(map(str.isdigit, value)) and any(map(str.isalpha, value))
                if good:
                    found[what].append((what, m.start(1), m.end(1)))
                    over[what] = m.end(1)
    return [s for k in KINDS for s in found[k]]


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with spans (overlaps joined) replaced by ``<KIND>`` of the first."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += text[at:start], f"<{kind.upper()}>"
        at = max(at, end)
    return "".join(out) + text[at:]


def _arrow_spans(rows: list[list[tuple[str, int, int]]]) -> pa.Array:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in r] for r in rows], kind)


def _runs(text_col: str, spans_col: str, mask: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = _automaton()
        for batch in slices(batches, text_col):
            texts = batch.column(text_col).to_pylist()
            spans = [spans_in(t, auto) if t else [] for t in texts]
            cols = {n: batch.column(n) for n in batch.schema.names}
            if mask:
                cols[text_col] = pa.array([masked(t, s) if s else t for t, s in zip(texts, spans)], pa.string())
            else:
                del cols[text_col]
            yield pa.RecordBatch.from_pydict(cols | {spans_col: _arrow_spans(spans)})

    return run


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``spans`` (array of kind, start, end) of each row."""
    out = T.StructType([docs.schema[id_col], T.StructField("spans", T.ArrayType(SPAN))])
    return docs.select(id_col, text_col).mapInArrow(_runs(text_col, "spans", False), out)


def mask_pii(docs: DataFrame, text_col: str = "text", spans_col: str | None = None) -> DataFrame:
    """``docs`` with each span in the text replaced by its kind; with ``spans_col`` the spans too."""
    name = spans_col or fresh("spans_", docs.columns)
    out = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(SPAN))])
    done = docs.mapInArrow(_runs(text_col, name, True), out)
    return done if spans_col else done.select(*docs.columns)


def joined(spans: str, kinds: tuple[str, ...]):
    """Column: ``kind:start:end`` of the spans of ``kinds``, joined by commas."""
    own = F.filter(F.col(spans), lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def number_of(spans: str, kind: str):
    """Column: how many spans are of ``kind``."""
    return F.size(F.filter(F.col(spans), lambda s: s["kind"] == kind)).cast("long")
