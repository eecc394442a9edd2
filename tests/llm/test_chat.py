"""Template language, escaping and the round trip through rendered conversations."""

from __future__ import annotations

import pytest
from hypothesis import given
from hypothesis import strategies as st

from lakemart.llm import chat
from lakemart.llm.template import Const, Out, TemplateError, compile_template, fold, parse

FILTERS = {"escape": chat.escape, "upper": lambda s: s.upper()}


def render(source, **variables):
    return "".join(t for t, _ in compile_template(source, FILTERS)(**variables) if t)


@pytest.mark.parametrize(
    ("source", "variables", "want"),
    [
        ("a{{ x }}b", {"x": 3}, "a3b"),
        ("{% if x == 'a' %}1{% elif x == 'b' %}2{% else %}3{% endif %}", {"x": "b"}, "2"),
        ("{% if x == 'a' %}1{% elif x == 'b' %}2{% else %}3{% endif %}", {"x": "c"}, "3"),
        ("{% for m in ms %}{{ loop.index }}{{ m.t }}{% if not loop.last %},{% endif %}{% endfor %}", {"ms": [{"t": "a"}, {"t": "b"}]}, "1a,2b"),
        ("{{ m['k'] | upper + '!' }}", {"m": {"k": "v"}}, "V!"),
        ("{{ 'a' in x and not false }}", {"x": "cat"}, "True"),
        ("{{ m.missing }}", {"m": {}}, ""),
        ("{% for m in ms %}x{% endfor %}", {"ms": []}, ""),
    ],
)
def test_renders(source, variables, want):
    assert render(source, **variables) == want


def test_constants_fold():
    assert fold(parse("a{{ 'b' + 'c' }}{% if 1 == 1 %}d{% else %}{{ x }}{% endif %}"), FILTERS) == (Out(Const("abcd")),)


@pytest.mark.parametrize("source", ["{% for x %}", "{% if a %}", "{{ a( }}", "{% import os %}", "{{ a | system }}", "{{ a b }}", "{% for x in y %}"])
def test_bad_templates_are_refused(source):
    with pytest.raises(TemplateError):
        compile_template(source, FILTERS)


@pytest.mark.parametrize("source", ["{{ x.__class__ }}", "{{ x['__class__'] }}", "{{ y }}", "{% for c in x %}{% endfor %}"])
def test_sandbox(source):
    with pytest.raises(TemplateError):
        render(source, x="text")


@given(st.lists(st.sampled_from([*chat.CONTROLS, "\\", "|>", "<", "|", "a", "turn", "[", "/", "\n"]), max_size=20).map("".join))
def test_escape_is_reversible_and_leaves_no_control(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in chat.CONTROLS)


def test_generation_marks_and_parts():
    pieces = compile_template(chat.TEMPLATE, {"escape": chat.escape})(messages=[{"role": "user", "text": "q"}, {"role": "assistant", "text": "<|end|>"}])
    parts = list(chat.parts_of(pieces, 1))
    assert [len(s) for _, s in parts] == [0, 1]
    assert [t for p, _ in parts for t in chat.read_turns(p)] == [("user", "q"), ("assistant", "<|end|>")]


def test_edge_rows(spark):
    rows = [(1, 1, "assistant", "b", 0), (1, 0, None, None, 0), (1, None, "user", "first", 0), (None, 0, "assistant", "", 0), (1, 1, "assistant", "b", 0), (2, 0, "assistant", "é" * 3000, 0)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int")
    parts = chat.format_conversations(turns, part_chars=10)
    texts = {}
    for r in parts.orderBy("conv_id", "part").collect():
        texts.setdefault(r.conv_id, []).extend(chat.read_turns(r.formatted))
    assert texts == {1: [("user", "first"), ("", ""), ("assistant", "b"), ("assistant", "b")], None: [("assistant", "")], 2: [("assistant", "é" * 3000)]}
    got = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.conversation_digests(parts).collect()}
    assert got == {1: (4, 2), None: (1, 0), 2: (1, 3000)}
    assert chat.conversation_digests(chat.format_conversations(turns.limit(0))).count() == 0
