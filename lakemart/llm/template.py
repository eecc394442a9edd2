"""A small sandboxed template language, compiled to Python closures.

Syntax: text; ``{{ expr }}``; ``{% for x in expr %}…{% endfor %}``;
``{% if expr %}…{% elif expr %}…{% else %}…{% endif %}``;
``{% generation %}…{% endgeneration %}`` (text a model would be trained on).
Expressions: string and integer literals, ``true false none``, names, ``a.b``,
``a['b']``, ``+ == != in and or not``, parentheses and filters ``a | f``.

Names resolve to what the caller passes and loop variables only; ``a.b`` reads
keys of mappings and the loop record, never attributes, and nothing can be
called, so a template reaches no Python object. Constants are folded and dead
branches dropped before closures are made. Loops take any iterable and output
is produced piece by piece, so a conversation is never held whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

#: Yielded after each round of an outermost loop.
BOUNDARY = (None, False)


class TemplateError(ValueError):
    """The template is not well formed, or an expression has no defined value."""


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Key:
    of: object
    key: object


@dataclass(frozen=True)
class Op:
    op: str
    args: tuple


@dataclass(frozen=True)
class Apply:
    filter: str
    to: object


@dataclass(frozen=True)
class Out:
    expr: object


@dataclass(frozen=True)
class Loop:
    var: str
    over: object
    body: tuple


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body)


@dataclass(frozen=True)
class Generation:
    body: tuple


_TAGS = re.compile(r"\{\{(.*?)\}\}|\{%-?(.*?)-?%\}", re.S)
_TOKENS = re.compile(r"""\s*(?:('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(\d+)|([A-Za-z_]\w*)|(==|!=|[().|+\[\]]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t"}
_WORDS = {"true": True, "false": False, "none": None}
_FIXED = {
    "+": lambda a, b: a + b,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "in": lambda a, b: a in b,
    "not": lambda a: not a,
}


class _Expr:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.strip()
        while at < len(source):
            m = _TOKENS.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:at + 10]!r}")
            text, number, word, mark = m.groups()
            if text is not None:
                self.tokens.append(("const", re.sub(r"\\(.)", lambda x: _ESCAPES.get(x[1], x[1]), text[1:-1], flags=re.S)))
            elif number is not None:
                self.tokens.append(("const", int(number)))
            elif word in _WORDS:
                self.tokens.append(("const", _WORDS[word]))
            else:
                self.tokens.append(("name", word) if word else ("mark", mark))
            at = m.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "const" and self.tokens[self.at][1] in values

    def take(self, *values: str):
        if self.peek(*values):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} expected")

    def word(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("a name expected")

    def whole(self):
        tree = self.disjunction()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def disjunction(self):
        left = self.conjunction()
        while self.take("or"):
            left = Op("or", (left, self.conjunction()))
        return left

    def conjunction(self):
        left = self.negation()
        while self.take("and"):
            left = Op("and", (left, self.negation()))
        return left

    def negation(self):
        return Op("not", (self.negation(),)) if self.take("not") else self.comparison()

    def comparison(self):
        left = self.sum()
        while op := self.take("==", "!=", "in"):
            left = Op(op, (left, self.sum()))
        return left

    def sum(self):
        left = self.filtered()
        while self.take("+"):
            left = Op("+", (left, self.filtered()))
        return left

    def filtered(self):
        left = self.atom()
        while self.take("|"):
            left = Apply(self.word(), left)
        return left

    def atom(self):
        if self.take("("):
            tree = self.disjunction()
            self.need(")")
        elif self.at < len(self.tokens) and self.tokens[self.at][0] == "const":
            tree = Const(self.tokens[self.at][1])
            self.at += 1
        else:
            tree = Name(self.word())
        while mark := self.take(".", "["):
            if mark == ".":
                tree = Key(tree, Const(self.word()))
            else:
                tree = Key(tree, self.disjunction())
                self.need("]")
        return tree


def parse(source: str) -> tuple:
    """The syntax tree of a template: a tuple of nodes."""
    pieces, at = [], 0
    for m in _TAGS.finditer(source):
        if m.start() > at:
            pieces.append(("text", source[at : m.start()]))
        pieces.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    if at < len(source):
        pieces.append(("text", source[at:]))
    pos = 0

    def block(*ends: str) -> tuple[tuple, str]:
        nonlocal pos
        nodes = []
        while pos < len(pieces):
            kind, value = pieces[pos]
            pos += 1
            if kind == "text":
                nodes.append(Out(Const(value)))
            elif kind == "out":
                nodes.append(Out(_Expr(value).whole()))
            else:
                word, _, rest = value.partition(" ")
                if word in ends:
                    return tuple(nodes), value
                if word == "for":
                    m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)
                    if not m:
                        raise TemplateError(f"bad loop {value!r}")
                    body, _ = block("endfor")
                    nodes.append(Loop(m[1], _Expr(m[2]).whole(), body))
                elif word == "if":
                    branches, test = [], _Expr(rest).whole()
                    while test is not None:
                        body, end = block("elif", "else", "endif")
                        branches.append((test, body))
                        test = _Expr(end[4:]).whole() if end.startswith("elif") else None
                        if end == "else":
                            branches.append((Const(True), block("endif")[0]))
                    nodes.append(If(tuple(branches)))
                elif word == "generation":
                    nodes.append(Generation(block("endgeneration")[0]))
                else:
                    raise TemplateError(f"unknown tag {value!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} expected")
        return tuple(nodes), ""

    return block()[0]


def _fold_expr(tree, filters: Mapping[str, Callable]):
    if isinstance(tree, Op):
        args = tuple(_fold_expr(a, filters) for a in tree.args)
        if tree.op in ("and", "or") and isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (tree.op == "and") else args[0]
        if tree.op in _FIXED and all(isinstance(a, Const) for a in args):
            return Const(_FIXED[tree.op](*(a.value for a in args)))
        return Op(tree.op, args)
    if isinstance(tree, Apply):
        to = _fold_expr(tree.to, filters)
        if tree.filter not in filters:
            raise TemplateError(f"unknown filter {tree.filter!r}")
        return Const(filters[tree.filter](to.value)) if isinstance(to, Const) else Apply(tree.filter, to)
    if isinstance(tree, Key):
        return Key(_fold_expr(tree.of, filters), _fold_expr(tree.key, filters))
    return tree


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def fold(nodes: tuple, filters: Mapping[str, Callable]) -> tuple:
    """Fold constants, drop dead branches and join neighbouring text."""
    out: list = []

    def add(node) -> None:
        if isinstance(node, Out) and isinstance(node.expr, Const):
            text = _text(node.expr.value)
            if out and isinstance(out[-1], Out) and isinstance(out[-1].expr, Const):
                text = out.pop().expr.value + text
            if text:
                out.append(Out(Const(text)))
        else:
            out.append(node)

    for node in nodes:
        if isinstance(node, Out):
            add(Out(_fold_expr(node.expr, filters)))
        elif isinstance(node, Loop):
            add(Loop(node.var, _fold_expr(node.over, filters), fold(node.body, filters)))
        elif isinstance(node, Generation):
            add(Generation(fold(node.body, filters)))
        else:
            live = []
            for test, body in node.branches:
                test = _fold_expr(test, filters)
                if isinstance(test, Const) and not test.value:
                    continue
                live.append((test, fold(body, filters)))
                if isinstance(test, Const):
                    break
            if live and isinstance(live[0][0], Const):
                for inner in live[0][1]:
                    add(inner)
            elif live:
                add(If(tuple(live)))
    return tuple(out)


class _LoopRecord(dict):
    """``loop`` inside a loop: index, index0, first and last."""


def _expr_closure(tree, filters: Mapping[str, Callable]) -> Callable[[dict], object]:
    if isinstance(tree, Const):
        return lambda env, v=tree.value: v
    if isinstance(tree, Name):
        def name(env, key=tree.name):
            if key not in env:
                raise TemplateError(f"{key!r} is not defined")
            return env[key]
        return name
    if isinstance(tree, Key):
        of, key = _expr_closure(tree.of, filters), _expr_closure(tree.key, filters)

        def look_up(env):
            record, k = of(env), key(env)
            if not isinstance(record, Mapping):
                raise TemplateError("only records have keys")
            return record.get(k)
        return look_up
    if isinstance(tree, Apply):
        to, f = _expr_closure(tree.to, filters), filters[tree.filter]
        return lambda env: f(to(env))
    args = [_expr_closure(a, filters) for a in tree.args]
    if tree.op == "and":
        return lambda env: args[0](env) and args[1](env)
    if tree.op == "or":
        return lambda env: args[0](env) or args[1](env)
    op = _FIXED[tree.op]
    return lambda env: op(*(a(env) for a in args))


def _uses_last(node) -> bool:
    if isinstance(node, Key) and node.of == Name("loop") and node.key == Const("last"):
        return True
    parts = node if isinstance(node, (tuple, list)) else vars(node).values() if hasattr(node, "__dataclass_fields__") else ()
    return any(_uses_last(p) for p in parts)


def _closure(nodes: tuple, filters: Mapping[str, Callable], depth: int) -> Callable[[dict, bool], Iterator]:
    parts = []
    for node in nodes:
        if isinstance(node, Out):
            if isinstance(node.expr, Const):
                parts.append(lambda env, gen, t=node.expr.value: ((t, gen),))
            else:
                value = _expr_closure(node.expr, filters)
                parts.append(lambda env, gen, value=value: ((_text(value(env)), gen),))
        elif isinstance(node, Generation):
            inner = _closure(node.body, filters, depth)
            parts.append(lambda env, gen, inner=inner: inner(env, True))
        elif isinstance(node, If):
            tests = [(_expr_closure(t, filters), _closure(b, filters, depth)) for t, b in node.branches]

            def choose(env, gen, tests=tests):
                for test, body in tests:
                    if test(env):
                        return body(env, gen)
                return ()
            parts.append(choose)
        else:
            over, body, ahead = _expr_closure(node.over, filters), _closure(node.body, filters, depth + 1), _uses_last(node.body)

            def loop(env, gen, var=node.var, over=over, body=body, ahead=ahead):
                items = over(env)
                if isinstance(items, (str, bytes)) or not isinstance(items, Iterable):
                    raise TemplateError("only lists can be looped over")
                items, i, none = iter(items), 0, object()
                item = next(items, none)
                while item is not none:
                    following = next(items, none) if ahead else None
                    record = _LoopRecord(index=i + 1, index0=i, first=i == 0, last=following is none)
                    yield from body(env | {var: item, "loop": record}, gen)
                    if depth == 0:
                        yield BOUNDARY
                    item, i = following if ahead else next(items, none), i + 1
            parts.append(loop)

    def run(env: dict, gen: bool) -> Iterator:
        for part in parts:
            yield from part(env, gen)

    return run


def compile_template(source: str, filters: Mapping[str, Callable[[object], object]]) -> Callable[..., Iterator[tuple[str | None, bool]]]:
    """A function of the template's variables that yields (text, generated) pieces."""
    run = _closure(fold(parse(source), filters), filters, 0)
    return lambda **variables: run(variables, False)
