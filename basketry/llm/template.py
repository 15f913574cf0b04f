"""A small sandboxed template language for chat formats.

Grammar: literal text, ``{{ expression }}`` and blocks ``{% ... %}``:

    {% for NAME in NAME %} ... {% endfor %}
    {% if EXPR %} ... {% elif EXPR %} ... {% else %} ... {% endif %}
    {% set NAME = EXPR %}
    {% generation %} ... {% endgeneration %}

Expressions: strings, integers, true/false/none, names, ``a.b``, ``not and
or``, ``== != + ~``, ``in``, parentheses and filters ``x | name``.  Only the
context's own names, attributes of dictionaries and registered filters can be
reached: there are no calls, no Python attributes and no imports.

``compile_template`` parses into a syntax tree, folds constant expressions
(including constant branches and adjacent literals) and returns a Python
closure; ``render(context)`` yields (text, inside a generation block) pieces
lazily, so a conversation given as an iterator is never held as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass


class TemplateError(ValueError):
    pass


# ------------------------------------------------------------------ syntax tree

@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Attr:
    of: object
    name: str


@dataclass(frozen=True)
class Unary:
    arg: object


@dataclass(frozen=True)
class Binary:
    op: str
    left: object
    right: object


@dataclass(frozen=True)
class Filter:
    arg: object
    name: str


@dataclass(frozen=True)
class Output:
    expr: object


@dataclass(frozen=True)
class Set:
    name: str
    expr: object


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body)


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


_PIECE = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[()+~|.]))")
_ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}
_WORDS = {"true": True, "false": False, "none": None}


class _Expression:
    """Recursive descent; ``or`` binds loosest, then and, not, comparison, + and ~, filters, attributes."""

    def __init__(self, text: str):
        self.toks, at = [], 0
        text = text.rstrip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise TemplateError(f"unexpected {text[at:at + 10]!r}")
            self.toks.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self):
        return self.toks[self.at] if self.at < len(self.toks) else (None, None)

    def take(self, *values):
        kind, v = self.peek()
        if kind in ("op", "name") and v in values:
            self.at += 1
            return v
        return None

    def whole(self):
        e = self.either()
        if self.at != len(self.toks):
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return e

    def either(self):
        e = self.both()
        while self.take("or"):
            e = Binary("or", e, self.both())
        return e

    def both(self):
        e = self.negated()
        while self.take("and"):
            e = Binary("and", e, self.negated())
        return e

    def negated(self):
        return Unary(self.negated()) if self.take("not") else self.compared()

    def compared(self):
        e = self.joined()
        while op := self.take("==", "!=", "in"):
            e = Binary(op, e, self.joined())
        return e

    def joined(self):
        e = self.filtered()
        while op := self.take("+", "~"):
            e = Binary(op, e, self.filtered())
        return e

    def filtered(self):
        e = self.atom()
        while self.take("|"):
            kind, v = self.peek()
            if kind != "name":
                raise TemplateError("a filter needs a name")
            self.at += 1
            e = Filter(e, v)
        return e

    def atom(self):
        kind, v = self.peek()
        self.at += 1
        if kind == "str":
            e = Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), v[1:-1]))
        elif kind == "int":
            e = Const(int(v))
        elif kind == "name":
            e = Const(_WORDS[v]) if v in _WORDS else Name(v)
        elif v == "(":
            e = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
        else:
            raise TemplateError(f"unexpected {v!r}" if v else "unexpected end")
        while self.take("."):
            kind, v = self.peek()
            if kind != "name" or v.startswith("_"):
                raise TemplateError("an attribute needs a public name")
            self.at += 1
            e = Attr(e, v)
        return e


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    pieces, at = [], 0
    for m in _PIECE.finditer(source):
        if m.start() > at:
            pieces.append(("text", source[at:m.start()]))
        pieces.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    if at < len(source):
        pieces.append(("text", source[at:]))
    pieces.reverse()
    body, end = _body(pieces, ())
    return body


def _body(pieces: list, ends: tuple) -> tuple[tuple, str]:
    out = []
    while pieces:
        kind, s = pieces.pop()
        if kind == "text":
            out.append(Output(Const(s)))
        elif kind == "out":
            out.append(Output(_Expression(s).whole()))
        else:
            word, _, rest = s.partition(" ")
            if word in ends:
                return tuple(out), s
            if word == "for":
                m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
                if not m:
                    raise TemplateError(f"bad loop {s!r}")
                inner, _ = _body(pieces, ("endfor",))
                out.append(For(m[1], _Expression(m[2]).whole(), inner))
            elif word == "if":
                branches, cond = [], _Expression(rest).whole()
                while True:
                    inner, end = _body(pieces, ("elif", "else", "endif"))
                    branches.append((cond, inner))
                    word, _, rest = end.partition(" ")
                    if word == "endif":
                        break
                    cond = Const(True) if word == "else" else _Expression(rest).whole()
                out.append(If(tuple(branches)))
            elif word == "set":
                m = re.fullmatch(r"([A-Za-z_]\w*)\s*=\s*(.+)", rest, re.S)
                if not m:
                    raise TemplateError(f"bad assignment {s!r}")
                out.append(Set(m[1], _Expression(m[2]).whole()))
            elif word == "generation":
                inner, _ = _body(pieces, ("endgeneration",))
                out.append(Generation(inner))
            else:
                raise TemplateError(f"unexpected block {s!r}")
    if ends:
        raise TemplateError(f"missing {ends[-1]}")
    return tuple(out), ""


# -------------------------------------------------------------- constant folding

def _apply(op: str, a, b):
    if op == "==":
        return a == b
    if op == "!=":
        return a != b
    if op == "in":
        return a in b if isinstance(b, (str, dict, list, tuple)) else False
    if op == "~":
        return text_of(a) + text_of(b)
    if isinstance(a, (str, int)) and type(a) is type(b):
        return a + b
    raise TemplateError("+ needs two strings or two integers")


def text_of(v) -> str:
    return "" if v is None else "true" if v is True else "false" if v is False else str(v)


def fold(node, filters: dict[str, Callable]):
    """The same tree with constant parts computed."""
    if isinstance(node, tuple):
        out, flat = [], []
        for x in (fold(n, filters) for n in node):
            flat += x if isinstance(x, tuple) else (x,)
        for x in flat:
            if isinstance(x, Output) and isinstance(x.expr, Const) and out and isinstance(out[-1], Output) and isinstance(out[-1].expr, Const):
                out[-1] = Output(Const(text_of(out[-1].expr.value) + text_of(x.expr.value)))
            else:
                out.append(x)
        return tuple(x for x in out if not (isinstance(x, Output) and isinstance(x.expr, Const) and text_of(x.expr.value) == ""))
    if isinstance(node, Unary):
        a = fold(node.arg, filters)
        return Const(not a.value) if isinstance(a, Const) else Unary(a)
    if isinstance(node, Binary):
        a, b = fold(node.left, filters), fold(node.right, filters)
        if node.op in ("and", "or"):
            if isinstance(a, Const):
                return b if bool(a.value) == (node.op == "and") else a
            return Binary(node.op, a, b)
        return Const(_apply(node.op, a.value, b.value)) if isinstance(a, Const) and isinstance(b, Const) else Binary(node.op, a, b)
    if isinstance(node, Filter):
        if node.name not in filters:
            raise TemplateError(f"no filter {node.name!r}")
        a = fold(node.arg, filters)
        return Const(filters[node.name](a.value)) if isinstance(a, Const) else Filter(a, node.name)
    if isinstance(node, Attr):
        return Attr(fold(node.of, filters), node.name)
    if isinstance(node, Output):
        return Output(fold(node.expr, filters))
    if isinstance(node, Set):
        return Set(node.name, fold(node.expr, filters))
    if isinstance(node, For):
        return For(node.name, fold(node.over, filters), fold(node.body, filters))
    if isinstance(node, Generation):
        return Generation(fold(node.body, filters))
    if isinstance(node, If):
        kept = []
        for cond, body in node.branches:
            cond = fold(cond, filters)
            if isinstance(cond, Const) and not cond.value:
                continue
            kept.append((cond, fold(body, filters)))
            if isinstance(cond, Const):
                break
        if not kept:
            return ()
        return kept[0][1] if isinstance(kept[0][0], Const) else If(tuple(kept))
    return node


# ---------------------------------------------------------------------- closures

def _value(node, filters) -> Callable[[dict], object]:
    if isinstance(node, Const):
        v = node.value
        return lambda env: v
    if isinstance(node, Name):
        n = node.name

        def look(env):
            if n not in env:
                raise TemplateError(f"no name {n!r}")
            return env[n]
        return look
    if isinstance(node, Attr):
        of, n = _value(node.of, filters), node.name

        def attribute(env):
            v = of(env)
            if not isinstance(v, dict):
                raise TemplateError(f"{n!r} of something that isn't a record")
            return v.get(n)
        return attribute
    if isinstance(node, Unary):
        a = _value(node.arg, filters)
        return lambda env: not a(env)
    if isinstance(node, Filter):
        a, f = _value(node.arg, filters), filters[node.name]
        return lambda env: f(a(env))
    a, b, op = _value(node.left, filters), _value(node.right, filters), node.op
    if op == "and":
        return lambda env: a(env) and b(env)
    if op == "or":
        return lambda env: a(env) or b(env)
    return lambda env: _apply(op, a(env), b(env))


def _statement(node, filters) -> Callable[[dict, bool], Iterator[tuple[str, bool]]]:
    if isinstance(node, Output):
        v = _value(node.expr, filters)

        def output(env, gen):
            yield text_of(v(env)), gen
        return output
    if isinstance(node, Set):
        v = _value(node.expr, filters)

        def assign(env, gen):
            env[node.name] = v(env)
            return iter(())
        return assign
    if isinstance(node, Generation):
        body = _block(node.body, filters)
        return lambda env, gen: body(env, True)
    if isinstance(node, If):
        branches = [(_value(c, filters), _block(b, filters)) for c, b in node.branches]

        def choose(env, gen):
            for cond, body in branches:
                if cond(env):
                    yield from body(env, gen)
                    return
        return choose
    over, body = _value(node.over, filters), _block(node.body, filters)

    def loop(env, gen):
        it, k, none = iter(over(env)), 0, object()
        item = next(it, none)
        while item is not none:
            following = next(it, none)
            inner = env | {node.name: item, "loop": {"index": k + 1, "index0": k, "first": k == 0, "last": following is none}}
            yield from body(inner, gen)
            item, k = following, k + 1
    return loop


def _block(nodes: tuple, filters):
    parts = [_statement(n, filters) for n in nodes]

    def run(env, gen):
        for p in parts:
            yield from p(env, gen)
    return run


def compile_template(source: str, filters: dict[str, Callable] | None = None) -> Callable[[dict], Iterator[tuple[str, bool]]]:
    filters = filters or {}
    body = _block(fold(parse(source), filters), filters)
    return lambda context: body(dict(context), False)
