"""A small sandboxed template language, compiled to closures.

``{{ value }}``, ``{% for x in list %}``, ``{% if %}/{% elif %}/{% else %}``, ``{% set x = value %}`` and
``{% generation %}`` for text that a model learns to write. Expressions have strings, integers, ``true/false/none``, names,
``a.b``, ``a['b']``, ``+ ==  != < > <= >= in``, ``not and or``, and filters ``|``. Only mapping items and the loop's own fields can
be reached, only the given filters called: no attributes, calls, imports or assignments to what was passed in.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any

Segment = tuple[str, bool]
Scope = dict[str, Any]
Expression = Callable[[Scope], Any]
Renderer = Callable[[Scope, bool], Iterator[Segment]]


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    base: Any
    key: Any


@dataclass(frozen=True)
class Operation:
    operator: str
    left: Any
    right: Any = None


@dataclass(frozen=True)
class Filtered:
    base: Any
    name: str


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class For:
    name: str
    source: Any
    body: tuple


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body)


@dataclass(frozen=True)
class Assign:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


BLOCK = re.compile(r"\{%(-?)(.*?)(-?)%\}|\{\{(-?)(.*?)(-?)\}\}|\{#.*?#\}", re.S)
TOKEN = re.compile(r"\s*(?:(\d+)|'((?:[^'\\]|\\.)*)'|\"((?:[^\"\\]|\\.)*)\"|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+<>.|()\[\]=]))", re.S)
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
COMPARE: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "+": lambda a, b: a + b,
    "-": lambda a, b: a - b,
}


@dataclass
class Tokens:
    items: list[tuple[str, Any]]
    at: int = 0

    @classmethod
    def of(cls, source: str) -> Tokens:
        items, at = [], 0
        source = source.rstrip()
        while at < len(source):
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            number, single, double, name, sign = m.groups()
            if number is not None:
                items.append(("const", int(number)))
            elif single is not None or double is not None:
                text = single if single is not None else double
                items.append(("const", re.sub(r"\\(.)", lambda e: ESCAPES.get(e[1], e[1]), text, flags=re.S)))
            else:
                items.append(("name", name) if name else ("sign", sign))
            at = m.end()
        return cls(items)

    def peek(self, *values: str) -> bool:
        return self.at < len(self.items) and self.items[self.at][0] != "const" and self.items[self.at][1] in values

    def take(self, *values: str) -> bool:
        if self.peek(*values):
            self.at += 1
            return True
        return False

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} is missing")

    def name(self) -> str:
        if self.at < len(self.items) and self.items[self.at][0] == "name":
            self.at += 1
            return self.items[self.at - 1][1]
        raise TemplateError("a name is missing")

    def end(self) -> None:
        if self.at < len(self.items):
            raise TemplateError(f"unexpected {self.items[self.at][1]!r}")


def _expression(t: Tokens):
    left = _and(t)
    while t.take("or"):
        left = Operation("or", left, _and(t))
    return left


def _and(t: Tokens):
    left = _not(t)
    while t.take("and"):
        left = Operation("and", left, _not(t))
    return left


def _not(t: Tokens):
    return Operation("not", _not(t)) if t.take("not") else _compare(t)


def _compare(t: Tokens):
    left = _sum(t)
    while t.peek("==", "!=", "<", ">", "<=", ">=", "in"):
        operator = t.items[t.at][1]
        t.at += 1
        left = Operation(operator, left, _sum(t))
    return left


def _sum(t: Tokens):
    left = _postfix(t)
    while t.peek("+", "-"):
        operator = t.items[t.at][1]
        t.at += 1
        left = Operation(operator, left, _postfix(t))
    return left


def _postfix(t: Tokens):
    node = _atom(t)
    while True:
        if t.take("."):
            node = Item(node, Const(t.name()))
        elif t.take("["):
            node = Item(node, _expression(t))
            t.need("]")
        elif t.take("|"):
            node = Filtered(node, t.name())
        else:
            return node


def _atom(t: Tokens):
    if t.take("("):
        node = _expression(t)
        t.need(")")
        return node
    if t.at >= len(t.items):
        raise TemplateError("an expression is missing")
    kind, value = t.items[t.at]
    t.at += 1
    if kind == "const":
        return Const(value)
    if kind == "name":
        words = {"true": True, "false": False, "none": None}
        return Const(words[value]) if value in words else Name(value)
    raise TemplateError(f"unexpected {value!r}")


@dataclass
class Parser:
    """Splits the source at its tags and builds the tree; a dash at a tag's edge strips white space on that side."""

    source: str
    parts: list[tuple[str, str]] = field(default_factory=list)
    at: int = 0

    def parse(self) -> tuple:
        place, strip = 0, False
        for m in BLOCK.finditer(self.source):
            text = self.source[place : m.start()]
            text = text.lstrip() if strip else text
            tag, value = m[2] is not None, m[5] is not None
            before, strip = (m[1], m[3]) if tag else (m[4], m[6]) if value else ("", "")
            self.parts.append(("text", text.rstrip() if before else text))
            if tag or value:
                self.parts.append(("tag", m[2]) if tag else ("value", m[5]))
            place = m.end()
        rest = self.source[place:]
        self.parts.append(("text", rest.lstrip() if strip else rest))
        body, stop = self._body(())
        if stop:
            raise TemplateError(f"unexpected {stop}")
        return body

    def _body(self, stops: tuple[str, ...]) -> tuple[tuple, str]:
        nodes = []
        while self.at < len(self.parts):
            kind, content = self.parts[self.at]
            self.at += 1
            if kind == "text":
                if content:
                    nodes.append(Text(content))
            elif kind == "value":
                t = Tokens.of(content)
                nodes.append(Output(_expression(t)))
                t.end()
            else:
                t = Tokens.of(content)
                word = t.name()
                if word in stops:
                    self.at -= 1
                    return tuple(nodes), word
                nodes.append(self._tag(word, t))
        if stops:
            raise TemplateError(f"{stops[-1]} is missing")
        return tuple(nodes), ""

    def _close(self) -> Tokens:
        t = Tokens.of(self.parts[self.at][1])
        self.at += 1
        t.name()
        return t

    def _tag(self, word: str, t: Tokens):
        if word == "set":
            name = t.name()
            t.need("=")
            node = Assign(name, _expression(t))
            t.end()
            return node
        if word == "for":
            name = t.name()
            t.need("in")
            source = _expression(t)
            t.end()
            body, _ = self._body(("endfor",))
            self._close().end()
            return For(name, source, body)
        if word == "generation":
            t.end()
            body, _ = self._body(("endgeneration",))
            self._close().end()
            return Generation(body)
        if word == "if":
            branches, condition, last = [], _expression(t), False
            t.end()
            while True:
                body, stop = self._body(("elif", "else", "endif"))
                branches.append((condition, body))
                t = self._close()
                if stop == "endif":
                    t.end()
                    return If(tuple(branches))
                if last:
                    raise TemplateError("a branch after else")
                last = stop == "else"
                condition = _expression(t) if stop == "elif" else Const(True)
                t.end()
        raise TemplateError(f"unknown tag {word!r}")


def fold(node, filters: dict[str, Callable]):
    """The tree with everything worked out that does not depend on the data; neighbouring texts become one."""
    if isinstance(node, tuple):
        out = []
        for part in (fold(n, filters) for n in node):
            parts = part if isinstance(part, tuple) else (part,)
            for p in parts:
                if isinstance(p, Text) and out and isinstance(out[-1], Text):
                    out[-1] = Text(out[-1].text + p.text)
                elif p != Text(""):
                    out.append(p)
        return tuple(out)
    if isinstance(node, Operation):
        left = fold(node.left, filters)
        if node.operator == "not":
            return Const(not left.value) if isinstance(left, Const) else Operation("not", left)
        right = fold(node.right, filters)
        if node.operator in ("and", "or") and isinstance(left, Const):
            return right if bool(left.value) == (node.operator == "and") else left
        if isinstance(left, Const) and isinstance(right, Const) and node.operator in COMPARE:
            try:
                return Const(COMPARE[node.operator](left.value, right.value))
            except TypeError as e:
                raise TemplateError(str(e)) from e
        return Operation(node.operator, left, right)
    if isinstance(node, Item):
        return Item(fold(node.base, filters), fold(node.key, filters))
    if isinstance(node, Filtered):
        base = fold(node.base, filters)
        if node.name not in filters:
            raise TemplateError(f"unknown filter {node.name!r}")
        return Const(filters[node.name](base.value)) if isinstance(base, Const) else Filtered(base, node.name)
    if isinstance(node, Output):
        value = fold(node.value, filters)
        return Text(_shown(value.value)) if isinstance(value, Const) else Output(value)
    if isinstance(node, If):
        branches = []
        for condition, body in node.branches:
            condition = fold(condition, filters)
            if isinstance(condition, Const) and not condition.value:
                continue
            branches.append((condition, fold(body, filters)))
            if isinstance(condition, Const):
                break
        if not branches:
            return ()
        return branches[0][1] if isinstance(branches[0][0], Const) else If(tuple(branches))
    if isinstance(node, For):
        return For(node.name, fold(node.source, filters), fold(node.body, filters))
    if isinstance(node, Generation):
        body = fold(node.body, filters)
        return Generation(body) if body else ()
    if isinstance(node, Assign):
        return Assign(node.name, fold(node.value, filters))
    return node


def _shown(value: Any) -> str:
    if value is None:
        return ""
    if isinstance(value, str | int):
        return str(value)
    raise TemplateError(f"{type(value).__name__} cannot be shown")


def _item(base: Any, key: Any) -> Any:
    if isinstance(base, dict):
        return base.get(key)
    raise TemplateError(f"{type(base).__name__} has no items")


def _value(node, filters: dict[str, Callable]) -> Expression:
    if isinstance(node, Const):
        return lambda scope, value=node.value: value
    if isinstance(node, Name):
        return lambda scope, name=node.name: scope.get(name)
    if isinstance(node, Item):
        base, key = _value(node.base, filters), _value(node.key, filters)
        return lambda scope: _item(base(scope), key(scope))
    if isinstance(node, Filtered):
        base, call = _value(node.base, filters), filters[node.name]
        return lambda scope: call(base(scope))
    left = _value(node.left, filters)
    if node.operator == "not":
        return lambda scope: not left(scope)
    right = _value(node.right, filters)
    if node.operator == "and":
        return lambda scope: left(scope) and right(scope)
    if node.operator == "or":
        return lambda scope: left(scope) or right(scope)
    call = COMPARE[node.operator]
    return lambda scope: call(left(scope), right(scope))


def _with_place(items: Iterable[Any]) -> Iterator[tuple[Any, dict[str, Any]]]:
    """Each item with its ``loop`` fields; one item is read ahead, so an endless source can be rendered as it comes."""
    source = iter(items or ())
    try:
        held = next(source)
    except StopIteration:
        return
    index = 0
    for item in source:
        yield held, {"index": index + 1, "index0": index, "first": index == 0, "last": False}
        held, index = item, index + 1
    yield held, {"index": index + 1, "index0": index, "first": index == 0, "last": True}


def _body(nodes: tuple, filters: dict[str, Callable]) -> Renderer:
    steps = [_node(n, filters) for n in nodes]

    def run(scope: Scope, learned: bool) -> Iterator[Segment]:
        for step in steps:
            yield from step(scope, learned)

    return steps[0] if len(steps) == 1 else run


def _node(node, filters: dict[str, Callable]) -> Renderer:
    if isinstance(node, Text):
        return lambda scope, learned, text=node.text: iter(((text, learned),))
    if isinstance(node, Output):
        value = _value(node.value, filters)
        return lambda scope, learned: iter(((_shown(value(scope)), learned),))
    if isinstance(node, Generation):
        body = _body(node.body, filters)
        return lambda scope, learned: body(scope, True)
    if isinstance(node, Assign):
        value = _value(node.value, filters)

        def assign(scope: Scope, learned: bool) -> Iterator[Segment]:
            scope[node.name] = value(scope)
            return iter(())

        return assign
    if isinstance(node, If):
        branches = [(_value(c, filters), _body(b, filters)) for c, b in node.branches]

        def choose(scope: Scope, learned: bool) -> Iterator[Segment]:
            for condition, body in branches:
                if condition(scope):
                    return body(scope, learned)
            return iter(())

        return choose
    source, body = _value(node.source, filters), _body(node.body, filters)

    def loop(scope: Scope, learned: bool) -> Iterator[Segment]:
        inner = dict(scope)
        for item, place in _with_place(source(scope)):
            inner[node.name], inner["loop"] = item, place
            yield from body(inner, learned)

    return loop


@dataclass(frozen=True)
class Template:
    tree: tuple
    render: Callable[[Scope], Iterator[Segment]]


def compile_template(source: str, filters: dict[str, Callable[[Any], Any]] | None = None) -> Template:
    """Parse, fold and compile; ``render(scope)`` yields (text, is it to be learned) as the data comes in."""
    filters = {"trim": str.strip, "upper": str.upper, "lower": str.lower} | (filters or {})
    tree = fold(Parser(source).parse(), filters)
    run = _body(tree, filters) if tree else lambda scope, learned: iter(())
    return Template(tree, lambda scope: run(dict(scope), False))
