"""A small sandboxed template language, compiled to closures.

Statements: ``{% for x in e %} {% endfor %}``, ``{% if e %} {% elif e %} {% else %} {% endif %}``,
``{% set x = e %}``, ``{% generation %} {% endgeneration %}``; output: ``{{ e }}``; comments: ``{# #}``. A ``-``
inside the braces (``{%- -%}``, ``{{- -}}``, ``{#- -#}``) takes the blanks on its side away. Expressions:
strings, numbers, ``true false none``, names, ``x.key``, ``x[e]``, ``+ ~ == != in not and or``,
brackets, and filters ``e | name``. Names reach only what the caller passes, keys only the items of
mappings and lists: no attribute of a Python object can be read and nothing called.

The syntax tree's constants are folded (operators and filters over constants, branches of constant
conditions, neighbouring texts), then each node becomes a generator function over an environment. A
loop reads its items one at a time, so a template renders as its messages come.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from enum import Enum


class Mark(Enum):
    """In the rendered stream, around what the assistant generated."""

    BEGIN = 1
    END = 2


BEGIN, END = Mark.BEGIN, Mark.END
_CUT = re.compile(r"(?:\s*\{\{-|\{\{)(.*?)(?:-\}\}\s*|\}\})|(?:\s*\{%-|\{%)(.*?)(?:-%\}\s*|%\})|(?:\s*\{#-|\{#).*?(?:-#\}\s*|#\})", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<num>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[-+~.|()\[\]=]))""")
_PLAIN = {"n": "\n", "t": "\t", "r": "\r"}


class TemplateError(ValueError):
    pass


class _Expressions:
    """Recursive descent over one expression's tokens; nodes are tuples."""

    def __init__(self, text: str) -> None:
        self.tokens: list[tuple[str, str]] = []
        at = 0
        text = text.rstrip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise TemplateError(f"cannot read {text[at:]!r}")
            self.tokens.append((m.lastgroup or "", m[m.lastgroup or 0]))
            at = m.end()

    def take(self, *words: str) -> str | None:
        if self.tokens and self.tokens[0][0] != "str" and self.tokens[0][1] in words:
            return self.tokens.pop(0)[1]
        return None

    def need(self, word: str) -> None:
        if not self.take(word):
            raise TemplateError(f"{word!r} expected before {self.tokens[:1]}")

    def name(self) -> str:
        if not self.tokens or self.tokens[0][0] != "name":
            raise TemplateError(f"a name expected before {self.tokens[:1]}")
        return self.tokens.pop(0)[1]

    def whole(self) -> tuple:
        node = self.either()
        if self.tokens:
            raise TemplateError(f"not expected: {self.tokens[0][1]!r}")
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        node = self.added()
        while op := self.take("==", "!=", "in"):
            node = (op, node, self.added())
        return node

    def added(self) -> tuple:
        node = self.filtered()
        while op := self.take("+", "~"):
            node = (op, node, self.filtered())
        return node

    def filtered(self) -> tuple:
        node = self.atom()
        while self.take("|"):
            node = ("filter", self.name(), node)
        return node

    def atom(self) -> tuple:
        if not self.tokens:
            raise TemplateError("an expression is missing")
        if self.take("("):
            node = self.either()
            self.need(")")
        else:
            kind, word = self.tokens.pop(0)
            if kind == "str":
                node = ("const", re.sub(r"\\(.)", lambda m: _PLAIN.get(m[1], m[1]), word[1:-1], flags=re.S))
            elif kind == "num":
                node = ("const", int(word))
            elif kind == "name":
                node = ("const", {"true": True, "false": False, "none": None}[word.lower()]) if word.lower() in ("true", "false", "none") else ("name", word)
            else:
                raise TemplateError(f"not expected: {word!r}")
        while True:
            if self.take("."):
                node = ("item", node, ("const", self.name()))
            elif self.take("["):
                node = ("item", node, self.either())
                self.need("]")
            else:
                return node


def parse(source: str) -> list:
    """The syntax tree: a list of text, output, for, if, set and generation nodes."""
    stack: list[tuple[str, list, tuple]] = [("", [], ())]
    at = 0
    for m in _CUT.finditer(source):
        if m.start() > at:
            stack[-1][1].append(("text", source[at : m.start()]))
        at = m.end()
        if m[1] is not None:
            stack[-1][1].append(("out", _Expressions(m[1]).whole()))
            continue
        if m[2] is None:  # a comment
            continue
        e = _Expressions(m[2])
        word = e.name()
        if word == "for":
            name = e.name()
            e.need("in")
            stack.append(("for", [], (name, e.whole())))
        elif word == "if":
            stack.append(("if", [], ([], e.whole())))
        elif word in ("elif", "else"):
            kind, body, (done, test) = stack.pop()
            if kind != "if" or test is None:
                raise TemplateError(f"{word} without if")
            stack.append(("if", [], ([*done, (test, body)], e.whole() if word == "elif" else None)))
        elif word == "set":
            name = e.name()
            e.need("=")
            stack[-1][1].append(("set", name, e.whole()))
        elif word == "generation":
            stack.append(("generation", [], ()))
        elif word.startswith("end") and len(stack) > 1 and word[3:] == stack[-1][0]:
            kind, body, head = stack.pop()
            if kind == "if":
                done, test = head
                node: tuple = ("if", [*done, (("const", True) if test is None else test, body)])
            else:
                node = (kind, *head, body)
            stack[-1][1].append(node)
        else:
            raise TemplateError(f"not expected: {word}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} has no end")
    if at < len(source):
        stack[0][1].append(("text", source[at:]))
    return stack[0][1]


def _text(x: object) -> str:
    return "" if x is None else x if isinstance(x, str) else str(x)


def _item(x: object, key: object) -> object:
    if isinstance(x, Mapping):
        return x.get(key)
    if isinstance(x, (list, tuple)) and isinstance(key, int) and -len(x) <= key < len(x):
        return x[key]
    return None


_BINARY: dict[str, Callable] = {"+": lambda a, b: a + b, "~": lambda a, b: _text(a) + _text(b), "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "in": lambda a, b: a in b, "item": _item}


def _fold(node: tuple, filters: Mapping[str, Callable]) -> tuple:
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind == "filter":
        if node[1] not in filters:
            raise TemplateError(f"no filter {node[1]}")
        inner = _fold(node[2], filters)
        return ("const", filters[node[1]](inner[1])) if inner[0] == "const" else ("filter", node[1], inner)
    if kind == "not":
        inner = _fold(node[1], filters)
        return ("const", not inner[1]) if inner[0] == "const" else ("not", inner)
    a, b = _fold(node[1], filters), _fold(node[2], filters)
    if kind in ("and", "or"):
        if a[0] == "const":
            return b if bool(a[1]) == (kind == "and") else a
        return (kind, a, b)
    if a[0] == b[0] == "const":
        return ("const", _BINARY[kind](a[1], b[1]))
    if kind == b[0] == "+" and a[0] == b[1][0] == "const":
        return ("+", ("const", a[1] + b[1][1]), b[2])
    return (kind, a, b)


def fold(nodes: list, filters: Mapping[str, Callable]) -> list:
    """The tree with its constants evaluated and neighbouring texts joined."""
    out: list[tuple] = []
    for node in nodes:
        kind = node[0]
        if kind == "out":
            e = _fold(node[1], filters)
            node = ("text", _text(e[1])) if e[0] == "const" else ("out", e)
        elif kind == "set":
            node = ("set", node[1], _fold(node[2], filters))
        elif kind == "for":
            node = ("for", node[1], _fold(node[2], filters), fold(node[3], filters))
        elif kind == "generation":
            node = ("generation", fold(node[1], filters))
        elif kind == "if":
            arms = []
            for test, body in node[1]:
                test = _fold(test, filters)
                if test[0] != "const" or test[1]:
                    arms.append((test, fold(body, filters)))
                if test[0] == "const" and test[1]:
                    break
            if arms and arms[0][0][0] == "const":
                for x in arms[0][1]:
                    _append(out, x)
                continue
            if not arms:
                continue
            node = ("if", arms)
        _append(out, node)
    return out


def _append(out: list, node: tuple) -> None:
    if node[0] == "text" and out and out[-1][0] == "text":
        out[-1] = ("text", out[-1][1] + node[1])
    elif node != ("text", ""):
        out.append(node)


def _value(node: tuple, filters: Mapping[str, Callable]) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "const":
        return lambda env, c=node[1]: c
    if kind == "name":
        return lambda env, n=node[1]: env.get(n)
    if kind == "filter":
        f, inner = filters[node[1]], _value(node[2], filters)
        return lambda env: f(inner(env))
    if kind == "not":
        inner = _value(node[1], filters)
        return lambda env: not inner(env)
    a, b = _value(node[1], filters), _value(node[2], filters)
    if kind == "and":
        return lambda env: a(env) and b(env)
    if kind == "or":
        return lambda env: a(env) or b(env)
    f = _BINARY[kind]
    return lambda env: f(a(env), b(env))


_Part = Callable[[dict], Iterator]


def _closure(node: tuple, filters: Mapping[str, Callable]) -> _Part:
    kind = node[0]
    if kind == "text":
        return lambda env, t=(node[1],): iter(t)
    if kind == "out":
        value = _value(node[1], filters)
        return lambda env: iter((_text(value(env)),))
    if kind == "set":
        name, value = node[1], _value(node[2], filters)

        def put(env: dict) -> Iterator:
            env[name] = value(env)
            return iter(())

        return put
    if kind == "generation":
        body = _sequence(node[1], filters)

        def generated(env: dict) -> Iterator:
            yield BEGIN
            yield from body(env)
            yield END

        return generated
    if kind == "if":
        arms = [(_value(test, filters), _sequence(body, filters)) for test, body in node[1]]

        def chosen(env: dict) -> Iterator:
            for test, body in arms:
                if test(env):
                    return body(env)
            return iter(())

        return chosen
    name, items, body = node[1], _value(node[2], filters), _sequence(node[3], filters)

    def looped(env: dict) -> Iterator:
        rest = iter(items(env) or ())
        now = next(rest, END)
        i = 0
        while now is not END:
            after = next(rest, END)
            yield from body({**env, name: now, "loop": {"index0": i, "index": i + 1, "first": i == 0, "last": after is END}})
            now, i = after, i + 1

    return looped


def _sequence(nodes: list, filters: Mapping[str, Callable]) -> _Part:
    parts = [_closure(n, filters) for n in nodes]

    def run(env: dict) -> Iterator:
        for part in parts:
            yield from part(env)

    return run


def compile_template(source: str, filters: Mapping[str, Callable]) -> Callable[..., Iterable]:
    """``render(**names)``: a stream of texts and of the marks ``BEGIN`` and ``END``."""
    run = _sequence(fold(parse(source), filters), filters)
    return lambda **names: run(dict(names))
