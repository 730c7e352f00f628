"""A small sandboxed template language, compiled to Python closures.

    {{ expression }}   {% if e %} {% elif e %} {% else %} {% endif %}
    {% for x in e %} {% endfor %}   {% set x = e %}   {% generation %} {% endgeneration %}
    {# comment #}

Expressions know literals, names, ``a.b`` and ``a["b"]`` on mappings, ``loop.index0/index/
first/last``, ``~ +``, comparisons, ``in``, ``and or not``, parentheses and the filters handed
to the compiler.  There are no calls, no attributes of Python objects and no loops but over
given lists, so a template can neither reach out of its data nor run for ever.  A dash inside
a tag (``{%- -%}``) strips white space on its side.

A compiled template takes the data and yields ``(text, generated)`` pieces as it goes, so
an iterator of messages of any length is rendered in bounded memory.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#.*?#\}", re.S)
TOKEN = re.compile(
    r"\s*(?:(\d+)|\"((?:[^\"\\]|\\.)*)\"|'((?:[^'\\]|\\.)*)'|([A-Za-z_]\w*)|(==|!=|<=|>=|[-~+<>().\[\]|=]))",
    re.S,
)
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
CONSTANTS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
WORDS = {"and", "or", "not", "in", "if", "else"}


class TemplateError(ValueError):
    """The template is not in the language, or its data lacks what it names."""


@dataclass(frozen=True)
class Node:
    kind: str
    value: object = None
    parts: tuple = ()


# ---------------------------------------------------------------- expressions


def tokens(source: str) -> list[tuple[str, object]]:
    out, at = [], 0
    while source[at:].strip():
        found = TOKEN.match(source, at)
        if not found:
            raise TemplateError(f"cannot read {source[at:].strip()[:20]!r}")
        number, double, single, name, sign = found.groups()
        if number is not None:
            out.append(("const", int(number)))
        elif double is not None or single is not None:
            body = double if double is not None else single
            out.append(("const", re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), body, flags=re.S)))
        elif name is not None:
            if name in CONSTANTS:
                out.append(("const", CONSTANTS[name]))
            else:
                out.append(("word" if name in WORDS else "name", name))
        else:
            out.append(("sign", sign))
        at = found.end()
    return out


class Expression:
    """Recursive descent, loosest operator first."""

    LEVELS = (("or",), ("and",), ("==", "!=", "<", ">", "<=", ">=", "in"), ("~", "+"))

    def __init__(self, source: str):
        self.left = tokens(source)

    def whole(self) -> Node:
        node = self.choice()
        if self.left:
            raise TemplateError(f"unexpected {self.left[0][1]!r}")
        return node

    def take(self, *values) -> bool:
        if self.left and self.left[0][0] != "const" and self.left[0][1] in values:
            self.taken = self.left.pop(0)[1]
            return True
        return False

    def need(self, value) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} expected")

    def choice(self) -> Node:
        node = self.binary(0)
        if self.take("if"):
            test = self.binary(0)
            self.need("else")
            return Node("choice", None, (test, node, self.choice()))
        return node

    def binary(self, level: int) -> Node:
        if level == 2 and self.take("not"):
            return Node("not", None, (self.binary(2),))
        if level == len(self.LEVELS):
            return self.unary()
        node = self.binary(level + 1)
        while self.take(*self.LEVELS[level]):
            sign = self.taken
            node = Node("binary", sign, (node, self.binary(level + 1)))
        return node

    def unary(self) -> Node:
        node = self.atom()
        while True:
            if self.take("."):
                node = Node("get", None, (node, Node("const", self.name())))
            elif self.take("["):
                node = Node("get", None, (node, self.choice()))
                self.need("]")
            elif self.take("|"):
                node = Node("filter", self.name(), (node,))
            else:
                return node

    def name(self) -> str:
        if not self.left or self.left[0][0] not in ("name", "word"):
            raise TemplateError("name expected")
        return self.left.pop(0)[1]

    def atom(self) -> Node:
        if self.take("("):
            node = self.choice()
            self.need(")")
            return node
        if not self.left or self.left[0][0] not in ("const", "name"):
            raise TemplateError("value expected")
        kind, value = self.left.pop(0)
        return Node(kind, value)


# ------------------------------------------------------------------ statements


def parse(source: str) -> Node:
    """Syntax tree of a template."""
    root: list[Node] = []
    # open blocks: (kind, header, finished branches, body being filled)
    stack: list[tuple[str, object, list, list]] = [("root", None, [], root)]
    at, strip = 0, False
    for tag in TAG.finditer(source):
        text = source[at : tag.start()]
        text = text.lstrip() if strip else text
        dash_left, dash_right = tag[1] or tag[4], tag[3] or tag[6]
        text = text.rstrip() if dash_left else text
        at, strip = tag.end(), bool(dash_right)
        if text:
            stack[-1][3].append(Node("text", text))
        if tag[2] is not None:
            stack[-1][3].append(Node("print", None, (Expression(tag[2]).whole(),)))
        elif tag[5] is not None:
            statement(tag[5].strip(), stack)
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is not closed")
    tail = source[at:].lstrip() if strip else source[at:]
    if tail:
        root.append(Node("text", tail))
    return Node("block", None, tuple(root))


def statement(source: str, stack: list) -> None:
    word, _, rest = source.partition(" ")
    kind, header, done, body = stack[-1]
    if word == "if":
        stack.append(("if", Expression(rest).whole(), [], []))
    elif word == "for":
        found = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)
        if not found or found[1] == "loop":
            raise TemplateError(f"bad loop: {rest}")
        stack.append(("for", (found[1], Expression(found[2]).whole()), [], []))
    elif word == "generation":
        if any(x[0] == "generation" for x in stack):
            raise TemplateError("generation inside generation")
        stack.append(("generation", None, [], []))
    elif word == "set":
        name, _, value = rest.partition("=")
        if not re.fullmatch(r"[A-Za-z_]\w*", name.strip()):
            raise TemplateError(f"bad name: {name}")
        body.append(Node("set", name.strip(), (Expression(value).whole(),)))
    elif word in ("elif", "else") and kind == "if" and header is not None:
        done.append((header, Node("block", None, tuple(body))))
        stack[-1] = ("if", Expression(rest).whole() if word == "elif" else None, done, [])
    elif word == f"end{kind}" and kind != "root":
        stack.pop()
        block = Node("block", None, tuple(body))
        if kind == "if":
            last = block
            branches = done if header is None else [*done, (header, block)]
            node = last if header is None else Node("block")
            for test, branch in reversed(branches):
                node = Node("if", None, (test, branch, node))
        elif kind == "for":
            node = Node("for", header[0], (header[1], block))
        else:
            node = Node("generation", None, (block,))
        stack[-1][3].append(node)
    else:
        raise TemplateError(f"unexpected {word!r}")


# ------------------------------------------------------------- constant folding


def fold(node: Node, filters: Mapping[str, Callable[[str], str]]) -> Node:
    """The same tree with constant parts computed and neighbouring texts joined."""
    parts = tuple(fold(p, filters) for p in node.parts)
    node = Node(node.kind, node.value, parts)
    constant = all(p.kind == "const" for p in parts)
    if node.kind in ("binary", "not", "filter", "choice") and constant:
        return Node("const", expression(node, filters)({}))
    if node.kind == "choice" and parts[0].kind == "const":
        return parts[1] if parts[0].value else parts[2]
    if node.kind == "print" and constant:
        return Node("text", shown(parts[0].value))
    if node.kind == "if" and parts[0].kind == "const":
        return parts[1] if parts[0].value else parts[2]
    if node.kind == "block":
        flat: list[Node] = []
        for part in parts:
            for x in part.parts if part.kind == "block" else (part,):
                if x.kind == "text" and flat and flat[-1].kind == "text":
                    flat[-1] = Node("text", flat[-1].value + x.value)
                elif not (x.kind == "text" and not x.value):
                    flat.append(x)
        return Node("block", None, tuple(flat))
    return node


# --------------------------------------------------------------------- closures


def shown(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


BINARY = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "~": lambda a, b: shown(a) + shown(b),
    "+": lambda a, b: a + b,
}


def expression(node: Node, filters) -> Callable[[dict], object]:
    """Closure from scope to value."""
    kind, value = node.kind, node.value
    parts = [expression(p, filters) for p in node.parts]
    if kind == "const":
        return lambda scope: value
    if kind == "name":
        def look(scope):
            if value not in scope:
                raise TemplateError(f"{value} is not defined")
            return scope[value]

        return look
    if kind == "get":
        inner, key = parts

        def get(scope):
            found = inner(scope)
            if not isinstance(found, Mapping):
                raise TemplateError("only mappings have fields")
            return found.get(key(scope))

        return get
    if kind == "filter":
        if value not in filters:
            raise TemplateError(f"no filter {value}")
        apply, (inner,) = filters[value], parts
        return lambda scope: apply(inner(scope))
    if kind == "not":
        (inner,) = parts
        return lambda scope: not inner(scope)
    if kind == "choice":
        test, yes, no = parts
        return lambda scope: yes(scope) if test(scope) else no(scope)
    left, right = parts
    if value == "and":
        return lambda scope: left(scope) and right(scope)
    if value == "or":
        return lambda scope: left(scope) or right(scope)
    apply = BINARY[value]

    def both(scope):
        try:
            return apply(left(scope), right(scope))
        except TypeError as e:
            raise TemplateError(str(e)) from e

    return both


Piece = tuple[str, bool]


def writer(node: Node, filters, generated: bool = False) -> Callable[[dict], Iterator[Piece]]:
    """Closure from scope to pieces of output; the flag marks text inside generation blocks."""
    kind, value = node.kind, node.value
    if kind == "text":
        piece = (value, generated)
        return lambda scope: iter((piece,))
    if kind == "print":
        inner = expression(node.parts[0], filters)
        return lambda scope: iter(((shown(inner(scope)), generated),))
    if kind == "set":
        inner = expression(node.parts[0], filters)

        def assign(scope):
            scope[value] = inner(scope)
            return iter(())

        return assign
    if kind == "generation":
        return writer(node.parts[0], filters, True)
    if kind == "if":
        test = expression(node.parts[0], filters)
        yes, no = (writer(p, filters, generated) for p in node.parts[1:])
        return lambda scope: yes(scope) if test(scope) else no(scope)
    if kind == "for":
        items, body = expression(node.parts[0], filters), writer(node.parts[1], filters, generated)

        def loop(scope):
            index, source = 0, iter(items(scope))
            item = next(source, loop)
            while item is not loop:
                after = next(source, loop)
                at = {"index0": index, "index": index + 1, "first": index == 0, "last": after is loop}
                yield from body({**scope, value: item, "loop": at})
                index, item = index + 1, after

        return loop
    bodies = [writer(p, filters, generated) for p in node.parts]

    def block(scope):
        for body in bodies:
            yield from body(scope)

    return block


def compile_template(source: str, filters: Mapping[str, Callable] | None = None):
    """Closure from data to an iterator of (text, generated) pieces."""
    filters = dict(filters or {})
    body = writer(fold(parse(source), filters), filters)
    return lambda data: body(dict(data))
