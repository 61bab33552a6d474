"""Rule text to a syntax tree.

or := and ("||" and)*; and := comparison ("&&" comparison)*; comparison := unary [op unary];
unary := "!" unary | primary; primary := number | string | true | false | null | "(" or ")" |
"[" [or ("," or)*] "]" | name "(" [or ("," or)*] ")" | path.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from decimal import Decimal, InvalidOperation


class RuleError(ValueError):
    """A rule that doesn't compile, with the place in its text."""

    def __init__(self, message: str, at: int = 0) -> None:
        super().__init__(f"{message} (at {at})")
        self.at = at


class Node:
    """A part of a rule."""


@dataclass(frozen=True)
class Lit(Node):
    value: Decimal | str | bool | None


@dataclass(frozen=True)
class Path(Node):
    parts: tuple[str, ...]


@dataclass(frozen=True)
class Array(Node):
    items: tuple[Node, ...]


@dataclass(frozen=True)
class Compare(Node):
    op: str
    left: Node
    right: Node


@dataclass(frozen=True)
class Not(Node):
    inner: Node


@dataclass(frozen=True)
class And(Node):
    terms: tuple[Node, ...]


@dataclass(frozen=True)
class Or(Node):
    left: Node
    right: Node


@dataclass(frozen=True)
class Call(Node):
    name: str
    args: tuple[Node, ...]
    at: int = 0


#: The functions of the language with their numbers of arguments and costs.
FUNCTIONS = {
    "contains": (2, 35), "containsany": (2, 35), "startswith": (2, 30), "startswithany": (2, 30), "endswith": (2, 30), "endswithany": (2, 30),
    "containsignorecase": (2, 35), "containsanyignorecase": (2, 35), "startswithignorecase": (2, 30), "startswithanyignorecase": (2, 30),
    "endswithignorecase": (2, 30), "endswithanyignorecase": (2, 30), "equalsignorecase": (2, 20), "matchesregex": (2, 100),
    "exists": (1, 2), "isnull": (1, 2), "in": (2, 4), "lower": (1, 20), "upper": (1, 20), "cidrcontains": (2, 45), "cidrcontainsany": (2, 45),
    "isip": (1, 10), "isipv4": (1, 10), "isipv6": (1, 10),
}
_ESCAPES = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t"}
_SCAN = re.compile(
    r"(?P<space>\s+)|(?P<number>-?[0-9]+(?:\.[0-9]*)?(?:[eE][+-]?[0-9]*)?)|(?P<name>[^\W\d][\w.@]*|@[\w.@]*)"
    r"|(?P<op>\|\||&&|==|!=|<=|>=|[!<>()\[\],])|(?P<quote>[\"'])"
)


def _string(text: str, start: int) -> tuple[str, int]:
    quote, out, i = text[start], [], start + 1
    while i < len(text):
        c = text[i]
        if c == quote:
            return "".join(out), i + 1
        if c == "\\" and i + 1 < len(text):
            i += 1
            c = text[i]
            if c == "u":
                digits = text[i + 1 : i + 5]
                if not re.fullmatch(r"[0-9a-fA-F]{4}", digits):
                    raise RuleError("bad unicode escape", i)
                out.append(chr(int(digits, 16)))
                i += 4
            else:
                out.append(_ESCAPES.get(c, c))
        else:
            out.append(c)
        i += 1
    raise RuleError("unterminated string", start)


def scan(text: str) -> list[tuple[str, object, int]]:
    """(kind, value, place) of every token; the last has the kind end."""
    out, i = [], 0
    while i < len(text):
        m = _SCAN.match(text, i)
        if not m:
            raise RuleError(f"unexpected {text[i]!r}", i)
        kind, start = m.lastgroup, i
        i = m.end()
        if kind == "number":
            try:
                out.append((kind, Decimal(m[0]), start))
            except InvalidOperation:
                raise RuleError(f"bad number {m[0]}", start) from None
        elif kind == "quote":
            value, i = _string(text, start)
            out.append(("string", value, start))
        elif kind != "space":
            out.append((kind, m[0], start))
    return [*out, ("end", "", len(text))]


class _Parser:
    def __init__(self, text: str) -> None:
        self.tokens, self.i = scan(text), 0

    @property
    def next(self) -> tuple[str, object, int]:
        return self.tokens[self.i]

    def take(self, *ops: str) -> str | None:
        kind, value, _ = self.next
        if kind == "op" and value in ops:
            self.i += 1
            return value
        return None

    def need(self, op: str) -> None:
        if not self.take(op):
            raise RuleError(f"expected {op}", self.next[2])

    def disjunction(self) -> Node:
        left = self.conjunction()
        while self.take("||"):
            left = Or(left, self.conjunction())
        return left

    def conjunction(self) -> Node:
        terms = [self.comparison()]
        while self.take("&&"):
            terms.append(self.comparison())
        return And(tuple(terms)) if len(terms) > 1 else terms[0]

    def comparison(self) -> Node:
        left = self.unary()
        op = self.take("==", "!=", "<", "<=", ">", ">=")
        return Compare(op, left, self.unary()) if op else left

    def unary(self) -> Node:
        return Not(self.unary()) if self.take("!") else self.primary()

    def several(self, close: str) -> tuple[Node, ...]:
        items: list[Node] = []
        if not self.take(close):
            items.append(self.disjunction())
            while self.take(","):
                items.append(self.disjunction())
            self.need(close)
        return tuple(items)

    def primary(self) -> Node:
        kind, value, at = self.next
        if kind in ("number", "string"):
            self.i += 1
            return Lit(value)
        if self.take("("):
            inner = self.disjunction()
            self.need(")")
            return inner
        if self.take("["):
            return Array(self.several("]"))
        if kind != "name":
            raise RuleError("expected a value", at)
        self.i += 1
        if value in ("true", "false", "null"):
            return Lit({"true": True, "false": False, "null": None}[value])
        if self.take("("):
            args = self.several(")")
            name = value.lower()
            if name not in FUNCTIONS:
                raise RuleError(f"unknown function {value}", at)
            if len(args) != FUNCTIONS[name][0]:
                raise RuleError(f"{value} takes {FUNCTIONS[name][0]} arguments", at)
            return Call(name, args, at)
        parts = value.split(".")
        while len(parts) > 1 and not parts[-1]:
            parts.pop()
        if not all(parts):
            raise RuleError(f"empty part in path {value}", at)
        return Path(tuple(parts))


def parse(text: str) -> Node:
    if not text or not text.strip():
        raise RuleError("empty rule")
    p = _Parser(text)
    tree = p.disjunction()
    if p.next[0] != "end":
        raise RuleError("expected the end of the rule", p.next[2])
    return tree
