"""Rules as SQL text. Values keep their kind to the end, so that null, missing and false never mix."""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import SparkSession

from sluicegate.functions import values as v
from sluicegate.plans.analysis import literals
from sluicegate.plans.grammar import And, Array, Call, Compare, Lit, Node, Not, Or, Path, RuleError


@dataclass(frozen=True)
class Value:
    """SQL of a value's kind, string, number text and boolean; els and leaves: of its elements, or None if it's no array."""

    k: str
    s: str
    t: str
    b: str
    els: str | None = None
    leaves: str | None = None
    literal: Lit | None = None

    @staticmethod
    def of(struct: str) -> Value:
        return Value(f"{struct}.k", f"{struct}.s", f"{struct}.t", f"{struct}.b")


NO_STRING, NO_BOOL = "cast(NULL AS STRING)", "cast(NULL AS BOOLEAN)"
_CLASS = {"==": "=", "<": "<", "<=": "<=", ">": ">", ">=": ">="}


def literal(node: Lit) -> Value:
    x = node.value
    if x is None:
        return Value("'Z'", NO_STRING, NO_STRING, NO_BOOL, literal=node)
    if isinstance(x, bool):
        return Value("'B'", v.quoted(str(x).lower()), NO_STRING, str(x).lower(), literal=node)
    if isinstance(x, Decimal):
        try:
            text = v.quoted(v.plain_decimal(x))
        except ValueError as e:
            raise RuleError(str(e)) from None
        return Value("'N'", text, text, NO_BOOL, literal=node)
    number = v.numeric_text(x)
    return Value("'S'", v.quoted(x), NO_STRING if number is None else v.quoted(number), NO_BOOL, literal=node)


def equals(a: Value, b: Value) -> str:
    if a.literal is not None and b.literal is None:
        a, b = b, a
    if b.literal is not None and a.literal is None:
        x = b.literal.value
        if x is None:
            return f"{a.k} = 'Z'"
        if isinstance(x, bool):
            return f"coalesce({a.k} = 'B' AND {a.b} = {b.b}, false)"
        if isinstance(x, Decimal):
            return f"coalesce({a.t} = {b.t}, false)"
        if v.numeric_text(x) is None:
            return f"coalesce({a.k} = 'S' AND {a.s} = {b.s}, false)"
        return f"coalesce(CASE {a.k} WHEN 'N' THEN {a.t} = {b.t} WHEN 'S' THEN {a.s} = {b.s} END, false)"
    return (
        f"coalesce(CASE WHEN {a.k} = 'M' OR {b.k} = 'M' THEN false WHEN {a.k} = 'Z' OR {b.k} = 'Z' THEN {a.k} = {b.k} "
        f"WHEN ({a.k} = 'N' OR {b.k} = 'N') AND {a.t} IS NOT NULL AND {b.t} IS NOT NULL THEN {a.t} = {b.t} "
        f"WHEN {a.k} = 'B' OR {b.k} = 'B' THEN {a.k} = {b.k} AND {a.b} = {b.b} ELSE {a.s} = {b.s} END, false)"
    )


def compares(op: str, a: Value, b: Value) -> str:
    numbers = f"coalesce(try_cast({a.t} AS DECIMAL(38,18)) {op} try_cast({b.t} AS DECIMAL(38,18)), try_cast({a.t} AS DOUBLE) {op} try_cast({b.t} AS DOUBLE))"
    return (
        f"coalesce(CASE WHEN {a.k} IN ('M', 'Z', 'A', 'O') OR {b.k} IN ('M', 'Z', 'A', 'O') THEN false "
        f"WHEN {a.t} IS NOT NULL AND {b.t} IS NOT NULL THEN {numbers} ELSE {a.s} {op} {b.s} END, false)"
    )


def any_leaf(a: Value, test: Callable[[Value], str]) -> str:
    """test of a value, or of any leaf of an array."""
    if a.leaves is None:
        return test(a)
    e = f"x{next(v._names)}"
    return f"CASE WHEN {a.k} = 'A' THEN exists({a.leaves}, {e} -> {test(Value.of(e))}) ELSE {test(a)} END"


def each_item(b: Value, test: Callable[[Value], str]) -> str:
    """Whether test holds for an item of an array; false for what is none."""
    if b.els is None:
        return "false"
    e = f"x{next(v._names)}"
    return f"coalesce(CASE WHEN {b.k} = 'A' THEN exists({b.els}, {e} -> {test(Value.of(e))}) ELSE false END, false)"


def _folded(start: str, end: str) -> Callable[[str, str], str]:
    """A test of strings that ignores case, code point by code point."""

    def test(s: str, needle: str) -> str:
        quoted = f"concat('(?iu){start}\\\\Q', replace({needle}, '\\\\E', '\\\\E\\\\\\\\E\\\\Q'), '\\\\E{end}')"
        return f"coalesce({s} RLIKE {quoted}, false)"

    return test


def _plain(function: str) -> Callable[[str, str], str]:
    return lambda s, needle: f"coalesce({function}({s}, {needle}), false)"


#: How the first word of a function's name compares two strings, with and without case.
_TESTS = {
    "contains": (_plain("contains"), _folded("", "")),
    "startswith": (_plain("startswith"), _folded("\\\\A", "")),
    "endswith": (_plain("endswith"), _folded("", "\\\\z")),
    "equals": (None, _folded("\\\\A", "\\\\z")),
}


def checked_pattern(pattern: str, at: int) -> None:
    """Raises RuleError for a pattern that the JVM doesn't take."""
    spark = SparkSession.getActiveSession()
    try:
        if spark is not None:
            spark._jvm.java.util.regex.Pattern.compile(pattern)
        else:
            re.compile(pattern)
    except Exception as e:
        raise RuleError(f"bad pattern: {str(e).splitlines()[0]}", at) from None


def network(text: str, at: int = 0) -> ipaddress.IPv4Network | ipaddress.IPv6Network:
    """A literal address/prefix; host bits may be set."""
    address, slash, prefix = text.strip().partition("/")
    if not slash or not re.fullmatch(r"[0-9]{1,3}", prefix.strip()):
        raise RuleError(f"bad network {text!r}", at)
    if re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", address.strip()):
        address = ".".join(str(int(x)) for x in address.strip().split("."))
    try:
        return ipaddress.ip_network(f"{address.strip()}/{int(prefix)}", strict=False)
    except ValueError:
        raise RuleError(f"bad network {text!r}", at) from None


def in_network(s: str, net: ipaddress.IPv4Network | ipaddress.IPv6Network) -> str:
    if net.version == 4:
        shift = 32 - net.prefixlen
        return f"coalesce(shiftright({v.ipv4(s)}, {shift}) = {int(net.network_address) >> shift}L, false)"
    first = format(int(net.network_address), "0128b")[: net.prefixlen]
    return f"coalesce({v.let(v.ipv6(s), lambda h: f'CASE WHEN {h} IS NOT NULL THEN substring({v.bits(h)}, 1, {net.prefixlen}) = {v.quoted(first)} END')}, false)"


def in_dynamic_network(s: str, net: str) -> str:
    """As in_network with a network that is only known per row: null if that is none."""
    address, prefix = f"split_part({net}, '/', 1)", f"try_cast({v.trimmed(f'split_part({net}, {v.quoted(chr(47))}, 2)')} AS INT)"
    one = f"length({net}) - length(replace({net}, '/', '')) = 1 AND {v.trimmed(f'split_part({net}, {v.quoted(chr(47))}, 2)')} RLIKE '^[0-9]{{1,3}}$'"
    four, six = v.ipv4(address), v.ipv6(address)
    in4 = v.let(four, lambda n: f"coalesce(shiftright({v.ipv4(s)}, 32 - {prefix}) = shiftright({n}, 32 - {prefix}), false)")
    in6 = v.let(six, lambda h: f"coalesce({v.let(v.ipv6(s), lambda g: f'substring({v.bits(g)}, 1, {prefix}) = substring({v.bits(h)}, 1, {prefix})')}, false)")
    return f"CASE WHEN {one} THEN CASE WHEN {four} IS NOT NULL AND {prefix} <= 32 THEN {in4} WHEN {six} IS NOT NULL AND {prefix} <= 128 THEN {in6} END END"


class Compiler:
    """Trees to SQL over the columns p0_k, p0_s ... of the paths; patterns: (strings, pattern) of the columns d0, d1 ..."""

    def __init__(self, paths: tuple[Path, ...]) -> None:
        self.columns = {p: f"p{i}" for i, p in enumerate(paths)}
        self.patterns: list[tuple[str, str]] = []

    def value(self, node: Node) -> Value:
        match node:
            case Lit():
                return literal(node)
            case Path():
                c = self.columns[node]
                return Value(f"{c}_k", f"{c}_s", f"{c}_t", f"{c}_b", f"{c}_els", f"{c}_leaves")
            case Array(items):
                made = [self.value(x) for x in items]
                if not made:
                    els = "cast(array() AS array<struct<k:string,s:string,t:string,b:boolean>>)"
                    return Value("'A'", NO_STRING, NO_STRING, NO_BOOL, els, els)
                own = [f"named_struct('k', {x.k}, 's', {x.s}, 't', {x.t}, 'b', {x.b})" for x in made]
                within = [f"array({o})" if x.leaves is None else f"CASE WHEN {x.k} = 'A' THEN {x.leaves} ELSE array({o}) END" for x, o in zip(made, own)]
                return Value("'A'", NO_STRING, NO_STRING, NO_BOOL, f"array({', '.join(own)})", f"flatten(array({', '.join(within)}))")
            case Call("lower" | "upper" as name, (inner,)):
                s = f"{name}({self.value(inner).s})"
                return Value(f"CASE WHEN {s} IS NULL THEN 'Z' ELSE 'S' END", s, v.canonical(s), NO_BOOL)
        b = self.test(node)
        return Value("'B'", f"CASE WHEN {b} THEN 'true' ELSE 'false' END", NO_STRING, b)

    def test(self, node: Node) -> str:
        """A boolean that is never null; values that aren't the boolean true are false."""
        match node:
            case Lit(x):
                return "true" if x is True else "false"
            case Path():
                return f"coalesce({self.columns[node]}_b, false)"
            case Array() | Call("lower" | "upper"):
                return "false"
            case Not(inner):
                return f"NOT ({self.test(inner)})"
            case And(terms):
                return "(" + " AND ".join(f"({self.test(t)})" for t in terms) + ")"
            case Or(left, right):
                return f"(({self.test(left)}) OR ({self.test(right)}))"
            case Compare("==" | "!=" as op, left, right):
                same = equals(self.value(left), self.value(right))
                return same if op == "==" else f"NOT ({same})"
            case Compare(op, left, right):
                return compares(_CLASS[op], self.value(left), self.value(right))
            case Call(name, args, at):
                return self.call(name, args, at)
        raise TypeError(node)

    def call(self, name: str, args: tuple[Node, ...], at: int) -> str:
        if name == "exists":
            return f"{self.value(args[0]).k} <> 'M'"
        if name == "isnull":
            return f"{self.value(args[0]).k} = 'Z'"
        if name in ("isip", "isipv4", "isipv6"):
            forms = {"isip": (v.ipv4, v.ipv6), "isipv4": (v.ipv4,), "isipv6": (v.ipv6,)}[name]
            return any_leaf(self.value(args[0]), lambda x: "(" + " OR ".join(f"{f(x.s)} IS NOT NULL" for f in forms) + ")")
        first = self.value(args[0])
        if name == "in":
            if (given := literals(args[1])) is not None:
                return any_leaf(first, lambda x: "(" + (" OR ".join(equals(x, literal(g)) for g in given) or "false") + ")")
            other = self.value(args[1])
            return any_leaf(first, lambda x: each_item(other, lambda y: equals(x, y)))
        if name == "matchesregex":
            if isinstance(args[1], Lit):
                if not isinstance(args[1].value, str):
                    raise RuleError("a pattern must be a string", at)
                checked_pattern(args[1].value, at)
                return any_leaf(first, lambda x: f"coalesce({x.s} RLIKE {v.quoted(args[1].value)}, false)")
            pattern = self.value(args[1]).s
            # an invalid pattern of a row must be false, and RLIKE would end the query
            return self.dynamic_pattern(first, pattern)
        if name == "cidrcontains":
            if isinstance(args[1], Lit):
                if not isinstance(args[1].value, str):
                    raise RuleError("a network must be a string", at)
                net = network(args[1].value, at)
                return any_leaf(first, lambda x: in_network(x.s, net))
            other = self.value(args[1]).s
            return any_leaf(first, lambda x: f"coalesce({in_dynamic_network(x.s, other)}, false)")
        if name == "cidrcontainsany":
            if (given := literals(args[1])) is not None:
                if not all(isinstance(g.value, str) for g in given):
                    raise RuleError("networks must be strings", at)
                nets = [network(g.value, at) for g in given]
                return any_leaf(first, lambda x: "(" + (" OR ".join(in_network(x.s, n) for n in nets) or "false") + ")")
            other = self.value(args[1])
            if other.els is None:
                return "false"
            e, f = f"x{next(v._names)}", f"x{next(v._names)}"
            valid = f"forall({other.els}, {e} -> {e}.s IS NULL OR {in_dynamic_network(v.quoted('0.0.0.0'), f'{e}.s')} IS NOT NULL)"
            hit = lambda x: f"exists({other.els}, {f} -> {f}.s IS NOT NULL AND coalesce({in_dynamic_network(x.s, f'{f}.s')}, false))"
            return any_leaf(first, lambda x: f"coalesce(CASE WHEN {other.k} = 'A' AND {valid} THEN {hit(x)} ELSE false END, false)")
        kind = next(k for k in _TESTS if name.startswith(k))
        test = _TESTS[kind][name.endswith("ignorecase")]
        second = self.value(args[1])
        if name == "equalsignorecase":
            return any_leaf(first, lambda x: any_leaf(second, lambda y: test(x.s, y.s)))
        if "any" in name:
            return any_leaf(first, lambda x: each_item(second, lambda y: test(x.s, y.s)))
        if name == "contains":
            whole = test(first.s, second.s)
            if first.els is None:
                return whole
            return f"coalesce(CASE WHEN {first.k} = 'A' THEN {each_item(first, lambda y: equals(y, second))} AND {second.k} NOT IN ('M', 'Z') ELSE {whole} END, false)"
        return any_leaf(first, lambda x: test(x.s, second.s))

    def dynamic_pattern(self, first: Value, pattern: str) -> str:
        """A column of its own: an Arrow UDF over all strings of the value and the pattern."""
        e = f"x{next(v._names)}"
        name = f"d{len(self.patterns)}"
        strings = f"array({first.s})" if first.leaves is None else f"CASE WHEN {first.k} = 'A' THEN transform({first.leaves}, {e} -> {e}.s) ELSE array({first.s}) END"
        self.patterns.append((strings, pattern))
        return name
