"""What a rule's tree tells before it runs: cost, order of terms, paths, index anchors, limits of rule sets."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

from sluicegate.plans.grammar import FUNCTIONS, And, Array, Call, Compare, Lit, Node, Not, Or, Path, RuleError, parse

#: Limits of a rule set and the form of a rule's name.
MAX_RULES, MAX_UNINDEXED = 500, 25
NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]{0,127}")


def literals(node: Node) -> tuple[Lit, ...] | None:
    """The items of an array that has only literals."""
    return node.items if isinstance(node, Array) and all(isinstance(x, Lit) for x in node.items) else None


def cost(node: Node) -> int:
    match node:
        case Lit():
            return 0
        case Path() | Array():
            return 1
        case Compare(op):
            return 3 if op in ("==", "!=") else 6
        case Not(inner):
            return cost(inner) + 1
        case And(terms):
            return sum(map(cost, terms))
        case Or(left, right):
            return cost(left) + cost(right) + 2
        case Call("in", (_, second)) if literals(second) is not None:
            return 3
        case Call("cidrcontains", (_, Lit())):
            return 35
        case Call("cidrcontainsany", (_, second)) if literals(second) is not None:
            return 35
        case Call(name):
            return FUNCTIONS[name][1]
    raise TypeError(node)


def ordered(node: Node) -> Node:
    """The tree with the terms of every conjunction by cost, cheapest first; equal costs keep their order."""
    match node:
        case And(terms):
            return And(tuple(sorted(map(ordered, terms), key=cost)))
        case Or(left, right):
            return Or(ordered(left), ordered(right))
        case Not(inner):
            return Not(ordered(inner))
        case Compare(op, left, right):
            return Compare(op, ordered(left), ordered(right))
        case Call(name, args, at):
            return Call(name, tuple(map(ordered, args)), at)
        case Array(items):
            return Array(tuple(map(ordered, items)))
    return node


def children(node: Node) -> tuple[Node, ...]:
    match node:
        case And(terms):
            return terms
        case Or(left, right) | Compare(_, left, right):
            return left, right
        case Not(inner):
            return (inner,)
        case Call(_, args) | Array(args):
            return args
    return ()


def paths(node: Node) -> Iterator[Path]:
    """Paths in the order of the text; repeated ones too."""
    if isinstance(node, Path):
        yield node
    for child in children(node):
        yield from paths(child)


def anchors(node: Node) -> dict[Path, set[Lit]]:
    """Paths with the values of which one at least must stand there for the rule to be true.

    From path == literal, literal == path and in(path, [literals]), joined over a conjunction.
    """
    match node:
        case Compare("==", Path() as p, Lit() as v) | Compare("==", Lit() as v, Path() as p):
            return {p: {v}}
        case Call("in", (Path() as p, second)) if (values := literals(second)) is not None:
            return {p: set(values)}
        case And(terms):
            out: dict[Path, set[Lit]] = {}
            for t in terms:
                for p, values in anchors(t).items():
                    out.setdefault(p, set()).update(values)
            return out
    return {}


@dataclass(frozen=True)
class Rule:
    name: str
    text: str
    tree: Node
    anchors: dict[Path, set[Lit]] = field(compare=False)

    @property
    def indexed(self) -> bool:
        return any(self.anchors.values())


@dataclass(frozen=True)
class RuleSet:
    """Rules in the order of their names; paths: each once, in the order of the rules."""

    rules: tuple[Rule, ...]
    paths: tuple[Path, ...]

    @property
    def anchor_paths(self) -> set[Path]:
        return {p for r in self.rules for p in r.anchors}

    @property
    def unindexed(self) -> int:
        return sum(not r.indexed for r in self.rules)


def compile_rules(rules: Mapping[str, str], max_rules: int = MAX_RULES, max_unindexed: int = MAX_UNINDEXED) -> RuleSet:
    """Parses and checks a set of named rules; raises RuleError."""
    if max_unindexed > max_rules:
        raise RuleError("more unindexed rules allowed than rules")
    if len(rules) > max_rules:
        raise RuleError(f"{len(rules)} rules; {max_rules} are allowed")
    made = []
    for name in sorted(rules, key=lambda n: n.encode("utf-16-be")):
        if not NAME.fullmatch(name):
            raise RuleError(f"bad rule name {name!r}")
        tree = ordered(parse(rules[name]))
        made.append(Rule(name, rules[name], tree, anchors(tree)))
    found = RuleSet(tuple(made), tuple(dict.fromkeys(p for r in made for p in paths(r.tree))))
    if found.unindexed > max_unindexed:
        raise RuleError(f"{found.unindexed} unindexed rules; {max_unindexed} are allowed")
    return found
