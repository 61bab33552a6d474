"""Drop rules over JSON events: the first true rule of an event, in the order of names, drops it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.functions import rules as sql
from sluicegate.functions import values as v
from sluicegate.plans.analysis import RuleSet, compile_rules
from sluicegate.plans.grammar import Path, RuleError

#: What happens to an event that can't be evaluated.
POLICIES = ("KEEP_EVENT", "DROP_EVENT", "CLOSE_CONNECTION")
EVALUATION_ERROR = "evaluation_error"
#: How much of a container may be read for one event.
MAX_DEPTH, MAX_NODES, MAX_CHARS = 32, 16_384, 2_097_152


def pointer(text: str) -> Path:
    """/a/b as a path; ~1 is a slash and ~0 a tilde."""
    if not text.startswith("/") or any(not p for p in text[1:].split("/")):
        raise RuleError(f"bad pointer {text!r}")
    return Path(tuple(p.replace("~1", "/").replace("~0", "~") for p in text[1:].split("/")))


def pointers(texts: Sequence[str]) -> list[Path]:
    if len(set(texts)) != len(texts):
        raise RuleError("a pointer stands twice")
    return [pointer(t) for t in texts]


def _key(part: str) -> str:
    return "['" + part.replace("\\", "\\\\").replace("'", "\\'") + "']"


def json_path(path: Path) -> str:
    return "$" + "".join(_key(p) for p in path.parts)


def _with_doc(events: DataFrame, raw: str) -> DataFrame:
    """events with _doc, the event as a VARIANT; null unless the text is exactly one JSON object.

    parse_json ignores what follows a value. Text that is whole within brackets and within an object
    can't be closed early in both, so two parses tell. Bytes that aren't UTF-8 are no JSON.
    """
    here = F.monotonically_increasing_id() >= 0
    text = F.try_validate_utf8(raw)
    listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    held = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    df = events.select("*", F.when(here & held.isNotNull(), listed).alias("_items"))
    one = F.col("_items")[0]
    return df.select(*events.columns, F.when(here & (F.size("_items") == 1) & F.schema_of_variant(one).startswith("OBJECT"), one).alias("_doc"))


def _found(strings: pd.Series, patterns: pd.Series) -> pd.Series:
    out = []
    for own, pattern in zip(strings, patterns):
        try:
            find = regex.compile(pattern).search if pattern is not None else None
        except regex.error:
            find = None
        out.append(bool(find and own is not None and any(s is not None and find(s) for s in own)))
    return pd.Series(out)


def _values(df: DataFrame, paths: tuple[Path, ...], used: str) -> DataFrame:
    """One VARIANT per path, then those of its columns (kind, string, number text, boolean, elements) that used names.

    Each step is a projection of its own, so that the next one reads its columns instead of repeating them.
    """
    some = [(i, p) for i, p in enumerate(paths)]
    has = lambda i, *names: any(f"p{i}_{n}" in used for n in names)
    df = df.select("*", *[F.expr(v.once(f"variant_get(_doc, {v.quoted(json_path(p))}, 'variant')")).alias(f"_v{i}") for i, p in some])
    df = df.select("*", *[F.expr(v.once(v.kind_of(f"_v{i}"))).alias(f"p{i}_k") for i, _ in some])
    df = df.select("*", *[F.expr(v.once(v.number_of(f"_v{i}"))).alias(f"_z{i}") for i, _ in some if has(i, "s", "t")])
    df = df.select("*", *[F.expr(v.once(v.string_of(f"_v{i}", f"p{i}_k", f"_z{i}"))).alias(f"p{i}_s") for i, _ in some if has(i, "s", "t")])
    made = [F.expr(v.once(v.number_text_of(f"p{i}_k", f"p{i}_s"))).alias(f"p{i}_t") for i, _ in some if has(i, "t")]
    made += [F.expr(v.once(v.boolean_of(f"_v{i}", f"p{i}_k"))).alias(f"p{i}_b") for i, _ in some if has(i, "b")]
    made += [F.expr(v.once(v.structs(v.elements_of(f"_v{i}")))).alias(f"p{i}_els") for i, _ in some if has(i, "els")]
    made += [F.expr(v.once(v.structs(v.leaves_of(f"_v{i}")))).alias(f"p{i}_leaves") for i, _ in some if has(i, "leaves")]
    return df.select("*", *made)


def budget_of(variant: str) -> str:
    """What reading a container costs: whether it is too deep, its parts, its characters; strings don't count as structure. Nothing for others."""
    text = f"cast({variant} AS STRING)"

    def parts(x: str) -> str:
        bare = f"regexp_replace({x}, '\"([^\"\\\\\\\\]|\\\\\\\\.)*\"', '')"

        def measured(y: str) -> str:
            marks = f"regexp_replace({y}, '[^\\\\[\\\\]{{}}]', '')"
            depth = f"aggregate(split({marks}, ''), named_struct('d', 0, 'm', 0), (a, c) -> named_struct('d', CASE WHEN c IN ('[', '{{') THEN a.d + 1 WHEN c IN (']', '}}') THEN a.d - 1 ELSE a.d END, 'm', greatest(a.m, CASE WHEN c IN ('[', '{{') THEN a.d + 1 ELSE a.d END)), a -> a.m)"
            nodes = f"length({y}) - length(replace(replace({y}, ',', ''), ':', '')) + 1"
            return f"named_struct('deep', length({marks}) > {2 * MAX_DEPTH} AND {depth} > {MAX_DEPTH}, 'nodes', {nodes}, 'chars', length({x}))"

        return v.let(bare, measured)

    none = "named_struct('deep', false, 'nodes', 0, 'chars', 0)"
    return f"coalesce(CASE WHEN substring(schema_of_variant({variant}), 1, 2) IN ('AR', 'OB') THEN {v.let(text, parts)} END, {none})"


def over_budget(n: int) -> str:
    """Whether the containers at all n paths of an event together cost more than one pass may; nothing is measured without any."""
    if not n:
        return "false"
    total = lambda costs, part: f"aggregate({costs}, 0L, (a, x) -> a + x.{part})"
    costly = v.let(
        f"array({', '.join(budget_of(f'_v{i}') for i in range(n))})",
        lambda costs: f"exists({costs}, x -> x.deep) OR {total(costs, 'nodes')} > {MAX_NODES} OR {total(costs, 'chars')} > {MAX_CHARS}",
    )
    return f"CASE WHEN {' OR '.join(f'p{i}_k IN (\'A\', \'O\')' for i in range(n))} THEN {costly} ELSE false END"


def apply_filter(
    events: DataFrame,
    rules: Mapping[str, str],
    policy: str = "KEEP_EVENT",
    raw: str = "raw",
    conn: str = "conn_id",
    order: str = "sequence",
    batch_pointers: Sequence[str] = (),
    **limits: int,
) -> DataFrame:
    """events with valid, drop, rule_name, evaluation_error and batch_values.

    Without rules nothing is parsed and every event stays. With rules an event that isn't exactly one JSON
    object, or one whose containers are over budget, is an error. policy: it stays flagged and without
    batch_values (KEEP_EVENT), is dropped as evaluation_error (DROP_EVENT), or its connection ends there: it and
    what conn sends after it in order go (CLOSE_CONNECTION). A null raw is an error like an empty one.

    rule_name is not deterministic for the optimizer, which keeps filters on it above the one parse.
    """
    if policy not in POLICIES:
        raise ValueError(policy)
    found = compile_rules(rules, **limits)
    wanted = pointers(batch_pointers)
    none = F.lit(None).cast("array<string>")
    if not found.rules:
        return events.select("*", F.lit(True).alias("valid"), F.lit(False).alias("drop"), F.lit(None).cast("string").alias("rule_name"), F.lit(False).alias("evaluation_error"), none.alias("batch_values"))
    events.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    paths = tuple(dict.fromkeys([*found.paths, *wanted]))
    compiler = sql.Compiler(paths)
    tests = [(r.name, compiler.test(r.tree)) for r in found.rules]
    used = " ".join([t for _, t in tests] + [x for pair in compiler.patterns for x in pair] + [f"p{paths.index(p)}_s" for p in wanted])
    df = _values(_with_doc(events, raw), paths, used)
    if compiler.patterns:
        find = F.pandas_udf(_found, "boolean").asNondeterministic()
        df = df.select("*", *[find(F.expr(s), F.expr(p)).alias(f"d{i}") for i, (s, p) in enumerate(compiler.patterns)])
    error = f"(_doc IS NULL OR {over_budget(len(paths))})"
    name = "CASE " + " ".join(f"WHEN {t} THEN {v.quoted(n)}" for n, t in tests) + " END"
    told = v.once(f"CASE WHEN {error} THEN {v.quoted(EVALUATION_ERROR)} ELSE {name} END")
    values = F.array(*[F.col(f"p{paths.index(p)}_s") for p in wanted]) if wanted else none
    df = df.select(*events.columns, values.alias("_values"), F.expr(told).alias("_told"))
    bad = F.coalesce(F.col("_told") == EVALUATION_ERROR, F.lit(False))
    by_rule = F.when(~bad, F.col("_told"))
    dropped = by_rule.isNotNull() | (bad if policy == "DROP_EVENT" else F.lit(False))
    shown = F.when(bad & (policy == "DROP_EVENT"), F.lit(EVALUATION_ERROR)).otherwise(by_rule)
    out = df.select(*events.columns, (~bad).alias("valid"), dropped.alias("drop"), shown.alias("rule_name"), bad.alias("evaluation_error"), F.when(~bad, F.col("_values")).alias("batch_values"))
    if policy == "CLOSE_CONNECTION":
        out = cut_connections(out, F.col("evaluation_error"), conn, order)
    return out


def cut_connections(events: DataFrame, error: Column, conn: str, order: str) -> DataFrame:
    """events without those from the first error of their connection on."""
    first = events.where(error).groupBy(conn).agg(F.min(order).alias("_first"))
    return events.join(first, conn, "left").where(F.col("_first").isNull() | (F.col(order) < F.col("_first"))).select(*events.columns)


def extract_pointers(events: DataFrame, texts: Sequence[str], raw: str = "raw", out: str = "batch_values") -> DataFrame:
    """events with out: for each pointer the text of its scalar as written (1.0 stays 1.0), else null, and valid.

    The first of repeated fields counts. Null, containers and what is absent give null; so does everything in a
    text that isn't one JSON object.
    """
    events.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    found = pointers(texts)
    df = _values(_with_doc(events, raw), tuple(found), "")
    made = [F.when(F.col(f"p{i}_k").isin("S", "N", "B"), F.get_json_object(raw, json_path(p))) for i, p in enumerate(found)]
    return df.select(*[c for c in events.columns if c != out], F.array(*made).alias(out), F.col("_doc").isNotNull().alias("valid"))


def rule_counters(decisions: DataFrame) -> DataFrame:
    """(rule_name, matches) of dropped events, those of evaluation errors left out."""
    return decisions.where("drop and not evaluation_error").groupBy("rule_name").agg(F.count(F.lit(1)).alias("matches"))


def index_keys(column: str) -> str:
    """The keys under which a path's value stands in the index of literals: Z:null, B:true, N:5, S:text."""

    def of(x: str) -> str:
        return (
            f"filter(array(CASE WHEN {x}k = 'Z' THEN 'Z:null' END, CASE WHEN {x}k = 'B' THEN concat('B:', {x}s) END, "
            f"CASE WHEN {x}t IS NOT NULL THEN concat('N:', {x}t) END, CASE WHEN {x}k IN ('S', 'N') THEN concat('S:', {x}s) END), y -> y IS NOT NULL)"
        )

    return f"CASE WHEN {column}_k = 'A' THEN flatten(transform({column}_leaves, z -> {of('z.')})) ELSE {of(f'{column}_')} END"


def rule_anchors(found: RuleSet) -> list[tuple[str, str, int]]:
    """(path, key, place of the rule) for every anchor value of every indexed rule."""
    out = []
    for i, r in enumerate(found.rules):
        for path, values in r.anchors.items():
            for x in values:
                lit = sql.literal(x)
                text = x.value if isinstance(x.value, str) else None
                if x.value is None:
                    keys = ["Z:null"]
                elif isinstance(x.value, bool):
                    keys = [f"B:{str(x.value).lower()}"]
                elif text is not None:
                    number = v.numeric_text(text)
                    keys = [f"S:{text}", *([f"N:{number}"] if number is not None else [])]
                else:
                    keys = [f"N:{lit.t[1:-1]}"]
                out += [(json_path(path), k, i) for k in keys]
    return out


def candidates(events: DataFrame, rules: Mapping[str, str], raw: str = "raw") -> DataFrame:
    """events with candidates: the places of the indexed rules that may be true, a superset of those that are.

    Anchors (bounded by the rules' own limits) are broadcast and met by key, as a hash semi-join.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    found = compile_rules(rules)
    paths = tuple(found.anchor_paths)
    df = _values(_with_doc(events, raw), paths, " ".join(f"p{i}_{n}" for i in range(len(paths)) for n in ("s", "t", "leaves")))
    table: dict[tuple[str, str], list[int]] = {}
    for path, key, i in rule_anchors(found):
        table.setdefault((path, key), []).append(i)
    hits = []
    for i, p in enumerate(paths):
        own = {k: sorted(set(x)) for (path, k), x in table.items() if path == json_path(p)}
        if own:
            lookup = "map(" + ", ".join(f"{v.quoted(k)}, array({', '.join(map(str, x))})" for k, x in own.items()) + ")"
            hits.append(f"flatten(transform(filter({index_keys(f'p{i}')}, y -> map_contains_key({lookup}, y)), y -> element_at({lookup}, y)))")
    made = f"array_sort(array_distinct(concat({', '.join(hits)})))" if hits else "cast(array() AS array<int>)"
    return df.select(*events.columns, F.expr(f"coalesce({made}, cast(array() AS array<int>))").alias("candidates"))
