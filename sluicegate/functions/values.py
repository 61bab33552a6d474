"""The value model of the rule language as SQL text over VARIANT.

A value has a kind, one letter: M missing, Z null, B boolean, N number, S string, A array, O object; a
string s (strings, numbers in plain notation, booleans), the plain text t of what converts to a number
(numbers, numeric strings), and a boolean b. Everything is JVM-side; every boolean is true or false, never null.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from decimal import Decimal
from itertools import count

#: Levels of nested arrays whose elements count in functions that look at any element: as many as an event may have.
LEVELS = 32
#: What converts to a number: no spaces, no letters but an exponent.
NUMERIC = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_PLAIN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"
_names = count()


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(value: str, body: Callable[[str], str]) -> str:
    """body over a name that is bound to value, computed once."""
    name = f"x{next(_names)}"
    return f"element_at(transform(array({value}), {name} -> {body(name)}), 1)"


def trimmed(s: str) -> str:
    """Without characters up to U+0020 at either end."""
    return rf"regexp_replace({s}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '')"


def _short(z: str) -> str:
    return f"CASE WHEN instr({z}, '.') > 0 THEN rtrim('.', rtrim('0', {z})) ELSE {z} END"


def canonical(s: str) -> str:
    """Plain text of a numeric string, null of others. Exponents go through DECIMAL(38,18), then DOUBLE."""
    body = f"ltrim('+-', {s})"
    whole, part = f"ltrim('0', split_part({body}, '.', 1))", f"rtrim('0', split_part({body}, '.', 2))"
    number = f"concat(CASE WHEN {s} LIKE '-%' AND {body} RLIKE '[1-9]' THEN '-' ELSE '' END, CASE WHEN {whole} = '' THEN '0' ELSE {whole} END, CASE WHEN {part} = '' THEN '' ELSE concat('.', {part}) END)"
    wide = _short(f"coalesce(cast(try_cast({s} AS DECIMAL(38,18)) AS STRING), cast(try_cast({s} AS DOUBLE) AS STRING))")
    return f"CASE WHEN {s} RLIKE '{_PLAIN}' THEN {number} WHEN {s} RLIKE '{NUMERIC}' THEN {wide} END"


def plain_decimal(value: Decimal) -> str:
    """A number in plain notation without trailing zeros."""
    if abs(value.adjusted()) > 10_000:
        raise ValueError("exponent out of range")
    text = format(value, "f")
    if "." in text:
        text = text.rstrip("0").rstrip(".")
    return "0" if text in ("-0", "") else text


def numeric_text(text: str) -> str | None:
    """The plain text of a literal string that converts to a number."""
    return plain_decimal(Decimal(text)) if re.fullmatch(NUMERIC[1:-1], text) else None


def kind_of(v: str) -> str:
    two = f"substring(schema_of_variant({v}), 1, 2)"
    return (
        f"CASE WHEN {v} IS NULL THEN 'M' WHEN is_variant_null({v}) THEN 'Z' ELSE "
        f"CASE {two} WHEN 'ST' THEN 'S' WHEN 'BI' THEN 'N' WHEN 'DE' THEN 'N' WHEN 'DO' THEN 'N' WHEN 'BO' THEN 'B' WHEN 'AR' THEN 'A' ELSE 'O' END END"
    )


def number_of(v: str) -> str:
    """Text of a number as VARIANT gives it; doubles through DECIMAL(38,18)."""
    return (
        f"CASE WHEN schema_of_variant({v}) = 'DOUBLE' THEN coalesce(cast(try_variant_get({v}, '$', 'decimal(38,18)') AS STRING), "
        f"try_variant_get({v}, '$', 'string')) ELSE try_variant_get({v}, '$', 'string') END"
    )


def string_of(v: str, k: str, z: str) -> str:
    """z: the value's number_of."""
    return f"CASE WHEN {k} = 'N' THEN {_short(z)} WHEN {k} IN ('S', 'B') THEN try_variant_get({v}, '$', 'string') END"


def number_text_of(k: str, s: str) -> str:
    return f"CASE WHEN {k} = 'N' THEN {s} WHEN {k} = 'S' THEN {canonical(s)} END"


def boolean_of(v: str, k: str) -> str:
    return f"CASE WHEN {k} = 'B' THEN try_variant_get({v}, '$', 'boolean') END"


def once(e: str) -> str:
    """e as an expression that the optimizer doesn't copy into its consumers or push filters through."""
    return f"CASE WHEN monotonically_increasing_id() >= 0 THEN {e} END"


def scalar_struct(v: str) -> str:
    """k, s, t and b of a variant, for elements of arrays."""

    def with_kind(k: str) -> str:
        own = let(number_of(v), lambda z: string_of(v, k, z))
        return let(own, lambda s: f"named_struct('k', {k}, 's', {s}, 't', {number_text_of(k, s)}, 'b', {boolean_of(v, k)})")

    return let(kind_of(v), with_kind)


def elements_of(v: str) -> str:
    return f"CASE WHEN substring(schema_of_variant({v}), 1, 2) = 'AR' THEN try_variant_get({v}, '$', 'array<variant>') END"


def leaves_of(v: str) -> str:
    """Elements of an array, those of arrays within it instead of these, to LEVELS levels."""

    def opened(own: str) -> str:
        a, e, i, x = (f"x{next(_names)}" for _ in range(4))
        nested = f"exists({a}, {x} -> substring(schema_of_variant({x}), 1, 2) = 'AR')"
        deeper = f"flatten(transform({a}, {e} -> coalesce({elements_of(e)}, array({e}))))"
        return f"aggregate(sequence(2, {LEVELS}), {own}, ({a}, {i}) -> CASE WHEN {nested} THEN {deeper} ELSE {a} END)"

    return let(elements_of(v), opened)


def structs(array: str) -> str:
    e = f"x{next(_names)}"
    return f"transform({array}, {e} -> {scalar_struct(e)})"


def ipv4(s: str) -> str:
    """The 32 bits of a dotted IPv4 address as BIGINT, else null; leading zeros are decimal."""
    return let(
        trimmed(s),
        lambda x: f"CASE WHEN {x} RLIKE '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}$' AND forall(split({x}, '[.]'), o -> cast(o AS INT) <= 255) "
        f"THEN aggregate(split({x}, '[.]'), 0L, (a, o) -> a * 256 + cast(o AS BIGINT)) END",
    )


def ipv6(s: str) -> str:
    """The 32 hex digits of an IPv6 address, else null. IPv4-mapped addresses, brackets and zones are none."""
    valid = r"^([0-9a-fA-F]{0,4}:){2,7}([0-9a-fA-F]{0,4}|[0-9]{1,3}([.][0-9]{1,3}){3})$"

    def groups(part: str) -> str:
        # a dotted end is two groups
        dotted = f"substring_index({part}, ':', -1)"
        four = ipv4(dotted)
        ends = f"split(concat(substring({part}, 1, length({part}) - length({dotted})), {let(four, lambda n: f'concat(hex(shiftright({n}, 16)), chr(58), hex({n} & 65535L))')}), ':')"
        return f"CASE WHEN {part} = '' THEN array() WHEN instr({part}, '.') > 0 THEN {ends} ELSE split({part}, ':') END"

    def whole(x: str) -> str:
        squeezed = f"instr({x}, '::') > 0"

        def both(a: str) -> str:
            right = f"CASE WHEN {squeezed} THEN {groups(f'substring({x}, instr({x}, {quoted(chr(58) * 2)}) + 2)')} ELSE array() END"

            def filled(r: str) -> str:
                fill = f"8 - size({a}) - size({r})"
                ok = f"CASE WHEN {squeezed} THEN {fill} >= 1 ELSE {fill} = 0 END AND forall(concat({a}, {r}), g -> length(g) BETWEEN 1 AND 4)"
                digits = f"array_join(transform(concat({a}, array_repeat('0', {fill}), {r}), g -> lpad(lower(g), 4, '0')), '')"
                return f"CASE WHEN {ok} THEN {digits} END"

            return let(right, filled)

        left = f"CASE WHEN {squeezed} THEN {groups(f'substring({x}, 1, instr({x}, {quoted(chr(58) * 2)}) - 1)')} ELSE {groups(x)} END"
        once = f"length({x}) - length(replace({x}, '::', '')) <= 2 AND instr({x}, ':::') = 0"
        return f"CASE WHEN {x} RLIKE '{valid}' AND {once} THEN {let(left, both)} END"

    return let(let(trimmed(s), whole), lambda h: f"CASE WHEN {h} NOT LIKE '00000000000000000000ffff%' THEN {h} END")


def bits(h: str) -> str:
    """128 characters 0 and 1 of 32 hex digits."""
    return f"array_join(transform(split({h}, ''), d -> lpad(conv(d, 16, 2), 4, '0')), '')"
