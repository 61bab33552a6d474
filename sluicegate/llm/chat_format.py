"""Chat formatting: conversations become one marked text each, assembled by columns of bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import whole_groups

#: The strings that mark turns here and in other usual templates.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
CONTROL = [OPEN, CLOSE, "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
#: The role whose texts are under the loss mask.
LEARNED = "assistant"
#: A control string, with any number of backslashes after its first character, gets one more there.
_MARKED = r"([<\[])(\\*)(" + "|".join(re.escape(c[1:]) for c in CONTROL) + ")"
_ESCAPED = re.compile(r"([<\[])\\(\\*)(" + "|".join(re.escape(c[1:]) for c in CONTROL) + ")")
#: Bytes that are scattered in one go.
PIECE = 1 << 22


def escaped(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, _MARKED, r"\1\\\2\3")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def escaped_roles(roles: pa.Array) -> pa.Array:
    """A role stands on one line, so its backslashes and line ends are written out too."""
    return escaped(pc.replace_substring(pc.replace_substring(roles, "\\", "\\\\"), "\n", "\\n"))


def unescaped_role(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(text))


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The data of a text column, where each text starts in it, how many bytes it has."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1 + texts.offset)[texts.offset :]
    data = texts.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8), offsets[:-1], np.diff(offsets)


def assemble(columns: list[pa.Array], first: np.ndarray) -> pa.Array:
    """Row i's texts, one of each column in turn, written one after another; rows from first[j] on make text j.

    Lengths give offsets by a cumulative sum; each column's bytes are then scattered to
    their places in one preallocated buffer.
    """
    parts = [_bytes(c) for c in columns]
    sizes = np.stack([p[2] for p in parts], axis=1)
    ends = np.cumsum(sizes.ravel()).reshape(sizes.shape)
    out = np.empty(int(ends[-1, -1]) if len(ends) else 0, dtype=np.uint8)
    for k, (data, starts, n) in enumerate(parts):
        to = ends[:, k] - n
        row = 0
        while row < len(n):
            till = max(row + 1, int(np.searchsorted(np.cumsum(n[row:]), PIECE, side="right")) + row)
            if n[row] > PIECE:  # a long text is one copy
                out[to[row] : to[row] + n[row]] = data[starts[row] : starts[row] + n[row]]
                till = row + 1
            else:
                own = n[row:till]
                step = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
                out[np.repeat(to[row:till], own) + step] = data[np.repeat(starts[row:till], own) + step]
            row = till
    bounds = np.concatenate([(ends[:, 0] - sizes[:, 0])[first], [len(out)]]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(bounds), pa.py_buffer(out))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv, formatted, loss_spans.

    A turn is <|im_start|>role, a line end, the text, <|im_end|> and a line end. Control strings
    inside roles and texts are escaped, so that parse() gives every turn back. loss_spans: start
    and end, in characters of formatted, of each text whose role is assistant.
    Null roles and texts are empty. Turns are in the order of turn (nulls first), ties by role and text,
    and repeated rows stay. Rows with a null conv are one conversation. A conversation
    is one value of the result, so its turns meet in one task; others are dealt by conv.
    """
    schema = turns.select(F.col(conv), F.lit("").alias("formatted"), F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))).alias("loss_spans")).schema
    rows = turns.select(F.col(conv), F.col(turn).alias("_turn"), F.coalesce(role, F.lit("")).alias("_role"), F.coalesce(text, F.lit("")).alias("_text"))
    rows = rows.repartition(conv).sortWithinPartitions(conv, "_turn", "_role", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, [conv]):
            t = t.combine_chunks()
            ids, roles, texts = (t.column(c).combine_chunks() for c in (conv, "_role", "_text"))
            new = np.ones(len(ids), dtype=bool)
            if len(ids) > 1:
                same = pc.fill_null(pc.equal(ids[1:], ids[:-1]), False).to_numpy(zero_copy_only=False)
                none = ids.is_null().to_numpy(zero_copy_only=False)
                new[1:] = ~(same | (none[1:] & none[:-1]))
            first = np.flatnonzero(new)
            fixed = lambda s, n=len(ids): pa.array([s], type=pa.string()).take(pa.array(np.zeros(n, dtype=np.int64)))
            shown, inner = escaped_roles(roles), escaped(texts)
            made = assemble([fixed(OPEN), shown, fixed("\n"), inner, fixed(f"{CLOSE}\n")], first)
            before = pc.utf8_length(shown).to_numpy().astype(np.int64) + len(OPEN) + 1
            chars = pc.utf8_length(inner).to_numpy().astype(np.int64)
            ends = np.cumsum(before + chars + len(CLOSE) + 1)
            lengths = np.diff(np.append(first, len(ids)))
            base = np.repeat(np.concatenate([[0], ends])[first], lengths)
            to = ends - len(CLOSE) - 1 - base
            learned = pc.equal(roles, LEARNED).to_numpy(zero_copy_only=False)
            spans = pa.StructArray.from_arrays([pa.array((to - chars)[learned]), pa.array(to[learned])], names=["start", "end"])
            offsets = np.concatenate([[0], np.cumsum(np.add.reduceat(learned.astype(np.int64), first))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), spans)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(first)), made.cast(pa.string()), lists], names=[conv, "formatted", "loss_spans"])

    return rows.mapInArrow(run, schema)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) pairs of a formatted conversation."""
    out = []
    for part in formatted.split(f"{CLOSE}\n")[:-1]:
        role, _, text = part.removeprefix(OPEN).partition("\n")
        out.append((unescaped_role(role), unescaped(text)))
    return out
