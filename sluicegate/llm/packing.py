"""Best-fit packing: planned over a histogram of lengths; pieces take slots by their rank within a length."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluicegate.llm.common import written

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 1024
END_ID = 2
#: Pieces of one length that are ranked together in one task, about.
RANKED = 512
#: Bytes of text whose distinct chunks are encoded together, bytes that are searched for cuts at a time, chunks that the tokenizer gets
#: at a time, pieces handed on at a time.
GROUP, LOOKED_AT, AT_ONCE, HANDED = 1 << 23, 1 << 20, 16_000, 1 << 14
_LETTER, _BLANK, _MARK, _WIDE, _ODD = range(5)
_KIND = np.array([_WIDE if c >= 128 else _ODD if 28 <= c < 32 else _LETTER if chr(c).isalpha() else _BLANK if chr(c).isspace() else _MARK for c in range(256)], dtype=np.uint8)


def cuts(data: np.ndarray) -> np.ndarray:
    """For each place in UTF-8 bytes whether a text may be cut before it without changing its byte-level tokens.

    The pattern of these tokenizers goes from left to right, looks back at nothing, and no match goes from a letter or mark
    on into white space, nor from a letter on into a mark. So it may be cut before white space that follows something
    else, between a letter and a mark, and after a line end that stands alone. Characters beyond ASCII count only
    where a byte or two tell their kind.
    """
    out = np.empty(len(data), dtype=bool)
    for at in range(0, len(data), LOOKED_AT):  # three bytes before a place tell
        low = max(0, at - 3)
        out[at : at + LOOKED_AT] = _cuts(data[low : at + LOOKED_AT])[at - low :]
    out[:1] = True
    return out


def _cuts(data: np.ndarray) -> np.ndarray:
    kind = np.concatenate([np.full(3, _BLANK, dtype=np.uint8), _KIND[data]])
    byte = np.concatenate([np.full(3, 32, dtype=np.uint8), data])
    here, k1, k2 = kind[3:], kind[2:-1], kind[1:-2]
    b0, b1, b2, b3 = byte[3:], byte[2:-1], byte[1:-2], byte[:-3]
    out = (here == _BLANK) & (k1 != _BLANK) & (k1 != _ODD)
    wide = np.flatnonzero(out & (k1 == _WIDE))  # perhaps white space
    x1, x2, x3 = b1[wide], b2[wide], b3[wide]
    out[wide] = ~(((x2 == 0xC2) & ((x1 == 0x85) | (x1 == 0xA0))) | (x3 == 0xE1) | (x3 == 0xE3) | ((x3 == 0xE2) & (x2 <= 0x81)))
    out |= (here == _MARK) & ((k1 == _LETTER) | ((b2 == 0xC3) & (b1 != 0x97) & (b1 != 0xB7)))
    alone = (b1 == 10) & ((k2 == _LETTER) | (k2 == _MARK) | (b3 == 0xC3))
    out |= alone & ((here == _LETTER) | (here == _MARK) | ((here == _WIDE) & (b0 == 0xC3)))
    return out


class Coder:
    """Token ids of whole texts. The distinct chunks of GROUP bytes of text are encoded once; nothing is kept beyond them.

    Strings of added tokens in a text become those tokens, unless special_as_text. With a tokenizer that isn't
    byte-level, every text is one chunk.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        told = json.loads(self.tokenizer.to_str())
        before, added = told["pre_tokenizer"] or {}, [t for t in told["added_tokens"] if not (special_as_text and t["special"])]
        self.added = [t["content"].encode() for t in added]
        self.cuttable = (
            told["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before["add_prefix_space"]
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        )
        # a byte-level token has a character for each of its bytes
        self.bytes = np.zeros(self.tokenizer.get_vocab_size(), dtype=np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.bytes[i] = len(token)
        for t in told["added_tokens"]:
            self.bytes[t["id"]] = len(t["content"].encode())

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end (null: empty), and for each text, and at the end, how many ids stand before it."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, dtype=np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        before, parts, at, total = np.zeros(len(ends), dtype=np.int64), [np.zeros(0, dtype="<u4")], 0, 0
        while at < len(data):
            starts, to = self._window(data, ends, at)
            ids, n = self._ids(data[at:to], starts - at)
            inside = slice(np.searchsorted(ends, at, side="right"), np.searchsorted(ends, to, side="right"))
            before[inside] = total + n[np.searchsorted(starts, ends[inside])]
            parts.append(ids)
            at, total = to, total + len(ids)
        return np.concatenate(parts), before

    def _window(self, data: np.ndarray, ends: np.ndarray, at: int) -> tuple[np.ndarray, int]:
        """Where the chunks of data[at:to] start; to is a cut, about GROUP bytes on."""
        size, margin = GROUP, max([4, *map(len, self.added)])
        while True:
            to = min(at + size, len(data))
            cut = cuts(data[at:to]) if self.cuttable else np.zeros(to - at, dtype=bool)
            for token in self.added:
                for found in re.finditer(re.escape(token), data[at:to]):  # none inside a token's string
                    cut[found.start() + 1 : found.start() + len(token)] = False
            cut[ends[np.searchsorted(ends, at) : np.searchsorted(ends, to)] - at] = True
            cut[0] = True
            starts = np.flatnonzero(cut) + at
            if to == len(data):
                return starts, to
            last = int(starts[np.searchsorted(starts, to - margin, side="right") - 1])
            if last > at:
                return starts[: np.searchsorted(starts, last)], last
            size *= 2

    def _ids(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks end to end, and for each chunk, and at the end, how many ids stand before it."""
        offsets = np.append(starts, len(data)).astype(np.int64)
        chunks = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        if not self.cuttable:
            found = [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(chunks.dictionary.to_pylist(), add_special_tokens=False)]
            sizes = np.array([len(x) for x in found], dtype=np.int64)
        else:
            found = []
            for at in range(0, len(chunks.dictionary), AT_ONCE):
                distinct = chunks.dictionary.slice(at, AT_ONCE).to_pylist()
                own = [distinct[i : i + 2000] for i in range(0, len(distinct), 2000)]
                found += [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(own, is_pretokenized=True, add_special_tokens=False)]
            ends = np.cumsum(np.concatenate([self.bytes[x] for x in found]))
            sizes = np.diff(np.searchsorted(ends, np.cumsum(pc.binary_length(chunks.dictionary).to_numpy())) + 1, prepend=0)
        first, of = np.cumsum(sizes) - sizes, chunks.indices.to_numpy()
        n = np.append(0, np.cumsum(sizes[of]))
        kind = np.int32 if n[-1] < 1 << 31 else np.int64
        places = np.repeat((first[of] - n[:-1]).astype(kind), sizes[of])
        places += np.arange(len(places), dtype=kind)
        return np.concatenate(found)[places], n


def token_pieces(
    docs: DataFrame, text: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, special_as_text: bool = False
) -> DataFrame:
    """One row per piece of each document: the columns of docs without text, piece, start, length, ids.

    The ids of a document are those of its whole text (null: empty) and end_id. A document of more than
    capacity ids is cut: all pieces but the first have capacity ids. ids: little-endian unsigned 32-bit
    numbers. Repeated rows give repeated pieces; columns named piece, start, length or ids are replaced.
    An empty table gives an empty result. special_as_text: see Coder.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    made = ["piece", "start", "length", "ids"]
    kept = [c for c in docs.columns if c not in (text, *made)]
    zero = F.lit(0).cast("long")
    schema = docs.select(*kept, F.lit(0).alias("piece"), zero.alias("start"), zero.alias("length"), F.lit(b"").alias("ids")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(path, special_as_text)
        for batch in batches:
            texts = batch.column(len(kept))
            sizes = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)))
            at = 0
            while at < len(texts):
                to = max(at + 1, int(np.searchsorted(sizes, sizes[at] + GROUP, side="right")) - 1)
                ids, before = coder.encoded(texts.slice(at, to - at))
                data = np.insert(ids, before[1:], end_id).astype("<u4", copy=False)
                yield from _cut(batch.slice(at, to - at), len(kept), data, before + np.arange(len(before)), capacity)
                pa.default_memory_pool().release_unused()  # the worker lives on
                at = to

    return docs.select(*kept, F.col(text)).mapInArrow(run, schema)


def _cut(rows: pa.RecordBatch, kept: int, data: np.ndarray, before: np.ndarray, capacity: int) -> Iterator[pa.RecordBatch]:
    """The pieces of rows, whose ids in data begin at before, HANDED at a time."""
    n = np.diff(before)
    many = -(-n // capacity)
    row = np.repeat(np.arange(len(n)), many)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    head = n - (many - 1) * capacity
    start = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
    length = np.where(piece == 0, head[row], capacity)
    ends = np.append(0, np.cumsum(length))
    for a in range(0, len(row), HANDED):
        b = min(a + HANDED, len(row))
        ids = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(((ends[a : b + 1] - ends[a]) * 4).astype(np.int32)), pa.py_buffer(data[ends[a] : ends[b]])])
        own = rows.take(pa.array(row[a:b]))
        made = [pa.array(piece[a:b], type=pa.int32()), pa.array(start[a:b], type=pa.int64()), pa.array(length[a:b], type=pa.int64()), ids]
        yield pa.RecordBatch.from_arrays([*own.columns[:kept], *made], names=[*rows.schema.names[:kept], "piece", "start", "length", "ids"])


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit, longest first, over counts of lengths.

    Returns runs of slots (length, first_rank, n, per_sequence, first_sequence, offset): the n pieces of
    this length from first_rank on go, per_sequence to each, into the sequences from first_sequence on,
    the first of a sequence at offset. Bins with equal rests are handled as one, so the work and the
    runs depend on the number of lengths, not of pieces.
    """
    bins: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by rest: (first sequence, how many)
    out, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left, rest = 0, histogram[length], length
        while left and rest <= capacity:
            if not bins[rest]:
                rest += 1
                continue
            first, n = bins[rest].pop()
            if n > left:
                bins[rest].append((first + left, n - left))
                n = left
            out.append((length, rank, n, 1, first, capacity - rest))
            rank, left = rank + n, left - n
            bins[rest - length].append((first, n))
            rest = max(length, min(rest, rest - length))
        per = capacity // length
        for n, each in ((left // per, per), (1, left % per)):
            if n and each:
                out.append((length, rank, n * each, each, sequences, 0))
                bins[capacity - each * length].append((sequences, n))
                rank, sequences = rank + n * each, sequences + n
    return out


def pack(pieces: DataFrame, keys: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces, which have a length of 1 to capacity.

    keys: columns that order pieces of one length, so that every run gives the same places; rows equal
    in them are interchangeable. Pieces are read twice, so they should be a written table. A length that
    many pieces have is dealt out by hash and ranked in parts of about RANKED rows, each from the sum of
    the parts before it. The histogram (at most capacity rows) and the plan (a few runs per length) are all
    that the driver sees and what is broadcast. An empty table stays empty.
    """
    spark = pieces.sparkSession
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = spark.createDataFrame(plan(counts, capacity), "length long, first_rank long, n long, per long, first_sequence long, at long")
    parts = spark.createDataFrame([(k, max(1, round(n / RANKED))) for k, n in counts.items()], "length long, parts long")
    dealt = pieces.join(F.broadcast(parts), "length").withColumn("_part", F.pmod(F.xxhash64(*keys), F.col("parts"))).drop("parts")
    sizes = dealt.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.selectExpr("length", "_part", "sum(_size) over (partition by length order by _part) - _size as _before")
    order = ", ".join(f"`{k}`" for k in keys)
    ranked = dealt.selectExpr("*", f"row_number() over (partition by length, _part order by {order}) - 1 as _own")
    placed = ranked.join(before, ["length", "_part"]).withColumn("_rank", F.col("_own") + F.col("_before"))
    slot = F.col("_rank") - F.col("first_rank")
    return placed.join(F.broadcast(runs), "length").where((slot >= 0) & (slot < F.col("n"))).select(
        *pieces.columns,
        (F.col("first_sequence") + F.floor(slot / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("at") + slot % F.col("per") * F.col("length")).alias("offset"),
    )


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """docs as packed pieces with their ids: id_col, piece, start, length, ids, sequence_id, offset."""
    pieces = written(token_pieces(docs.select(id_col, text), text, path, capacity), "pieces")
    return pack(pieces, [id_col, "piece", "start"], capacity)
