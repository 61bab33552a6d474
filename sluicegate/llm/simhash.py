"""Near duplicates by SimHash: segment bit counts, a grid join under Manhattan distance, exact checks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import blocks, components, pairs_of_runs, smallest_labels, whole_groups, written

SHINGLE = 4
SEED = 42
MOST_BITS = 4
#: Bytes of a text that are cut into words at a time.
PIECE = 1 << 20
#: Fingerprints of one cell that meet in one task; more are cut into blocks.
BLOCK = 1024
#: Expected fingerprints in a cell; the grid gets finer with their number.
IN_CELL = 64
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_ODD = 0x5555555555555555


def words_of(data: bytes) -> Iterator[list[bytes]]:
    """Lower-cased (A-Z) words between runs of space and 09-0D, in pieces of bounded size."""
    at = 0
    while at < len(data):
        end = at + PIECE
        if end < len(data):
            cut = _SPACE.search(data, end)
            end = cut.start() if cut else len(data)
        yield data[at:end].lower().split()
        at = end


def fingerprint(data: bytes | None, k: int = SHINGLE) -> int:
    """Signed 64 bits: a bit is 1 if it is set in over half of the hashes of the k-word shingles."""
    counts, total, carry = np.zeros(64, dtype=np.int64), 0, []
    one = xxhash.xxh64_intdigest
    for words in words_of(data or b""):
        words = carry + words
        carry = words[len(words) - k + 1 :] if len(words) >= k else words
        if len(words) < k:
            continue
        joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        hashes = np.array([one(joined[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
    if not total:
        if not carry:
            return 0
        h = one(b" ".join(carry), SEED)
    else:
        h = sum(1 << j for j in np.flatnonzero(2 * counts > total).tolist())
    return h - (1 << 64) if h >> 63 else h


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fp", k: int = SHINGLE) -> DataFrame:
    """Adds out (long) to docs; null and blank texts get zero. Texts are read whole, piece by piece."""
    schema = docs.drop(out).withColumn(out, F.lit(0).cast("long")).schema
    names = [c for c in docs.columns if c != out]
    own = text if text in names else "_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(own)
            made = pa.array([fingerprint(x.as_py(), k) for x in texts.cast(pa.binary())], type=pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), made], names=[*names, out])
            pa.default_memory_pool().release_unused()  # the worker lives on

    return docs.select(*names, *([] if own == text else [F.col(text).alias(own)])).mapInArrow(run, schema)


def bit_counts(fp: Column) -> Column:
    """The 32 counts of set bits in two-bit segments, each written in unary in its own two bits.

    So the Manhattan distance of two count vectors is the number of differing bits of these words.
    """
    low, high = fp.bitwiseAND(F.lit(_ODD)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_ODD))
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def grid_masks(n: int, most: int = MOST_BITS) -> list[int]:
    """Masks of the coordinates that a cell fixes.

    The 32 coordinates are dealt into g runs. Count vectors within a Manhattan distance of most agree
    on g - most of the runs at least, so one cell of the choices of g - most runs holds both. A
    coordinate tells 1.415 bits of chance collision; g is the least that leaves IN_CELL in a cell.
    """
    for g in range(most + 1, most + 5):
        cuts = [round(32 * i / g) for i in range(g + 1)]
        chosen = list(combinations(range(g), g - most))
        if n <= IN_CELL * 2 ** (1.415 * 32 * (g - most) / g):
            break
    masks = [sum(((1 << 2 * (cuts[i + 1] - cuts[i])) - 1) << 2 * cuts[i] for i in c) for c in chosen]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fps: DataFrame, n: int, most: int = MOST_BITS) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct fingerprints fp within most differing bits.

    fps: distinct values of fp. Of the links inside a batch of cells only a spanning forest is given
    out, so a group of near copies makes as many rows as it has members, not its pairs.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("grid"), F.col("counts").bitwiseAND(F.lit(m)).alias("cell")) for i, m in enumerate(grid_masks(n, most))])
    rows = fps.select("fp", bit_counts(F.col("fp")).alias("counts")).withColumn("c", F.explode(cells)).select("c.grid", "c.cell", "fp", "counts")
    keys = ["grid", "cell", "block_i", "block_j"]
    met = blocks(rows, ["grid", "cell"], "fp", BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, keys):
            key = np.stack([t.column(k).to_numpy().astype(np.int64) for k in keys], axis=1)
            runs = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]).any(axis=1))])
            fp, counts = (t.column(c).to_numpy().view(np.uint64) for c in ("fp", "counts"))
            chunk, cross = t.column("chunk").to_numpy(), key[:, 2] != key[:, 3]
            found = [[np.zeros(0, dtype=np.int64)] * 2]
            for a, b in pairs_of_runs(runs):
                near = np.bitwise_count(counts[a] ^ counts[b]) <= most
                near &= ~cross[a] | (chunk[a] != chunk[b])
                a, b = a[near], b[near]
                near = np.bitwise_count(fp[a] ^ fp[b]) <= most
                found.append([a[near], b[near]])
            a, b = (np.concatenate(x) for x in zip(*found))
            label = smallest_labels(len(fp), a, b)
            of = np.flatnonzero(label != np.arange(len(fp)))
            yield pa.RecordBatch.from_arrays([pa.array(fp[of].view(np.int64)), pa.array(fp[label[of]].view(np.int64))], names=["a", "b"])

    return met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long").distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", most: int = MOST_BITS, k: int = SHINGLE) -> DataFrame:
    """Every row of docs, without its text, with fp and component_id.

    component_id: the smallest id_col that a chain of links reaches; null if none of them has one.
    Rows with equal fingerprints are linked, rows without words among themselves (fingerprint zero).
    An empty table gives an empty result; rows that repeat stay. Columns of docs named fp or
    component_id are replaced.
    """
    kept = [c for c in docs.columns if c not in (text, "fp", "component_id")]
    rows = written(fingerprints(docs.select(*kept, text), text, k=k).drop(text), "simhash-rows")
    classes = written(rows.groupBy("fp").agg(F.min(id_col).alias("least_id")), "simhash-classes")
    of = written(_roots(classes, most).join(classes, "fp"), "simhash-roots")
    ids = written(of.groupBy("root").agg(F.min("least_id").alias("component_id")), "simhash-ids")
    return rows.join(of.select("fp", "root").join(ids, "root").select("fp", "component_id"), "fp", "left").select(*kept, "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", most: int = MOST_BITS, k: int = SHINGLE) -> DataFrame:
    """docs with one row of each group: the one with the smallest id_col, null ids last.

    Of several such rows that with the smallest hash of all columns stays; rows that are equal in every
    column are one. Texts are shuffled once, dealt by fingerprint and hash of the row.
    """
    columns = docs.columns
    own = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)], F.xxhash64(*[f"`{c}`" for c in columns]).alias("_row"))
    rows = written(fingerprints(own, f"c{columns.index(text)}", "_fp", k), "simhash-texts")
    first = F.min(F.struct(F.col(f"c{columns.index(id_col)}").isNull().alias("none"), F.col(f"c{columns.index(id_col)}").alias("id"), F.col("_row").alias("row"), F.col("_fp").alias("fp"))).alias("first")
    classes = written(rows.groupBy(F.col("_fp").alias("fp")).agg(first), "simhash-classes")
    of = _roots(classes, most).join(classes, "fp")
    stay = of.groupBy("root").agg(F.min("first").alias("f")).select(F.col("f.fp").alias("_fp"), F.col("f.row").alias("_row"))
    kept = rows.join(stay.hint("shuffle_hash"), ["_fp", "_row"]).groupBy("_fp", "_row").agg(*[F.first(f"c{i}").alias(f"c{i}") for i in range(len(columns))])
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])


def _roots(classes: DataFrame, most: int) -> DataFrame:
    """(fp, root) of every fingerprint."""
    roots = components(links(classes.select("fp"), classes.count(), most), "simhash")
    return classes.select("fp").join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))
