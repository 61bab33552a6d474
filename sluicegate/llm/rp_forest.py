"""Approximate nearest neighbours: a forest of random-projection trees and one priority queue over all of them."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import whole_groups, written
from sluicegate.llm.vectors import matrix, prepared, unit

#: The hyperplanes are fitted on so many vectors, and bytes of them, at most, chosen by hash; every vector is indexed.
SAMPLE_ROWS, SAMPLE_BYTES = 20_000, 1 << 25
TREES = 4
#: Vectors in a leaf, about, up to 2^SHALLOW leaves. Beyond, leaves grow with the root of the number of vectors, up to 2^DEEP.
IN_LEAF, SHALLOW, DEEP = 32, 7, 11
#: Part of the sample's true neighbours that a search has to find; so many of its vectors are asked for to see how many leaves that takes.
RECALL, ASKED = 0.95, 256
#: Vectors of a cell, and queries at it, that meet in one task; queries that are compared at a time.
BLOCK_ROWS, BLOCK_QUERIES, AT_ONCE = 4096, 1024, 256


@dataclass
class Forest:
    """Trees of one depth in heap order: node i of a tree has the children 2i + 1 and 2i + 2."""

    depth: int
    #: trees x nodes x dim, trees x nodes
    normals: np.ndarray
    offsets: np.ndarray
    #: How steeply a vector's place beside a hyperplane tells its neighbours' side, and the part of all leaves that a query visits.
    slope: float = 1.0
    share: float = 1.0

    @property
    def budget(self) -> int:
        """Leaves that a query visits."""
        return max(1, int(np.ceil(self.share * len(self.normals) * 2**self.depth)))

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """The leaf (0 to 2^depth - 1) of each row in each tree."""
        out = np.zeros((len(rows), len(self.normals)), dtype=np.int64)
        for t in range(out.shape[1]):
            at = out[:, t]
            for _ in range(self.depth):
                at[:] = 2 * at + 1 + (np.einsum("ij,ij->i", rows, self.normals[t, at]) > self.offsets[t, at])
        return out - (2**self.depth - 1)

    def sides(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows x trees x nodes: the log-probabilities that a neighbour of the row is on the left and on the right of a hyperplane."""
        trees, inner, dim = self.normals.shape
        x = self.slope * ((rows @ self.normals.reshape(-1, dim).T).reshape(-1, trees, inner) - self.offsets)
        return -np.logaddexp(0, x), -np.logaddexp(0, -x)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Rows x trees x leaves: the log-probability of each leaf, the sum over the hyperplanes above it."""
        left, right = self.sides(rows)
        out = np.zeros((len(rows), len(self.normals), 1))
        for d in range(self.depth):
            level = slice(2**d - 1, 2 ** (d + 1) - 1)
            out = np.stack([out + left[:, :, level], out + right[:, :, level]], axis=3).reshape(*out.shape[:2], -1)
        return out

    def visited(self, rows: np.ndarray) -> Iterator[tuple[float, list[tuple[int, int]]]]:
        """For each row the (tree, leaf) pairs that one queue over all trees gives first, and the score of the last."""
        inner = 2**self.depth - 1
        for left, right in zip(*self.sides(rows)):
            left, right = left.tolist(), right.tolist()
            queue, found, p = [(0.0, t, 0) for t in range(len(left))], [], 0.0
            while queue and len(found) < self.budget:
                p, t, i = heapq.heappop(queue)
                if i >= inner:
                    found.append((t, i - inner))
                else:
                    heapq.heappush(queue, (p - left[t][i], t, 2 * i + 1))
                    heapq.heappush(queue, (p - right[t][i], t, 2 * i + 2))
            yield -p, found


def plan(n: int) -> int:
    """Depth of the trees for n vectors."""
    return max(1, min(round(np.log2(max(n, 2) / IN_LEAF)), SHALLOW + max(0, round(np.log2(max(n, 2) / 65_536) / 2)), DEEP))


def fit(sample: np.ndarray, depth: int, k: int, trees: int = TREES, recall: float = RECALL, seed: int = 5) -> Forest:
    """Each split halves its part of the sample along the widest of four differences of two of its rows, at right angles to the splits above.

    Then slope and share are chosen: the true k neighbours, within the sample, of ASKED of its rows tell how many leaves
    of all trees a queue has to give before the part recall of them is met; the slope that needs fewest is taken.
    """
    n, dim = sample.shape
    rng = np.random.default_rng([seed, dim])
    inner = 2**depth - 1
    normals, offsets = np.zeros((trees, inner, dim)), np.zeros((trees, inner))
    for t in range(trees):
        parts = {0: (np.arange(n), np.zeros((0, dim)))}
        for i in range(inner):
            own, above = parts.pop(i)
            tried = sample[rng.choice(own, 4)] - sample[rng.choice(own, 4)] if len(own) else np.zeros((4, dim))
            tried -= tried @ above.T @ above
            size = np.sqrt(np.einsum("ij,ij->i", tried, tried))
            if size.max() < 1e-9:
                tried = rng.normal(size=(4, dim))
                size = np.sqrt(np.einsum("ij,ij->i", tried, tried))
            tried /= np.maximum(size, 1e-300)[:, None]
            along = sample[own] @ tried.T
            best = int(np.argmax(along.std(axis=0))) if len(own) else 0
            normals[t, i], offsets[t, i] = tried[best], np.median(along[:, best]) if len(own) else 0.0
            right = along[:, best] > offsets[t, i]
            above = np.vstack([above, tried[best]]) if len(above) < dim - 1 else above
            parts[2 * i + 1], parts[2 * i + 2] = (own[~right], above), (own[right], above)
    forest = Forest(depth, normals, offsets)
    asked = rng.choice(n, min(ASKED, n), replace=False)
    if n < 2:
        return forest
    cos = sample[asked] @ sample.T
    cos[np.arange(len(asked)), asked] = -np.inf
    near = np.argpartition(-cos, min(k, n - 1) - 1, axis=1)[:, : min(k, n - 1)]
    leaves, need = forest.leaves(sample), {}
    for slope in (1.0, 2.0, 4.0, 8.0, 16.0, 32.0):
        scores = Forest(depth, normals, offsets, slope).scores(sample[asked])
        held = np.stack([scores[np.arange(len(asked))[:, None], t, leaves[near, t]] for t in range(trees)]).max(axis=0)
        order = np.sort(scores.reshape(len(asked), -1), axis=1)
        ranks = [order.shape[1] - np.searchsorted(o, h - 1e-9) for o, h in zip(order, held)]
        need[slope] = float(np.quantile(np.concatenate(ranks), recall)) / order.shape[1]
    forest.slope = min(need, key=need.get)
    forest.share = need[forest.slope]
    return forest


def nearest(df: DataFrame, is_query: str, k: int = 5, id_col: str = "vec_id", vector: str = "embedding", trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row that fulfils is_query (SQL over id).

    Nearness is the cosine in double precision; ties go to the smaller vec_id. A query's candidates are
    all rows with another id than its own. Vectors that are null, zero or hold null or non-finite
    components take no part, nor do rows with a null id. Vectors are compared with those of equal length.
    Repeated rows (same id, same vector) count once.

    Equal vectors are one entry of the index that keeps its k + 1 smallest ids, which are all that k
    answers can hold, ids of a vector are limited before they are shuffled. An entry stands in one leaf of every
    tree. A query visits the budget of leaves that its queue over all trees gives first, the same number for
    every query. Entries are dealt out by the cell, a node of a tree with about BLOCK_ROWS entries below it, and in blocks if it has
    more; a query goes to the cells of its leaves. Of a cell only the entries in visited leaves are compared, and an entry
    that the query meets in several trees only in the first.
    """
    spark = df.sparkSession
    rows = written(prepared(df, id_col, vector).where("vec is not null and id is not null"), "ann-rows")
    few = rows.selectExpr("id", "vec", "dim", "row_number() over (partition by vec order by id) as _r").where(f"_r <= {k + 1}")
    entries = written(few.distinct().groupBy("vec", "dim").agg(F.array_sort(F.collect_set("id")).alias("ids")), "ann-entries")
    sizes = {r.dim: r.n for r in entries.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    forests, above = {}, {}
    for dim, n in sizes.items():
        most = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim)))
        chance = F.pmod(F.xxhash64(F.lit(3), "vec"), F.lit(1 << 30)) / float(1 << 30)
        got = entries.where((F.col("dim") == dim) & (chance < min(1.0, 1.2 * most / n))).select("vec", chance.alias("u")).orderBy("u", "vec").limit(most).collect()
        forests[dim] = fit(unit(np.frombuffer(b"".join(r.vec for r in got), dtype="<f8").reshape(-1, dim)), plan(n), k, trees, recall)
        above[dim] = min(forests[dim].depth, max(0, int(np.ceil(np.log2(n / BLOCK_ROWS)))))

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, own in _by_dim(batch):
                leaves = forests[dim].leaves(unit(matrix(own.column("vec"))))
                cells = leaves >> (forests[dim].depth - above[dim])
                yield _listed(own, {"leaves": leaves, "cells": cells + (np.arange(trees) << 32)}, trees)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, own in _by_dim(batch):
                last, cells = [], []
                for score, found in forests[dim].visited(unit(matrix(own.column("vec")))):
                    last.append(score)
                    cells.append(sorted({(t << 32) + (leaf >> (forests[dim].depth - above[dim])) for t, leaf in found}))
                yield pa.RecordBatch.from_arrays(
                    [*(own.column(c).combine_chunks() for c in ("dim", "id", "vec")), pa.array(last, type=pa.float64()), pa.array(cells, type=pa.list_(pa.int64()))],
                    names=["dim", "id", "vec", "last", "cells"],
                )

    placed = written(entries.mapInArrow(indexed, "dim int, ids array<long>, vec binary, leaves array<long>, cells array<long>"), "ann-index")
    visits = written(rows.where(is_query).distinct().mapInArrow(asked, "dim int, id long, vec binary, last double, cells array<long>"), "ann-queries")
    #: At most trees x cells rows for each length of vector.
    counts = F.broadcast(
        placed.select("dim", F.explode("cells").alias("cell"), F.lit(1).alias("v"), F.lit(0).alias("q"))
        .union(visits.select("dim", F.explode("cells"), F.lit(0), F.lit(1)))
        .groupBy("dim", "cell")
        .agg(F.ceil(F.sum("v") / BLOCK_ROWS).cast("int").alias("nv"), F.ceil(F.sum("q") / BLOCK_QUERIES).cast("int").alias("nq"))
    )
    index = placed.select("dim", F.explode("cells").alias("cell"), "ids", "vec", "leaves", F.lit(None).cast("double").alias("last"))
    queries = visits.select("dim", F.explode("cells"), F.array("id"), "vec", F.lit(None).cast("array<long>"), "last")
    both = index.union(queries).withColumn("asks", F.col("last").isNotNull()).join(counts, ["dim", "cell"]).where("nv > 0 and nq > 0")
    own = F.pmod(F.xxhash64(F.lit(9), "vec"), F.when(F.col("asks"), F.col("nq")).otherwise(F.col("nv"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("asks"), F.col("nv")).otherwise(F.col("nq")) - 1))
    both = both.withColumn("_own", own).withColumn("_other", other)
    both = both.select("dim", "cell", F.when(F.col("asks"), F.col("_other")).otherwise(F.col("_own")).alias("bv"), F.when(F.col("asks"), F.col("_own")).otherwise(F.col("_other")).alias("bq"), "asks", "ids", "vec", "leaves", "last")
    keys = ["dim", "cell", "bv", "bq"]

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, keys):
            t = t.combine_chunks()
            key = np.stack([t.column(c).to_numpy().astype(np.int64) for c in keys], axis=1)
            starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
            asks = t.column("asks").to_numpy()
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), t.num_rows]):
                q, v = a + np.flatnonzero(asks[a:b]), a + np.flatnonzero(~asks[a:b])
                for at in range(0, len(q) if len(v) else 0, AT_ONCE):
                    yield from _best(t, q[at : at + AT_ONCE], v, int(key[a, 1]) >> 32, forests[int(key[a, 0])], k)

    near = both.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compared, "query_id long, vec_id long, score double")
    best = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = best.selectExpr("query_id", "row_number() over (partition by query_id order by score desc, vec_id) as rank", "vec_id", "score")
    return ranked.where(F.col("rank") <= k)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Table]]:
    t = pa.Table.from_batches([batch])
    dims = t.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        yield dim, t.filter(pa.array(dims == dim))


def _listed(own: pa.Table, lists: dict[str, np.ndarray], width: int) -> pa.RecordBatch:
    offsets = pa.array(np.arange(0, width * own.num_rows + 1, width), type=pa.int32())
    made = {c: pa.ListArray.from_arrays(offsets, pa.array(x.ravel())) for c, x in lists.items()}
    return pa.RecordBatch.from_arrays([*(own.column(c).combine_chunks() for c in ("dim", "ids", "vec")), *made.values()], names=["dim", "ids", "vec", *made])


def _best(t: pa.Table, q: np.ndarray, v: np.ndarray, tree: int, forest: Forest, k: int) -> Iterator[pa.RecordBatch]:
    """For each query of a block the k + 1 nearest entries' ids; more if the last of them are equally near.

    Only entries in leaves that the query visits in this tree and in no earlier one count.
    """
    vec = t.column("vec")
    asked, held = matrix(vec.take(pa.array(q))), matrix(vec.take(pa.array(v)))
    leaves = t.column("leaves").combine_chunks().take(pa.array(v)).flatten().to_numpy().reshape(len(v), -1)
    seen = forest.scores(unit(asked)) >= t.column("last").to_numpy()[q][:, None, None] - 1e-9
    new = seen[:, tree, leaves[:, tree]]
    for before in range(tree):
        new &= ~seen[:, before, leaves[:, before]]
    rows, cols = np.flatnonzero(new.any(axis=1)), np.flatnonzero(new.any(axis=0))
    if not len(rows):
        return
    q, v, asked, held, new = q[rows], v[cols], asked[rows], held[cols], new[np.ix_(rows, cols)]
    norms = np.sqrt(np.einsum("ij,ij->i", asked, asked))[:, None] * np.sqrt(np.einsum("ij,ij->i", held, held))[None, :]
    cos = np.where(new, asked @ held.T / norms, -np.inf)
    least = np.partition(cos, -(k + 1), axis=1)[:, -(k + 1)] if len(v) > k + 1 else np.full(len(q), -np.inf)
    row, col = np.nonzero(new & (cos >= least[:, None] - 1e-12))
    ids = t.column("ids").combine_chunks()
    flat, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
    n = (offsets[1:] - offsets[:-1])[v[col]]
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    vec_id = flat[np.repeat(offsets[v[col]], n) + step]
    query_id = np.repeat(flat[offsets[q[row]]], n)
    # the score is summed over the pair alone, so that it does not depend on the block
    a, b = asked[row], held[col]
    score = np.repeat(np.einsum("ij,ij->i", a, b) / norms[row, col], n)
    other = vec_id != query_id
    yield pa.RecordBatch.from_arrays([pa.array(query_id[other]), pa.array(vec_id[other]), pa.array(score[other])], names=["query_id", "vec_id", "score"])
