"""Near duplicates of embeddings: p-stable hashing of unit vectors in several tables, exact cosine checks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import blocks, components, smallest_labels, whole_groups, written
from sluicegate.llm.vectors import matrix, prepared, unit

LEAST_COSINE = 0.9
#: Width of a quantised projection, in units of the length of the vectors.
WIDTH = 2.0
#: Vectors that share a bucket by chance, about; and the share of links at LEAST_COSINE that no table has.
IN_BUCKET, MISSED = 128, 0.03
#: Vectors of one bucket that meet in one task; more are cut into blocks.
BLOCK = 512


def same_bucket(distance: float, width: float = WIDTH) -> float:
    """Probability that one projection puts two vectors at this distance into one interval (Datar et al., 2004)."""
    if not distance:
        return 1.0
    r = width / distance
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(n: int, least: float = LEAST_COSINE) -> tuple[int, int]:
    """Projections of a table, and tables, for n vectors: orthogonal ones share buckets rarely, links in some table."""
    far, near = same_bucket(math.sqrt(2)), same_bucket(math.sqrt(2 - 2 * least))
    k = max(2, round(math.log(max(1, n / IN_BUCKET)) / -math.log(far)))
    return k, max(1, math.ceil(math.log(MISSED) / math.log(1 - near**k)))


def bucketed(units: np.ndarray, k: int, tables: int, seed: int = 17) -> np.ndarray:
    """The 64-bit bucket of each unit vector in each table."""
    rng = np.random.default_rng([seed, units.shape[1], k, tables])
    along = rng.normal(size=(units.shape[1], tables * k))
    shift, mix = rng.uniform(0, WIDTH, tables * k), rng.integers(1, 1 << 62, tables * k) * 2 + 1
    cells = np.floor((units @ along + shift) / WIDTH).astype(np.int64)
    return (cells * mix).reshape(len(units), tables, k).sum(axis=2)


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", least: float = LEAST_COSINE) -> DataFrame:
    """One row per row of df: id_col, n_links, component_id, kept.

    Two vectors of equal length are linked if their cosine, in double precision, is at least least and some table
    puts them into one bucket. n_links counts the other rows linked directly, component_id is the
    smallest id that links reach, kept tells whether it is the row's own. Vectors that are null, zero
    or hold null or non-finite components are linked with nothing. Rows with equal vectors are one class
    of that many members, so copies are never compared. A null id counts as a member, not as the smallest id.
    """
    rows = written(prepared(df, id_col, vector), "lsh-rows").withColumn("digest", F.unhex(F.sha2("vec", 256)))
    classes = rows.where("vec is not null").groupBy("digest").agg(F.min("id").alias("least_id"), F.count(F.lit(1)).alias("n"), F.first("vec").alias("vec"), F.first("dim").alias("dim"))
    classes = written(classes, "lsh-classes")
    k, tables = plan(classes.count(), least)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                made = bucketed(unit(matrix(own.column("vec"))), k, tables)
                at = pa.array(np.repeat(np.arange(len(made)), tables))
                yield pa.RecordBatch.from_arrays(
                    [own.column("dim").take(at), pa.array(np.tile(np.arange(tables, dtype=np.int32), len(made))), pa.array(made.ravel()), own.column("digest").take(at)],
                    names=["dim", "tab", "bucket", "digest"],
                )

    places = written(classes.select("dim", "digest", "vec").mapInArrow(hashed, "dim int, tab int, bucket long, digest binary"), "lsh-places")
    keys = ["dim", "tab", "bucket", "block_i", "block_j"]
    met = blocks(places, ["dim", "tab", "bucket"], "digest", BLOCK).join(classes.select("digest", "vec", "n"), "digest")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, keys):
            t = t.combine_chunks()
            key = np.stack([t.column(c).to_numpy().astype(np.int64) for c in keys], axis=1)
            starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
            chunk, n, vec = t.column("chunk").to_numpy(), t.column("n").to_numpy(), t.column("vec")
            links, label = np.zeros(t.num_rows, dtype=np.int64), np.arange(t.num_rows)
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), t.num_rows]):
                units = unit(matrix(vec[a:b]))
                near = np.triu(units @ units.T >= least, 1)
                if key[a, 3] != key[a, 4]:
                    near &= chunk[a:b, None] != chunk[None, a:b]
                i, j = np.nonzero(near)
                if not len(i):
                    continue
                if tab := int(key[a, 1]):  # a pair counts in the first table where it meets
                    places = bucketed(units, k, tables)[:, :tab]
                    new = np.concatenate([(places[i[s : s + 65536]] != places[j[s : s + 65536]]).all(axis=1) for s in range(0, len(i), 65536)])
                    i, j = i[new], j[new]
                np.add.at(links, a + i, n[a + j])
                np.add.at(links, a + j, n[a + i])
                label[a:b] = a + smallest_labels(b - a, i, j)
            of = pa.array(np.flatnonzero(links))
            digest = t.column("digest").combine_chunks()
            yield pa.RecordBatch.from_arrays([digest.take(of), pa.array(links).take(of), digest.take(pa.array(label).take(of))], names=["digest", "links", "root"])

    found = written(met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compared, "digest binary, links long, root binary"), "lsh-links")
    roots = components(found.where("digest <> root").select(F.col("digest").alias("a"), F.col("root").alias("b")), "lsh")
    links = found.groupBy("digest").agg(F.sum("links").alias("links"))
    of = classes.select("digest", "least_id", "n").join(roots.withColumnRenamed("node", "digest"), "digest", "left").join(links, "digest", "left")
    of = written(of.withColumn("root", F.coalesce("root", "digest")), "lsh-roots")
    ids = written(of.groupBy("root").agg(F.min("least_id").alias("component_id")), "lsh-ids")
    told = of.join(ids, "root").select("digest", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = rows.select("id", "digest").join(told, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))
