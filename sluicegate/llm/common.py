"""What several corpus operators share: tables cut from their lineage, blocks of large groups, components."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.shipping import ship

_OWN: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one that the cluster names in spark.checkpoint.dir.

    Where none is named, a folder of this machine serves a local master; a cluster has to name one.
    """
    if not (found := spark.conf.get("spark.checkpoint.dir", None)):
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        os.makedirs("/tmp/checkpoints", exist_ok=True)
        found = "file://" + tempfile.mkdtemp(dir="/tmp/checkpoints")
        spark.conf.set("spark.checkpoint.dir", found)
        _OWN.append((spark, found))
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: computed once, whole again after an executor is lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _OWN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, df: DataFrame) -> None:
    """Deletes a table of written() that no later read needs."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    for spark, path in _OWN:
        if spark._jsc is not None and spark.sparkContext._jsc is not None:
            try:
                _delete(spark, path)
            except Exception:  # noqa: BLE001  the JVM may be gone when the interpreter ends
                return


def blocks(rows: DataFrame, keys: list[str], item: str, limit: int) -> DataFrame:
    """Lets all rows of a key meet in pairs, though no task gets more than about 2 * limit rows of it.

    Keys with a single row are dropped. A key with more than limit rows is cut into chunks by the
    hash of item; each pair of chunks is a block of its own. Adds block_i <= block_j and chunk:
    within a block with block_i < block_j only pairs from different chunks are to be looked at.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    met = rows.join(counts, keys).withColumn("_nb", F.ceil(F.col("_n") / limit).cast("int"))
    met = met.withColumn("chunk", F.when(F.col("_nb") > 1, F.pmod(F.xxhash64(F.lit(7), F.col(item)), F.col("_nb")).cast("int")).otherwise(0))
    met = met.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
    return met.select(
        *rows.columns,
        "chunk",
        F.least("chunk", "_j").alias("block_i"),
        F.greatest("chunk", "_j").alias("block_j"),
    )


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from sorted batches; a group that spans batches is put together."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            col = batch.column(k)
            if batch.num_rows > 1:
                new[1:] |= pc.not_equal(col[1:], col[:-1]).fill_null(True).to_numpy(zero_copy_only=False)
        if rest:
            new[0] = any(batch.column(k)[0] != rest[-1].column(k)[-1] for k in keys)
        starts = np.flatnonzero(new)
        if not len(starts):
            rest.append(batch)
            continue
        if done := [*rest, *([batch.slice(0, starts[-1])] if starts[-1] else [])]:
            yield pa.Table.from_batches(done)
        rest = [batch.slice(starts[-1])]
    if rest:
        yield pa.Table.from_batches(rest)


def pairs_of_runs(runs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (a, b), a < b, within runs of equal numbers, one distance b - a at a time."""
    at = np.arange(len(runs))
    step = 1
    while True:
        at = at[at + step < len(runs)]
        at = at[runs[at] == runs[at + step]]
        if not len(at):
            return
        yield at, at + step
        step += 1


def smallest_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that the edges a-b reach."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before, label)
        label = label[label]
        if np.array_equal(label, before):
            return label


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); root: the smallest node it reaches.

    Large-star and small-star steps (Kiveris et al., 2014) in turn until nothing changes. A step
    groups with partial aggregation and joins two written tables on the node, so that a hub is only a skewed key of a
    join, which Spark can split.
    """
    spark = edges.sparkSession
    now = written(_oriented(edges), f"{name}-edges")
    sign = _signature(now)
    while sign[0]:
        both = now.union(now.select(F.col("b"), F.col("a")))
        least = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), f"{name}-least")
        large = written(_oriented(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))), f"{name}-large")
        down = written(large.groupBy("a").agg(F.min("b").alias("m")), f"{name}-down")
        small = large.join(down, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m")), F.struct(F.col("b").alias("a"), F.col("m")))).alias("e"))
        new = written(_oriented(small.select(F.col("e.a"), F.col("e.m").alias("b"))), f"{name}-edges")
        for done in (now, least, large, down):
            discard(spark, done)
        now, before, sign = new, sign, _signature(new)
        if sign == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger node a to the smaller b."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row.n, row.x
