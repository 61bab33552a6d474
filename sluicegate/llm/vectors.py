"""Vectors as rows: which ones count, and their doubles as bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prepared(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, vec, dim) of every row: vec holds the components as little-endian doubles.

    vec is null for vectors that are null, empty, zero, or hold null or non-finite components, or whose
    squared length is not a positive finite double.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            starts = lists.offsets.to_numpy().astype(np.int64)
            flat = np.array(lists.values.cast(pa.float64()).to_numpy(zero_copy_only=False))  # nulls become nan
            valid = lists.is_valid().to_numpy(zero_copy_only=False) if lists.null_count else np.ones(len(lists), dtype=bool)
            out = []
            for ok, a, b in zip(valid.tolist(), starts[:-1].tolist(), starts[1:].tolist()):
                with np.errstate(all="ignore"):
                    length = float(flat[a:b] @ flat[a:b]) if ok else 0.0
                out.append(flat[a:b].tobytes() if 0 < length < np.inf else None)
            dims = pa.array([len(x) // 8 if x else 0 for x in out], type=pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, type=pa.binary()), dims], names=["id", "vec", "dim"])

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).mapInArrow(run, "id long, vec binary, dim int")


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The rows of a vec column that all have the same dim."""
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), dtype="<f8").reshape(len(parts), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
