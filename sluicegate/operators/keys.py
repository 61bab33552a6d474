"""The key under which an event is batched."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.operators.filter import cut_connections, extract_pointers

#: Strategies, the separator of joined keys, defaults.
STRATEGIES = ("NONE", "PER_SOURCE", "CONNECTION", "WINDOW", "PER_AGENT_TYPE", "JSON_KV", "SIZE_TIME", "HYBRID")
SEPARATOR = "\u001f"
AGENT_TYPE = "/agent/type"
MISSING, MAX_KEY_BYTES = "_missing", 256


def _trim(c: Column) -> Column:
    return F.regexp_replace(c, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def normalized(key: Column, default: str = MISSING, hashed: bool = False, max_bytes: int = MAX_KEY_BYTES) -> Column:
    """A trimmed key, default if it is blank; its SHA-256 if hashed or longer than max_bytes in UTF-8."""
    own = _trim(F.coalesce(key, F.lit("")))
    own = F.when(own == "", F.lit(default)).otherwise(own)
    long = F.lit(True) if hashed else F.octet_length(own) > max_bytes
    return F.when(long, F.sha2(own, 256)).otherwise(own)


def needed_pointers(strategy: str, pointers: Sequence[str] = ()) -> list[str]:
    """The JSON pointers whose values make up the key."""
    if strategy == "JSON_KV" and not pointers:
        raise ValueError("JSON_KV needs pointers")
    if strategy == "PER_AGENT_TYPE" or strategy == "HYBRID" and not pointers:
        return [AGENT_TYPE]
    return list(pointers) if strategy in ("JSON_KV", "HYBRID") else []


def with_batch_key(
    events: DataFrame,
    strategy: str = "SIZE_TIME",
    pointers: Sequence[str] = (),
    missing: str = "DEFAULT_BUCKET",
    default: str = MISSING,
    hashed: bool = False,
    max_bytes: int = MAX_KEY_BYTES,
    values: str | None = None,
    raw: str = "raw",
) -> DataFrame:
    """events with batch_key.

    values: a column with the pointers' values that the filter has found (numbers normalised, the last of repeated
    fields); without it they are read from raw (numbers as written, the first of repeated fields), also where the
    column is null. A value that is null or blank puts the event into default, or with missing="REJECT" ends its
    connection there, as does a raw that isn't one JSON object.
    """
    if strategy not in STRATEGIES:
        raise ValueError(strategy)
    fixed = {
        "NONE": F.concat_ws(":", "conn_id", F.col("sequence").cast("string")),
        "PER_SOURCE": F.col("remote_address") if "remote_address" in events.columns else F.lit(None).cast("string"),
        "CONNECTION": F.col("conn_id"),
        "WINDOW": F.concat_ws(":", "conn_id", F.col("window_id").cast("string")) if "window_id" in events.columns else F.lit(None).cast("string"),
        "SIZE_TIME": F.lit("all"),
    }
    finish = lambda key: normalized(key, default, hashed, max_bytes)
    if strategy in fixed:
        return events.withColumn("batch_key", finish(fixed[strategy]))
    columns = [F.col(c) for c in events.columns]
    df = _with_found(events, strategy, pointers, raw)
    own = F.coalesce(F.col(values), F.col("_found")) if values else F.col("_found")
    blank = F.exists(own, lambda x: _trim(F.coalesce(x, F.lit(""))) == "")
    whole = F.col("_whole") | (F.col(values).isNotNull() if values else F.lit(False))
    df = df.select(*columns, F.when(blank, F.lit(default)).otherwise(F.array_join(own, SEPARATOR)).alias("_key"), (~whole | (blank if missing == "REJECT" else F.lit(False))).alias("_bad"))
    df = cut_connections(df, F.col("_bad"), "conn_id", "sequence")
    return df.select(*columns, finish(F.col("_key")).alias("batch_key"))


def _with_found(events: DataFrame, strategy: str, pointers: Sequence[str], raw: str) -> DataFrame:
    marked = extract_pointers(events.withColumnsRenamed({"valid": "_own_valid"}), needed_pointers(strategy, pointers), raw, "_found")
    return marked.withColumnRenamed("valid", "_whole").withColumnsRenamed({"_own_valid": "valid"})
