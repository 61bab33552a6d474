"""Rates, caps and pressure of a listener, replayed over event tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Reasons for which a connection is turned away, in the order in which they are tried.
REASONS = ("GLOBAL_CONNECTION_LIMIT", "PER_SOURCE_CONNECTION_LIMIT", "GLOBAL_CONNECTION_RATE_LIMIT", "PER_SOURCE_CONNECTION_RATE_LIMIT")


def rate_limited(events: DataFrame, per_second: int, by: tuple[str, ...] = ("conn_id",), time: str = "received_ts", order: str = "arrival") -> DataFrame:
    """events with within_rate: whether they are among the first per_second of their key in their second."""
    keys = ", ".join([*by, f"date_trunc('second', `{time}`)"])
    return events.selectExpr("*", f"row_number() over (partition by {keys} order by `{order}`) <= {per_second} as within_rate")


def pressure(samples: DataFrame, limit: int, high: int = 80, low: int = 60, used: str = "used", order: str = "arrival", by: str = "listener") -> DataFrame:
    """samples with paused: on from high percent of limit, off from low percent, unchanged in between."""
    mark = F.when(F.col(used) * 100 >= limit * high, True).when(F.col(used) * 100 <= limit * low, False)
    rows = samples.withColumn("_mark", mark)
    return rows.selectExpr("*", f"coalesce(last(_mark, true) over (partition by `{by}` order by `{order}`), false) as paused").drop("_mark")


def admit(attempts: DataFrame, max_connections: int = 30_000, per_source: int = 1000, per_second: int = 100_000, per_source_second: int = 0, by: str = "listener") -> DataFrame:
    """attempts with rejected: null or the first reason that turns the connection away.

    attempts: listener, arrival, source, opened_ts, closed_ts (null: still open). Turned away attempts use no quota. What a listener
    admits depends on all it has admitted before, so the attempts of a listener are one ordered group; its open
    connections, at most max_connections, are all that is kept. 0 as a rate means no limit.
    """
    import heapq

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, open_, sources, second, total, own = None, [], {}, None, 0, {}
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.listener != now:
                    now, open_, sources, second = row.listener, [], {}, None
                at = row.opened_ts
                while open_ and open_[0][0] <= at:
                    sources[heapq.heappop(open_)[1]] -= 1
                if (this := at.floor("s")) != second:
                    second, total, own = this, 0, {}
                reason = None
                if len(open_) >= max_connections:
                    reason = REASONS[0]
                elif sources.get(row.source, 0) >= per_source:
                    reason = REASONS[1]
                elif per_second and total >= per_second:
                    reason = REASONS[2]
                elif per_source_second and own.get(row.source, 0) >= per_source_second:
                    reason = REASONS[3]
                else:
                    total += 1
                    own[row.source] = own.get(row.source, 0) + 1
                    sources[row.source] = sources.get(row.source, 0) + 1
                    heapq.heappush(open_, (row.closed_ts if row.closed_ts is not pd.NaT else pd.Timestamp.max, row.source))
                out.append(reason)
            yield batch.assign(rejected=pd.Series(out, dtype=object, index=batch.index))

    rows = attempts.select(F.col(by).alias("listener"), "arrival", "source", "opened_ts", "closed_ts")
    schema = rows.select("*", F.lit("").alias("rejected")).schema
    schema["rejected"].nullable = True
    return rows.repartition("listener").sortWithinPartitions("listener", "arrival").mapInPandas(fold, schema)
