import time

from sluicegate.operators.batching import Limits
from sluicegate.streaming.batcher import batched, write_batches


def test_stream_batches_by_count_and_idle_time(spark, tmp_path):
    source = tmp_path / "in"
    for i in range(2):
        spark.createDataFrame([("k", j, f"e{j}") for j in range(5 * i, 5 * i + 5)], "batch_key string, arrival long, raw string").coalesce(1).write.mode("append").parquet(str(source))
    events = spark.readStream.schema("batch_key string, arrival long, raw string").parquet(str(source))
    query = write_batches(batched(events, Limits(events=4, age=10_000_000, idle=1_000_000)), str(tmp_path / "out"), str(tmp_path / "check"), processingTime="1 second")
    try:
        for _ in range(120):
            time.sleep(1)
            assert query.exception() is None
            try:
                got = spark.read.parquet(str(tmp_path / "out")).orderBy("batch_no").collect()
            except Exception:  # noqa: BLE001  nothing is written yet
                continue
            if sum(r.event_count for r in got) == 10:
                break
    finally:
        query.stop()
    assert [(r.batch_no, r.flush_reason, r.event_count) for r in got] == [(0, "event-count", 4), (1, "event-count", 4), (2, "idle", 2)]
    assert "".join(r.ndjson for r in got).split() == [f"e{j}" for j in range(10)]
