"""Queries over the events table, one per operator, each with the SQL that says the same over plain columns.

Events become an envelope: a JSON text, a connection, a sequence, a window of 50 events. Rules
read the JSON; the SQL reads the columns it was made from.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.operators import admission, batching, claims, filter, keys, ledger, reporting
from sluicegate.shipping import ship
from sluicegate.sources import framing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

IP = "concat('10.', cast(user_id % 256 as string), '.', cast(event_id % 256 as string), '.', cast(k as string))"
#: By k modulo 3 an IPv6 address, no address, an IPv4 address; a network that holds the event's address where k is even or its third octet is 0.
ANY_IP = "case k % 3 when 0 then concat('2001:db8::', lower(hex(user_id % 3)), ':', lower(hex(event_id % 256))) when 1 then concat('x', ip) else ip end"
NET = "case when k % 2 = 0 then '10.0.0.0/8' else concat('10.', user_id % 256, '.0.0/24') end"
DEEP = "array(array(array(array(array(array(k))))), array(array(array(array(array(-1))))))"
#: The same table for SQL: columns as the rules see them.
E_SQL = """e AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(json_extract(props, '$.k') AS INT) AS k,
         'c' || (user_id % 8) AS conn_id, row_number() OVER (PARTITION BY user_id % 8 ORDER BY event_id) AS sequence,
         '10.' || (user_id % 256) || '.' || (event_id % 256) || '.' || CAST(json_extract(props, '$.k') AS INT) AS ip
  FROM events
), w AS (
  SELECT *, (sequence - 1) // 50 + 1 AS window_id, (sequence - 1) % 50 AS "offset", sequence % 50 = 0 AS window_complete FROM e
)"""


def events(spark: SparkSession, sf_dir: str, ledger_columns: bool = False, wide: bool = False) -> DataFrame:
    """event_id, raw, and with ledger_columns conn_id, sequence, window_id, ...; these need one window per connection.

    wide: raw has an agent, addresses of both kinds and nested arrays as well.
    """
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    df = df.withColumn("ip", F.expr(IP))
    doc = F.struct(
        F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type")).alias("event"),
        F.struct(F.col("user_id").alias("id"), F.upper("event_type").alias("group")).alias("user"),
        F.struct(F.col("k").alias("k"), F.col("k").cast("string").alias("text"), (F.col("k") % 2 == 0).alias("even"), F.when(F.col("k") % 2 == 1, F.col("k")).alias("odd")).alias("metric"),
        F.struct(F.col("ip").alias("ip"), *([F.expr(ANY_IP).alias("any"), F.expr(NET).alias("net")] if wide else [])).alias("source"),
        *([F.when(F.col("k") % 4 == 0, F.struct(F.col("event_type").alias("type"))).alias("agent"), F.expr(DEEP).alias("deep")] if wide else []),
        F.array(F.col("event_type"), F.col("k").cast("string")).alias("tags"),
    )
    df = df.withColumn("raw", F.to_json(doc))
    if not ledger_columns:
        return df.select("event_id", "event_type", F.concat(F.lit("c"), (F.col("user_id") % 8).cast("string")).alias("conn_id"), F.col("event_id").alias("sequence"), "raw")
    df = df.select("event_id", "event_type", "ts", "k", F.concat(F.lit("c"), (F.col("user_id") % 8).cast("string")).alias("conn_id"), "ip", "raw")
    df = df.selectExpr("*", "cast(row_number() over (partition by conn_id order by event_id) as long) as sequence")
    return df.selectExpr(
        "event_id", "event_type", "k", "conn_id", "sequence", "event_id as arrival", "cast((sequence - 1) div 50 + 1 as long) as window_id",
        "cast((sequence - 1) % 50 as long) as offset", "sequence % 50 = 0 as window_complete", "ip as remote_address", "5044 as remote_port",
        "cast(null as string) as tls_subject", "cast(null as string) as tls_issuer", "cast(ts as timestamp) as received_ts", "raw", "cast(octet_length(raw) as long) as payload_bytes",
    )


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle if oracle.lstrip().startswith("WITH") else f"WITH {E_SQL} {oracle}"
        return f

    return register


#: name: (rule, the same over columns). Each query counts the events that the rule drops, by type.
RULES = {
    "flt_eq_number": ("metric.k == 42", "k = 42"),
    "flt_eq_string_number": ('metric.text == 42 || metric.k == "7"', "k IN (42, 7)"),
    "flt_ne_missing": ("metric.odd != 7", "k <> 7"),
    "flt_cmp_numeric_string": ('metric.text >= "9"', "k >= 9"),
    "flt_cmp_string": ('event.type < "m"', "event_type < 'm'"),
    "flt_bool_precedence": ("metric.k < 10 || metric.k > 50 && !metric.even == false", "k < 10 OR (k > 50 AND k % 2 = 0)"),
    "flt_not_nonboolean": ("!event.type && metric.even", "k % 2 = 0"),
    "flt_parentheses": ("(metric.k < 10 || metric.k > 90) && metric.even", "(k < 10 OR k > 90) AND k % 2 = 0"),
    "flt_array_literal": ('contains(["click", 5, metric.k], event.type)', "event_type = 'click'"),
    "fn_contains": ('contains(event.type, "i")', "contains(event_type, 'i')"),
    "fn_contains_array": ('contains(tags, "click")', "event_type = 'click'"),
    "fn_contains_any": ('containsAny(event.type, ["ck", "ur"])', "contains(event_type, 'ck') OR contains(event_type, 'ur')"),
    "fn_starts_with": ('startsWith(event.type, "c")', "starts_with(event_type, 'c')"),
    "fn_starts_with_any": ('startsWithAny(tags, ["v", "9"])', "starts_with(event_type, 'v') OR starts_with(k::VARCHAR, '9')"),
    "fn_ends_with": ('endsWith(event.type, "e")', "ends_with(event_type, 'e')"),
    "fn_ends_with_any": ('endsWithAny(event.type, ["k", "w"])', "ends_with(event_type, 'k') OR ends_with(event_type, 'w')"),
    "fn_contains_ignore_case": ('containsIgnoreCase(user.group, "Lic")', "contains(event_type, 'lic')"),
    "fn_contains_any_ignore_case": ('containsAnyIgnoreCase(tags, ["LIC", "77"])', "contains(event_type, 'lic') OR contains(k::VARCHAR, '77')"),
    "fn_starts_with_ignore_case": ('startsWithIgnoreCase(user.group, "cl")', "starts_with(event_type, 'cl')"),
    "fn_starts_with_any_ignore_case": ('startsWithAnyIgnoreCase(user.group, ["vi", "pu"])', "starts_with(event_type, 'vi') OR starts_with(event_type, 'pu')"),
    "fn_ends_with_ignore_case": ('endsWithIgnoreCase(user.group, "ck")', "ends_with(event_type, 'ck')"),
    "fn_ends_with_any_ignore_case": ('endsWithAnyIgnoreCase(user.group, ["ew", "ck"])', "ends_with(event_type, 'ew') OR ends_with(event_type, 'ck')"),
    "fn_equals_ignore_case": ('equalsIgnoreCase(user.group, ["click", "View"])', "event_type IN ('click', 'view')"),
    "fn_matches_regex": ('matchesRegex(event.type, "^c.*k$|ie")', "regexp_matches(event_type, '^c.*k$|ie')"),
    "fn_matches_regex_dynamic": ("matchesRegex(event.id, metric.text)", "contains(event_id::VARCHAR, k::VARCHAR)"),
    "fn_exists": ("exists(metric.odd) && !exists(metric.none)", "k % 2 = 1"),
    "fn_is_null": ("isNull(metric.none) || metric.k == 3", "k = 3"),
    "fn_in": ('in(metric.k, [1, "2", 3])', "k IN (1, 2, 3)"),
    "fn_in_dynamic": ("in(user.id, tags)", "user_id = k"),
    "fn_lower_upper": ('lower(user.group) == event.type && upper(event.type) == "CLICK"', "event_type = 'click'"),
    "fn_cidr_v4": ('cidrContains(source.ip, "10.16.0.0/12")', "user_id % 256 BETWEEN 16 AND 31"),
    "fn_cidr_any": ('cidrContainsAny(source.ip, ["10.0.0.0/9", "2001:db8::/32"])', "user_id % 256 < 128"),
    "fn_is_ip": ("isIp(source.any)", "k % 3 <> 1"),
    "fn_is_ipv4": ("isIpv4(source.any)", "k % 3 = 2"),
    "fn_is_ipv6": ("isIpv6(source.any)", "k % 3 = 0"),
    "fn_cidr_v6": ('cidrContains(source.any, "2001:db8::/112")', "k % 3 = 0 AND user_id % 3 = 0"),
    "fn_cidr_any_v6": ('cidrContainsAny(source.any, ["10.0.0.0/9", "2001:db8::1:0/112"])', "(k % 3 = 0 AND user_id % 3 = 1) OR (k % 3 = 2 AND user_id % 256 < 128)"),
    "fn_cidr_dynamic": ("cidrContains(source.ip, source.net)", "k % 2 = 0 OR event_id % 256 = 0"),
    "flt_deep_array": ('in(metric.k, [3, 4]) && containsAny(deep, ["3"])', "k = 3"),
}


def _rule_query(rule: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = filter.apply_filter(events(spark, sf_dir, wide=any(x in rule for x in ("source.any", "source.net", "deep"))), {"rule": rule})
        return found.where("drop").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))

    return run


for _name, (_rule, _sql) in RULES.items():
    QUERIES[_name] = _rule_query(_rule)
    ORACLES[_name] = f"WITH {E_SQL} SELECT event_type, count(*) AS n FROM e WHERE {_sql} GROUP BY event_type"

RULE_SET = {"a-click": 'event.type == "click" && metric.k < 30', "b-group": 'equalsIgnoreCase(user.group, "view")', "c-many": "in(metric.k, [5, 6, 7, 8])", "d-net": 'cidrContains(source.ip, "10.0.0.0/11")'}
RULE_CASE = "CASE WHEN event_type = 'click' AND k < 30 THEN 'a-click' WHEN event_type = 'view' THEN 'b-group' WHEN k IN (5, 6, 7, 8) THEN 'c-many' WHEN user_id % 256 < 32 THEN 'd-net' END"


@query(f"SELECT coalesce({RULE_CASE}, 'kept') AS rule_name, count(*) AS n FROM e GROUP BY 1")
def rules_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filter.apply_filter(events(spark, sf_dir), RULE_SET)
    return found.groupBy(F.coalesce("rule_name", F.lit("kept")).alias("rule_name")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT {RULE_CASE} AS rule_name, count(*) AS matches FROM e WHERE {RULE_CASE} IS NOT NULL GROUP BY 1")
def rules_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter.rule_counters(filter.apply_filter(events(spark, sf_dir), RULE_SET))


def _damaged(df: DataFrame) -> DataFrame:
    """Every event whose id ends in 13 has a byte too many."""
    return df.withColumn("raw", F.when(F.col("event_id") % 100 == 13, F.concat("raw", F.lit(" x"))).otherwise(F.col("raw")))


@query("SELECT event_id % 100 = 13 AS evaluation_error, event_type = 'click' AND event_id % 100 <> 13 AS \"drop\", count(*) AS n FROM e GROUP BY 1, 2")
def rules_keep_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filter.apply_filter(_damaged(events(spark, sf_dir)), {"r": 'event.type == "click"'})
    return found.groupBy("evaluation_error", "drop").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CASE WHEN event_id % 100 = 13 THEN 'evaluation_error' WHEN event_type = 'click' THEN 'r' END AS rule_name, count(*) AS n FROM e GROUP BY 1")
def rules_drop_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filter.apply_filter(_damaged(events(spark, sf_dir)), {"r": 'event.type == "click"'}, "DROP_EVENT")
    return found.groupBy("rule_name").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT conn_id, count(*) AS n FROM e LEFT JOIN (SELECT conn_id, min(event_id) AS first FROM e WHERE event_id % 100 = 13 GROUP BY 1) f USING (conn_id) WHERE first IS NULL OR event_id < first GROUP BY 1")
def rules_close_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filter.apply_filter(_damaged(events(spark, sf_dir)), {"r": 'event.type == "none"'}, "CLOSE_CONNECTION")
    return found.groupBy("conn_id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_type, count(*) AS n FROM e WHERE event_type = 'click' OR k IN (5, 6, 7, 8) GROUP BY 1")
def rules_indexed_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexed = {k: RULE_SET[k] for k in ("a-click", "c-many")}
    found = filter.candidates(events(spark, sf_dir), indexed).where("size(candidates) > 0")
    return found.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS filter_events_input, count(*) FILTER (event_type <> 'click') AS filter_events_kept, count(*) FILTER (event_type = 'click') AS filter_events_dropped, 0::BIGINT AS filter_evaluation_errors FROM e")
def filter_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.filter_metrics(filter.apply_filter(events(spark, sf_dir), {"r": 'event.type == "click"'})).drop("filter_bytes_dropped")


KEYS = {
    "key_none": ({"strategy": "NONE"}, "conn_id || ':' || sequence"),
    "key_per_source": ({"strategy": "PER_SOURCE"}, "ip"),
    "key_connection": ({"strategy": "CONNECTION"}, "conn_id"),
    "key_window": ({"strategy": "WINDOW"}, "conn_id || ':' || window_id"),
    "key_agent_type": ({"strategy": "PER_AGENT_TYPE"}, "CASE WHEN k % 4 = 0 THEN event_type ELSE '_missing' END"),
    "key_json_kv": ({"strategy": "JSON_KV", "pointers": ["/event/type", "/metric/k"]}, "event_type || chr(31) || k"),
    "key_size_time": ({"strategy": "SIZE_TIME"}, "'all'"),
    "key_hybrid": ({"strategy": "HYBRID", "pointers": ["/user/group"]}, "upper(event_type)"),
    "key_hash": ({"strategy": "JSON_KV", "pointers": ["/event/type"], "hashed": True}, "sha256(event_type)"),
    "key_missing": ({"strategy": "JSON_KV", "pointers": ["/metric/odd"], "default": "gone"}, "CASE WHEN k % 2 = 1 THEN k::VARCHAR ELSE 'gone' END"),
}


def _key_query(options: dict) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return keys.with_batch_key(events(spark, sf_dir, True, wide=options["strategy"] == "PER_AGENT_TYPE"), **options).groupBy("batch_key").agg(F.count(F.lit(1)).alias("n"))

    return run


for _name, (_options, _sql) in KEYS.items():
    QUERIES[_name] = _key_query(_options)
    ORACLES[_name] = f"WITH {E_SQL} SELECT {_sql} AS batch_key, count(*) AS n FROM w GROUP BY 1"


@query("SELECT conn_id AS batch_key, (sequence - 1) // 64 AS batch_no, count(*)::INT AS event_count FROM e GROUP BY 1, 2")
def batch_count_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = keys.with_batch_key(events(spark, sf_dir, True), "CONNECTION")
    found = batching.assign_batches(keyed, batching.Limits(events=64, timers=False))
    return found.groupBy("batch_key", "batch_no").agg(F.count(F.lit(1)).cast("int").alias("event_count"))


@query("SELECT conn_id AS batch_key, (sequence - 1) // 64 AS batch_no, count(*)::INT AS event_count FROM e GROUP BY 1, 2")
def batch_count_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = keys.with_batch_key(events(spark, sf_dir, True), "CONNECTION")
    return batching.count_batches(keyed, 64).groupBy("batch_key", "batch_no").agg(F.count(F.lit(1)).cast("int").alias("event_count"))


BYTES_SQL = f"""
WITH RECURSIVE {E_SQL}, s AS (
  SELECT conn_id, sequence, k + 1 AS size FROM e
), b AS (
  SELECT conn_id, sequence, 0 AS batch_no, size AS held, size >= 300 AS closed FROM s WHERE sequence = 1
  UNION ALL
  SELECT s.conn_id, s.sequence, CASE WHEN b.closed OR b.held + s.size > 300 THEN b.batch_no + 1 ELSE b.batch_no END,
         CASE WHEN b.closed OR b.held + s.size > 300 THEN s.size ELSE b.held + s.size END,
         CASE WHEN b.closed OR b.held + s.size > 300 THEN s.size ELSE b.held + s.size END >= 300
  FROM b JOIN s ON s.conn_id = b.conn_id AND s.sequence = b.sequence + 1
)
SELECT conn_id AS batch_key, batch_no::BIGINT AS batch_no, count(*) AS event_count FROM b GROUP BY 1, 2
"""


@query(BYTES_SQL)
def batch_byte_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = events(spark, sf_dir, True).withColumn("raw", F.repeat(F.lit("x"), F.col("k") + 1))
    found = batching.assign_batches(keys.with_batch_key(sized, "CONNECTION"), batching.Limits(bytes=300, timers=False))
    return found.groupBy("batch_key", "batch_no").agg(F.count(F.lit(1)).alias("event_count"))


@query("""SELECT conn_id AS batch_key, batch_no, count(*) AS event_count FROM (
  SELECT *, sum(CASE WHEN ts - prev >= INTERVAL 60 SECOND THEN 1 ELSE 0 END) OVER (PARTITION BY conn_id ORDER BY event_id)::BIGINT AS batch_no
  FROM (SELECT *, lag(ts) OVER (PARTITION BY conn_id ORDER BY event_id) AS prev FROM e)) GROUP BY 1, 2""")
def batch_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = batching.Limits(events=1 << 40, bytes=1 << 50, age=1 << 60, idle=60_000_000)
    found = batching.assign_batches(keys.with_batch_key(events(spark, sf_dir, True), "CONNECTION"), limits)
    return found.groupBy("batch_key", "batch_no").agg(F.count(F.lit(1)).alias("event_count"))


@query("SELECT conn_id || ':' || window_id AS batch_key, CASE WHEN count(*) = 50 THEN 'window-boundary' ELSE 'service-disabled' END AS flush_reason, count(*)::INT AS event_count, min(sequence) AS first_seq, count(*) AS lines FROM w GROUP BY conn_id, window_id")
def batch_window_ndjson(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = keys.with_batch_key(events(spark, sf_dir, True), "WINDOW")
    found = batching.collect_batches(batching.assign_batches(keyed, batching.Limits(strategy="WINDOW", timers=False)))
    lines = (F.length("ndjson") - F.length(F.replace("ndjson", F.lit("\n"), F.lit("")))).cast("long")
    return found.select("batch_key", "flush_reason", "event_count", F.col("runs")[0]["first_seq"].alias("first_seq"), lines.alias("lines"))


@query("SELECT conn_id || ':' || window_id AS batch_key, 'application/x-ndjson' AS mime, count(*)::VARCHAR AS n, min(sequence)::VARCHAR AS first, max(sequence)::VARCHAR AS last, 45::INT AS size FROM w GROUP BY conn_id, window_id")
def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = keys.with_batch_key(events(spark, sf_dir, True), "WINDOW").withColumn("remote_address", F.col("conn_id"))
    found = batching.collect_batches(batching.assign_batches(keyed, batching.Limits(strategy="WINDOW", timers=False)))
    a = reporting.attributes(found, "WINDOW", 5044)
    get = lambda k: F.col("attributes")[k]
    return a.select("batch_key", get("mime.type").alias("mime"), get("record.count").alias("n"), get("beats.sequence.first").alias("first"), get("beats.sequence.last").alias("last"), F.size("attributes").alias("size"))


@query("SELECT event_id, sequence, expected FROM (SELECT *, lag(sequence) OVER (PARTITION BY conn_id, window_id ORDER BY event_id) + 1 AS expected FROM w WHERE event_id % 7 <> 0) WHERE expected <> sequence")
def seq_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.sequence_gaps(events(spark, sf_dir, True).where("event_id % 7 <> 0")).select("event_id", "sequence", "expected")


@query("SELECT conn_id, window_id, min(sequence) AS first_seq, count(*) AS count FROM (SELECT *, sequence - row_number() OVER (PARTITION BY conn_id, window_id ORDER BY sequence) AS g FROM w WHERE event_id % 7 <> 0) GROUP BY conn_id, window_id, g")
def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.coalesce_runs(events(spark, sf_dir, True).where("event_id % 7 <> 0")).select("conn_id", "window_id", "first_seq", "count")


@query("""SELECT conn_id, window_id, max(sequence) AS ack_sequence, count(*) AS events_advanced FROM (
  SELECT *, sum(CASE WHEN event_id % 1000 = 999 THEN 1 ELSE 0 END) OVER (PARTITION BY conn_id ORDER BY sequence) AS open FROM w) WHERE open = 0 GROUP BY 1, 2""")
def ack_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = events(spark, sf_dir, True).withColumn("committed", F.col("event_id") % 1000 != 999)
    windows = own.select("conn_id", "window_id").distinct().withColumn("advertised", F.lit(50))
    return ledger.frontier(own, windows).select("conn_id", "window_id", "ack_sequence", "events_advanced")


@query("SELECT conn_id, count(*) AS n FROM w WHERE event_id % 7 <> 0 GROUP BY 1")
def commit_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = events(spark, sf_dir, True)
    kept = ledger.coalesce_runs(own.where("event_id % 7 <> 0"))
    return ledger.commit(own.withColumn("committed", F.lit(False)), kept).where("committed").groupBy("conn_id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT conn_id, count(*) AS n, count(*) FILTER (window_complete) AS complete FROM w GROUP BY 1")
def windows_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = events(spark, sf_dir, True).select("conn_id", "arrival", "sequence", "window_id", "offset")
    opened = own.where("offset = 0").selectExpr("conn_id", "arrival * 2 - 1 as frame_no", "'W' as type", "50L as window_size", "cast(null as long) as sequence")
    sent = own.selectExpr("conn_id", "arrival * 2 as frame_no", "'J' as type", "cast(null as long) as window_size", "sequence")
    found = ledger.assign_windows(opened.union(sent)).where("type = 'J'")
    return found.groupBy("conn_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("window_complete").alias("complete"))


@query("SELECT conn_id, max(open_events)::BIGINT AS most FROM (SELECT conn_id, sum(CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END) OVER (PARTITION BY conn_id ORDER BY event_id) AS open_events FROM w) GROUP BY 1")
def outstanding(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = events(spark, sf_dir, True).withColumn("committed", F.col("event_id") % 3 == 0)
    return ledger.outstanding(own).groupBy("conn_id").agg(F.max("open_events").alias("most"))


@query("SELECT count(*) FILTER (n <= 2) AS admitted, count(*) FILTER (n > 2) AS rejected FROM (SELECT row_number() OVER (PARTITION BY conn_id, date_trunc('second', ts) ORDER BY event_id) AS n FROM w)")
def rate_limit_1s(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = admission.rate_limited(events(spark, sf_dir, True), 2)
    return found.agg(F.count_if("within_rate").alias("admitted"), F.count_if(~F.col("within_rate")).alias("rejected"))


@query("""SELECT arrival, paused FROM (SELECT event_id AS arrival, coalesce(last_value(CASE WHEN k >= 80 THEN true WHEN k <= 60 THEN false END IGNORE NULLS)
  OVER (PARTITION BY conn_id ORDER BY event_id ROWS UNBOUNDED PRECEDING), false) AS paused FROM w)""")
def pressure_hysteresis(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = events(spark, sf_dir, True).select("arrival", F.col("conn_id").alias("listener"), F.col("k").alias("used"))
    return admission.pressure(own, 100).select("arrival", "paused")


@query()
def admission_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = events(spark, sf_dir, True).selectExpr("'l' as listener", "arrival", "conn_id as source", "received_ts as opened_ts", "received_ts + make_interval(0, 0, 0, 0, 1, 0, 0) as closed_ts")
    return admission.admit(own, 50, 10, 0, 3).groupBy(F.coalesce("rejected", F.lit("admitted")).alias("rejected")).agg(F.count(F.lit(1)).alias("n"))


#: Every window of every connection is a ready batch.
READY_SQL = """r AS (
  SELECT row_number() OVER (ORDER BY window_id, conn_id) AS ready_no, count(*)::INT AS event_count FROM w GROUP BY window_id, conn_id
)"""


def ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = events(spark, sf_dir, True).groupBy("window_id", "conn_id").agg(F.count(F.lit(1)).cast("int").alias("event_count"), F.lit(0).cast("long").alias("payload_bytes"))
    return own.selectExpr("cast(row_number() over (order by window_id, conn_id) as long) as ready_no", "event_count", "payload_bytes")


@query(f"WITH {E_SQL}, {READY_SQL} SELECT ready_no, event_count FROM (SELECT *, sum(event_count) OVER (ORDER BY ready_no) AS total FROM r) WHERE total <= 500 AND ready_no <= 32")
def claim_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.claim(ready(spark, sf_dir), 32, 500).select("ready_no", "event_count")


#: Claims of four batches; every third of them is committed, every third rolled back, then committed too late, some are abandoned.
def _claimed(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = ready(spark, sf_dir).selectExpr("(ready_no - 1) div 4 as n", "ready_no").selectExpr("concat('claim', n) as claim_id", "n", "ready_no")
    said = own.where("n % 3 < 2 or n % 9 = 8").selectExpr("claim_id", "case when n % 9 = 8 then 'ABANDONED' when n % 3 = 0 then 'COMMIT_CONFIRMED' else 'ROLLBACK_CONFIRMED' end as state", "1L as at")
    late = own.where("n % 3 = 1").selectExpr("claim_id", "'COMMIT_CONFIRMED'", "2L").union(spark.sql("select 'unknown', 'COMMIT_CONFIRMED', 1L"))
    return claims.resolved(own.select("claim_id", "ready_no"), said.union(late))


CLAIM_STATE = "CASE WHEN n % 9 = 8 THEN 'ABANDONED' WHEN n % 3 = 0 THEN 'COMMIT_CONFIRMED' WHEN n % 3 = 1 THEN 'ROLLBACK_CONFIRMED' ELSE 'CLAIMED' END"


@query(f"WITH {E_SQL}, {READY_SQL} SELECT {CLAIM_STATE} AS state, count(DISTINCT n) AS claims, count(*) AS batches FROM (SELECT (ready_no - 1) // 4 AS n FROM r) GROUP BY 1")
def claim_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.snapshot(_claimed(spark, sf_dir))


@query(f"WITH {E_SQL}, {READY_SQL} SELECT 'claim' || n AS claim_id, ready_no FROM (SELECT (ready_no - 1) // 4 AS n, ready_no FROM r) WHERE n % 3 = 1")
def claim_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _claimed(spark, sf_dir)
    return claims.records(own, own.where("state = 'ROLLBACK_CONFIRMED'").select("claim_id").distinct()).select("claim_id", "ready_no")


@query(f"""WITH {E_SQL}, {READY_SQL}, q AS (SELECT *, row_number() OVER (ORDER BY ready_no) AS place, sum(event_count) OVER (ORDER BY ready_no) AS total
  FROM (SELECT *, (ready_no - 1) // 4 AS n FROM r) WHERE {CLAIM_STATE} IN ('ROLLBACK_CONFIRMED', 'ABANDONED'))
  SELECT ready_no, 'next' AS claim_id, 'CLAIMED' AS state FROM q WHERE place = 1 OR (place <= 6 AND total <= 10000)""")
def claim_after_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.next_claim(ready(spark, sf_dir), _claimed(spark, sf_dir), "next", 6).select("ready_no", "claim_id", "state")


@query("""SELECT avg(2 + CASE WHEN event_type = 'click' THEN 1 ELSE 0 END + CASE WHEN k IN (5, 6, 7, 8) THEN 1 ELSE 0 END) AS filter_candidate_rules_avg,
  avg(CASE WHEN event_type = 'click' AND k < 30 THEN 1
           ELSE CASE WHEN event_type = 'click' THEN 1 ELSE 0 END + 1 + CASE WHEN event_type = 'view' THEN 0 ELSE 1 END END) AS filter_rules_evaluated_avg,
  1.0::DOUBLE AS filter_json_passes_avg, 4.0::DOUBLE AS filter_values_extracted_avg FROM e""")
def filter_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules a and c are indexed, b and d are not; an event is tried on its candidates in order up to the one that drops it."""
    own = filter.candidates(events(spark, sf_dir), RULE_SET)
    return reporting.filter_averages(filter.apply_filter(own, RULE_SET), RULE_SET)


@query("""SELECT * FROM (SELECT count(k) AS count, floor(avg(k))::BIGINT AS mean, max(k)::BIGINT AS max FROM e),
  (SELECT quantile_disc(k, 0.5)::BIGINT AS p50, quantile_disc(k, 0.95)::BIGINT AS p95, quantile_disc(k, 0.99)::BIGINT AS p99 FROM (SELECT k FROM e ORDER BY event_id DESC LIMIT 2048))""")
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.latency_summary(events(spark, sf_dir, True).select(F.col("k").cast("long").alias("ms"), "event_id"), "ms", "event_id")


@query("SELECT event_id, '3241' || upper(lpad(to_hex(sequence), 8, '0')) AS ack FROM e")
def ack_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir, True).select("event_id", F.hex(framing.ack_column(F.col("sequence"))).alias("ack"))


@query("SELECT conn_id, count(*) AS n, count(DISTINCT window_id) AS windows, sum(sequence)::BIGINT AS sequences FROM w GROUP BY 1")
def frames_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events are framed window by window, some compressed, and decoded again."""
    own = events(spark, sf_dir, True)
    frames = own.groupBy("conn_id", "window_id").agg(F.array_sort(F.collect_list(F.struct("sequence", "raw"))).alias("own"))

    def framed(batches):
        for pdf in batches:
            data = []
            for window_id, rows in zip(pdf["window_id"], pdf["own"]):
                body = framing.window(len(rows)) + b"".join(framing.event(r["sequence"], r["raw"].encode()) for r in rows)
                data.append(framing.envelope(body) if window_id % 2 else body)
            yield pdf[["capture_id", "conn_id"]].assign(data=data)

    captures = frames.withColumn("capture_id", F.concat_ws(":", "conn_id", F.col("window_id").cast("string"))).mapInPandas(framed, "capture_id string, conn_id string, data binary")
    found = framing.decode(captures).where("error is null")
    return found.groupBy("conn_id").agg(F.count_if(F.col("type") == "J").alias("n"), F.count_if(F.col("type") == "W").alias("windows"), F.sum("sequence").alias("sequences"))


#: message of a closed connection by event_id modulo 5: reason.
CLOSED = {
    "JSON frame exceeds maximum frame size": "FRAME_TOO_LARGE", "window exceeds maximum events": "WINDOW_TOO_LARGE", "sequence gap": "PROTOCOL_VIOLATION",
    "outstanding unacknowledged events exceed the per-connection maximum": "PER_CONNECTION_MEMORY_LIMIT", "it did not complete within 30 s": "PARTIAL_FRAME_TIMEOUT",
}


@query("SELECT CASE event_id % 5 " + " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(CLOSED.values())) + " END AS reason, count(*) AS n FROM e GROUP BY 1")
def close_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.array(*[F.lit(m) for m in CLOSED])[(F.col("event_id") % 5).cast("int")]
    return events(spark, sf_dir).groupBy(reporting.close_reason(message).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT conn_id, count(*) AS n FROM e LEFT JOIN (SELECT conn_id, min(sequence) AS first FROM e WHERE k % 64 = 0 GROUP BY 1) f USING (conn_id) WHERE first IS NULL OR sequence < first GROUP BY 1")
def key_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event without a key ends its connection."""
    own = events(spark, sf_dir, True).withColumn("raw", F.when(F.col("k") % 64 == 0, F.lit("{}")).otherwise(F.col("raw")))
    return keys.with_batch_key(own, "JSON_KV", ["/event/type"], "REJECT").groupBy("conn_id").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT remote, batch_no, count(*)::INT AS event_count FROM (SELECT conn_id IN ('c0', 'c1') AS remote, (row_number() OVER (PARTITION BY conn_id IN ('c0', 'c1') ORDER BY event_id) - 1) // 100 AS batch_no FROM e) GROUP BY 1, 2""")
def batch_two_listeners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key for all events, but each listener has batches of its own."""
    keyed = keys.with_batch_key(events(spark, sf_dir, True), "SIZE_TIME").withColumn("remote", F.col("conn_id").isin("c0", "c1"))
    found = batching.collect_batches(batching.assign_batches(keyed, batching.Limits(events=100, timers=False), shard="remote"), shard="remote")
    return found.select("remote", "batch_no", "event_count")


@query("""SELECT conn_id, batch_key, batch_no, count(*)::INT AS event_count FROM (SELECT conn_id, event_type AS batch_key, sum(new) OVER (PARTITION BY conn_id ORDER BY event_id)::BIGINT - 1 AS batch_no FROM (
  SELECT *, CASE WHEN event_type = lag(event_type) OVER (PARTITION BY conn_id ORDER BY event_id) THEN 0 ELSE 1 END AS new FROM e)) GROUP BY 1, 2, 3""")
def batch_active_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of one open batch: an event of another key ends it."""
    keyed = keys.with_batch_key(events(spark, sf_dir, True), "JSON_KV", ["/event/type"])
    found = batching.assign_limited(keyed, batching.Limits(events=1 << 30, timers=False), 1, shard="conn_id")
    return found.groupBy("conn_id", "batch_key", "batch_no").agg(F.count(F.lit(1)).cast("int").alias("event_count"))
