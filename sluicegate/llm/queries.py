"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm import chat_format, euclid_lsh, language_id, line_dedup, mixing, packing, pseudo_lm, rp_forest, simhash, url_filter
from sluicegate.llm.common import table, written

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language_id.fit_on(docs, ~held_out)
    return language_id.identify(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = line_dedup.drop_recurring(docs)
    return found.select("doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"), F.col("n_dropped").cast("long").alias("n_dropped"))


#: A leaf is gone through by rounds, each of which finds one more template.
OP2_SQL = r"""
WITH RECURSIVE l AS (
  SELECT doc_id, no - 1 AS no, parts[no] AS raw FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL), LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS no)
), m AS (
  SELECT doc_id, no, regexp_replace(trim(regexp_replace(raw, '\s+', ' ', 'g')), '[^ ]*[0-9][^ ]*', '<*>', 'g') AS masked FROM l WHERE regexp_matches(raw, '\S')
), k AS (
  SELECT *, string_split(masked, ' ') AS toks, len(string_split(masked, ' ')) AS n FROM m
), c AS (
  SELECT n, toks[1:3] AS lead, masked, any_value(toks) AS toks, count(*) AS c, md5(masked) AS tie, count(*) OVER (PARTITION BY n, toks[1:3]) AS m FROM k GROUP BY n, toks[1:3], masked
), round AS (
  SELECT n, lead, masked, toks, c, tie, NULL::VARCHAR AS template FROM c WHERE m > 1
  UNION ALL
  SELECT n, lead, masked, toks, c, tie, CASE WHEN list_sum([(toks[i] = model[i])::INT FOR i IN range(1, n + 1)]) >= 0.8 * n THEN top END
  FROM (SELECT *, first_value(masked) OVER w AS top, first_value(toks) OVER w AS model FROM round WHERE template IS NULL WINDOW w AS (PARTITION BY n, lead ORDER BY c DESC, tie DESC))
), own AS (
  SELECT n, lead, masked, template FROM round WHERE template IS NOT NULL UNION ALL SELECT n, lead, masked, masked FROM c WHERE m = 1
), t AS (
  SELECT k.doc_id, k.no, k.n, k.masked, own.lead, own.template FROM k JOIN own ON k.n = own.n AND k.masked = own.masked
), held AS (
  SELECT n, lead, template, min(doc_id) AS first FROM t GROUP BY 1, 2, 3 HAVING count(DISTINCT doc_id) >= CASE WHEN n < 5 AND max(length(masked)) < 40 THEN 10 ELSE 2 END
), gone AS (
  SELECT t.doc_id, t.no FROM t JOIN held ON t.n = held.n AND t.lead = held.lead AND t.template = held.template WHERE t.doc_id <> held.first
), made AS (
  SELECT doc_id, string_agg(raw, chr(10) ORDER BY no) AS text FROM l WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = l.doc_id AND g.no = l.no) GROUP BY 1
)
SELECT d.doc_id, length(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(made.text, '') END)::INT AS n_chars, md5(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(made.text, '') END) AS text_md5,
       coalesce(x.n, 0) AS n_dropped
FROM documents d LEFT JOIN made ON made.doc_id = d.doc_id LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1) x ON x.doc_id = d.doc_id
"""


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


OP3_SQL = r"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url FROM pages
), p AS (
  SELECT page_id,
         translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM u
), r(r_host, r_path, r_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), best AS (
  SELECT host, path, arg_max(r_host || r_path, length(r_host || r_path)) AS rule, arg_max(r_verdict, length(r_host || r_path)) AS v
  FROM (SELECT DISTINCT host, path FROM p) JOIN r
    ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
  GROUP BY host, path
)
SELECT page_id, p.host, p.path, rule, coalesce(v, 'allow') AS verdict
FROM p LEFT JOIN best ON p.host = best.host AND p.path = best.path
"""


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return euclid_lsh.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op5_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudo_lm.score(docs, pseudo_lm.fit(docs))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "id % 50 = 0", 5)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = mixing.mixed(docs, max_repeats=4.0)
    return found.select(F.col("id").alias("doc_id"), "source", F.col("tokens").alias("n_words"), "n_rows", "copies")


#: The exponent in closed form: the smallest source comes (largest / smallest)^(1 - a) times.
OP7_SQL = r"""
WITH u AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '\S+'))::BIGINT AS n_words, count(*) AS n_rows FROM documents GROUP BY 1, 2, 3
), s AS (
  SELECT source, sum(n_words * n_rows)::DOUBLE AS words, ceil(count(*) / 512.0)::BIGINT AS blocks FROM u GROUP BY 1
), t AS (
  SELECT max(words) AS top, max(words) / min(words) AS ratio FROM s WHERE words > 0
), r AS (
  SELECT source, blocks, CASE WHEN words > 0 THEN (top / words) ** (1 - CASE WHEN ratio > 4 THEN 1 - ln(4) / ln(ratio) ELSE 0 END) + 1e-9 ELSE 1 END AS repeats FROM s, t
), b AS (
  SELECT u.*, repeats, md5('mix' || coalesce(doc_id::VARCHAR, '')) AS h, ('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, '')), 25, 8))::BIGINT % blocks AS block
  FROM u JOIN r ON u.source IS NOT DISTINCT FROM r.source
), c AS (
  SELECT *, sum(n_words * n_rows) OVER (PARTITION BY source, block) AS whole,
         sum(n_words * n_rows) OVER (PARTITION BY source, block ORDER BY h, doc_id, n_words ROWS UNBOUNDED PRECEDING) - n_words * n_rows AS before
  FROM b
)
SELECT doc_id, source, n_words, n_rows,
       CASE WHEN n_words > 0 THEN floor(repeats)::BIGINT + (before + n_words * n_rows / 2.0 <= (repeats - floor(repeats)) * whole)::BIGINT ELSE 1 END AS copies
FROM c
"""


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    trap = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", trap), (-7, 1, "assistant", trap)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return chat_format.format_chats(turns).mapInArrow(_chat_digests, schema)


def _chat_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for formatted, spans in zip(batch.column(1), batch.column(2)):
            formatted = formatted.as_py()
            turns = chat_format.parse(formatted)
            loss = "".join(chat_format.unescaped(formatted[s["start"] : s["end"]]) for s in spans.as_py())
            told = "".join(f"{role}\n{text}\n" for role, text in turns)
            out.append((len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
        columns = list(zip(*out)) or [()] * 5
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, type=k) for c, k in zip(columns, kinds))], names=names)


OP9_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, regexp_replace(text, '([<\\[])(\\\\*)(\\|im_start\\|>|\\|im_end\\|>|\\|endoftext\\|>|\\|system\\|>|\\|user\\|>|\\|assistant\\|>|s>|/s>|INST\\]|/INST\\]|<SYS>>|</SYS>>)', '\\1\\\\\\2\\3', 'g') AS inside FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>') + length(role) + 1 + length(inside) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digests = written(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return packing.pack(digests, ["doc_id", "piece", "start", "ids_crc32"])


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_line_dedup": op2_line_dedup,
    "op3_url_filter": op3_url_filter,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_pseudo_likelihood": op5_pseudo_likelihood,
    "op6_nearest": op6_nearest,
    "op7_mixing": op7_mixing,
    "op8_simhash": op8_simhash,
    "op9_chat_format": op9_chat_format,
    "op10_best_fit_packing": op10_best_fit_packing,
}
ORACLES = {"op2_line_dedup": OP2_SQL, "op3_url_filter": OP3_SQL, "op7_mixing": OP7_SQL, "op9_chat_format": OP9_SQL}
