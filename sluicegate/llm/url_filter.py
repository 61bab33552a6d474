"""Allow and block lists of hosts and paths over URLs, by hashed host-suffix and path-prefix expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules up to this many are broadcast; at 200 bytes a rule that is 20 MB. More are joined by a shuffle.
BROADCAST_RULES = 100_000
#: Hex digits of the digest on which the equi-join runs; whole digests are compared after it.
PREFIX_DIGITS = 8
#: The letters that a host is lower-cased by.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    # no host holds a slash and a path is empty or starts with one, so the two parts stay apart
    return F.sha2(F.concat(host, path), 256)


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Adds host, path, rule and verdict to every row of pages.

    rules: host, path, verdict (allow or block). A rule fits its host and all subdomains, if the path
    of the url starts with the rule's. The longest fitting rule (host and path together) wins; of
    equally long ones that with the longer host, then block before allow. Without one, rule is null and
    verdict is default. Null urls and urls without :// have an empty host and path. Rows of rules with a
    null host are left out; a null path is an empty one. Rows of pages stay as they are, repeated ones
    too; columns of pages named host, path, rule or verdict are replaced.

    The distinct (host, path) pairs are expanded, so a frequent url costs one expansion, and the best
    rule goes back to the rows by an equi-join. Of the suffixes and prefixes of a url only those as
    long as some rule's are made.
    """
    rules = rules.where("host is not null").select(
        F.translate("host", UPPER, LOWER).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), F.col("verdict").alias("r_verdict")
    ).distinct()
    rules = rules.withColumn("r_digest", _digest(F.col("r_host"), F.col("r_path"))).withColumn("r_short", F.substring("r_digest", 1, PREFIX_DIGITS))
    shape = rules.agg(
        F.count(F.lit(1)).alias("n"),
        F.sort_array(F.collect_set(F.size(F.split("r_host", r"\.")))).alias("labels"),
        F.sort_array(F.collect_set(F.length("r_path"))).alias("lengths"),
    ).first()
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    rows = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))

    urls = rows.select("host", "path").where("host <> ''").distinct()
    n_labels = F.size(F.split("host", r"\."))
    suffixes = F.transform(F.filter(_ints(shape.labels), lambda k: k <= n_labels), lambda k: F.call_function("substring_index", F.col("host"), F.lit("."), -k))
    prefixes = F.transform(F.filter(_ints(shape.lengths), lambda k: k <= F.length("path")), lambda k: F.substring(F.col("path"), F.lit(1), k))
    said = urls.withColumn("suffix", F.explode(suffixes)).withColumn("prefix", F.explode(prefixes))
    said = said.withColumn("digest", _digest(F.col("suffix"), F.col("prefix"))).withColumn("r_short", F.substring("digest", 1, PREFIX_DIGITS))
    held = F.broadcast(rules) if shape.n <= BROADCAST_RULES else rules
    fits = said.join(held, "r_short").where("digest = r_digest")
    rank = F.struct(F.length(F.concat("r_host", "r_path")), F.length("r_host"), (F.col("r_verdict") == "block").cast("int"))
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict")), rank).alias("best"))
    # rows without a host share one key that no rule fits, so they are left out of the join
    told = rows.where("host <> ''").join(best, ["host", "path"], "left").unionByName(rows.where("host = ''"), allowMissingColumns=True)
    return told.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


def _ints(values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<int>")
