"""Mixing sources by temperature: weights by a bisected exponent, realised by block permutations. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import written

#: Documents of a block, about.
BLOCK_DOCS = 512
#: Exponents that one pass over the sources tries, and passes: 16^8 steps between 0 and 1.
TRIED, PASSES = 16, 8
SEED = "mix"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def exponent(sources: DataFrame, max_repeats: float | None, target_entropy: float | None) -> tuple[float, float, float]:
    """The exponent a of weights share^a, the sum of share^a, and the budget as a multiple of all tokens.

    sources: share. With target_entropy (nats) the greatest a in [0, 1] whose weights have that entropy;
    0 if none has. With max_repeats, a is raised until no source is repeated more often than that, under the
    least budget that keeps every source whole. Entropy falls and repeats fall as a grows, so both
    are found by narrowing an interval, TRIED exponents a pass, without collecting the sources.
    """

    def told(a: list[float]) -> list[dict]:
        p, cols = F.col("share"), []
        for i, x in enumerate(a):
            cols += [F.sum(F.pow(p, F.lit(x))).alias(f"z{i}"), F.sum(F.pow(p, F.lit(x)) * F.log(p)).alias(f"l{i}")]
        row = sources.agg(F.max("share").alias("top"), F.min("share").alias("low"), *cols).first()
        out = []
        for i, x in enumerate(a):
            z = row[f"z{i}"]
            # the budget that keeps the largest source whole, and how often the smallest then comes
            out.append({"a": x, "z": z, "entropy": math.log(z) - x * row[f"l{i}"] / z, "repeats": (row.top / row.low) ** (1 - x), "budget": z * row.top ** (1 - x)})
        return out

    def narrowed(fits_low) -> float:  # the greatest a for which fits_low still holds, or 0
        low, high = 0.0, 1.0
        for _ in range(PASSES):
            tried = [low + (high - low) * i / TRIED for i in range(TRIED + 1)]
            fits = [x["a"] for x in told(tried) if fits_low(x)]
            if not fits or fits[-1] == tried[-1]:
                return fits[-1] if fits else low
            low = fits[-1]
            high = tried[tried.index(low) + 1]
        return low

    a = narrowed(lambda x: x["entropy"] >= target_entropy) if target_entropy is not None else 0.0
    if max_repeats is not None and told([a])[0]["repeats"] > max_repeats:
        a = min(1.0, narrowed(lambda x: x["repeats"] > max_repeats) + TRIED**-PASSES)
    at = told([a])[0]
    return a, at["z"], at["budget"]


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
    max_repeats: float | None = None,
    target_entropy: float | None = None,
    budget: float | None = None,
) -> DataFrame:
    """One row per document: id, source, tokens, copies, weight; repeated rows are one row with n_rows.

    A source with the share p of all words gets the weight p^a / sum p^a; exponent() finds a. budget: words
    of the mixture; by default the least that keeps every source whole. The documents of a source are dealt into blocks by hash. A block comes
    as often as its source is repeated, the last time in part: the documents of its permutation (by md5) come as long as the
    middle of the document lies within the rest of the block's budget. So each block meets the weights to half a document.
    Documents without words come once and have no share. A null source is a source. Rows equal in id, source and number of words
    are one unit, so that each has the same copies. An empty table gives an empty result.
    """
    units = docs.select(F.col(id_col).alias("id"), F.col(source).alias("source"), n_words(F.col(text)).alias("tokens")).groupBy("id", "source", "tokens").agg(F.count(F.lit(1)).alias("n_rows"))
    units = written(units, "mix-units")
    per = written(units.groupBy("source").agg(F.sum(F.col("tokens") * F.col("n_rows")).alias("words"), F.count(F.lit(1)).alias("docs")), "mix-sources")
    total = per.agg(F.sum("words")).first()[0] or 0
    shares = per.where("words > 0").withColumn("share", F.col("words") / F.lit(float(max(total, 1))))
    a, z, factor = exponent(shares, max_repeats, target_entropy) if total else (1.0, 1.0, 1.0)
    words = float(total) * factor if budget is None else float(budget)
    weight = F.when(F.col("words") > 0, F.pow(F.col("words") / F.lit(float(max(total, 1))), F.lit(a)) / F.lit(z)).otherwise(F.lit(0.0))
    plan = per.select(F.col("source").alias("s"), weight.alias("weight"), F.ceil(F.col("docs") / BLOCK_DOCS).alias("blocks"), "words")
    # 1e-9: a source that is to come exactly n times isn't cut short by rounding
    plan = plan.withColumn("repeats", F.when(F.col("words") > 0, F.col("weight") * F.lit(words) / F.col("words") + F.lit(1e-9)).otherwise(F.lit(1.0)))
    rows = units.join(plan.drop("words"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    order = F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    rows = rows.withColumn("_md5", order).withColumn("_block", F.conv(F.substring("_md5", 25, 8), 16, 10).cast("long") % F.col("blocks"))
    rows = rows.withColumn("_words", F.col("tokens") * F.col("n_rows"))
    rows = rows.selectExpr(
        "*",
        "sum(_words) over (partition by source, _block) as _all",
        "sum(_words) over (partition by source, _block order by _md5, id, tokens rows unbounded preceding) - _words as _before",
    )
    whole = F.floor("repeats")
    extra = (F.col("_before") + F.col("_words") / 2.0 <= (F.col("repeats") - whole) * F.col("_all")).cast("long")
    return rows.select("id", "source", "tokens", "n_rows", F.when(F.col("tokens") > 0, whole + extra).otherwise(F.lit(1)).cast("long").alias("copies"), "weight")


def mixture(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", **targets: float | None) -> DataFrame:
    """docs, each row as often as its copies."""
    columns = docs.columns
    plan = mixed(docs, id_col, text, source, **targets).select(F.col("id").alias("_i"), F.col("source").alias("_s"), F.col("tokens").alias("_t"), "copies")
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], F.col(id_col).alias("_id"), F.col(source).alias("_source"), n_words(F.col(text)).alias("_tokens"))
    on = F.col("_id").eqNullSafe(F.col("_i")) & F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_tokens") == F.col("_t"))
    out = rows.join(plan.hint("shuffle_hash"), on).where("copies > 0").withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
