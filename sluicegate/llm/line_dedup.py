"""Lines that recur across documents, found by a fixed-depth tree of line templates. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import written

#: Leading tokens that the tree looks at, below the number of tokens.
DEPTH = 3
#: Share of positions at which a line agrees with its template.
SIMILAR = 0.8
#: Lines of a leaf that are looked at together: its most frequent ones that have no template yet.
HEAD = 256
#: Documents across which a template recurs; one of short lines, of fewer than SHORT tokens and SHORT_CHARS characters, needs SHORT_DOCS.
MIN_DOCS, SHORT, SHORT_CHARS, SHORT_DOCS = 2, 5, 40, 10
ANY = "<*>"


def _masked(line: Column) -> Column:
    """A line's tokens between single spaces; those with a digit are variable fields from the start."""
    other = reduce(Column.__or__, [F.contains(line, F.lit(x)) for x in ("  ", "\t", "\r", "\x0b", "\f")])
    plain = F.trim(F.when(other, F.regexp_replace(line, r"\s+", " ")).otherwise(line))
    return F.when(plain.rlike("[0-9]"), F.regexp_replace(plain, r"[^ ]*[0-9][^ ]*", ANY)).otherwise(plain)


def _lines(docs: DataFrame, id_col: str, text: str, short: int, short_chars: int) -> DataFrame:
    """(doc, id, no, n, short, leaf, line) of every line that isn't blank; doc and id together stand for a document."""
    doc = docs.where(F.col(text).isNotNull()).select(F.xxhash64(id_col, text).alias("doc"), F.col(id_col).alias("id"), F.posexplode(F.split(text, "\n")).alias("no", "raw"))
    own = doc.select("doc", "id", "no", _masked(F.col("raw")).alias("masked")).where("masked <> ''")
    own = own.withColumn("n", F.octet_length("masked") - F.octet_length(F.replace("masked", F.lit(" "), F.lit(""))) + 1)
    few = (F.col("n") < short) & (F.length("masked") < short_chars)
    return own.select("doc", "id", "no", "n", few.alias("short"), F.xxhash64("n", F.substring_index("masked", " ", DEPTH)).alias("leaf"), F.xxhash64("masked").alias("line"))


def _agree(a: str, b: str) -> str:
    """SQL: whether two arrays of as many tokens agree at SIMILAR of the places."""
    return f"size(filter(zip_with({a}, {b}, (p, q) -> p = q), same -> same)) >= {SIMILAR}D * size({a})"


def _classes(light: DataFrame) -> DataFrame:
    """(leaf, line, c, doc, no, m) of the distinct lines that occur more than once or share their leaf: how often, one place, lines of the leaf.

    Lines too short to differ anywhere count as alone in their leaf.
    """
    all_of = light.groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("c"), F.first("doc").alias("doc"), F.first("no").alias("no"), F.first("n").alias("n"))
    several = all_of.where(F.ceil(SIMILAR * F.col("n")) < F.col("n")).groupBy("leaf").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    return all_of.join(several, "leaf", "left").where("c > 1 or m is not null").select("leaf", "line", "c", "doc", "no", "m")


def _tokens(classes: DataFrame, docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(leaf, line, c, m, tie, toks) of the lines that share their leaf; toks: a hash of each token; tie: the md5 of the masked line.

    A line's text is read from one place where it stands, so texts are shuffled once and only such lines are masked again.
    """
    wanted = classes.where("m is not null").groupBy("doc").agg(F.collect_list(F.struct("no", "leaf", "line", "c", "m")).alias("wanted"))
    own = docs.where(F.col(text).isNotNull()).select(F.xxhash64(id_col, text).alias("doc"), F.col(text).alias("text"))
    found = own.join(wanted, "doc").select(F.split("text", "\n").alias("parts"), "wanted").select("parts", F.explode("wanted").alias("w"))
    found = found.select("w.leaf", "w.line", "w.c", "w.m", _masked(F.get("parts", F.col("w.no"))).alias("masked"))
    toks = F.transform(F.split("masked", " "), lambda t: F.xxhash64(t))
    return found.select("leaf", "line", "c", "m", F.md5("masked").alias("tie"), toks.alias("toks")).dropDuplicates(["leaf", "line"])


def _heads(lines: DataFrame) -> DataFrame:
    """(leaf, found, made) for leaves of at most HEAD lines: the templates in order, and which line has which.

    The lines of a leaf are gone through from the most frequent to the rarest, ties by md5. A line that agrees with no
    template so far becomes the next one, any other belongs to the first with which it agrees.
    """
    per = lines.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("c", "tie", "line", "toks")), asc=False).alias("lines"))
    none = "named_struct('found', cast(array() as array<struct<line: bigint, toks: array<bigint>>>), 'made', cast(array() as array<struct<line: bigint, template: bigint>>))"
    step = f"""element_at(transform(array(filter(s.found, t -> {_agree('x.toks', 't.toks')})), hits -> named_struct(
        'found', if(size(hits) > 0, s.found, array_append(s.found, named_struct('line', x.line, 'toks', x.toks))),
        'made', array_append(s.made, named_struct('line', x.line, 'template', if(size(hits) > 0, hits[0].line, x.line))))), 1)"""
    return per.select("leaf", F.expr(f"aggregate(lines, {none}, (s, x) -> {step})").alias("s")).select("leaf", "s.found", "s.made")


def _merged(classes: DataFrame, docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(leaf, line, template) of the lines that share their leaf.

    Leaves of up to HEAD lines are done at once. Of a larger one the HEAD most frequent lines are, then its other lines
    are compared with the templates found by a join on the leaf, whose hot leaves Spark may split, and those
    that agree with none go on. So no task collects more than HEAD lines, and the templates are those of one pass over all lines.
    """
    rest = written(_tokens(classes, docs, id_col, text), "line-classes")
    small = _heads(rest.where(F.col("m") <= HEAD)).select("leaf", F.inline("made"))
    parts, rest = [small], rest.where(F.col("m") > HEAD)
    while rest.limit(1).count():
        head = rest.selectExpr("*", "row_number() over (partition by leaf order by c desc, tie desc) as _rank").where(F.col("_rank") <= HEAD)
        models = written(_heads(head), "line-heads")
        made = models.select("leaf", F.inline("made"))
        parts.append(made)
        tail = rest.join(made, ["leaf", "line"], "left_anti").join(models.select("leaf", "found"), "leaf")
        hit = F.expr(f"get(filter(found, t -> {_agree('toks', 't.toks')}), 0).line")
        tried = written(tail.withColumn("template", hit).drop("found"), "line-tried")
        parts.append(tried.where("template is not null").select("leaf", "line", "template"))
        rest = tried.where("template is null").drop("template")
    return reduce(DataFrame.union, parts)


def _copies(found: DataFrame, words: DataFrame, least: float) -> DataFrame:
    """(doc, source) of the documents that are a copy of one earlier document as a whole.

    source is the document in which most words of doc's recurring lines stand first. doc is its copy if the
    lines that both have, as often as both have them, hold the share least of the words of either.
    """
    per = found.groupBy("leaf", "template", "n", "doc").agg(F.count(F.lit(1)).alias("times"))
    firsts = found.where("later").groupBy("doc", "first").agg(F.sum("n").alias("held"))
    source = firsts.groupBy("doc").agg(F.max_by("first", F.struct("held", "first")).alias("source"))
    source = source.join(words, "doc").join(words.select(F.col("doc").alias("source"), F.col("words").alias("source_words")), "source")
    source = source.where((F.col("words") >= least * F.col("source_words")) & (F.col("source_words") >= least * F.col("words")))
    mine = per.join(source, "doc").select("source", "doc", "leaf", "template", "n", "times", F.greatest("words", "source_words").alias("most"))
    theirs = per.select(F.col("doc").alias("source"), "leaf", "template", F.col("times").alias("there"))
    both = mine.join(theirs, ["source", "leaf", "template"]).groupBy("doc", "source", "most").agg(F.sum(F.col("n") * F.least("times", "there")).alias("shared"))
    return both.where(F.col("shared") >= least * F.col("most")).select("doc", "source")


def recurring_lines(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, copies_from: float | None = None,
    short: int = SHORT, short_chars: int = SHORT_CHARS, short_docs: int = SHORT_DOCS,
) -> DataFrame:
    """(doc, id, recurring) of the documents with recurring lines: the numbers of lines, from 0, whose template also stands in an earlier document.

    A template recurs if it stands in min_docs documents; one whose lines all have fewer than short tokens and fewer than
    short_chars characters, if in short_docs (or min_docs, if that is more). The earliest document, by id (nulls last) and hash, keeps
    its lines. doc is the hash of id and text, so repeated rows are one document. With copies_from, lines that a
    copy has from the document it is a copy of don't count as recurring.
    """
    light = written(_lines(docs, id_col, text, short, short_chars), "lines")
    classes = written(_classes(light), "line-kinds")
    merged = written(_merged(classes, docs, id_col, text).where("line <> template"), "line-merged")
    alike = merged.select("leaf", "line", "template").union(merged.select("leaf", F.col("template").alias("line"), "template").distinct())
    # a line that stands once and shares no template can't recur
    maybe = classes.where("c > 1").select("leaf", "line").join(alike, ["leaf", "line"], "full").withColumn("template", F.coalesce("template", "line"))
    maybe = written(maybe, "line-maybe")  # a join of two tables as they are can have its hot keys split
    own = written(light.join(maybe, ["leaf", "line"]).select("doc", "id", "no", "n", "short", "leaf", "template"), "line-templates")
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("doc").alias("doc"))
    per = own.groupBy("leaf", "template", "doc", "id").agg(F.min("short").alias("short"))
    held = per.groupBy("leaf", "template").agg(F.count(F.lit(1)).alias("docs"), F.min("short").alias("short"), F.min(place).alias("first"))
    held = held.where(F.col("docs") >= F.when(F.col("short"), max(min_docs, short_docs)).otherwise(min_docs))
    held = written(held.select("leaf", "template", F.col("first.doc").alias("first"), F.col("first.id").alias("first_id")), "line-held")
    same = (F.col("first") == F.col("doc")) & F.col("first_id").eqNullSafe(F.col("id"))
    if copies_from is None:
        later = own.join(held, ["leaf", "template"]).where(~same)
    else:
        found = own.join(held, ["leaf", "template"], "left").withColumn("later", F.col("first").isNotNull() & ~same)
        found = written(found.dropDuplicates(["doc", "no"]), "line-firsts")
        words = written(light.dropDuplicates(["doc", "no"]).groupBy("doc").agg(F.sum("n").alias("words")), "line-words")
        later = found.where("later").join(_copies(found, words, copies_from), "doc", "left").where(~F.coalesce(F.col("source") == F.col("first"), F.lit(False)))
    return later.groupBy("doc", "id").agg(F.collect_set("no").alias("recurring"))


def drop_recurring(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, copies_from: float | None = None,
    short: int = SHORT, short_chars: int = SHORT_CHARS, short_docs: int = SHORT_DOCS,
) -> DataFrame:
    """docs with text without its recurring lines, and n_dropped, the number of lines taken out.

    A line goes if its template stands in min_docs documents or more (short lines: short_docs, see
    recurring_lines), of which this isn't the first. Blank lines, null and empty texts stay as they are; no row goes. With
    copies_from, a document that shares lines of that part of its words with one earlier document, and of that part of the other's
    words, is a copy as a whole, which a document-level operator should judge: it keeps the lines that the other keeps, and loses
    those that stand first in any third one. A column n_dropped of docs is replaced; other columns may have any name.
    """
    columns = [c for c in docs.columns if c != "n_dropped"]
    found = recurring_lines(docs, id_col, text, min_docs, copies_from, short, short_chars, short_docs)
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)], F.col(id_col).alias("_id"), F.xxhash64(id_col, text).alias("_doc"))
    rows = rows.join(found.hint("shuffle_hash"), (F.col("_doc") == F.col("doc")) & F.col("_id").eqNullSafe(F.col("id")), "left")
    own = F.col(f"c{columns.index(text)}")
    kept = F.filter(F.split(own, "\n"), lambda _, i: ~F.array_contains(F.col("recurring"), i))
    made = F.when(F.col("recurring").isNull() | own.isNull(), own).otherwise(F.concat_ws("\n", kept))
    return rows.select(*[(made if c == text else F.col(f"c{i}")).alias(c) for i, c in enumerate(columns)], F.coalesce(F.when(own.isNotNull(), F.size("recurring")), F.lit(0)).alias("n_dropped"))
