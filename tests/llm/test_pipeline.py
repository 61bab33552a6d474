import corpus_pipeline as p
from tests.compare import SMALL


def test_stages_keep_columns_and_good_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    n = [docs.count()]
    for name, stage in p.STAGES[:-1]:
        docs = p.written(stage(spark, docs, SMALL), f"t-{name}")
        assert docs.columns == columns
        n.append(docs.count())
    language, lines, near, mix = n[1:]
    assert language == lines >= 0.98 * n[0]
    assert near <= lines <= mix + lines - near
    packed = p.STAGES[-1][1](spark, docs, SMALL)
    kept = docs.select("doc_id").distinct().count()
    assert packed.select("doc_id").distinct().count() == kept
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0


def test_exact_copies_leave_one(spark):
    text = "some words of a text that is copied as a whole here and there\n" * 5
    rows = [(i, text, "en", "s", len(text)) for i in range(30)] + [(100 + i, f"another text number {i} that only stands here with its own words {i * 7919}", "en", "t", 9) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in p.STAGES[:3]:
        docs = p.written(stage(spark, docs, SMALL), "t")
    ids = [r.doc_id for r in docs.collect()]
    assert [i for i in ids if i < 100] == [0]


def test_only_copies_of_one_document_keep_recurring_lines(spark):
    words = lambda name, n: " ".join(f"{name}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(n))
    a, b, c = words("a", 60), words("b", 60), words("c", 60)
    texts = [
        f"{a}\n{words('d', 10)}", f"{b}\n{c}\n{words('e', 90)}", f"{a}\n{words('f', 10)}",  # 2: a passage and ten words
        f"{a}\n{b}\n{c}", a, f"{b}\n{c}",  # of several documents; a part of one
        f"{b}\n{c}\n{words('e', 90)}", f"{words('g', 600)}\n{words('h', 590)}\n{a}", f"{words('g', 600)}\n{words('h', 590)}\n{a}",  # copies
        f"{words('k', 60)}\n{words('m', 60)}", "\n".join([words("k", 60)] * 2),  # one line of it twice
        *[f"{words('n', 40)}\nyes no\nnot now\nof course"] * 2,  # a copy of which short lines are too rare to recur
    ]
    want = dict(enumerate(texts)) | {2: words("f", 10), 3: "", 4: "", 5: "", 7: f"{words('g', 600)}\n{words('h', 590)}", 8: f"{words('g', 600)}\n{words('h', 590)}", 10: ""}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in p.without_recurring_lines(spark, docs, SMALL).collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert {i: r.n_chars for i, r in got.items()} == {i: len(t) for i, t in want.items()}


def odd_documents(spark, labelled=True):
    words = lambda name, n: " ".join(f"{name}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(n))
    texts = {1: words("b", 50), 2: words("c", 40), 3: None, 4: "", 5: " \n", 6: "1 2 3", 7: words("d", 30) + "\n" + "x" * 50_000}
    rows = [(i, t, "en" if labelled and i % 2 else None, None if i == 2 else "s", None, f"r{i}", i) for i, t in texts.items()]
    rows += [rows[0], rows[0], (None, words("f", 60), None, "s", 5, "none", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, recurring string, _row long")


def test_odd_documents(spark):
    docs = odd_documents(spark)
    columns = docs.columns
    for name, stage in p.STAGES[:-1]:
        docs = p.written(stage(spark, docs, SMALL), f"t-{name}")
        assert docs.columns == columns
        if name == "language_id":
            assert sorted((r.doc_id or 0) for r in docs.collect()) == [0, 1, 1, 1, 2, 7]
    assert {r.doc_id or 0 for r in docs.collect()} == {0, 1, 2, 7}
    pieces = p.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id or 0 for r in pieces} == {0, 1, 2, 7} and all(1 <= r.length <= 1024 - r.offset for r in pieces)


def test_unlabelled_and_empty_tables(spark):
    docs = odd_documents(spark, labelled=False)
    assert p.known_language(spark, docs, SMALL).count() == docs.count()
    docs = docs.where("false")
    for name, stage in p.STAGES:
        docs = p.written(stage(spark, docs, SMALL), f"t-{name}")
        assert docs.count() == 0
