import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluicegate.llm import chat_format, language_id, line_dedup, mixing, packing, pseudo_lm, queries, url_filter
from tests.compare import SMALL, assert_same

CHATS = "conv_id long, turn long, role string, text string"
ODD_TEXTS = [None, "", " ", "\n\n", "x", "1 2 3", "ü" * 5, "a b\n" * 4000, "x" * 300_000]


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_oracles(spark, name):
    assert_same(spark, queries.QUERIES[name], queries.ORACLES[name])


# language identification


def test_language_on_held_out_rows(spark):
    got = queries.op1_language_id(spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang", "text")
    both = got.join(docs, "doc_id").where("held_out").collect()
    assert len(both) == sum(zlib.crc32(str(i).encode()) % 4 == 2 for i in range(docs.count()))
    assert np.mean([r.lang == r.lang_pred for r in both]) >= 0.97
    assert np.mean([r.rejected for r in both]) <= 0.02


def test_language_odd_rows(spark):
    model = language_id.fit(["the cat and the dog"] * 30 + ["der hund und die katze"] * 30, ["en"] * 30 + ["de"] * 30)
    rows = [(i, t, "x", 1.5) for i, t in enumerate(ODD_TEXTS)]
    got = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score double"), model).orderBy("doc_id").collect()
    assert [r.lang_pred == "und" for r in got] == [True] * 4 + [False, True, False, False, False]
    assert all((r.score == 0 and r.rejected) if r.lang_pred == "und" else 0 < r.score <= 1 for r in got)
    none = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, a string, b double"), language_id.fit([], []))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    assert language_id.fit_on(spark.createDataFrame([], "doc_id long, text string, lang string"), F.lit(True)).langs == []


def test_language_pieces_agree(monkeypatch):
    model = language_id.fit(["the cat and the dog"] * 30 + ["der hund und die katze"] * 30, ["en"] * 30 + ["de"] * 30)
    texts = pa.array(["the hund " * 50, "cat", "", "der " * 20])
    whole = model.scores(texts)
    monkeypatch.setattr(language_id, "PIECE", 7)
    for a, b in zip(whole, model.scores(texts)):
        assert np.allclose(a, b)


# line deduplication


def brute_lines(rows, min_docs=2):
    """How many lines each (id, text) loses, ids ascending, by going through the lines of every leaf one after another."""
    lines = [(i, tuple("<*>" if re.search("[0-9]", t) else t for t in x.split())) for i, text in rows for x in (text or "").split("\n") if x.strip()]
    leaves, template, docs = {}, {}, {}
    for _, toks in lines:
        leaves.setdefault((len(toks), toks[:3]), Counter())[toks] += 1
    for own in leaves.values():
        found = []
        for toks in sorted(own, key=lambda t: (own[t], hashlib.md5(" ".join(t).encode()).hexdigest()), reverse=True):
            template[toks] = next((f for f in found if sum(map(str.__eq__, f, toks)) >= 0.8 * len(toks)), toks)
            found += [toks] * (template[toks] == toks)
    for i, toks in lines:
        docs.setdefault(template[toks], {}).setdefault(i, set()).add(len(toks) < 5 and len(" ".join(toks)) < 40)
    lost = dict.fromkeys((i for i, _ in rows), 0)
    for i, toks in lines:
        own = docs[template[toks]]
        need = max(min_docs, 10) if all(all(x) for x in own.values()) else min_docs
        lost[i] += len(own) >= need and i != min(own)
    return lost, leaves, template


def test_lines_shared_by_documents_go(spark):
    long = "this passage stands in more than one of the documents here"
    rows = [(1, f"{long}\nown one"), (2, f"own two\n{long}\n\nlast"), (3, f"{long} \nuser 17 logged in from 10.0.0.1"), (4, "user 23 logged in from 10.9.8.7\nx"), (5, None), (6, ""), (7, "\n\n"), (None, f"{long}\nend")]
    df = spark.createDataFrame([(*r, "z", 0) for r in rows], "doc_id long, text string, leaf string, n_dropped int")
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.drop_recurring(df).collect()}
    assert got == {1: (f"{long}\nown one", 0), 2: ("own two\n\nlast", 1), 3: ("user 17 logged in from 10.0.0.1", 1), 4: ("x", 1), 5: (None, 0), 6: ("", 0), 7: ("\n\n", 0), None: ("end", 1)}
    assert line_dedup.drop_recurring(df.where("false")).count() == 0


def test_templates_with_variable_words(spark):
    words = [f"w{chr(97 + i)}" for i in range(20)]
    other = [*words[:10], "changed", *words[11:]]
    far = [*words[:4], *[f"v{chr(97 + i)}" for i in range(16)]]
    rows = [(1, " ".join(words)), (2, " ".join(words)), (3, " ".join(other)), (4, " ".join(far))]
    got = {r.doc_id: r.n_dropped for r in line_dedup.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0}
    same = spark.createDataFrame(rows[:1] * 3 + rows[1:2], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_dropped) for r in line_dedup.drop_recurring(same).collect()) == [(1, 0)] * 3 + [(2, 1)]
    assert {r.n_dropped for r in line_dedup.drop_recurring(same, copies_from=0.8).collect()} == {0}


def test_leaf_with_several_families(spark):
    """Families of 60 words in one leaf, equally frequent, of one document for each line: each gets its template."""
    words = lambda f: ["same", "three", "tokens", *[f"{chr(97 + f)}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(57)]]
    lines = []
    for f in range(6):
        for change in range(3):
            own = words(f)
            own[10 + change] = "changed"
            lines.append(" ".join(own))
    lines += [" ".join(words(7 + f)) for f in range(3)]
    lines += ["same three tokens x y", "same three tokens x z", "same three tokens q r", "same three tokens q s"]
    got = {r.doc_id: r.n_dropped for r in line_dedup.drop_recurring(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()}
    assert got == {i: int(i < 18 and i % 3 > 0 or i in (22, 24)) for i in range(len(lines))}


@pytest.mark.parametrize("head", [3, 256])
def test_templates_against_brute_force(spark, monkeypatch, head):
    monkeypatch.setattr(line_dedup, "HEAD", head)
    rng = np.random.default_rng(5)
    lines = [" ".join(["p", "q", "r", *(f"{'ab'[j % 2]}{'xyz'[v]}" for j, v in enumerate(rng.choice(3, n, p=[0.8, 0.1, 0.1])))]) for n in (2, 3, 7, 9, 12) for _ in range(60)]
    want, leaves, template = brute_lines(list(enumerate(lines)))
    assert max(len({template[t] for t in own}) for own in leaves.values()) > 5
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert {r.doc_id: r.n_dropped for r in line_dedup.drop_recurring(df).collect()} == want


def test_unrelated_lines_of_a_leaf_change_nothing(spark):
    words = ["lead", "of", "leaf", *[f"w{chr(97 + i)}" for i in range(12)]]
    own = [" ".join([*words[:7], f"x{c}", *words[8:]]) for c in "abcd"]
    other = " ".join(["lead", "of", "leaf", *[f"z{chr(97 + i)}" for i in range(12)]])
    for more, want in ([], 3), ([other] * 3, 5):
        df = spark.createDataFrame(list(enumerate(own + more)), "doc_id long, text string")
        assert sum(r.n_dropped for r in line_dedup.drop_recurring(df).collect()) == want


def test_line_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert {r.doc_id: r.n_dropped for r in queries.op2_line_dedup(spark, SMALL).collect()} == brute_lines(docs)[0]


def test_lines_with_clashing_columns(spark):
    names = ["recurring", "_doc", "_id", "doc", "id", "c0", "leaf", "a.b"]
    rows = [(i, "a line of six or more words", *[f"{i}{n}" for n in names]) for i in range(3)]
    df = spark.createDataFrame(rows, ["doc_id", "text", *names])
    got = line_dedup.drop_recurring(df)
    assert got.columns == [*df.columns, "n_dropped"]
    assert sorted(got.collect()) == sorted((i, "" if i else t, *x, int(i > 0)) for i, t, *x in rows)


def test_short_lines_need_more_documents(spark):
    df = spark.createDataFrame([(i, "yes\nno") for i in range(9)] + [(20 + i, "no") for i in range(3)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.drop_recurring(df).collect()}
    assert got[0] == "yes\nno" and got[5] == "yes" and got[21] == ""
    assert {r.doc_id: r.text for r in line_dedup.drop_recurring(df, short=0).collect()}[5] == ""
    long = spark.createDataFrame([(i, "\u6587" * 60) for i in range(2)], "doc_id long, text string")  # one token, but not short
    assert [r.n_dropped for r in line_dedup.drop_recurring(long).orderBy("doc_id").collect()] == [0, 1]


# urls


def test_url_precedence_and_odd_rows(spark):
    rules = spark.createDataFrame([("b.c", "/", "block"), ("a.b.c", "/x", "allow"), ("b.c", "/x/y", "block"), (None, "/", "block"), ("d", None, "block")], "host string, path string, verdict string")
    urls = {
        "http://B.c/": ("b.c", "b.c/", "block"), "http://z.a.b.c/xq": ("z.a.b.c", "a.b.c/x", "allow"), "http://a.b.c/x/yz": ("a.b.c", "a.b.c/x", "allow"),
        "http://q.b.c/x/y": ("q.b.c", "b.c/x/y", "block"), "http://xb.c/": ("xb.c", None, "allow"), "http://b.c?x": ("b.c", None, "allow"), "ftp://k.d": ("k.d", "d", "block"),
        None: ("", None, "allow"), "b.c/": ("", None, "allow"), "": ("", None, "allow"), "a://b.c://d/": ("b.c:", None, "allow"), "x\ny://d": ("d", "d", "block"),
    }
    df = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)] + [(0, "http://B.c/", "old")], "page_id long, url string, host string")
    got = url_filter.filter_urls(df, rules)
    assert {r.url: (r.host, r.rule, r.verdict) for r in got.collect()} == urls
    assert got.count() == len(urls) + 1
    clash = df.withColumn("best", F.lit(1)).withColumn("c0", F.lit(2)).withColumn("rule", F.lit(3))
    assert url_filter.filter_urls(clash, rules).columns == ["page_id", "url", "best", "c0", "host", "path", "rule", "verdict"]
    assert url_filter.filter_urls(clash, rules).where("best = 1 and c0 = 2").count() == len(urls) + 1
    assert url_filter.filter_urls(df.where("false"), rules).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(df, rules.where("false"), default="block").collect()} == {"block"}
    plain = url_filter.BROADCAST_RULES
    try:
        url_filter.BROADCAST_RULES = 0
        assert {r.url: (r.host, r.rule, r.verdict) for r in url_filter.filter_urls(df, rules).collect()} == urls
    finally:
        url_filter.BROADCAST_RULES = plain


# pseudo-likelihood


def per_word(spark, fitted, texts):
    got = pseudo_lm.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), fitted).agg(F.sum("log_likelihood"), F.sum("n_words")).first()
    return got[0] / got[1]


def unigram(texts):
    n = Counter(w for t in texts for w in t.split())
    return sum(c * np.log(c / n.total()) for c in n.values()) / n.total()


def test_network_beats_a_unigram_and_knows_order(spark):
    rng = np.random.default_rng(6)
    words, step = [f"w{i}" for i in range(40)], rng.permutation(40)
    texts = []
    for _ in range(400):  # three words in four follow from the word before
        at, own = int(rng.integers(40)), []
        for _ in range(200):
            own.append(words[at])
            at = int(step[at]) if rng.random() < 0.75 else int(rng.integers(40))
        texts.append(" ".join(own))
    fitted = pseudo_lm.fit(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    mixed = [" ".join(rng.permutation(t.split())) for t in texts]
    own = per_word(spark, fitted, texts)
    assert own > unigram(texts) + 0.3 and own > per_word(spark, fitted, mixed) + 0.5


def test_query_scores_beat_a_unigram(spark):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = queries.op5_pseudo_likelihood(spark, "/root/testdata/sf0.01").agg(F.sum("log_likelihood"), F.sum("n_words"), F.count("doc_id")).first()
    assert got[1] == sum(len(t.split()) for t in texts) and got[2] == len(texts)
    assert got[0] / got[1] > unigram(texts) + 0.02


def test_scores_do_not_depend_on_layout(spark, monkeypatch):
    monkeypatch.setattr(pseudo_lm, "GROUP", 20_000)
    monkeypatch.setattr(pseudo_lm, "BATCH", 256)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    got = [{r.doc_id: r.log_likelihood for r in pseudo_lm.score(docs, pseudo_lm.fit(docs.repartition(n, F.rand(n)))).collect()} for n in (1, 9)]
    assert all(abs(got[0][i] - got[1][i]) <= 1e-6 * abs(got[0][i]) for i in got[0])


def hash_of(word):
    h = sum((b + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, b in enumerate(word.encode())) % (1 << 64)
    for shift, by in ((31, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ h >> shift) * by % (1 << 64)
    return h ^ h >> 31


@pytest.mark.parametrize("known", [4, 65_536])
def test_scores_against_brute_force(spark, monkeypatch, known):
    monkeypatch.setattr(pseudo_lm, "KNOWN", known)
    texts = [*ODD_TEXTS, "a b c a b x", "a b \u00e9t\u00e9 c d e f g h h h"]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, n_words string, _text string")
    fitted = pseudo_lm.fit(docs)
    got = {r.doc_id: r for r in pseudo_lm.score(docs, fitted).collect()}
    counts, vocab, net = Counter(w for t in texts for w in (t or "").split()), fitted.vocabulary, fitted.network
    assert len(vocab.hashes) == min(known, len(counts))
    place = {w: [int(x[0]) for x in vocab.placed(np.array([hash_of(w)], dtype=np.uint64))] for w in counts}
    mass = Counter()
    for w, c in counts.items():
        mass[place[w][0]] += c
    first, first_bias, wide, bias, inner, inner_bias = (x.astype(float) for x in net.layers)

    def log_p(words, at):
        around = [place[words[at + o]][1] if 0 <= at + o < len(words) else len(net.embeddings) - 1 for o in (-2, -1, 1, 2)]
        h = np.tanh(np.concatenate([net.embeddings[r] for r in around]) @ first + first_bias)
        cell = place[words[at]][0]
        c, m = vocab.classes[cell], vocab.members[cell]
        z, y = np.exp(h @ wide + bias), np.exp(h @ inner[c] + inner_bias[c])
        return np.log(z[c] / z.sum()) + np.log(y[m] / y.sum()) + np.log(counts[words[at]] / mass[cell])

    for i, text in enumerate(texts):
        words = (text or "").split()
        assert got[i].n_words == len(words) and got[i]._text == "y" and (got[i].per_word is None) == (not words)
        if len(words) < 100:
            assert abs(got[i].log_likelihood - sum(log_p(words, at) for at in range(len(words)))) < 1e-3
    empty = docs.where("false")
    assert pseudo_lm.score(empty, pseudo_lm.fit(empty)).count() == 0
    assert np.isfinite(pseudo_lm.score(docs, pseudo_lm.fit(empty)).agg(F.sum("log_likelihood")).first()[0])


def test_words_in_pieces(monkeypatch):
    texts = [" ab  cde\nf g" * 9, None, "", "x", "a" * 50, "q r"]
    want = [[hash_of(w) for w in (t or "").split()] for t in texts]
    for piece in (1 << 21, 5):
        monkeypatch.setattr(pseudo_lm, "PIECE", piece)
        runs = list(pseudo_lm._runs(pa.array(texts)))
        assert np.concatenate([h for h, _ in runs]).tolist() == sum(want, [])
        assert np.concatenate([n for _, n in runs]).tolist() == list(map(len, want))


# mixing


def words(n):
    return " ".join(["w"] * n)


def test_mixture_meets_weights(spark):
    rows = [(i, words(5 + i % 7), "big") for i in range(3000)] + [(5000 + i, words(5 + i % 7), "small") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    per = {r.source: (r.repeats, r.least) for r in mixing.mixed(df, max_repeats=2.5).groupBy("source").agg((F.sum(F.col("copies") * F.col("tokens")) / F.sum("tokens")).alias("repeats"), F.min("copies").alias("least")).collect()}
    assert per["big"] == (1.0, 1) and abs(per["small"][0] - 2.5) < 0.02 and per["small"][1] == 2
    flat = {r.source: r.weight for r in mixing.mixed(df, target_entropy=0.6).select("source", "weight").distinct().collect()}
    assert abs(-sum(w * np.log(w) for w in flat.values()) - 0.6) < 1e-6 and abs(sum(flat.values()) - 1) < 1e-9
    half = mixing.mixed(df, target_entropy=0.0, budget=sum(len(r[1].split()) for r in rows) / 2)
    taken = half.agg(F.sum(F.col("copies") * F.col("tokens")) / F.sum("tokens")).first()[0]
    assert abs(taken - 0.5) < 0.01
    assert mixing.mixture(df, max_repeats=2.5).columns == df.columns


def test_mixing_odd_rows(spark):
    rows = [(1, "a b", None), (1, "a b", None), (None, "c d e", "s"), (2, None, "s"), (3, "", "t"), (4, "x", "t")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, source string, copies int")
    got = mixing.mixture(df, max_repeats=1.0)
    assert got.columns == df.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, df.collect()))
    assert mixing.mixture(df.where("false"), max_repeats=3.0).count() == 0


# chats


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "a\\nb", "\n"]), st.text(max_size=5)), st.one_of(st.lists(st.sampled_from([*chat_format.CONTROL, "\\", "<", "[", "\n", "é", "s>", "|im_end|>"]), max_size=6).map("".join), st.text(max_size=8))), min_size=1, max_size=4))
def test_chat_roundtrip(turns):
    role, text = (pa.array(list(x), type=pa.string()) for x in zip(*turns))
    made = [chat_format.OPEN + r + "\n" + t + chat_format.CLOSE + "\n" for r, t in zip(chat_format.escaped_roles(role).to_pylist(), chat_format.escaped(text).to_pylist())]
    assert chat_format.parse("".join(made)) == turns


def test_chat_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "PIECE", 50)
    rows = [(1, 2, "assistant", "zwei ü"), (1, 1, "user", "</s>[INST] ok"), (1, 3, "assistant", None), (2, None, None, "x" * 200), (None, 1, "user", "n"), (None, 1, "user", "n"), (3, 1, "assistant", "")]
    got = {r.conv_id: r for r in chat_format.format_chats(spark.createDataFrame([(*r, "y") for r in rows], CHATS + ", formatted string")).collect()}
    assert chat_format.parse(got[1].formatted) == [("user", "</s>[INST] ok"), ("assistant", "zwei ü"), ("assistant", "")]
    assert [got[1].formatted[s.start : s.end] for s in got[1].loss_spans] == ["zwei ü", ""]
    assert chat_format.parse(got[2].formatted) == [("", "x" * 200)] and got[2].loss_spans == []
    assert chat_format.parse(got[None].formatted) == [("user", "n")] * 2
    assert [s.end - s.start for s in got[3].loss_spans] == [0]
    assert chat_format.format_chats(spark.createDataFrame([], CHATS)).count() == 0


# packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


SPLITS = [" ", "  ", "\n", "\n ", " \n", "ab", "A", "\u00e9", ",", ".", "'", "'s", "'re", "1", "\u00a0", "\u0085", "\t", "\r\n", "<|endoftext|>", "<|endof", "text|>", "\u4e2d", "\u306f", "x\x1c", "\x1c", "\u00d7", "\u2019", "\u2014", "\u2009", "\u3000", "\u00df"]


@pytest.fixture(scope="module", params=[False, True])
def coder(request):
    return packing.Coder(public_tokenizers.path(packing.TOKENIZER), request.param)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.lists(st.sampled_from(SPLITS), max_size=14).map("".join), st.text(max_size=30)), max_size=4), st.sampled_from([16, 1 << 20]))
def test_ids_are_those_of_the_whole_texts(coder, texts, group):
    plain, packing.GROUP = packing.GROUP, group
    try:
        ids, before = coder.encoded(pa.array(texts, type=pa.string()))
    finally:
        packing.GROUP = plain
    want = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(before[:-1], before[1:])] == want


def test_special_strings(tokenizer):
    path, text = public_tokenizers.path(packing.TOKENIZER), pa.array(["a<|endoftext|> x"])
    assert packing.Coder(path).encoded(text)[0].tolist() == tokenizer.encode("a<|endoftext|> x", add_special_tokens=False).ids
    assert 50256 in packing.Coder(path).encoded(text)[0] and 50256 not in packing.Coder(path, True).encoded(text)[0]


def test_other_tokenizers():
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["Some Words, and\nmore.  Of them", "", "\u00e9t\u00e9 <|endoftext|> x"]
    ids, before = packing.Coder(path).encoded(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(before[:-1], before[1:])] == [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]


def test_packing_query_against_plain_tokenizer(spark, tokenizer):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got, want, lengths = queries.op10_best_fit_packing(spark, SMALL).collect(), [], []
    for i, text in docs.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        at = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(at, at[1:]))]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 1024
    bins = []
    for n in sorted((w[3] for w in want), reverse=True):
        best = min((i for i, rest in enumerate(bins) if rest >= n), key=bins.__getitem__, default=None)
        if best is None:
            bins.append(1024 - n)
        else:
            bins[best] -= n
    assert len(ends) <= len(bins)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 40), max_size=12))
def test_plan_fills_every_slot_once(histogram):
    used, ranks = {}, {}
    for length, rank, n, per, first, at in packing.plan(histogram, 20):
        for i in range(n):
            ranks.setdefault(length, []).append(rank + i)
            used.setdefault(first + i // per, []).append((at + i % per * length, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in histogram.items()}
    for slots in used.values():
        end = 0
        for at, length in sorted(slots):
            assert at == end
            end += length
        assert end <= 20
    bins = []  # best fit, one at a time
    for length in sorted((k for k, n in histogram.items() for _ in range(n)), reverse=True):
        best = min((i for i, r in enumerate(bins) if r >= length), key=lambda i: bins[i], default=None)
        if best is None:
            bins.append(20 - length)
        else:
            bins[best] -= length
    assert len(used) <= len(bins)


def test_packing_odd_rows(spark, tokenizer):
    texts = [*ODD_TEXTS, "a b c " * 700]
    rows = [(i, t, "z") for i, t in enumerate(texts)] + [(None, "null id", "z"), (4, "x", "z")]
    assert packing.token_pieces(spark.createDataFrame(rows, "doc_id long, text string, _text string")).select("_text").distinct().count() == 1
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string, piece string")).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(texts):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        own = sorted(by[i], key=lambda r: r.start)
        if i == 4:
            assert len(own) == 2
            continue
        assert np.frombuffer(b"".join(bytes(r.ids) for r in own), dtype="<u4").tolist() == ids
        assert [r.piece for r in own] == list(range(len(own))) and all(r.length == 1024 for r in own[1:])
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 1024
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
