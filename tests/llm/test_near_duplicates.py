import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from sluicegate.llm import common, euclid_lsh, queries, rp_forest, simhash
from tests.compare import SMALL

DOCS = "doc_id long, text string, lang string"


def brute_fingerprint(text, k=4):
    words = (text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).replace(b"\t", b" ").split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def groups(n, linked):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB\t\n ñ c", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) % (1 << 64) == brute_fingerprint(text)


def test_fingerprint_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(3000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "PIECE", 50)
    assert simhash.fingerprint(text.encode()) == whole == brute_fingerprint(text) - (1 << 64 if whole < 0 else 0)
    assert simhash.fingerprint(text.encode(), 1) % (1 << 64) == brute_fingerprint(text, 1)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=4))
def test_a_cell_holds_every_close_pair(x, flips):
    def unary(v):
        low, high = v & 0x5555555555555555, v >> 1 & 0x5555555555555555
        return low | high | (low & high) << 1

    y = x
    for f in flips:
        y ^= 1 << f
    assert (unary(x) ^ unary(y)).bit_count() <= (x ^ y).bit_count()
    for n in (10, 10**6, 10**9):
        assert any((unary(x) & m) == (unary(y) & m) for m in simhash.grid_masks(n))


def test_links_are_all_found(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = np.random.default_rng(0)
    base = [int(x) for x in rng.integers(0, 2**63, 40)]
    fps = list({b ^ sum(1 << int(f) for f in rng.integers(0, 64, k)) for b in base for k in (0, 1, 2, 3, 5) for _ in range(3)})
    fps += [fps[0] ^ 1 << i for i in range(60)]
    fps = list(dict.fromkeys(f - (1 << 64) if f >> 63 else f for f in fps))
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    roots = {r.node: r.root for r in common.components(simhash.links(df, len(fps)), "t").collect()}
    want = groups(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if ((fps[i] ^ fps[j]) % (1 << 64)).bit_count() <= 4])
    got = [roots.get(f, f) for f in fps]
    assert all((got[i] == got[j]) == (want[i] == want[j]) for i in range(len(fps)) for j in range(i))


def test_simhash_odd_rows(spark):
    rows = [(3, "a b c d e", "x"), (1, "A  b c d e", None), (None, "a b c d e", "x"), (5, None, "x"), (4, "", "y"), (4, "", "y"), (6, " \t", None), (7, "other words than these", "x"), (8, "lone", "x")]
    df = spark.createDataFrame(rows, DOCS)
    got = simhash.near_groups(df).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in got) == [(-1, 1), (1, 1), (3, 1), (4, 4), (4, 4), (5, 4), (6, 4), (7, 7), (8, 8)]
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 7, 8]
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_groups(empty).count() == simhash.keep_one(empty).count() == 0
    clash = df.withColumnsRenamed({"lang": "fp"}).withColumn("_row", df.doc_id)
    assert simhash.near_groups(clash).columns == ["doc_id", "_row", "fp", "component_id"]
    clash = clash.withColumnsRenamed({"_row": "c1"}).withColumn("_row", clash.doc_id).withColumn("_fp", clash.doc_id)
    assert simhash.keep_one(clash).columns == clash.columns
    assert sorted((r.doc_id, r._row) for r in simhash.keep_one(clash).collect()) == [(i, i) for i in (1, 4, 7, 8)]


def test_simhash_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").toPandas()
    fps = [brute_fingerprint(t) for t in docs.text]
    label = groups(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    least = {}
    for i, d in zip(label, docs.doc_id):
        least[i] = min(least.get(i, d), d)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op8_simhash(spark, SMALL).collect()}
    assert got == {d: (f"{f:016x}", least[i]) for d, f, i in zip(docs.doc_id, fps, label)}


def vectors(rng, n=300, dim=16):
    base = rng.normal(size=(n, dim))
    near = base[:60] + rng.normal(scale=0.08, size=(60, dim)) * np.linalg.norm(base[:60], axis=1)[:, None] / 4
    hot = base[0] + rng.normal(scale=0.01, size=(80, dim))
    return np.concatenate([base, near, hot, base[:5], base[:5] * 3])


@pytest.mark.parametrize("block", [512, 16])
def test_lsh_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(euclid_lsh, "BLOCK", block)
    x = vectors(np.random.default_rng(1))
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in euclid_lsh.near_vectors(df).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    assert len(got) == len(x)
    assert all(got[i].n_links <= near[i].sum() for i in got)
    assert sum(g.n_links for g in got.values()) >= 0.95 * near.sum()
    label = groups(len(x), list(zip(*np.nonzero(near))))
    assert np.mean([got[i].component_id == label[i] for i in got]) > 0.95
    assert all(g.kept == (g.component_id == i) for i, g in got.items())


ODD = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, []), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (1, [1.0, 0.0])]


def test_lsh_odd_rows(spark):
    df = spark.createDataFrame([(i, v, "x") for i, v in ODD], "vec_id long, embedding array<double>, digest string")
    got = sorted(((r.vec_id or -1), r.n_links, r.component_id, r.kept) for r in euclid_lsh.near_vectors(df).collect())
    assert got == [(-1, 3, 1, False), (1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), *[(i, 0, i, True) for i in range(3, 10)]]
    assert euclid_lsh.near_vectors(df.where("false")).count() == 0


def test_forest_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(4000, 16)), np.repeat(rng.normal(size=(1, 16)), 60, axis=0)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in rp_forest.nearest(df, "id % 50 = 0").collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    hits = 0
    for q in range(0, len(x), 50):
        cos = u @ u[q]
        cos[q] = -9
        best = sorted(range(len(x)), key=lambda i: (-round(cos[i], 12), i))[:5]
        assert sorted(got[q]) == [1, 2, 3, 4, 5]
        assert all(abs(cos[i] - s) < 1e-12 for i, s in got[q].values())
        hits += len({i for i, _ in got[q].values()} & set(best))
    assert hits / (5 * len(range(0, len(x), 50))) >= 0.9
    assert [got[4000][r][0] for r in range(1, 6)] == [4001, 4002, 4003, 4004, 4005]


def brute_nearest(ids, x):
    """{query: its nearest ids in order} for the ids that 50 divides."""
    u = x / np.linalg.norm(x, axis=1)[:, None]
    out = {}
    for q in np.flatnonzero(ids % 50 == 0):
        cos = u @ u[q]
        out[int(ids[q])] = [int(ids[i]) for i in sorted(range(len(x)), key=lambda i: (-round(cos[i], 12), ids[i])) if i != q][:5]
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_forest_query_against_brute_force(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").toPandas()
    want, got = brute_nearest(rows.vec_id.to_numpy(), np.array(rows.embedding.tolist(), dtype=float)), {}
    for r in queries.op6_nearest(spark, f"/root/testdata/{sf}").orderBy("rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got.keys() == want.keys() and {len(x) for x in got.values()} == {5}
    assert np.mean([len(set(got[q]) & set(want[q])) / 5 for q in want]) >= 0.9


def test_forest_looks_at_few_of_clustered_vectors():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 32))[rng.integers(300, size=20_000)] + 0.4 * rng.normal(size=(20_000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    forest, asked = rp_forest.fit(x, rp_forest.plan(len(x)), 5), np.arange(0, 20_000, 100)
    leaves, hits, looked = forest.leaves(x), 0, 0
    for q, (last, found) in zip(asked, forest.visited(x[asked])):
        seen = forest.scores(x[q : q + 1])[0] >= last - 1e-9
        assert len(found) == forest.budget and all(seen[t, leaf] for t, leaf in found)
        met = np.any([seen[t, leaves[:, t]] for t in range(leaves.shape[1])], axis=0)
        cos = x @ x[q]
        cos[q] = -9
        hits += met[np.argsort(-cos)[:5]].sum()
        looked += met.sum()
    assert hits / (5 * len(asked)) >= 0.9 and looked / len(asked) < 0.05 * len(x)


def test_forest_in_blocks(spark, monkeypatch):
    """Cells, blocks and slices of queries don't change what is found."""
    x = np.random.default_rng(4).normal(size=(1500, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = sorted(map(tuple, rp_forest.nearest(df, "id % 5 = 0").collect()))
    for name, value in (("BLOCK_ROWS", 100), ("BLOCK_QUERIES", 40), ("AT_ONCE", 7)):
        monkeypatch.setattr(rp_forest, name, value)
    assert sorted(map(tuple, rp_forest.nearest(df, "id % 5 = 0").collect())) == want


def test_forest_odd_rows(spark):
    df = spark.createDataFrame([(i, v, 1) for i, v in ODD if i != 8] + [(50, [1.0, 1.0], 1)], "vec_id long, embedding array<double>, dim int")
    got = [(r.query_id, r.rank, r.vec_id) for r in rp_forest.nearest(df, "id in (50, 9, 1)").orderBy("query_id", "rank").collect()]
    assert got == [(1, 1, 2), (1, 2, 50), (50, 1, 1), (50, 2, 2)]
    assert rp_forest.nearest(df.where("false"), "id % 2 = 0").count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 130)] + [(130, 129), (200, 200)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 131)}}
