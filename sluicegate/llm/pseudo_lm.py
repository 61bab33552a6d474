"""Masked pseudo-likelihood: a window network predicts every word from both sides; sums of log-probabilities score documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType

from sluicegate.llm.common import written

#: Words whose counts go with the model: the most frequent of the whole corpus. The counts of all others are joined.
KNOWN = 65_536
#: The network tells words apart by cells, CLASSES of MEMBERS each: the most frequent words have their own, others share the last SHARED by hash.
CLASSES, MEMBERS, SHARED = 32, 64, 512
#: Words with an embedding of their own; others share some by hash.
EMBEDDED, EMBEDDED_SHARED = 16_384, 4096
#: Words on either side, sizes of an embedding and of the hidden layer.
SIDE, DIM, HIDDEN = 2, 8, 16
BATCH, SCORED, RATE, SEED = 8192, 8192, 3.0, 23
#: Characters of the documents that one network learns from before networks are averaged; one group in FIRST makes the start of all.
GROUP, FIRST = 16_000_000, 16
#: Bytes of text that are cut into words at a time; words that a task counts before it passes them on.
PIECE, COUNTED = 1 << 21, 4_000_000
_CELLS, _ROWS = CLASSES * MEMBERS, EMBEDDED + EMBEDDED_SHARED
_BLANK = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])
_BASE = 0x9E3779B97F4A7C15


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    made = []
    for x in (_BASE, pow(_BASE, -1, 1 << 64)):
        row = np.full(1 << bits, x, dtype=np.uint64)
        row[0] = 1
        made.append(np.cumprod(row, dtype=np.uint64))
    return made[0], made[1]


def hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of some texts that stand end to end, and how many words each text has.

    ends: where the texts start, and the end of the last. Words are what stands between white space (space and 09-0D).
    A word's hash is the polynomial of its bytes, a difference of two sums of a prefix.
    """
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(ends) - 1, dtype=np.int64)
    word = ~_BLANK[data]
    border = np.zeros(len(data) + 1, dtype=bool)
    border[ends] = True
    before = np.concatenate([[False], word[:-1]])
    starts = np.flatnonzero(word & (~before | border[:-1]))
    after = np.concatenate([word[1:], [False]])
    stops = np.flatnonzero(word & (~after | border[1:])) + 1
    powers, inverse = _powers(max(1, int(len(data)).bit_length()))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], dtype=np.uint64)])
    h = (sums[stops] - sums[starts]) * inverse[starts]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h, np.diff(np.searchsorted(starts, ends))


def _runs(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """hashes() of about PIECE bytes of texts at a time (null: empty); a longer text is cut before white space and put together again."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + PIECE, side="right")) - 1)
        own = data[ends[at] : ends[to]]
        if len(own) <= PIECE:
            yield hashes(own, ends[at : to + 1] - ends[at])
        else:
            parts, start = [], 0
            while start < len(own):
                stop, step = start + PIECE, PIECE
                while stop < len(own) and not len(blank := np.flatnonzero(_BLANK[own[stop : stop + step]])):
                    stop += step
                stop = min(len(own), stop + (int(blank[0]) if stop < len(own) else 0))
                parts.append(hashes(own[start:stop], np.array([0, stop - start]))[0])
                start = stop
            yield np.concatenate(parts), np.array([sum(map(len, parts))])
        at = to


@dataclass
class Vocabulary:
    """The most frequent words: their hashes in ascending order, their ranks by count, and the logarithms of their counts."""

    hashes: np.ndarray
    ranks: np.ndarray
    counts: np.ndarray
    #: For each cell its class and its place there, and the number of words.
    classes: np.ndarray
    members: np.ndarray
    mass: np.ndarray

    @staticmethod
    def of(top: list[tuple[int, int]], shared: np.ndarray) -> Vocabulary:
        """top: hashes (signed) and counts of words, most frequent first; shared: the words of every remainder of a hash by SHARED, all words together."""
        h, n = (np.array([x[i] for x in top], dtype=np.int64) for i in (0, 1))
        order = np.argsort(h.view(np.uint64), kind="stable")
        own = _CELLS - SHARED
        mass = np.zeros(_CELLS)
        mass[: min(own, len(n))] = n[:own]
        mass[own:] = shared
        np.subtract.at(mass, own + (h[:own] & (SHARED - 1)), n[:own])
        by = np.empty(_CELLS, dtype=np.int64)
        by[np.argsort(-mass, kind="stable")] = np.arange(_CELLS)
        return Vocabulary(h.view(np.uint64)[order], order.astype(np.int32), np.log(n[order].astype(np.float64)), (by % CLASSES).astype(np.uint8), (by // CLASSES).astype(np.uint8), mass)

    def placed(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The cell of each word, its embedding, and its place among the known words (-1: not known)."""
        if not len(self.hashes):
            low = (h & np.uint64(SHARED - 1)).astype(np.int64)
            return _CELLS - SHARED + low, EMBEDDED + (h & np.uint64(EMBEDDED_SHARED - 1)).astype(np.int64), np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        known = self.hashes[at] == h
        rank = np.where(known, self.ranks[at], 1 << 30)
        cell = np.where(rank < _CELLS - SHARED, rank, _CELLS - SHARED + (h & np.uint64(SHARED - 1)).astype(np.int64))
        row = np.where(rank < EMBEDDED, rank, EMBEDDED + (h & np.uint64(EMBEDDED_SHARED - 1)).astype(np.int64))
        return cell, row, np.where(known, at, -1)


@dataclass
class Network:
    """embeddings: a row for each known or shared word, and one, of zeros, beyond the text. layers: to the hidden layer, from it to
    the classes, from it to the members of each class, each with its bias."""

    embeddings: np.ndarray
    layers: list[np.ndarray]

    @staticmethod
    def new(vocab: Vocabulary) -> Network:
        """A network that says how frequent each word is whatever stands around it."""
        rng = np.random.default_rng(SEED)
        table = rng.normal(0, 0.5, (_ROWS + 1, DIM)).astype(np.float32)
        table[_ROWS] = 0
        mass = np.zeros((CLASSES, MEMBERS))
        mass[vocab.classes, vocab.members] = np.maximum(vocab.mass, 0) + 1e-3
        whole = mass.sum(axis=1)
        first = rng.normal(0, (2 * SIDE * DIM) ** -0.5, (2 * SIDE * DIM, HIDDEN))
        shapes = [first, np.zeros(HIDDEN), np.zeros((HIDDEN, CLASSES)), np.log(whole / whole.sum()), np.zeros((CLASSES, HIDDEN, MEMBERS)), np.log(mass / whole[:, None])]
        return Network(table, [x.astype(np.float32) for x in shapes])

    def copy(self) -> Network:
        return Network(self.embeddings.copy(), [x.copy() for x in self.layers])

    def hidden(self, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = self.embeddings[around].reshape(len(around), -1)
        return x, np.tanh(x @ self.layers[0] + self.layers[1])

    def predict(self, around: np.ndarray, classes: np.ndarray, members: np.ndarray) -> np.ndarray:
        """The log-probability of each word's cell, given the words around it: that of its class and that of its place there."""
        _, h = self.hidden(around)
        out, (order, cuts) = _log_of(_exponents(h, self.layers[2], self.layers[3]), classes), _by_class(classes)
        h, members, inner = h[order], members[order], np.empty(len(h), dtype=np.float32)
        for c, a, b in cuts:
            inner[a:b] = _log_of(_exponents(h[a:b], self.layers[4][c], self.layers[5][c]), members[a:b])
        out[order] += inner
        return out

    def learn(self, around: np.ndarray, classes: np.ndarray, members: np.ndarray, rate: float) -> None:
        """One step of gradient descent on the mean loss."""
        x, h = self.hidden(around)
        first, first_bias, wide, bias, inner, inner_bias = self.layers
        scale, (order, cuts) = np.float32(rate / len(h)), _by_class(classes)
        d = _loss_slope(_exponents(h, wide, bias), classes, scale)
        dh = d @ wide.T
        wide -= h.T @ d
        bias -= np.ones(len(d), dtype=np.float32) @ d
        sorted_h, sorted_members, sorted_dh = h[order], members[order], np.empty_like(h)
        for c, a, b in cuts:
            d = _loss_slope(_exponents(sorted_h[a:b], inner[c], inner_bias[c]), sorted_members[a:b], scale)
            sorted_dh[a:b] = d @ inner[c].T
            inner[c] -= sorted_h[a:b].T @ d
            inner_bias[c] -= np.ones(b - a, dtype=np.float32) @ d
        dh[order] += sorted_dh
        dh *= 1 - h * h
        dx = (dh @ first.T).reshape(-1, DIM)
        first -= x.T @ dh
        first_bias -= dh.sum(axis=0)
        rows = around.ravel()
        for k in range(DIM):  # an embedding stands in few windows of a batch, so its steps are longer
            self.embeddings[:, k] -= np.float32(20) * np.bincount(rows, weights=dx[:, k], minlength=_ROWS + 1).astype(np.float32)
        self.embeddings[_ROWS] = 0


def _by_class(classes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order of the words by class, and where the words of each class stand in it."""
    order = np.argsort(classes, kind="stable")
    cuts = np.searchsorted(classes[order], np.arange(CLASSES + 1)).tolist()
    return order, [(c, a, b) for c, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]


def _exponents(h: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """h @ w + b less a number that keeps their exponentials finite, and the largest of each row above zero.

    As h lies between -1 and 1, bounds of all rows come from w and b, which spares a search in each row.
    """
    reach = np.abs(w).sum(axis=0)
    top = (b + reach).max()
    z = h @ w
    if top - (b - reach).max() < 80:
        z += b - top
    else:
        z += b
        z -= z.max(axis=1, keepdims=True)
    return z


def _log_of(z: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The log-probability of the right one in each row of exponents."""
    own = z[np.arange(len(z)), right]
    np.exp(z, out=z)
    return own - np.log(z @ np.ones(z.shape[1], dtype=np.float32))


def _loss_slope(z: np.ndarray, right: np.ndarray, scale: np.float32) -> np.ndarray:
    np.exp(z, out=z)
    z *= (scale / (z @ np.ones(z.shape[1], dtype=np.float32)))[:, None]
    z[np.arange(len(z)), right] -= scale
    return z


def windows(rows: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """For each word of the texts the embeddings of the SIDE words on either side."""
    place = np.arange(len(rows)) + SIDE * (1 + np.repeat(np.arange(len(per_text)), per_text))
    line = np.full(len(rows) + SIDE * (len(per_text) + 1), _ROWS, dtype=np.int64)
    line[place] = rows
    return np.stack([line[place + o] for o in range(-SIDE, SIDE + 1) if o], axis=1)


def _word_counts(docs: DataFrame, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for h, _ in _runs(batch.column(0)):
                held.append(h)
                n += len(h)
                if n > COUNTED:
                    yield _counted(held)
                    held, n = [], 0
        yield _counted(held)

    return docs.select(text).where(F.col(text).isNotNull()).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(held: list[np.ndarray]) -> pa.RecordBatch:
    word, n = np.unique(np.concatenate(held) if held else np.zeros(0, dtype=np.uint64), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])


@dataclass
class Fitted:
    vocabulary: Vocabulary
    network: Network
    #: word (hash), n: the counts of all words.
    counts: DataFrame


def fit(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> Fitted:
    """Counts all words of all texts, then learns from every word of all texts.

    Documents are dealt by the hash of id and text into groups of about GROUP characters. Each group's network goes over its
    documents in the order of their hashes (repeated rows once); networks are averaged, embeddings by how often their words
    occurred. One group in FIRST does so first, then all groups go on from that average. So the result depends on the rows,
    not on how they are stored.
    """
    counts = written(_word_counts(docs, text), "lm-words")
    # words below a power of two go first, so that not every task sends its own KNOWN words to the driver
    powers = {r.p: r.kinds for r in counts.groupBy(F.length(F.bin("n")).alias("p")).agg(F.count(F.lit(1)).alias("kinds")).collect()}
    least = max((p for p in powers if sum(n for q, n in powers.items() if q >= p) >= KNOWN), default=1)
    top = [(r.word, r.n) for r in counts.where(F.col("n") >= 1 << (least - 1)).orderBy(F.desc("n"), "word").limit(KNOWN).collect()]
    shared = np.zeros(SHARED)
    for r in counts.groupBy(F.col("word").bitwiseAND(SHARED - 1).alias("k")).agg(F.sum("n").alias("n")).collect():
        shared[r.k] = r.n
    vocab = Vocabulary.of(top, shared)
    network = Network.new(vocab)
    own = docs.where(F.col(text).isNotNull()).select(F.xxhash64(id_col, text).alias("h"), F.col(text).alias("t"))
    size = own.agg(F.sum(F.length("t"))).first()[0] or 0
    groups = max(1, round(size / GROUP))
    own = own.withColumn("g", F.pmod("h", F.lit(groups)).cast("int"))
    if groups >= FIRST:
        network = _round(own.where(F.col("g") % FIRST == 0), max(1, groups // FIRST), vocab, network)
    return Fitted(vocab, _round(own, groups, vocab, network), counts)


def _round(own: DataFrame, groups: int, vocab: Vocabulary, start: Network) -> Network:
    """The average of the networks of all groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, last, state = None, None, None
        for batch in batches:
            g, h = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            at = 0
            for to in [*(np.flatnonzero(np.diff(g)) + 1).tolist(), len(g)] if len(g) else []:
                if g[at] != group:
                    if state is not None:
                        yield state.result(group)
                    group, last, state = g[at], None, _Learner(vocab, start)
                fresh = np.append(last is None or h[at] != last, np.diff(h[at:to]) != 0)
                state.go_on(batch.column(2).slice(at, to - at).filter(pa.array(fresh)))
                last, at = h[to - 1], to
        if state is not None:
            yield state.result(group)

    schema = "g int, n long, layers binary, rows binary, embeddings binary"
    made = own.select("g", "h", "t").repartition(groups, "g").sortWithinPartitions("g", "h").mapInArrow(run, schema)
    made = written(made, "lm-networks")
    parts = max(1, round(groups**0.5))
    summed = written(made.withColumn("p", F.col("g") % parts).repartition(parts, "p").sortWithinPartitions("p", "g").drop("p").mapInArrow(_summed, schema), "lm-sums")
    found = summed.coalesce(1).sortWithinPartitions("g").mapInArrow(_summed, schema).collect()
    if not found or not found[0].n:
        return start
    r, layers = found[0], []
    flat = np.frombuffer(r.layers) / r.n
    for x in start.layers:
        layers.append(flat[: x.size].reshape(x.shape).astype(np.float32))
        flat = flat[x.size :]
    n = np.frombuffer(r.rows)[:, None]
    table = np.where(n > 0, np.frombuffer(r.embeddings).reshape(-1, DIM) / np.maximum(n, 1), start.embeddings[:_ROWS])
    return Network(np.vstack([table, np.zeros((1, DIM))]).astype(np.float32), layers)


class _Learner:
    """The network of one group."""

    def __init__(self, vocab: Vocabulary, start: Network):
        self.vocab, self.network, self.n, self.rows = vocab, start.copy(), 0, np.zeros(_ROWS)
        self.around, self.cells = np.zeros((0, 2 * SIDE), dtype=np.int64), np.zeros(0, dtype=np.int64)

    def go_on(self, texts: pa.Array) -> None:
        """Learns from whole batches of words; what is left waits for the next texts."""
        for h, per_text in _runs(texts):
            cell, row, _ = self.vocab.placed(h)
            self.rows += np.bincount(row, minlength=_ROWS)
            self.around, self.cells = np.concatenate([self.around, windows(row, per_text)]), np.concatenate([self.cells, cell])
            self._learn(BATCH)

    def _learn(self, least: int) -> None:
        at = 0
        while len(self.cells) - at >= least:
            cells = self.cells[at : at + BATCH]
            self.network.learn(self.around[at : at + BATCH], self.vocab.classes[cells], self.vocab.members[cells], RATE)
            at += len(cells)
            self.n += len(cells)
        self.around, self.cells = self.around[at:], self.cells[at:]

    def result(self, group: int) -> pa.RecordBatch:
        self._learn(1)
        layers = np.concatenate([x.ravel() for x in self.network.layers]).astype(np.float64) * self.n
        return _row(group, self.n, layers, self.rows, self.network.embeddings[:_ROWS].astype(np.float64) * self.rows[:, None])


def _row(group: int, n: int, *arrays: np.ndarray) -> pa.RecordBatch:
    made = [pa.array([group], type=pa.int32()), pa.array([n], type=pa.int64()), *(pa.array([x.tobytes()], type=pa.binary()) for x in arrays)]
    return pa.RecordBatch.from_arrays(made, names=["g", "n", "layers", "rows", "embeddings"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    group, n, sums = None, 0, None
    for batch in batches:
        for r in range(batch.num_rows):
            group, n = batch.column(0)[r].as_py() if group is None else group, n + batch.column(1)[r].as_py()
            own = [np.frombuffer(batch.column(c)[r].as_buffer()) for c in (2, 3, 4)]
            sums = [x.copy() for x in own] if sums is None else [a + b for a, b in zip(sums, own)]
    if sums is not None:
        yield _row(group, n, *sums)


def score(docs: DataFrame, fitted: Fitted, text: str = "text") -> DataFrame:
    """docs without text, with n_words, log_likelihood and per_word.

    log_likelihood: the sum over all words of log p(word | SIDE words on either side), that of the word's cell by
    the network and that of the word in its cell by its count. Words unknown to fit's texts count as if they had occurred
    once. Null and blank texts have no words, a sum of 0 and a null per_word. Columns of docs with these names are replaced;
    others may have any name.
    """
    names, vocab, network = ["n_words", "log_likelihood", "per_word"], fitted.vocabulary, fitted.network
    kept = [c for c in docs.columns if c not in (text, *names)]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(text).alias("t"))
    schema = rows.drop("t").schema
    for name, kind in (("n_words", LongType()), ("part", DoubleType()), ("rare", ArrayType(LongType()))):
        schema = schema.add(name, kind)
    of_cell = np.log(np.maximum(vocab.mass, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sums, rare, ends = [], [], [], [np.zeros(1, dtype=np.int64)]
            for h, per_text in _runs(batch.column(len(kept))):
                cell, row, known = vocab.placed(h)
                around, logp = windows(row, per_text), np.where(known >= 0, vocab.counts[known] if len(vocab.counts) else 0.0, 0.0) - of_cell[cell]
                for at in range(0, len(h), SCORED):
                    c = cell[at : at + SCORED]
                    logp[at : at + SCORED] += network.predict(around[at : at + SCORED], vocab.classes[c], vocab.members[c])
                of = np.repeat(np.arange(len(per_text)), per_text)
                sizes.append(per_text)
                sums.append(np.bincount(of, weights=logp, minlength=len(per_text)).astype(np.float64))  # of no words it would be integers
                rare.append(h[known < 0].view(np.int64))
                ends.append(ends[-1][-1] + np.cumsum(np.bincount(of[known < 0], minlength=len(per_text))))
            flat = [np.concatenate(x) if x else np.zeros(0) for x in (sizes, sums, rare, ends)]
            lists = pa.ListArray.from_arrays(pa.array(flat[3], type=pa.int32()), pa.array(flat[2].astype(np.int64)))
            made = [pa.array(flat[0].astype(np.int64)), pa.array(flat[1]), lists]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *made], names=schema.names)

    told = written(rows.mapInArrow(run, schema).withColumn("key", F.monotonically_increasing_id()), "lm-scores")
    rare = told.select("key", F.explode("rare").alias("word")).join(fitted.counts, "word").groupBy("key").agg(F.sum(F.log("n")).alias("more"))
    whole = F.col("part") + F.coalesce("more", F.lit(0.0))
    return told.drop("rare").join(rare, "key", "left").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], "n_words", whole.alias("log_likelihood"), F.when(F.col("n_words") > 0, whole / F.col("n_words")).alias("per_word")
    )
