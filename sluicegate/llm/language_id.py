"""Language identification: averaged embeddings of hashed subwords, a linear softmax, calibrated rejection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows from which the model is fitted, at most, all languages together; but each language has LEAST_ROWS if it can.
SAMPLE_ROWS, LEAST_ROWS = 2000, 8
#: Languages whose row counts are broadcast; more are joined by a shuffle.
BROADCAST_LANGS = 10_000
ORDERS = (2, 3, 4)
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
DIM = 16
#: Passes over the sample, and steps at least: a small sample is gone over more often.
EPOCHS, STEPS = 4, 10_000
#: Bytes, and texts, that are looked at in one go.
PIECE, SLICE = 1 << 20, 500
#: Of right answers on held-out excerpts so many may be rejected; and no answer surer than LEAST_SURE is.
REJECTED_RIGHT, LEAST_SURE = 0.001, 0.5
_LETTERS = np.array([c if c >= 128 or chr(c).isalpha() else 32 for c in range(256)], dtype=np.uint8)


@dataclass
class Model:
    langs: list[str]
    #: For each language the logits of the buckets; the last bucket is for windows that don't count.
    logits: np.ndarray
    temperature: float
    reject_below: float

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Mean logits (texts by languages) and the number of subwords of each text."""
        data, ends = _joined(texts)
        sums, n = np.zeros((len(self.langs), len(texts))), np.zeros(len(texts))
        ones = np.append(np.ones(BUCKETS, dtype=np.float32), np.float32(0))
        for at in range(0, len(data), PIECE):
            to = min(at + PIECE, len(data))
            first = int(np.searchsorted(ends, at, side="right"))
            last = int(np.searchsorted(ends, to - 1, side="right"))
            starts = np.maximum(np.concatenate([[at], ends[first:last]]), at) - at
            for ids in subwords(data, at, to):
                n[first : last + 1] += np.add.reduceat(ones[ids], starts)
                for k, own in enumerate(self.logits):
                    sums[k, first : last + 1] += np.add.reduceat(own[ids], starts, dtype=np.float64)
        return (sums / np.maximum(n, 1)).T, n

    def predict(self, texts: pa.Array) -> list[pa.Array]:
        """Language, calibrated score, whether the answer is rejected; SLICE texts at a time."""
        made = [self._predict(texts.slice(at, SLICE)) for at in range(0, max(len(texts), 1), SLICE)]
        return [pa.concat_arrays(x) for x in zip(*made)]

    def _predict(self, texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
        letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if not self.langs:
            return pa.array(["und"] * len(texts), type=pa.string()), pa.array(np.zeros(len(texts))), pa.array(np.ones(len(texts), dtype=bool))
        logits, _ = self.scores(texts)
        p = softmax(logits / self.temperature)
        best = p.argmax(axis=1)
        score = np.where(letters, p[np.arange(len(p)), best], 0.0)
        names = np.where(letters, np.array(self.langs, dtype=object)[best], "und")
        return pa.array(names, type=pa.string()), pa.array(score), pa.array(~letters | (score < self.reject_below))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all lower-cased texts, each between two spaces, and where each text ends."""
    texts = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    texts = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string()))
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(0, dtype=np.int64)
    return np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


def subwords(data: np.ndarray, at: int, to: int) -> Iterator[np.ndarray]:
    """For each order the bucket of the window that ends at each place of data[at:to].

    A window lies within a word and the spaces next to it; others get the bucket BUCKETS, so no
    window reaches from one text into the next.
    """
    low = max(0, at - max(ORDERS) + 1)
    raw = _LETTERS[data[low:to]]
    space, code = raw == 32, raw.astype(np.uint32)
    wide = code
    for n in range(2, max(ORDERS) + 1):
        wide = (wide[:-1] << np.uint32(8)) | code[n - 1 :]
        if n not in ORDERS:
            continue
        bad = space[: len(wide)] & space[1 : len(wide) + 1] if n == 2 else np.zeros(len(wide), dtype=bool)
        for inner in range(1, n - 1):
            bad |= space[inner : inner + len(wide)]
        ids = (((wide + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)
        ids[bad] = BUCKETS
        out = np.full(to - at, BUCKETS, dtype=np.int64)
        if got := min(len(ids), to - at):
            out[-got:] = ids[-got:]
        yield out


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a whole text's subwords, and the share of each."""
    data, counts = np.frombuffer(text, dtype=np.uint8), np.zeros(BUCKETS + 1, dtype=np.int64)
    for at in range(0, len(data), PIECE):
        for ids in subwords(data, at, min(at + PIECE, len(data))):
            counts += np.bincount(ids, minlength=BUCKETS + 1)
    ids = np.flatnonzero(counts[:BUCKETS])
    return ids, (counts[ids] / max(1, counts[:BUCKETS].sum())).astype(np.float32)


def fit(texts: list[str], langs: list[str], seed: int = 1) -> Model:
    """The model of these texts."""
    data, ends = _joined(pa.array(texts, type=pa.string()))
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    return fit_bags([bag(data[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())], langs, seed)


def fit_bags(given: list[tuple[np.ndarray, np.ndarray]], langs: list[str], seed: int = 1) -> Model:
    """Stochastic gradient descent over bags of subwords; a tenth of them calibrates and is not learned from."""
    names = sorted(set(langs))
    if not names:
        return Model([], np.zeros((0, BUCKETS + 1), dtype=np.float32), 1.0, 0.0)
    number = {name: i for i, name in enumerate(names)}
    bags, target = [b for b in given if len(b[0])], [number[lang] for b, lang in zip(given, langs) if len(b[0])]
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(bags))
    held, learned = order[: len(order) // 10], order[len(order) // 10 :]
    table = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS + 1, DIM)).astype(np.float32)
    table[BUCKETS] = 0
    top = np.zeros((DIM, len(names)), dtype=np.float32)
    epochs = max(EPOCHS, -(-STEPS // max(1, len(learned))))
    steps, at = max(1, epochs * len(learned)), 0
    for _ in range(epochs):
        for i in rng.permutation(learned):
            ids, weight = bags[i]
            mean = weight @ table[ids]
            wrong = softmax(mean @ top)
            wrong[target[i]] -= 1
            rate = np.float32(2.0 * (1 - at / steps))
            table[ids] -= np.outer(weight * rate, top @ wrong)
            top -= rate * np.outer(mean, wrong)
            at += 1
    logits = np.ascontiguousarray((table @ top).T.astype(np.float32))
    seen = held if len(held) else learned
    raw, right = np.array([logits[:, bags[i][0]] @ bags[i][1] for i in seen]).reshape(-1, len(names)), np.array([target[i] for i in seen], dtype=int)
    temperature, below = _calibrated(raw, right) if len(right) else (1.0, 0.0)
    return Model(names, logits, temperature, below)


def _calibrated(raw: np.ndarray, right: np.ndarray) -> tuple[float, float]:
    """The temperature of least loss, and the score below which an answer is rejected."""
    at = np.arange(len(right))
    loss = {t: -np.log(np.maximum(softmax(raw / t)[at, right], 1e-12)).mean() for t in np.geomspace(0.1, 10, 41)}
    t = min(loss, key=loss.get)
    p = softmax(raw / t)
    sure = p.max(axis=1)[p.argmax(axis=1) == right]
    return float(t), min(LEAST_SURE, float(np.quantile(sure, REJECTED_RIGHT))) if len(sure) else 0.0


def sample(docs: DataFrame, labelled: Column, id_col: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = SAMPLE_ROWS) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[str]]:
    """Bags of the whole texts of labelled rows, spread evenly over all languages, chosen by hash; and their languages.

    There are about rows of them, or LEAST_ROWS for each language if that is more. Texts stay on the executors; a
    bag has an entry for each bucket at most. Repeated rows count once.
    """
    chance = F.pmod(F.xxhash64(F.lit(11), F.col(id_col), F.length(text)), F.lit(1 << 30)) / float(1 << 30)
    own = docs.where(F.coalesce(labelled, F.lit(False)) & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("l"), F.col(text).alias("t"), chance.alias("u"))
    counts = {r.l: r.n for r in own.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return [], []
    each = max(rows / len(counts), LEAST_ROWS)
    shares = docs.sparkSession.createDataFrame([(k, each / n) for k, n in counts.items()], "l string, share double")
    some = own.join(F.broadcast(shares) if len(counts) <= BROADCAST_LANGS else shares, "l").where("u < share").dropDuplicates(["l", "u"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = _joined(batch.column("t"))
            made = [bag(data[a:b].tobytes()) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("l"), batch.column("u"), pa.array([x.astype("<u2").tobytes() for x, _ in made], type=pa.binary()), pa.array([w.tobytes() for _, w in made], type=pa.binary())],
                names=["l", "u", "ids", "weights"],
            )

    got = some.select("l", "u", "t").mapInArrow(run, "l string, u double, ids binary, weights binary").collect()
    got.sort(key=lambda r: (r.u, r.l))
    return [(np.frombuffer(r.ids, dtype="<u2").astype(np.int64), np.frombuffer(r.weights, dtype=np.float32)) for r in got], [r.l for r in got]


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds lang_pred, score and rejected to every row of docs; columns of these names are replaced.

    lang_pred is one of the learned languages, or und if the text is null or has no letter; its score
    is then 0 and it is rejected. score is the calibrated probability of lang_pred; answers below
    model.reject_below are rejected. Of equally likely languages the first by name is given. A model
    without languages says und. Texts are read whole, in pieces of PIECE bytes.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    own = text if text in kept else "_text"
    schema = docs.select(*kept, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = model.predict(batch.column(own))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], names=[*kept, "lang_pred", "score", "rejected"])
            pa.default_memory_pool().release_unused()  # the worker lives on

    return docs.select(*kept, *([] if own == text else [F.col(text).alias(own)])).mapInArrow(run, schema)


def fit_on(docs: DataFrame, labelled: Column, **columns: str) -> Model:
    return fit_bags(*sample(docs, labelled, **columns))
