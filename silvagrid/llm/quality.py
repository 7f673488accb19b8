"""Quality scores: random-indexing word vectors, pooled, and a two-layer network with calibrated output."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvagrid.llm.common import byte_texts, id_crc, map_arrow, slices, span_hashes, stream, word_arrays


@dataclass(frozen=True)
class Quality:
    """Parameters: bits of word and shape buckets, vector length, entries of an index vector,
    neighbours on each side, labelled rows used at most, hidden units, passes, seed."""

    word_bits: int = 14
    shape_bits: int = 10
    length: int = 32
    entries: int = 2
    reach: int = 2
    max_rows: int = 20_000
    hidden: int = 16
    epochs: int = 30
    seed: int = 5

    @property
    def buckets(self) -> int:
        return (1 << self.word_bits) + (1 << self.shape_bits)


#: Score from which a document counts as good.
ACCEPT = 0.7
#: Classes of bytes in a shape: lower, upper, digit; other ASCII signs stand for themselves.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = 1
_CLASS[128:256] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_SAME = np.uint64(stream(29, 1)[0])


def _word_and_shape(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Two hashes per word: of its bytes with A-Z lowered, and of its classes with runs made one."""
    kinds = _CLASS[raw]
    keep = np.ones(len(raw), bool)
    keep[1:] = kinds[1:] != kinds[:-1]
    keep[starts] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    return np.stack([span_hashes(raw, starts, ends, True), span_hashes(kinds[keep], at[starts], at[ends])], axis=1)


def bucket_streams(texts: list[bytes], p: Quality) -> tuple[np.ndarray, np.ndarray]:
    """words x 2 buckets (word; shape, or a sign for "the same word again") and each text's offset."""
    hashes, offsets = word_arrays(texts, _word_and_shape)
    words, shapes = hashes[:, 0], hashes[:, 1].copy()
    again = np.zeros(len(words), bool)
    again[1:] = words[1:] == words[:-1]
    again[offsets[:-1][offsets[:-1] < len(words)]] = False
    shapes[again] = _SAME
    out = np.empty((len(words), 2), np.int64)
    out[:, 0] = words >> np.uint64(64 - p.word_bits)
    out[:, 1] = (shapes >> np.uint64(64 - p.shape_bits)).astype(np.int64) + (1 << p.word_bits)
    return out, offsets


def _index_vectors(p: Quality) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the few entries of each bucket's index vector."""
    drawn = stream(p.seed, p.buckets * p.entries).reshape(p.buckets, p.entries)
    return (drawn % np.uint64(p.length)).astype(np.int64), np.where(drawn >> np.uint64(63), 1.0, -1.0)


def word_vectors(docs: DataFrame, text: str = "text", p: Quality = Quality()) -> np.ndarray:
    """Context vectors of all buckets over the whole corpus, scaled to length 1.

    Each word adds the index vectors of its neighbours within its text to its bucket. Tasks add up
    what they read, Spark adds up the tasks' sums; the driver gets ``p.buckets`` rows whatever the
    corpus' size.
    """
    places, signs = _index_vectors(p)
    size = p.buckets * p.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for part in slices(byte_texts(batch.column(0))):
                buckets, offsets = bucket_streams(part, p)
                owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
                for gap in range(1, p.reach + 1):
                    both = owner[gap:] == owner[:-gap]
                    for k in range(2):
                        left, right = buckets[:-gap, k][both], buckets[gap:, k][both]
                        for x, y in ((left, right), (right, left)):
                            for e in range(p.entries):
                                total += np.bincount(x * p.length + places[y, e], signs[y, e], size)
        rows = total.reshape(p.buckets, p.length)
        filled = np.flatnonzero(rows.any(axis=1))
        values = pa.array(rows[filled].astype(np.int64).ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(filled) + 1) * p.length, pa.int32()), values)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(filled.astype(np.int32)), "v": lists})

    parts = docs.select(text).mapInArrow(run, "bucket int, v array<long>")
    summed = parts.groupBy("bucket").agg(*[F.sum(F.get("v", F.lit(i))).alias(f"v{i}") for i in range(p.length)]).toArrow()
    out = np.zeros((p.buckets, p.length), np.float32)
    if summed.num_rows:
        got = np.stack([summed.column(f"v{i}").to_numpy() for i in range(p.length)], axis=1).astype(np.float64)
        norm = np.linalg.norm(got, axis=1, keepdims=True)
        out[summed.column("bucket").to_numpy()] = got / np.where(norm, norm, 1)
    return out


def pool(texts: list[bytes], vectors: np.ndarray, p: Quality) -> np.ndarray:
    """texts x (2 * length): means of word and of shape vectors; zeros for a text without words."""
    return np.concatenate([np.zeros((0, 2 * p.length), np.float32), *(_pool(part, vectors, p) for part in slices(texts))])


def _pool(texts: list[bytes], vectors: np.ndarray, p: Quality) -> np.ndarray:
    buckets, offsets = bucket_streams(texts, p)
    out = np.zeros((len(texts), 2 * p.length), np.float32)
    filled = np.flatnonzero(np.diff(offsets))
    i = 0
    while i < len(filled):
        j = i + 1
        while j < len(filled) and offsets[filled[j] + 1] - offsets[filled[i]] <= 1 << 15:
            j += 1
        rows = filled[i:j]
        s, e = offsets[rows[0]], offsets[rows[-1] + 1]
        for k in range(2):
            out[rows, k * p.length : (k + 1) * p.length] = np.add.reduceat(vectors[buckets[s:e, k]], offsets[rows] - s, axis=0)
        i = j
    return out / np.maximum(np.diff(offsets), 1).astype(np.float32)[:, None]


@dataclass
class Network:
    """Two layers and a temperature; ``score`` gives the probability of label 1."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logit(x) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def train(x: np.ndarray, y: np.ndarray, fold: np.ndarray, p: Quality) -> Network:
    """Fits the network on rows outside ``fold`` (Adam, small batches) and its temperature on ``fold``.

    Without both labels the score is the smoothed share of label 1.
    """
    width = x.shape[1] if x.ndim == 2 else 2 * p.length
    prior = (y.sum() + 1.0) / (len(y) + 2.0)
    net = Network(np.zeros(width), np.ones(width), np.zeros((width, p.hidden)), np.zeros(p.hidden), np.zeros(p.hidden), float(np.log(prior / (1 - prior))))
    if len(set(y[~fold].tolist())) < 2:
        return net
    a, b = x[~fold].astype(np.float64), y[~fold].astype(np.float64)
    net.mean, net.scale = a.mean(axis=0), a.std(axis=0) + 1e-3
    rng = np.random.default_rng(p.seed)
    net.w1 = rng.normal(0, width**-0.5, (width, p.hidden))
    net.w2 = rng.normal(0, p.hidden**-0.5, p.hidden)
    a = (a - net.mean) / net.scale
    params = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second, step = [np.zeros_like(v) for v in params], [np.zeros_like(v) for v in params], 0
    for _ in range(p.epochs):
        order = rng.permutation(len(a))
        for at in range(0, len(order), 256):
            rows = order[at : at + 256]
            hidden = np.tanh(a[rows] @ params[0] + params[1])
            error = (_sigmoid(hidden @ params[2] + params[3]) - b[rows]) / len(rows)
            back = error[:, None] * params[2] * (1 - hidden**2)
            grads = [a[rows].T @ back + 1e-4 * params[0], back.sum(axis=0), hidden.T @ error + 1e-4 * params[2], error.sum(keepdims=True)]
            step += 1
            for v, g, m, s in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= 0.005 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = params[0], params[1], params[2], float(params[3][0])
    if fold.any():
        raw, target = net.logit(x[fold]), y[fold]
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        loss = [np.mean(np.logaddexp(0, raw / t) - target * raw / t) for t in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def fit_quality(
    docs: DataFrame, labels: DataFrame, p: Quality = Quality(), key: str = "doc_id", text: str = "text", label: str = "quality"
) -> tuple[np.ndarray, Network]:
    """Word vectors over all ``docs`` and a network learned from ``labels`` (key, label 0 or 1).

    At most ``p.max_rows`` labelled rows, in hash order of their ids, are used. NULL labels and
    ids, and ids with two different labels, are left out. A fifth of the rows sets the temperature.
    """
    vectors = word_vectors(docs, text, p)
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("_id"))
    known = known.agg(F.min(label).alias("y"), F.max(label).alias("_max")).where("y = _max").select("_id", "y")
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(p.max_rows)
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("text")).join(F.broadcast(known), "_id")
    rows = rows.select("_id", "text", F.col("y").cast("int"), (F.pmod(F.floor(id_crc("_id") / 4), F.lit(5)) == 0).alias("fold"))

    def run(batch: pa.RecordBatch) -> dict:
        pooled = pool(byte_texts(batch.column(1)), vectors, p)
        return {"_id": batch.column(0), "x": pa.array([v.tobytes() for v in pooled], pa.binary()), "y": batch.column(2), "fold": batch.column(3)}

    kind = dict(rows.dtypes)["_id"]
    got = map_arrow(rows, run, f"_id {kind}, x binary, y int, fold boolean").dropDuplicates(["_id"]).orderBy("_id").toArrow()
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(-1, 2 * p.length)
    y = np.array(got.column("y").to_pylist(), np.float64)
    return vectors, train(x, y, np.array(got.column("fold").to_pylist(), bool), p)


def score_quality(docs: DataFrame, model: tuple[np.ndarray, Network], p: Quality = Quality(), text: str = "text") -> DataFrame:
    """``docs`` with column ``score``: the probability of label 1 of each whole text (NULL: empty).

    A column of that name is replaced, all others stay. An empty text has the score of zero vectors.
    """
    vectors, net = model
    docs = docs.drop("score")
    schema = docs.withColumn("score", F.lit(0.0)).schema

    def run(batch: pa.RecordBatch) -> dict:
        scores = net.score(pool(byte_texts(batch.column(text)), vectors, p))
        return dict(zip(batch.schema.names, batch.columns)) | {"score": pa.array(np.clip(scores, 0, 1), pa.float64())}

    return map_arrow(docs, run, schema)


def keep_good(docs: DataFrame, model: tuple[np.ndarray, Network], least: float = ACCEPT, p: Quality = Quality(), text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``, with exactly the columns of ``docs``."""
    vectors, net = model

    def run(batch: pa.RecordBatch) -> dict:
        good = pa.array(net.score(pool(byte_texts(batch.column(text)), vectors, p)) >= least)
        return {n: c.filter(good) for n, c in zip(batch.schema.names, batch.columns)}

    return map_arrow(docs, run, docs.schema)


def training_labels(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Labelled rows whose crc32 of the id modulo 4 is not 2."""
    return labels.where(F.pmod(id_crc(key), F.lit(4)) != 2)
