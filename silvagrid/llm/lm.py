"""Interpolated modified Kneser-Ney bigram model, counted in Spark, kept in memory-mapped sorted arrays."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvagrid.llm.common import byte_texts, hash_words, slices, stream
from silvagrid.plans.staging import new_path, stage

#: Hash of the token that ends a text and stands before its first word.
END = np.uint64(stream(31, 1)[0])
#: Text bytes per shard of the model.
SHARD_BYTES = 16 << 20
MAX_SHARDS = 20_000
#: Times from which a word can be heavy, however small the corpus.
HEAVY = 1000


@dataclass(frozen=True)
class Model:
    """Where the arrays lie, and the few numbers that hold for all of them.

    Words are numbered in order of their hashes; shard i of the vocabulary holds the hashes of an
    i-th part of the 64-bit range, shard i of the bigrams those of an i-th part of the numbers.
    ``heavy`` words have so many followers that these are spread over all heavy shards.
    """

    path: str
    shards: int
    first: list[int]
    tokens: int = 0
    heavy: dict[int, int] = field(default_factory=dict)
    heavy_kinds: dict[int, tuple[int, int, int]] = field(default_factory=dict)
    discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    low_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    low_total: int = 0
    low_rest: float = 1.0

    @property
    def words(self) -> int:
        return self.first[-1]


def _save(path: str, name: str, array: np.ndarray) -> None:
    """Writes under another name first, so that a reader or a second attempt never sees half a file."""
    part = os.path.join(path, f".{name}-{uuid.uuid4().hex}")
    with open(part, "wb") as f:
        np.save(f, array)
    os.replace(part, os.path.join(path, f"{name}.npy"))


def _complete(path: str, name: str, shards: int, width: int = 0) -> None:
    """Writes empty files for the shards that got no rows, so that a file that is not there is a lost one."""
    for i in range(shards):
        if not os.path.exists(os.path.join(path, f"{name}-{i}.npy")):
            _save(path, f"{name}-{i}", np.zeros((0, width) if width else 0, np.uint32 if width else np.uint64))


@lru_cache(maxsize=4096)
def _load(path: str, name: str) -> np.ndarray:
    """Maps a file of the model; one that is missing raises, as scores would be wrong without it."""
    file = os.path.join(path, f"{name}.npy")
    with open(file, "rb") as f:
        empty = not np.prod(np.lib.format.read_array_header_1_0(f)[0]) if np.lib.format.read_magic(f) == (1, 0) else False
    return np.load(file, mmap_mode=None if empty else "r")


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text closed by END, and each text's offset."""
    words, at = hash_words(texts)
    n = np.diff(at) + 1
    offsets = np.concatenate([[0], np.cumsum(n)])
    out = np.full(offsets[-1], END)
    keep = np.ones(len(out), bool)
    keep[offsets[1:] - 1] = False
    out[keep] = words
    return out, offsets


def _hash_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _cut(sorted_shards: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.diff(sorted_shards, prepend=-1))
    return starts, np.append(starts[1:], len(sorted_shards))


_BLOB = "shard int, keys binary, counts binary"


def _blobs(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(shard, kind="stable")
    keys, counts, shard = keys[order], counts[order].astype(np.uint32), shard[order]
    starts, ends = _cut(shard)
    return pa.RecordBatch.from_pydict({
        "shard": pa.array(shard[starts].astype(np.int32)),
        "keys": pa.array([keys[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary()),
        "counts": pa.array([counts[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary()),
    })


def _merged(table: pa.Table, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of one shard's blobs and their summed counts."""
    keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), kind)
    counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint32)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64)


def _numbers(hashes: np.ndarray, m: Model) -> np.ndarray:
    """Numbers of words by hash; -1 for unknown ones."""
    asked, back = np.unique(hashes, return_inverse=True)
    out = np.full(len(asked), -1, np.int64)
    shard = _hash_shard(asked, m.shards)
    for s, e in zip(*_cut(shard)):
        known = _load(m.path, f"words-{shard[s]}")
        if len(known):
            at = np.minimum(np.searchsorted(known, asked[s:e]), len(known) - 1)
            out[s:e] = np.where(known[at] == asked[s:e], at + m.first[shard[s]], -1)
    return out[back]


def _by_number(numbers: np.ndarray, m: Model, name: str, width: int = 0) -> np.ndarray:
    """Values kept per word number in shards of the vocabulary; 0 for -1."""
    out = np.zeros((len(numbers), width) if width else len(numbers), np.int64)
    order = np.argsort(numbers, kind="stable")
    asked = numbers[order]
    shard = np.searchsorted(m.first, asked, side="right") - 1
    for s, e in zip(*_cut(shard)):
        if shard[s] >= 0:
            values = _load(m.path, f"{name}-{shard[s]}")
            if len(values):
                out[order[s:e]] = values[asked[s:e] - m.first[shard[s]]]
    return out


def _pair_shard(before: np.ndarray, word: np.ndarray, m: Model) -> np.ndarray:
    """The shard of a pair: by the word before, or, after a heavy word, by the word itself."""
    normal = np.searchsorted(m.first, before, side="right") - 1
    if not m.heavy:
        return normal
    heavy = np.isin(before, np.fromiter(m.heavy, np.int64, len(m.heavy)))
    return np.where(heavy, m.shards + word % m.shards, normal)


def _pairs(hashes: np.ndarray, offsets: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of each token and of the token before it (END before the first)."""
    word = _numbers(hashes, m)
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[offsets[:-1]] = _numbers(np.array([END]), m)[0]
    return before, word


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Counts the model over all rows of ``docs`` (NULL text: empty) in the shared folder.

    Each task counts slices of its rows and sends the counts as sorted arrays, cut by shard; a
    task per shard adds them up and writes a file. No array passes through the driver. The
    folder of ``spark.checkpoint.dir`` must be a mounted one, as workers map its files.
    """
    spark = docs.sparkSession
    where = urlparse(new_path(spark, "bigrams"))
    if where.scheme not in ("", "file"):
        raise ValueError("the model needs a mounted shared folder in spark.checkpoint.dir")
    path = where.path
    os.makedirs(path, exist_ok=True)
    texts = docs.select(F.col(text).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = min(MAX_SHARDS, max(8, -(-size // SHARD_BYTES)))
    many = max(HEAVY, size // (32 * shards))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(byte_texts(batch.column(0))):
                found, counts = np.unique(_tokens(part)[0], return_counts=True)
                yield _blobs(found, counts, _hash_shard(found, shards))

    def keep_words(key: tuple, table: pa.Table) -> pa.Table:
        found, counts = _merged(table, np.uint64)
        shard = key[0].as_py()
        _save(path, f"words-{shard}", found)
        _save(path, f"counts-{shard}", counts)
        big = np.flatnonzero(counts >= many)
        return pa.table({
            "shard": pa.array([shard], pa.int32()), "words": pa.array([len(found)], pa.int64()), "tokens": pa.array([counts.sum()], pa.int64()),
            "at": pa.array([big.tolist()], pa.list_(pa.int64())), "n": pa.array([counts[big].tolist()], pa.list_(pa.int64())),
        })

    counted = texts.mapInArrow(count_words, _BLOB).groupBy("shard").applyInArrow(
        keep_words, "shard int, words long, tokens long, at array<long>, n array<long>"
    )
    found = {r["shard"]: r for r in counted.collect()}
    for name in ("words", "counts"):
        _complete(path, name, shards)
    first = [0]
    for i in range(shards):
        first.append(first[-1] + (found[i]["words"] if i in found else 0))
    if first[-1] >= 1 << 32:
        raise ValueError("more than 2 ** 32 words")
    heavy = {first[i] + a: n for i, r in found.items() for a, n in zip(r["at"], r["n"])}
    m = Model(path, shards, first, sum(r["tokens"] for r in found.values()), heavy)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(byte_texts(batch.column(0))):
                before, word = _pairs(*_tokens(part), m)
                keys, counts = np.unique(before.astype(np.uint64) << np.uint64(32) | word.astype(np.uint64), return_counts=True)
                yield _blobs(keys, counts, _pair_shard((keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64), m))

    def keep_pairs(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        keys, counts = _merged(table, np.uint64)
        _save(path, f"pairs-{shard}", keys)
        _save(path, f"times-{shard}", counts.astype(np.uint32))
        before, kind = (keys >> np.uint64(32)).astype(np.int64), np.minimum(counts, 3) - 1
        rows = {"shard": [], "keys": [], "counts": [], "heavy": []}
        if shard < m.shards:
            kinds = np.zeros((m.first[shard + 1] - m.first[shard], 3), np.uint32)
            np.add.at(kinds, (before - m.first[shard], kind), 1)
            _save(path, f"kinds-{shard}", kinds)
        else:
            own, at = np.unique(before, return_inverse=True)
            kinds = np.zeros((len(own), 3), np.int64)
            np.add.at(kinds, (at, kind), 1)
            rows["heavy"] = np.column_stack([own, kinds]).tolist()
        number, times = np.unique((keys & np.uint64(0xFFFFFFFF)).astype(np.uint32), return_counts=True)
        home = np.searchsorted(m.first, number, side="right") - 1
        for s, e in zip(*_cut(home)):
            rows["shard"].append(int(home[s]))
            rows["keys"].append(number[s:e].tobytes())
            rows["counts"].append(times[s:e].astype(np.uint32).tobytes())
        n = len(rows["shard"])
        seen = np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()
        return pa.table({
            "shard": pa.array([*rows["shard"], -1], pa.int32()),
            "keys": pa.array([*rows["keys"], None], pa.binary()),
            "counts": pa.array([*rows["counts"], None], pa.binary()),
            "heavy": pa.array([None] * n + [rows["heavy"]], pa.list_(pa.list_(pa.int64()))),
            "seen": pa.array([None] * n + [seen], pa.list_(pa.int64())),
        })

    paired = texts.mapInArrow(count_pairs, _BLOB).groupBy("shard").applyInArrow(
        keep_pairs, _BLOB + ", heavy array<array<long>>, seen array<long>"
    )
    paired = stage(paired, "followers")
    for name in ("pairs", "times"):
        _complete(path, name, 2 * shards)
    _complete(path, "kinds", shards, 3)
    notes = paired.where("shard = -1")
    seen = notes.select(*[F.coalesce(F.sum(F.get("seen", F.lit(i))), F.lit(0)).alias(f"n{i}") for i in range(4)]).first()
    of_heavy = notes.select(F.explode("heavy").alias("x")).select(*[F.get("x", F.lit(j)).alias(f"c{j}") for j in range(4)])
    of_heavy = of_heavy.groupBy("c0").agg(F.sum("c1"), F.sum("c2"), F.sum("c3")).collect()

    def keep_followed(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        number, times = _merged(table, np.uint32)
        _save(path, f"followed-{shard}", times.astype(np.uint32))
        if len(number) != m.first[shard + 1] - m.first[shard]:
            raise ValueError("a word without a word before it")
        seen = np.bincount(np.minimum(times, 5), minlength=6)[1:5].tolist()
        return pa.table({"seen": pa.array([[*seen, int(times.sum()), len(times)]], pa.list_(pa.int64()))})

    low = paired.where("shard >= 0").select("shard", "keys", "counts").groupBy("shard").applyInArrow(keep_followed, "seen array<long>")
    n1, n2, n3, n4, total, kinds = low.select(*[F.coalesce(F.sum(F.get("seen", F.lit(i))), F.lit(0)) for i in range(6)]).first()
    _complete(path, "followed", shards)
    d = _discounts([n1, n2, n3, n4])
    rest = (d[0] * n1 + d[1] * n2 + d[2] * (kinds - n1 - n2)) / total if total else 1.0
    return Model(path, shards, first, m.tokens, heavy, {r[0]: (r[1], r[2], r[3]) for r in of_heavy}, _discounts(list(seen)), d, total, rest)


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Chen and Goodman's three discounts from how many entries occur 1, 2, 3 and 4 times."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    out = []
    for k in (1, 2, 3):
        raw = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k * 0.5
        out.append(float(min(max(raw, 0.0), k)))
    return tuple(out)


def _low(word: np.ndarray, m: Model) -> np.ndarray:
    """Probability of a word by the number of different words before it; what is discounted goes
    to all known words and one unknown alike."""
    spread = m.low_rest / (m.words + 1)
    if not m.low_total:
        return np.full(len(word), spread)
    times = _by_number(word, m, "followed")
    taken = np.array([0.0, *m.low_discounts])[np.minimum(times, 3)]
    return np.maximum(times - taken, 0) / m.low_total + spread


def _probabilities(before: np.ndarray, word: np.ndarray, m: Model) -> np.ndarray:
    low = _low(word, m)
    total = _by_number(before, m, "counts")
    kinds = _by_number(before, m, "kinds", 3)
    if m.heavy_kinds:
        own = np.array(sorted(m.heavy_kinds), np.int64)
        at = np.minimum(np.searchsorted(own, before), len(own) - 1)
        hit = own[at] == before
        kinds[hit] = np.array([m.heavy_kinds[k] for k in own.tolist()], np.int64)[at[hit]]
    known = (before >= 0) & (word >= 0)
    times = np.zeros(len(word), np.int64)
    b, w = before[known], word[known]
    keys = b.astype(np.uint64) << np.uint64(32) | w.astype(np.uint64)
    shard = _pair_shard(b, w, m)
    order = np.lexsort((keys, shard))
    found = np.zeros(len(keys), np.int64)
    for s, e in zip(*_cut(shard[order])):
        here = order[s:e]
        pairs = _load(m.path, f"pairs-{shard[here[0]]}")
        if len(pairs):
            at = np.minimum(np.searchsorted(pairs, keys[here]), len(pairs) - 1)
            counts = _load(m.path, f"times-{shard[here[0]]}")
            found[here] = np.where(pairs[at] == keys[here], counts[at], 0)
    times[known] = found
    seen = total > 0
    scale = 1 / np.where(seen, total, 1)
    taken = np.array([0.0, *m.discounts])[np.minimum(times, 3)]
    rest = np.where(seen, kinds @ np.array(m.discounts) * scale, 1.0)
    return np.maximum(times - taken, 0) * scale + rest * low


def score(docs: DataFrame, m: Model, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, n_known, train_tokens, base_score, score and perplexity.

    ``score`` is the log10 probability of all tokens of the whole text and its end, ``base_score``
    that of smoothed word counts. NULL text counts as empty: one token, the end. Columns of these
    names are replaced, all others stay. No shuffle; workers map the model's files.
    """
    docs = docs.drop("n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
    long, real = F.lit(0).cast("long"), F.lit(0.0)
    added = {"n_tokens": long, "n_known": long, "train_tokens": long, "base_score": real, "score": real, "perplexity": real}
    schema = docs.withColumns(added).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, known, base, full = [], [], [], []
            for part in slices(byte_texts(batch.column(text))):
                hashes, offsets = _tokens(part)
                before, word = _pairs(hashes, offsets, m)
                counts = _by_number(word, m, "counts")
                starts = offsets[:-1]
                n.append(np.diff(offsets))
                known.append(np.add.reduceat((counts > 0).astype(np.int64), starts))
                base.append(np.add.reduceat(np.log10((counts + 0.5) / (m.tokens + 0.5 * (m.words + 1))), starts))
                full.append(np.add.reduceat(np.log10(_probabilities(before, word, m)), starts))
            n, full = np.concatenate(n), np.concatenate(full)
            with np.errstate(over="ignore"):
                perplexity = 10 ** (-full / n)
            yield pa.RecordBatch.from_pydict(dict(zip(batch.schema.names, batch.columns)) | {
                "n_tokens": pa.array(n), "n_known": pa.array(np.concatenate(known)),
                "train_tokens": pa.array(np.full(len(n), m.tokens, np.int64)),
                "base_score": pa.array(np.concatenate(base)), "score": pa.array(full), "perplexity": pa.array(perplexity),
            })

    return docs.mapInArrow(run, schema)
