"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvagrid.llm.common import byte_texts, id_crc, map_arrow, mix


@dataclass(frozen=True)
class Recurrent:
    """Parameters: units per direction, bytes of a training window, windows per document, documents
    per language used at most, steps, windows per step, bytes of a segment, seed."""

    units: int = 8
    window: int = 48
    per_document: int = 3
    documents: int = 600
    steps: int = 260
    batch: int = 192
    segment: int = 128
    seed: int = 3


#: Segments that run side by side.
LANES = 2048


@dataclass
class Model:
    """Weights of both directions: ``table`` 3h x 256 (a byte's share), ``again`` 3h x h, ``out`` k x h."""

    names: list[str]
    table: list[np.ndarray] = field(default_factory=list)
    again: list[np.ndarray] = field(default_factory=list)
    out: list[np.ndarray] = field(default_factory=list)
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _states(x: np.ndarray, live: np.ndarray | None, table: np.ndarray, again: np.ndarray, keep: list | None = None) -> np.ndarray:
    """steps x h x lanes states of one direction over bytes ``x`` (steps x lanes)."""
    h = again.shape[1]
    state = np.zeros((h, x.shape[1]), table.dtype)
    out = np.empty((len(x), h, x.shape[1]), table.dtype)
    for t, at in enumerate(x):
        seen = table.take(at, axis=1)
        past = again @ state
        gates = seen[: 2 * h] + past[: 2 * h]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        update, reset = gates[:h], gates[h:]
        new = reset * past[2 * h :]
        new += seen[2 * h :]
        np.tanh(new, out=new)
        if keep is not None:
            keep.append((state, update, reset, past[2 * h :], new))
        state = new + update * (state - new)
        if live is not None:
            state *= live[t]
        out[t] = state
    return out


def position_probabilities(x: np.ndarray, live: np.ndarray | None, m: Model) -> np.ndarray:
    """steps x languages x lanes: the label of every byte as probabilities."""
    ahead = _states(x, live, m.table[0], m.again[0])
    back = _states(x[::-1], None if live is None else live[::-1], m.table[1], m.again[1])[::-1]
    logits = m.out[0] @ ahead
    logits += m.out[1] @ back
    logits += m.bias[:, None]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def train_model(windows: np.ndarray, labels: np.ndarray, names: list[str], p: Recurrent) -> Model:
    """Cross-entropy at every position, gradients through time in both directions, Adam."""
    rng = np.random.default_rng(p.seed)
    h, k = p.units, len(names)
    params = []
    for _ in range(2):
        params += [rng.normal(0, 0.3, (3 * h, 256)), rng.normal(0, h**-0.5, (3 * h, h)), rng.normal(0, h**-0.5, (k, h))]
    params.append(np.zeros(k))
    first, second = [np.zeros_like(v) for v in params], [np.zeros_like(v) for v in params]
    groups = [np.flatnonzero(labels == i) for i in range(k)]
    for step in range(1, p.steps + 1):
        rows = np.concatenate([rng.choice(g, -(-p.batch // k)) for g in groups])
        x, y = windows[rows].T, labels[rows]
        grads = [np.zeros_like(v) for v in params]
        kept: list[list] = [[], []]
        states = [
            _states(x if d == 0 else x[::-1], None, params[3 * d], params[3 * d + 1], kept[d]) for d in range(2)
        ]
        logits = params[2] @ states[0] + params[5] @ states[1][::-1] + params[6][:, None]
        logits -= logits.max(axis=1, keepdims=True)
        error = np.exp(logits)
        error /= error.sum(axis=1, keepdims=True)
        error[:, y, np.arange(len(y))] -= 1
        error /= error.shape[0] * error.shape[2]
        grads[6] = error.sum(axis=(0, 2))
        for d in range(2):
            e = error if d == 0 else error[::-1]
            grads[3 * d + 2] = np.einsum("tkn,thn->kh", e, states[d], optimize=True)
            seen = x if d == 0 else x[::-1]
            flow = np.zeros((h, x.shape[1]))
            changes = np.empty((len(x), 3 * h, x.shape[1]))
            again = params[3 * d + 1]
            for t in range(len(x) - 1, -1, -1):
                before, update, reset, past, new = kept[d][t]
                flow = flow + params[3 * d + 2].T @ e[t]
                new_in = flow * (1 - update) * (1 - new * new)
                reset_in = new_in * past * reset * (1 - reset)
                update_in = flow * (before - new) * update * (1 - update)
                both = np.concatenate([update_in, reset_in, new_in * reset])
                grads[3 * d + 1] += both @ before.T
                changes[t, : 2 * h], changes[t, 2 * h :] = both[: 2 * h], new_in
                flow = flow * update + again.T @ both
            by_byte = changes.transpose(1, 0, 2).reshape(3 * h, -1)
            at = seen.reshape(-1)
            for i in range(3 * h):
                grads[3 * d][i] = np.bincount(at, by_byte[i], 256)
        norm = np.sqrt(sum((g * g).sum() for g in grads))
        for v, g, a, b in zip(params, grads, first, second):
            g = g / max(1.0, norm)
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            v -= 0.02 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    low = [v.astype(np.float32) for v in params]
    return Model(names, [low[0], low[3]], [low[1], low[4]], [low[2], low[5]], low[6])


#: Languages up to which their table is broadcast; beyond that the documents are exchanged.
BROADCAST_LANGUAGES = 10_000


def training_windows(docs: DataFrame, key: str, text: str, lang: str, p: Recurrent) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows of bytes from a bounded sample of labelled documents, their labels, the languages.

    About ``p.documents`` per language by hash of the id, ``p.per_document`` windows from each, at
    places drawn from the id over the whole text. Every language counts, however rare.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.pmod(id_crc(key), F.lit(5)) != 0))
    counts = known.groupBy(F.col(lang).alias("lang")).agg(F.count(F.lit(1)).alias("c"))
    counts = sorted((r["lang"], r["c"]) for r in counts.collect())
    names = [n for n, _ in counts]
    empty = np.zeros((0, p.window), np.uint8), np.zeros(0, np.int64), names
    if not counts:
        return empty
    share = F.pmod(F.xxhash64(F.lit(p.seed), key), F.lit(1_000_000))
    drawn = [(n, i, min(1_000_000, 1_000_000 * p.documents // c + 1)) for i, (n, c) in enumerate(counts)]
    few = len(drawn) <= BROADCAST_LANGUAGES
    drawn = docs.sparkSession.createDataFrame(drawn, f"lang {dict(docs.dtypes)[lang]}, y int, upto long")
    drawn = F.broadcast(drawn) if few else drawn  # a row per language; texts stay where they are
    rows = known.select(F.col(key).cast("string").alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"), share.alias("draw"))
    rows = rows.join(drawn, "lang").where("draw < upto").select("id", "text", "y", "draw")

    def run(batch: pa.RecordBatch) -> dict:
        found, labels = [], []
        for t, y, draw in zip(byte_texts(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if t:
                places = mix(np.uint64(draw + 1) * np.arange(1, p.per_document + 1, dtype=np.uint64)) % np.uint64(max(1, len(t) - p.window))
                for s in places.tolist():
                    found.append(t[s : s + p.window].ljust(p.window))
                    labels.append(y)
        return {"w": pa.array(found, pa.binary()), "y": pa.array(labels, pa.int32()), "draw": pa.array([0] * len(found), pa.int64())}

    bound = 2 * p.documents * p.per_document * len(names)
    got = map_arrow(rows, run, "w binary, y int, draw long").orderBy(F.xxhash64("w"), "w", "y").limit(bound).toArrow()
    if not got.num_rows:
        return empty
    windows = np.frombuffer(b"".join(got.column("w").to_pylist()), np.uint8).reshape(-1, p.window)
    labels = np.array(got.column("y").to_pylist(), np.int64)
    used = np.unique(labels)
    return windows, np.searchsorted(used, labels), [names[i] for i in used]


def fit_language(docs: DataFrame, p: Recurrent = Recurrent(), key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Learns from rows with text and language whose crc32 of the id modulo 5 is not 0."""
    windows, labels, names = training_windows(docs, key, text, lang, p)
    return train_model(windows, labels, names, p) if len(windows) else Model([])


def document_probabilities(texts: list[bytes], m: Model, p: Recurrent, spans: list | None = None) -> np.ndarray:
    """texts x languages: means of all positions' probabilities; every byte is labelled.

    Texts are cut into segments of ``p.segment`` bytes, which run side by side from a zero state.
    ``spans`` gets, for each text, its runs of equal labels as (start, length, language).
    """
    pooled = np.zeros((len(texts), len(m.names)))
    parts = [(i, s, min(p.segment, len(t) - s)) for i, t in enumerate(texts) for s in range(0, len(t), p.segment)]
    best: dict[int, list[tuple[int, np.ndarray]]] = {}
    full = [x for x in parts if x[2] == p.segment]
    rest = sorted((x for x in parts if x[2] < p.segment), key=lambda x: x[2])
    for group in (full, rest):
        for at in range(0, len(group), LANES):
            lanes = group[at : at + LANES]
            longest = max(n for _, _, n in lanes)
            raw = b"".join(texts[i][s : s + n].ljust(longest, b"\0") for i, s, n in lanes)
            x = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(len(lanes), longest).T)
            live = None
            if group is rest:
                live = (np.arange(longest)[:, None] < np.array([n for _, _, n in lanes])).astype(np.float32)
            chances = position_probabilities(x, live, m)
            weighed = chances if live is None else chances * live[:, None, :]
            np.add.at(pooled, [i for i, _, _ in lanes], weighed.sum(axis=0).T)
            if spans is not None:
                for (i, s, n), labels in zip(lanes, chances.argmax(axis=1).T):
                    best.setdefault(i, []).append((s, labels[:n]))
    if spans is not None:
        for i in range(len(texts)):
            labels = np.concatenate([b for _, b in sorted(best[i], key=lambda x: x[0])]) if i in best else np.zeros(0, int)
            cuts = np.flatnonzero(np.diff(labels, prepend=-1))
            spans.append([(int(s), int(e - s), m.names[labels[s]]) for s, e in zip(cuts, [*cuts[1:], len(labels)])])
    return pooled / np.maximum([len(t) for t in texts], 1)[:, None]


def identify(docs: DataFrame, m: Model, p: Recurrent = Recurrent(), text: str = "text", with_spans: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and, if asked for, ``spans`` (start and length in bytes, lang).

    NULL texts, texts without a letter, and all texts of an untrained model are ``und`` with score 0.
    Columns of these names are replaced, all others stay. No shuffle.
    """
    docs = docs.drop("lang_pred", "score", "spans", "_letter").withColumn("_letter", F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    added = {"lang_pred": F.lit(""), "score": F.lit(0.0)}
    if with_spans:
        added["spans"] = F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit("").alias("lang")))
    schema = docs.drop("_letter").withColumns(added).schema

    def run(batch: pa.RecordBatch) -> dict:
        letter = batch.column("_letter").to_pylist()
        texts = [t if has and m.names else b"" for t, has in zip(byte_texts(batch.column(text)), letter)]
        spans: list | None = [] if with_spans else None
        chances = document_probabilities(texts, m, p, spans)
        known = [bool(t) for t in texts]
        top = chances.argmax(axis=1) if m.names else np.zeros(len(texts), int)
        out = {n: c for n, c in zip(batch.schema.names, batch.columns) if n != "_letter"}
        out["lang_pred"] = pa.array([m.names[i] if ok else "und" for i, ok in zip(top, known)], pa.string())
        out["score"] = pa.array([float(min(1.0, c[i])) if ok else 0.0 for c, i, ok in zip(chances, top, known)], pa.float64())
        if with_spans:
            kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("lang", pa.string())]))
            out["spans"] = pa.array([[dict(zip(("start", "length", "lang"), s)) for s in x] for x in spans], kind)
        return out

    return map_arrow(docs, run, schema)
