"""Language, quality and the language model."""

import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest

from silvagrid.llm import language, lm, quality
from silvagrid.llm.queries import QUERIES
from tests.conftest import SF_DIR

LARGER = "/root/testdata/sf0.01"


def test_gradients_by_differences(monkeypatch):
    """One step of training moves the loss as the gradient says: the loss falls on a separable task."""
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.integers(97, 105, (60, 12)), rng.integers(105, 113, (60, 12))]).astype(np.uint8)
    y = np.repeat([0, 1], 60)
    m = language.train_model(x, y, ["a", "b"], language.Recurrent(units=4, window=12, steps=60, batch=40))
    chances = language.position_probabilities(np.ascontiguousarray(x.T), None, m)
    assert (chances.mean(axis=0).argmax(axis=0) == y).mean() > 0.95


def test_language_held_out(spark):
    df = spark.read.parquet(f"{LARGER}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op3_bidirectional_gru"](spark, LARGER).collect()}
    held = [(got[r["doc_id"]]["lang_pred"], r["lang"]) for r in df.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(got) == df.count() and len(held) == sum(r["held_out"] for r in got.values())
    assert sum(a == b for a, b in held) / len(held) > 0.97 and all(0 <= r["score"] <= 1 for r in got.values())


def test_language_odd_rows(spark, odd, none, documents):
    model = language.fit_language(documents, language.Recurrent(steps=40))
    out = language.identify(odd, model, with_spans=True)
    assert set(out.columns) == {*odd.columns, "lang_pred", "spans"} and out.count() == odd.count()
    for r in out.collect():
        if r["doc_id"] in (3, 4, 5, 8):
            assert (r["lang_pred"], r["score"], r["spans"]) == ("und", 0.0, [])
        elif r["text"]:
            assert sum(s["length"] for s in r["spans"]) == len(r["text"].encode())
    empty = language.fit_language(none)
    assert empty.names == [] and {r["lang_pred"] for r in language.identify(odd, empty).collect()} == {"und"}
    assert language.identify(none, model).count() == 0


def test_quality_held_out(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op9_random_indexing_quality"](spark, LARGER).collect()}
    held = [(got[k]["predicted"], q) for k, q in labels.items() if got[k]["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2) and r["predicted"] == int(r["score"] >= 0.7) for k, r in got.items())
    assert sum(a == b for a, b in held) / len(held) > 0.95


def test_quality_odd_rows(spark, odd, none, documents):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (6, 0), (None, 1), (9, None)], "doc_id long, quality int")
    model = quality.fit_quality(odd, labels)
    out = quality.score_quality(odd, model)
    assert out.count() == odd.count() and all(0 <= r["score"] <= 1 for r in out.collect())
    kept = quality.keep_good(odd, model, 0.0)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    blank = quality.fit_quality(none, labels.limit(0))
    assert quality.score_quality(none, blank).count() == 0
    assert {r["score"] for r in quality.score_quality(odd, blank).collect()} == {0.5}


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def brute_force(texts):
    """Interpolated modified Kneser-Ney on word pairs with dictionaries."""
    counts = Counter(w for x in texts for w in x)
    pairs = Counter(p for x in texts for p in zip([None, *x], x))

    def discounts(values):
        n = [sum(v == k for v in values) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        return [0, *(k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3))]

    after = Counter(b for _, b in pairs)
    high, low = discounts(pairs.values()), discounts(after.values())
    spread = sum(low[min(v, 3)] for v in after.values()) / len(pairs) / (len(counts) + 1)
    rest = Counter()
    for (a, _), v in pairs.items():
        rest[a] += high[min(v, 3)]

    def p(a, b):
        under = (after[b] - low[min(after[b], 3)] if b in after else 0) / len(pairs) + spread
        if a not in counts:
            return under
        v = pairs.get((a, b), 0)
        return (v - high[min(v, 3)]) / counts[a] + rest[a] / counts[a] * under

    return counts, p


@pytest.mark.parametrize("many", [None, 5])
def test_language_model_query(spark, documents, monkeypatch, many):
    if many:
        # many words heavy, so that their followers are spread
        monkeypatch.setattr(lm, "HEAVY", many)
        monkeypatch.setattr(lm, "SHARD_BYTES", 1 << 13)
    got = {r["doc_id"]: r for r in QUERIES["op8_kneser_ney"](spark, SF_DIR).collect()}
    texts = {r["doc_id"]: tokens(r["text"]) for r in documents.collect()}
    counts, p = brute_force([x for k, x in texts.items() if zlib.crc32(str(k).encode()) % 5 != 1])
    n, v = sum(counts.values()), len(counts)
    assert math.isclose(sum(p(b"the", w) for w in counts) + p(b"the", b"\0"), 1)
    for k, x in texts.items():
        r = got[k]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(x), sum(counts[w] > 0 for w in x), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x), rel_tol=1e-9)
        assert math.isclose(r["score"], sum(math.log10(p(a, b)) for a, b in zip([None, *x], x)), rel_tol=1e-9)


def test_language_model_odd_rows(spark, odd, none):
    model = lm.fit(odd)
    out = lm.score(odd, model)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == odd.count() and rows[3]["n_tokens"] == rows[4]["n_tokens"] == 1
    assert all(math.isfinite(r["score"]) for r in rows.values())
    empty = lm.fit(none)
    assert {r["score"] for r in lm.score(odd, empty).collect()} == {0.0}
    assert lm.score(none, model).count() == 0


def test_all_languages_are_learned(spark):
    rows = [(100 * k + i, f"text {k} of {i} " * 5, f"l{k:03d}") for k in range(70) for i in range(1 + 4 * (k < 60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learnt = {r["lang"] for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5}
    _, labels, names = language.training_windows(docs, "doc_id", "text", "lang", language.Recurrent())
    assert set(names) == learnt and len(names) > 64 and set(labels.tolist()) == set(range(len(names)))


def test_a_lost_file_of_the_model_raises(spark):
    docs = spark.createDataFrame([(i, f"a b c d {i} e f") for i in range(30)], "doc_id long, text string")
    model = lm.fit(docs)
    gone = [f for f in os.listdir(model.path) if f.startswith("pairs-")]
    assert gone
    for f in gone:
        os.remove(os.path.join(model.path, f))
    with pytest.raises(Exception, match="pairs-"):
        lm.score(docs, model).collect()
