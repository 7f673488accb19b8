import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from silvagrid.llm import resample as r

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(FOLD))


def features(text, longest):
    w = words_of(text)
    return [" ".join(w[i : i + n]).encode() for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, p):
    """The definition over whole texts, without lines."""
    found = [(k, words_of(t), [crc32(x) % p.buckets for x in features(t, p.longest)]) for k, t in docs]
    s = Counter(b for *_, x in found for b in x)
    t = Counter(crc32(x) % p.buckets for text in target for x in features(text, p.longest))
    all_s, all_t = sum(s.values()) + p.buckets, sum(t.values()) + p.buckets
    gain = {b: math.floor(p.unit * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in s}
    rows = []
    for k, words, x in found:
        weight = sum(gain[b] for b in x) // len(x) if x else 0
        h = int(hashlib.sha256(f"{p.seed}:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-p.unit * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((k, len(x), weight, score, len(words)))
    enough = sorted((x for x in rows if x[4] >= p.least_words), key=lambda x: (-x[3], x[0] is not None, x[0]))
    drawn = enough[: len(enough) * p.percent // 100]
    out = [(*x[:4], i) for i, x in enumerate(drawn, 1)]
    for x in drawn:
        rows.remove(x)
    return sorted([*out, *((*x[:4], None) for x in rows)], key=str)


def rows_of(df):
    assert [(c, t) for c, t in df.dtypes if c != "doc_id"] == [(c, "bigint") for c in ("n_features", "weight", "score", "rank")]
    return sorted((tuple(x) for x in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize("p", [
    r.Resampling(), r.Resampling(longest=3, buckets=101, percent=60, held=100), r.Resampling(longest=2, least_words=2, percent=50, seed=7),
])
def test_equals_brute_force(spark, p):
    block = "The same line\nas in Every text, 3 words\n\n  \nof\nall"
    texts = [None, "", "?!", "one", "ä b", block, block + "\nmore", "x\n" + block] + [f"{block}\n{' '.join(f'W{i * k % 11}' for k in range(i))}\nend {i}" for i in range(60)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(12, texts[12]), (None, texts[20])]
    target = [texts[30], "w1 w2 w3 w1 same line as", None, ""]
    df = spark.createDataFrame([(k, t, "x", 0.5) for k, t in docs], "doc_id long, text string, n_words string, score double")
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, weight int")
    got = rows_of(r.resample(df, goal, p))
    assert got == brute(docs, target, p) and any(x[4] for x in got)


def test_runs_within_and_over_lines():
    p = r.Resampling(longest=4, buckets=1 << 30)
    f = r.Features(p)
    for text in ("a b\nc\n\nd e f g h\ni", "a", "\n\n", "a b c d e f\ng", "a\nb\nc\nd\ne"):
        lines = text.encode().split(b"\n")
        got = [b for line in lines for part in f.inside(line) for b in part] + [b for part in f.across(lines) for b in part]
        assert Counter(got) == Counter(crc32(x) % p.buckets for x in features(text, 4))


def test_a_long_line_is_cut_between_words():
    p = r.Resampling(longest=3)
    line = b" ".join(b"w%d" % (i % 977) for i in range(400_000))
    parts = list(r.Features(p).inside(line))
    assert len(parts) > 1
    assert Counter(b for x in parts for b in x) == Counter(crc32(x) % p.buckets for x in features(line.decode(), 3))


def test_lines_are_counted_once(spark):
    df = spark.createDataFrame([("A b\nc",), ("a B\nc c",), (None,)], "text string")
    got = {bytes(x["line"]): x["times"] for x in r.distinct_lines(df, r.Resampling(), "text").collect()}
    assert got == {b"a b": 2, b"c": 1, b"c c": 1}
    assert r.bucket_counts(df).sum() == 7


def test_odd_rows(spark, odd, none):
    for docs, goal in ((odd, odd), (odd, none), (none, odd), (none, none)):
        want = brute([(x["doc_id"], x["text"]) for x in docs.collect()], [x["text"] for x in goal.collect()], r.Resampling(percent=50))
        assert rows_of(r.resample(docs, goal, r.Resampling(percent=50))) == want


def test_gains_of_empty_sides():
    p = r.Resampling(buckets=4)
    assert r.bucket_gains(np.zeros(4, np.int64), np.zeros(4, np.int64), p).tolist() == [0, 0, 0, 0]
