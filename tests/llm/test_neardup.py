import random

import numpy as np
import pytest

from silvagrid.llm import neardup
from silvagrid.llm.common import components, hash_words
from tests.conftest import SF_DIR
from tests.llm.conftest import texts_of


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])


def exact(texts):
    """Sizes and components by comparing all pairs."""
    sets, lead = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def root(i):
        while lead[i] != i:
            i = lead[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * min(len(a), len(b)) >= 85 * max(len(a), len(b)) and 100 * len(a & b) >= 85 * len(a | b):
                x, y = sorted((root(i), root(j)))
                lead[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_words_hash_alike_wherever_they_stand():
    rnd = random.Random(1)
    texts = [bytes(rnd.choice(b"ab \n\tXYZ,.\x0b\x0c\r") for _ in range(rnd.randrange(60))) for _ in range(800)]
    texts += [b"", b"word" * 400_000 + b" " + b"x " * 900_000]
    hashes, at = hash_words(texts)
    seen = {}
    for t, s, e in zip(texts, at[:-1], at[1:]):
        words = t.lower().split()
        assert len(words) == e - s
        for w, h in zip(words, hashes[s:e].tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_query_equals_all_pairs(spark, documents):
    assert found(neardup.near_duplicates(documents)) == exact(texts_of(documents))


def test_large_group_of_near_copies(spark):
    """Divided regions, chains and rows that only few of the group are near to."""
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(900)}" for _ in range(150)]
    texts = {}
    for i in range(150):
        words = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 2, 3, 4])):
            words[rnd.randrange(150)] = f"n{rnd.randrange(9999)}"
        texts[i] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert found(neardup.near_duplicates(df, neardup.Forest(region=4, spread=2))) == exact(texts)


def test_star_of_rows_just_similar_enough(spark):
    """Each row is near to one base only; those that leave its regions early are found too."""
    rnd = random.Random(7)
    base = [f"w{i}" for i in range(135)]
    texts = {0: " ".join(base)}
    for i in range(1, 1501):
        words = list(base)
        for at in (rnd.randrange(5, 60), rnd.randrange(70, 125)):
            words[at] = f"n{rnd.randrange(10**9)}"
        texts[i] = " ".join(words)
    sets = {i: shingles(t) for i, t in texts.items()}
    assert all(0.85 <= len(s & sets[0]) / len(s | sets[0]) < 0.87 for i, s in sets.items() if i)
    assert len(sets[1] & sets[2]) < 0.85 * len(sets[1] | sets[2])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {i for i, (_, c, _) in found(neardup.near_duplicates(df)).items() if c != 0} == set()


def test_one_id_with_several_texts(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (3, b + " more"), (5, a), (5, c), (4, c + " end"), (7, "other words " * 9), (7, "")]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(1, 1), (3, 1), (5, 1), (4, 1), (7, 7)}


def test_no_pairs_leave_a_part(spark):
    """A part of k rows of one group gives at most k - 1 links, whatever its pairs."""
    import pyarrow as pa

    sets = [np.arange(i, i + 400, dtype=np.uint64) for i in range(40)]
    values, offsets = np.concatenate(sets), np.arange(41) * 400
    sig = neardup.signatures(values, offsets, 72).astype(np.uint8)
    rows = {"label": list(range(40)), "outer": [True] * 40, "sig": [x.tobytes() for x in sig], "members": [x.tobytes() for x in sets]}
    schema = pa.schema([("label", pa.int64()), ("outer", pa.bool_()), ("sig", pa.binary()), ("members", pa.binary())])
    got = neardup._confirmed_links(pa.table(rows, schema), neardup.Forest(), 72, 0.66)
    assert got.num_rows == 39


def test_odd_rows(odd, none):
    got = neardup.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert [r["component_id"] for i in (1, 2, 10) for r in by[i]] == [1, 1, 1, 1]
    for i in (3, 4, 5):
        assert (by[i][0]["n_shingles"], by[i][0]["component_id"], by[i][0]["kept"]) == (0, i, True)
    assert all(r["component_id"] is None and r["kept"] for r in by[None])
    assert neardup.near_duplicates(none).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(110)] + [(i, i + 1) for i in range(300, 340)] + [(500, i) for i in range(501, 540)]
    lead = {}

    def root(i):
        while lead.setdefault(i, i) != i:
            i = lead[i]
        return i

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        lead[y] = x
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(i, i) == root(i) for i in lead)


def test_signatures_agree_as_often_as_sets(spark):
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 1000).astype(np.uint64)
    both = np.concatenate([np.sort(a[:900]), np.sort(a[100:])])
    sig = neardup.signatures(both, np.array([0, 900, 1800]), 2000)
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.04


def test_query_is_registered():
    from silvagrid.llm.queries import QUERIES

    assert "op5_lsh_forest" in QUERIES and SF_DIR
