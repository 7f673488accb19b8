import re
from collections import Counter, defaultdict

import pytest

from silvagrid.llm import divergence as d

WORD = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=3, ranks=200):
    """The definition, with a look at every term of every pair of sources."""
    langs = defaultdict(lambda: defaultdict(Counter))
    seen = defaultdict(Counter)
    for lang, source, text in rows:
        words = WORD.findall((text or "").translate(FOLD))
        langs[lang or ""][source or ""].update(words)
        seen[lang or ""].update(set(words))
    out = set()
    for lang, sources in langs.items():
        kept = [t for t, n in seen[lang].items() if n >= least]
        whole = sum(sources.values(), Counter())

        def shares(counts):
            total = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // total for t in kept}

        p, q = {s: shares(c) for s, c in sources.items()}, shares(whole)
        for s in sources:
            found = {
                "pair": [(sum((p[s][t] - p[x][t]) ** 2 // p[x][t] for t in kept), x) for x in sources if x != s],
                "term": [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if sources[s][t] and p[s][t] > q[t]],
            }
            for part, values in found.items():
                ranked = sorted(values, key=lambda v: (-v[0], v[1].encode()))
                out |= {(lang, s, part, item, v, i) for i, (v, item) in enumerate(ranked[: ranks if part == "term" else None], 1)}
    return out


def rows_of(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_odd_rows(spark, odd, none):
    want = brute([(r["lang"], r["source"], r["text"]) for r in odd.collect()], least=2)
    assert rows_of(d.audit_sources(odd, d.Divergence(least_docs=2))) == want and want
    want = brute([(r["lang"], r["source"], r["text"]) for r in odd.collect()])
    assert rows_of(d.audit_sources(odd)) == want
    assert any(value == 0 and part == "pair" for _, _, part, _, value, _ in want)  # languages without kept terms
    assert rows_of(d.audit_sources(none)) == set()


@pytest.fixture(scope="module")
def skewed(spark):
    """One source with most rows, one without terms, ties, shared and single counts, text in upper case."""
    words = [f"t{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(90)]
    rows = []
    for i in range(240):
        source = "hot" if i % 3 else f"s{i % 7}"
        rows.append(("en", source, " ".join(w.upper() if k % 2 else w for k, w in enumerate(words) if (i * 7 + k * k) % (5 + k % 11) == 0)))
    rows += [("en", "mute", "12 34"), ("fr", "alone", "un deux"), ("fr", "alone", "un deux"), ("fr", "alone", "un")]
    return spark.createDataFrame(rows * 2, "lang string, source string, text string"), rows * 2


@pytest.mark.parametrize("p", [d.Divergence(), d.Divergence(held=3, nodes=5), d.Divergence(ranks=7)])
def test_equals_brute_force(skewed, p):
    df, rows = skewed
    assert rows_of(d.audit_sources(df, p)) == brute(rows, ranks=p.ranks)


def test_shared_paths_are_nodes_once():
    tree = d.PatternTree()
    tree.insert([(0, 50, 5), (1, 70, 6), (2, 90, 7)], 3)
    tree.insert([(0, 50, 5), (1, 70, 6)], 2)
    tree.insert([(0, 50, 5), (2, 90, 7)], 1)
    assert len(tree.parent) == 5 and tree.rows == [0, 6, 5, 3, 1]

    def f(p, q):
        return (p - q) ** 2 // q

    a, b, ab, ba = (x.tolist() for x in tree.corrections())
    got = {(x, y): (u, v) for x, y, u, v in zip(a, b, ab, ba)}
    want = 5 * (f(50, 70) - f(50, 6) - f(5, 70) + f(5, 6)), 5 * (f(70, 50) - f(6, 50) - f(70, 5) + f(6, 5))
    assert got[0, 1] == want and set(got) == {(0, 1), (0, 2), (1, 2)}
    assert got[0, 2][0] == 4 * (f(50, 90) - f(50, 7) - f(5, 90) + f(5, 7))


def test_shares_stay_exact_beyond_longs(spark):
    big = 9_000_000_000_000_000
    df = spark.createDataFrame([(big, 2 * big, 7), (0, 0, 0)], "n long, total long, kept long")
    rows = df.select(d.share("n", "total", "kept", d.Divergence()).alias("p")).collect()
    assert [r["p"] for r in rows] == [1 + 10**9 * (big + 1) // (2 * big + 7), None]
