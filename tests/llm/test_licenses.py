import re

import numpy as np
import pytest

from silvagrid.llm import licenses as li
from silvagrid.llm.queries import QUERIES
from tests.conftest import SF_DIR

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
MIT, BSD = li.NOTICES[6], li.NOTICES[7]


def words_of(text):
    return WORD.findall((text or "").translate(FOLD))


def brute_base(text):
    w, places = words_of(text), []
    for t in li.BASE:
        own = words_of(t.text)
        places += [(i, t.label) for i in range(len(w)) if w[i : i + len(own)] == own]
    at = [i for i, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def brute_labels(text, rarity, p=li.Scan()):
    """Every place of a text against every template, word by word."""
    w, labels, best = words_of(text), set(), 0.0
    for t in li.BASE + li.NOTICES:
        own = words_of(t.text)
        if not t.phrases:
            if any(w[i : i + len(own)] == own for i in range(len(w))):
                labels.add(t.label)
                best = 1.0
            continue
        rare = sorted(set(own), key=lambda x: (-rarity[x.encode()], x.encode()))[: p.rare]
        for s in range(-len(own), len(w)):
            starts = {x: {i - j for i, y in enumerate(w) if y == x for j, z in enumerate(own) if z == x} for x in rare}
            if not any(s in starts[x] for x in rare[: len(rare) - p.agree + 1]):
                continue
            if sum(any(abs(o - s) <= p.slack for o in starts[x]) for x in rare) < p.agree:
                continue
            ok = True
            for text_ in t.phrases:
                ph = words_of(text_)
                at = next(i for i in range(len(own)) if own[i : i + len(ph)] == ph)
                ok &= any(w[i : i + len(ph)] == ph and abs(i - s - at) <= p.slack for i in range(len(w)))
            if ok:
                window = w[max(0, s - p.slack) : max(0, s + len(own) + p.slack)]
                got = sum(min(window.count(x), own.count(x)) for x in set(own)) / len(own)
                if got >= t.share:
                    labels.add(t.label)
                    best = max(best, got)
    return ",".join(sorted(labels)), best


def scanned(df):
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert df.columns == ["doc_id", *names]
    return [(r["doc_id"], tuple(r[n] for n in names)) for r in df.collect()]


def texts():
    filler = "and so the words went on " * 3
    out = [
        None, "", "MIT license", "The MIT-Licence", "mit\nLICENSE mit License license", "the Apache License, Version 2.0. MIT License",
        "GNU General Public\nLicense; general public license", "a GNU Lesser General Public License text", "mit ä license", "MITä license",
        "Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0", "license " * 50, "mit license " * 30,
    ]
    for t in (MIT, BSD, *li.NOTICES[8:]):
        w = t.text.split()
        gone = [x for i, x in enumerate(w) if i % 6 != 1]
        more = [y for x in w for y in ([x, "quux"] if x.startswith("cop") else [x])]
        out += [t.text, filler + t.text.upper() + filler, " ".join(w[: len(w) // 2]), " ".join(gone), " ".join(more), " ".join(sorted(w)), t.text + " " + filler + t.text]
    return out


def test_equals_brute_force(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    rarity = li.license_rarity(df, li.BASE + li.NOTICES)
    want = []
    for k, t in rows:
        labels, best = brute_labels(t, rarity)
        want.append((k, (*brute_base(t), labels, best)))
    got = scanned(li.scan_licenses(df))
    assert sorted(got) == want
    by_text = dict(zip(texts(), (x for _, x in want)))
    assert by_text[MIT.text][5] == "mit" and by_text[MIT.text][6] == 1.0 and by_text[MIT.text][1] == 0
    assert by_text[BSD.text][5] == "bsd" and "cc-by-nc" in by_text["Licensed under CC BY-NC 4.0."][5]
    assert 0 < sum(x[6] not in (0.0, 1.0) for x in by_text.values())


def test_rarity_is_counted_over_all_texts(spark):
    df = spark.createDataFrame([("mit mit license",), ("License",), (None,), ("ä",)], "text string")
    got = li.license_rarity(df, li.BASE)
    assert got[b"license"] == np.log(5 / 3) and got[b"mit"] == np.log(5 / 2) and got[b"apache"] == np.log(5)


def test_query_has_all_base_places(spark, documents):
    want = {r["doc_id"]: brute_base(r["text"]) for r in documents.collect()}
    got = dict(scanned(QUERIES["op11_positional_license_index"](spark, SF_DIR)))
    assert {k: v[:5] for k, v in got.items()} == want and any(v[1] for v in got.values())
    assert all(0 <= v[6] <= 1 and set(v[4].split(",")) - {""} <= set(v[5].split(",")) for v in got.values())


def test_very_long_text_with_many_places():
    index = li.LicenseIndex(li.BASE + li.NOTICES, {w: 1.0 for w in li.vocabulary(li.BASE + li.NOTICES)}, li.Scan())
    n, found = index.scan(b"x y mit license z " * 200_000 + MIT.text.encode())
    assert n == 1_000_000 + len(words_of(MIT.text))
    assert [(t.label, len(p)) for t, p, _ in found if t.base] == [("mit", 200_000)] and len(found) == 2


@pytest.mark.parametrize("which", ["odd", "none"])
def test_odd_rows(request, which):
    df = request.getfixturevalue(which)
    want = sorted(((r["doc_id"], brute_base(r["text"])) for r in df.collect()), key=str)
    assert sorted(((k, v[:5]) for k, v in scanned(li.scan_licenses(df))), key=str) == want
