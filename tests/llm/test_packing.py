import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from silvagrid.llm import packing
from silvagrid.llm.queries import QUERIES, byte_bpe
from tests.conftest import SF_DIR


@pytest.mark.parametrize("n,want", [(0, []), (1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (16, [(0, 8), (8, 8)])])
def test_cut(n, want):
    assert packing.cut(n, 8) == want


def test_plan_fills_every_slot_once():
    rnd = random.Random(1)
    for _ in range(200):
        c = rnd.choice([10, 30, 64, 2048])
        counts = {rnd.randrange(1, c + 1): rnd.randrange(1, 50) for _ in range(rnd.randrange(60))}
        ranks, bins = {}, {}
        for length, rank, n, per, first, offset in packing.packing_plan(counts, c).tolist():
            for k in range(n):
                ranks.setdefault(length, []).append(rank + k)
                bins.setdefault(first + k // per, []).append((offset + k % per * length, length))
        assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
        for b in bins.values():
            at = 0
            for start, length in sorted(b):
                assert start == at
                at += length
            assert at <= c and sum(3 * n > c for _, n in b) <= 2
        total = sum(k * n for k, n in counts.items())
        large = max(sum(n for k, n in counts.items() if 2 * k > c), -(-sum(n for k, n in counts.items() if 3 * k > c) // 2))
        assert c < 64 or len(bins) <= max(1.25 * max(-(-total // c), large) + 2, 1 if bins else 0)


def test_query(spark, documents):
    slow = Tokenizer.from_file(byte_bpe())
    ids = {r["doc_id"]: [*slow.encode(r["text"], add_special_tokens=False).ids, 0] for r in documents.collect()}
    pieces, bins = {}, {}
    for r in QUERIES["op6_best_fit_packing"](spark, SF_DIR).collect():
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for k, own in ids.items():
        assert sorted(pieces[k]) == [(i, *x) for i, x in enumerate(packing.cut(len(own)))]
    for b in bins.values():
        assert [o for o, _ in sorted(b)] == np.cumsum([0, *[n for _, n in sorted(b)]])[:-1].tolist() and sum(n for _, n in b) <= 2048
    assert len(bins) <= 1.1 * sum(map(len, ids.values())) / 2048 + 1


def test_special_strings_by_the_tokenizer():
    text = "a <|endoftext|> b"
    assert packing.token_ids(text, byte_bpe()).tolist()[:-1] == Tokenizer.from_file(byte_bpe()).encode(text, add_special_tokens=False).ids


def test_odd_rows(odd, none):
    small = odd.where("doc_id is null or doc_id <> 6")
    got = packing.pack_documents(small, byte_bpe(), 64).collect()
    assert sum(r["piece"] == 0 for r in got) == small.count()
    assert [r["length"] for r in got if r["doc_id"] in (3, 4)] == [1, 1]
    assert packing.pack_documents(none, byte_bpe()).count() == 0
