import hashlib
import math
import zlib

import numpy as np
import pytest

from silvagrid.llm import media
from silvagrid.llm.queries import QUERIES
from tests.conftest import SF_DIR


def paeth_encoded(rows, kinds, step=3):
    """The five row filters, byte by byte."""
    out = np.zeros_like(rows)
    for i, k in enumerate(kinds):
        for x in range(rows.shape[1]):
            a = int(rows[i, x - step]) if x >= step else 0
            b = int(rows[i - 1, x]) if i else 0
            c = int(rows[i - 1, x - step]) if i and x >= step else 0
            p = a + b - c
            near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            out[i, x] = (int(rows[i, x]) - [0, a, b, (a + b) // 2, near][k]) & 255
    return out


def test_all_filters_are_undone():
    rng = np.random.default_rng(0)
    rows, kinds = rng.integers(0, 256, (30, 192)).astype(np.uint8), rng.integers(0, 5, 30)
    assert (media._unfilter(kinds, paeth_encoded(rows, kinds), 3) == rows).all()


@pytest.mark.parametrize("payload", [b"", b"a", b"x" * 192, bytes(range(256)) * 40])
def test_round_trip(payload):
    padded = media.pad(payload)
    assert len(padded) % 192 == 0 and padded and padded.rstrip(b" ") == payload.rstrip(b" ")
    assert media.decode_png(media.encode_png(padded)).tobytes() == padded


@pytest.mark.parametrize("at", [3, 20, 45, -6])
def test_damage_is_found(at):
    png = bytearray(media.encode_png(media.pad(b"some text " * 50)))
    png[at] ^= 1
    with pytest.raises(ValueError):
        media.decode_png(bytes(png))


def test_hash_follows_the_picture():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 256, (64, 192)).astype(np.uint8)
    b = np.clip(a.astype(int) + rng.integers(-2, 3, a.shape), 0, 255).astype(np.uint8)
    bits = [int.from_bytes(media.cosine_hash(x), "big") for x in (a, b, rng.integers(0, 256, a.shape).astype(np.uint8))]
    assert (bits[0] ^ bits[1]).bit_count() < 12 < (bits[0] ^ bits[2]).bit_count()


def test_odd_rows(odd, none):
    stored = media.encode_media(odd)
    assert stored.columns == [*odd.columns, "n_bytes", "media"] and stored.count() == odd.count()
    assert media.media_features(media.encode_media(none), ["doc_id"]).count() == 0
    got = media.media_features(stored, ["doc_id", "text"]).collect()
    for r in got:
        assert r["payload_sha256"] == hashlib.sha256(media.pad((r["text"] or "").encode())).hexdigest()


def test_query(spark, documents):
    got = {r["doc_id"]: r for r in QUERIES["op1_media_png"](spark, SF_DIR).collect()}
    for r in documents.collect():
        payload, out = media.pad(r["text"].encode()), got.pop(r["doc_id"])
        assert (out["n_bytes"], out["payload_bytes"]) == (len(r["text"].encode()), len(payload))
        assert out["tail_crc32"] == zlib.crc32(payload[-16:])
        assert out["media_sha256"] == hashlib.sha256(media.encode_png(payload)).hexdigest()
    assert not got


def hash_by_loops(rows):
    """Area means to a square, then the cosine sums of the lowest frequencies, one by one."""
    h, w, side, low = rows.shape[0], rows.shape[1] // media.CHANNELS, media.SIDE, media.LOW
    bright = [[sum(int(rows[y, media.CHANNELS * x + k]) for k in range(media.CHANNELS)) / media.CHANNELS for x in range(w)] for y in range(h)]

    def weights(n):
        out = []
        for i in range(side):
            lo, hi = i * n / side, (i + 1) * n / side
            share = [max(0.0, min(hi, j + 1) - max(lo, j)) for j in range(n)]
            out.append([(j, s / sum(share)) for j, s in enumerate(share) if s > 0])
        return out

    down, across = weights(h), weights(w)
    small = [[sum(a * b * bright[y][x] for y, a in down[i] for x, b in across[j]) for j in range(side)] for i in range(side)]
    waves = [[math.cos(math.pi * k * (2 * i + 1) / (2 * side)) for i in range(side)] for k in range(low)]
    found = [sum(small[i][j] * waves[u][i] * waves[v][j] for i in range(side) for j in range(side)) for u in range(low) for v in range(low)]
    middle = sorted(found)
    return found, (middle[31] + middle[32]) / 2


def test_hash_equals_cosine_sums_by_loops():
    rng = np.random.default_rng(1)
    for n in (1, 7, 45):
        rows = rng.integers(0, 256, (n, media.ROW_BYTES)).astype(np.uint8)
        found, cut = hash_by_loops(rows)
        bits = np.unpackbits(np.frombuffer(media.cosine_hash(rows), np.uint8))
        assert len(bits) == 64
        for i in range(64):  # what lies on the median but for rounding is not compared
            if abs(found[i] - cut) > 1e-6 * max(map(abs, found)):
                assert bits[i] == (found[i] > cut)
