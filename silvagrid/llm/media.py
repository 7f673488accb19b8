"""Texts as pictures: lossless PNG in a binary column, read back, with a cosine-transform hash."""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvagrid.llm.common import byte_texts, map_arrow

#: A row of the picture: 64 pixels of red, green and blue.
ROW_BYTES, CHANNELS = 192, 3
PAD = b" "
SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Side of the reduced picture and of the block of low frequencies kept.
SIDE, LOW = 32, 8


def pad(payload: bytes) -> bytes:
    """Byte 32 up to a positive multiple of a row."""
    return payload + PAD * ((-len(payload)) % ROW_BYTES if payload else ROW_BYTES)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def _filtered(rows: np.ndarray) -> bytes:
    """Each row with the filter (none, left, up) of the smallest sum of absolute differences."""
    left, up = rows.copy(), rows.copy()
    left[:, CHANNELS:] -= rows[:, :-CHANNELS]
    up[1:] -= rows[:-1]
    tried = np.stack([rows, left, up])
    cost = np.abs(tried.view(np.int8).astype(np.int16)).sum(axis=2)
    kind = cost.argmin(axis=0)
    out = np.empty((len(rows), rows.shape[1] + 1), np.uint8)
    out[:, 0] = kind
    out[:, 1:] = tried[kind, np.arange(len(rows))]
    return out.tobytes()


def encode_png(payload: bytes, level: int = 4) -> bytes:
    """A true-colour PNG, 64 pixels wide, holding ``payload`` (a positive multiple of 192 bytes).

    Rows are stored unfiltered or filtered, whichever deflates to less.
    """
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW_BYTES)
    plain = np.insert(rows, 0, 0, axis=1).tobytes()
    body = min(zlib.compress(plain, level), zlib.compress(_filtered(rows), level), key=len)
    head = struct.pack(">IIBBBBB", ROW_BYTES // CHANNELS, len(rows), 8, 2, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", body) + _chunk(b"IEND", b"")


def _unfilter(kinds: np.ndarray, data: np.ndarray, step: int) -> np.ndarray:
    """Undoes the five row filters; left and up filters over whole runs of rows at once."""
    out = data.copy()
    zero = np.zeros(data.shape[1], np.uint8)
    starts = np.flatnonzero(np.diff(kinds, prepend=-1))
    for s, e in zip(starts, [*starts[1:], len(kinds)]):
        kind, block = kinds[s], out[s:e]
        above = out[s - 1] if s else zero
        if kind == 1:
            folded = block.reshape(len(block), -1, step)
            np.cumsum(folded, axis=1, dtype=np.uint8, out=folded)
        elif kind == 2:
            block[0] += above
            np.cumsum(block, axis=0, dtype=np.uint8, out=block)
        elif kind in (3, 4):
            for i in range(s, e):
                _unfilter_row(out[i], out[i - 1] if i else zero, kind, step)
        elif kind:
            raise ValueError(f"unknown filter {kind}")
    return out


def _unfilter_row(row: np.ndarray, above: np.ndarray, kind: int, step: int) -> None:
    left, corner = np.zeros(step, np.int16), np.zeros(step, np.int16)
    for at in range(0, len(row), step):
        up = above[at : at + step].astype(np.int16)
        if kind == 3:
            guess = (left + up) // 2
        else:
            base = left + up - corner
            dl, du, dc = abs(base - left), abs(base - up), abs(base - corner)
            guess = np.where((dl <= du) & (dl <= dc), left, np.where(du <= dc, up, corner))
        left = (row[at : at + step].astype(np.int16) + guess) & 255
        row[at : at + step] = left
        corner = up


def decode_png(media: bytes) -> np.ndarray:
    """Rows x bytes of an 8-bit PNG without interlace; every chunk's checksum is tested."""
    if media[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, body, head, ended = 8, [], None, False
    while at < len(media) and not ended:
        (size,) = struct.unpack_from(">I", media, at)
        kind, part = media[at + 4 : at + 8], media[at + 8 : at + 8 + size]
        (crc,) = struct.unpack_from(">I", media, at + 8 + size)
        if zlib.crc32(kind + part) != crc:
            raise ValueError(f"checksum of chunk {kind!r}")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body.append(part)
        ended = kind == b"IEND"
        at += 12 + size
    if head is None or not ended:
        raise ValueError("truncated PNG")
    width, height, depth, colour, _, _, interlace = head
    channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(colour)
    if depth != 8 or channels is None or interlace:
        raise ValueError("only 8-bit samples without palette and interlace")
    raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, -1)
    if raw.shape[1] != width * channels + 1:
        raise ValueError("wrong size of picture data")
    return _unfilter(raw[:, 0], raw[:, 1:], channels)


def _averaging(n: int, side: int) -> np.ndarray:
    """side x n weights that take area means (a row is repeated where n < side)."""
    edges = np.arange(side + 1) * (n / side)
    cells = np.arange(n)
    overlap = np.minimum(edges[1:, None], cells + 1) - np.maximum(edges[:-1, None], cells)
    overlap = np.clip(overlap, 0, None)
    return (overlap / overlap.sum(axis=1, keepdims=True)).astype(np.float64)


_K = np.arange(LOW)[:, None]
_COSINE = np.cos(np.pi * _K * (2 * np.arange(SIDE)[None, :] + 1) / (2 * SIDE))
_ACROSS = _averaging(ROW_BYTES // CHANNELS, SIDE)


def cosine_hash(rows: np.ndarray) -> bytes:
    """8 bytes: which of the 8 x 8 lowest frequencies of the brightness lie above their median."""
    grey = rows.reshape(len(rows), -1, CHANNELS).sum(axis=2, dtype=np.int32)
    across = _ACROSS if grey.shape[1] == _ACROSS.shape[1] else _averaging(grey.shape[1], SIDE)
    small = _averaging(len(grey), SIDE) @ grey @ across.T
    low = np.round(_COSINE @ small @ _COSINE.T, 6)
    return np.packbits(low.ravel() > np.median(low)).tobytes()


def encode_media(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_bytes`` and the PNG of the whole text as binary column ``media``.

    NULL and empty text give one row of spaces. Columns of the input named ``n_bytes`` or
    ``media`` are replaced; all others are kept. No shuffle.
    """
    df = df.drop("n_bytes", "media")
    schema = df.withColumns({"n_bytes": F.lit(0).cast("long"), "media": F.lit(b"")}).schema

    def encode(batch: pa.RecordBatch) -> dict:
        texts = byte_texts(batch.column(text))
        return dict(zip(batch.schema.names, batch.columns)) | {
            "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "media": pa.array([encode_png(pad(t)) for t in texts], pa.binary()),
        }

    return map_arrow(df, encode, schema)


FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, cosine binary"


def media_features(df: DataFrame, keep: list[str], media: str = "media") -> DataFrame:
    """Reads stored pictures back: columns ``keep``, digests of payload and picture, and the hash.

    A NULL picture gives NULL features; a damaged one raises, as its checksums do not hold.
    """
    names = [f.split()[0] for f in FEATURES.split(", ")]
    schema = ", ".join([f"`{n}` {t}" for n, t in df.select(*keep).dtypes] + [FEATURES])

    def one(media_bytes: bytes | None) -> tuple:
        if media_bytes is None:
            return (None,) * len(names)
        rows = decode_png(media_bytes)
        payload = rows.tobytes()
        return (
            len(payload),
            hashlib.sha256(payload).hexdigest(),
            zlib.crc32(payload[-16:]),
            len(media_bytes),
            hashlib.sha256(media_bytes).hexdigest(),
            cosine_hash(rows),
        )

    def read(batch: pa.RecordBatch) -> dict:
        found = list(zip(*[one(m) for m in batch.column(media).to_pylist()]))
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        out = {k: batch.column(k) for k in keep}
        return out | {n: pa.array(v, t) for n, v, t in zip(names, found, kinds)}

    return map_arrow(df.select(*keep, media), read, schema)
