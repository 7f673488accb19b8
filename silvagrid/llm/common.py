"""Helpers shared by the operators: Arrow batches, vectorised words, gapless ranks, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silvagrid.plans.staging import stage

#: Bytes hashed at once; keeps the work arrays in cache.
PACK_BYTES = 1 << 18
#: Bytes of text whose word arrays are held at once.
SLICE_BYTES = 4 << 20
#: Rows that one bucket of a distributed ranking aims at.
RANK_ROWS = 50_000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id written as text; NULL ids count as 0."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id, "utf-8")), F.lit(0))


# ---------------------------------------------------------------- hashing


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on an array of uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` pseudo-random uint64 values by splitmix64, the same on every machine."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * GOLDEN + np.uint64(seed) * np.uint64(0xD1342543DE82EF95))


@lru_cache(maxsize=4)
def _byte_values(lower: bool) -> np.ndarray:
    values = stream(7, 256)
    if lower:
        values[65:91] = values[97:123]
    return values


_MULT = np.uint64(0x5851F42D4C957F2D)
_INV = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    while len(_powers[0]) < n:
        for k, base in enumerate((_MULT, _INV)):
            p = _powers[k]
            _powers[k] = np.concatenate([p, p * (p[-1:] * base)])
    return _powers[0], _powers[1]


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _pieces(data: bytes) -> Iterator[bytes]:
    """Cuts a long text at white space, so that work arrays stay small."""
    at = 0
    while len(data) - at > 4 * PACK_BYTES:
        end = at + PACK_BYTES
        block = data[at:end]
        cut = max(block.rfind(b" "), block.rfind(b"\n"), block.rfind(b"\t"))
        if cut <= 0:
            nxt = [p for p in (data.find(b" ", end), data.find(b"\n", end), data.find(b"\t", end)) if p >= 0]
            cut = (min(nxt) if nxt else len(data)) - at
        yield data[at : at + cut]
        at += cut
    yield data[at:]


WordFn = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    solid = np.zeros(len(raw) + 2, np.int8)
    solid[1:-1] = ~_SPACE[raw]
    step = np.diff(solid)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the spans of a byte array; equal spans anywhere have equal hashes."""
    up, down = _power_tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_byte_values(lower)[raw] * up[: len(raw)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    return mix(hashes ^ ((ends - starts).astype(np.uint64) * GOLDEN))


def word_arrays(texts: list[bytes], fn: WordFn) -> tuple[np.ndarray, np.ndarray]:
    """``fn(bytes, starts, ends)`` over all words ``[^\\x20\\x09-\\x0D]+``, and each text's offset.

    Works on buffers of several texts, not word by word. ``fn`` gives a row per word and must not
    look beyond a word, as very long texts are cut at white space.
    """
    found, counts, i = [], np.zeros(len(texts) + 1, np.int64), 0
    while i < len(texts):
        if len(texts[i]) > 4 * PACK_BYTES:
            for piece in _pieces(texts[i]):
                raw = np.frombuffer(piece, np.uint8)
                starts, ends = _word_spans(raw)
                found.append(fn(raw, starts, ends))
                counts[i + 1] += len(starts)
            i += 1
            continue
        j, size = i, 0
        while j < len(texts) and size + len(texts[j]) <= 4 * PACK_BYTES and (j == i or size < PACK_BYTES):
            size += len(texts[j]) + 1
            j += 1
        raw = np.frombuffer(b" ".join(texts[i:j]), np.uint8)
        starts, ends = _word_spans(raw)
        found.append(fn(raw, starts, ends))
        limits = np.cumsum([len(t) + 1 for t in texts[i:j]])
        counts[i + 1 : j + 1] = np.diff(np.searchsorted(starts, limits), prepend=0)
        i = j
    none = np.zeros(0, np.uint8)
    return (np.concatenate(found) if found else fn(none, none.astype(np.int64), none.astype(np.int64))), np.cumsum(counts)


def hash_words(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words and the offsets of each text's words; ``lower`` folds A-Z only."""
    return word_arrays(texts, lambda raw, starts, ends: span_hashes(raw, starts, ends, lower))


# ---------------------------------------------------------------- words as bytes


def folding(digits: bool, lines: bool = False) -> bytes:
    """Byte table: A-Z become a-z, letters and all bytes from 0x80 on stay, digits and line ends if
    asked for, the rest becomes spaces. Words are then what stands between spaces."""
    out = bytearray(b" " * 128) + bytes(range(128, 256))
    for b in (*range(97, 123), *(range(48, 58) if digits else ()), *((10,) if lines else ())):
        out[b] = b
    for b in range(65, 91):
        out[b] = b + 32
    return bytes(out)


def word_lists(text: bytes, table: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of some ``size`` bytes, so that a long text is never a list as a whole."""
    data, at = text.translate(table), 0
    while at < len(data):
        end = data.find(b" ", at + size)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


# ---------------------------------------------------------------- Arrow


def byte_texts(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes, NULL as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def binary_array(blobs: list[bytes]) -> pa.Array:
    return pa.array(blobs, pa.binary())


def slices(texts: list[bytes]) -> Iterator[list[bytes]]:
    """A batch's texts in order, in parts of about ``SLICE_BYTES``; a longer text is a part by itself."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= SLICE_BYTES:
            yield texts[at : i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield texts[at:]


def byte_slices(column: pa.Array, kind: type) -> list[np.ndarray]:
    """The values of a binary column without NULLs as arrays of ``kind``, not copied."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return [raw[s:e].view(kind) for s, e in zip(at[:-1], at[1:])]


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``mapInArrow`` with a function from batch to a dictionary of columns; empty batches are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(fn(batch))

    return df.mapInArrow(run, schema)


# ---------------------------------------------------------------- bit maps


def bitmap(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bit map of ``2 ** bits`` places, as uint64 words, marked by the top bits of ``column`` (long).

    Its size does not depend on the rows. It only spares rows a shuffle: what it lets through by
    chance, however much that is, has to fall out in a join.
    """
    place = F.shiftrightunsigned(column, 64 - bits)
    words = hashes.select(F.shiftright(place, 6).alias("w"), F.expr("1L").alias("one"), place.bitwiseAND(63).cast("int").alias("b"))
    words = words.groupBy("w").agg(F.bit_or(F.expr("shiftleft(one, b)")).alias("v")).toArrow()
    out = np.zeros(1 << bits - 6, np.int64)
    out[words.column("w").to_numpy()] = words.column("v").to_numpy()
    return out.view(np.uint64)


def marked(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (uint64) are marked in a bit map."""
    bits = len(words).bit_length() + 5
    place = hashes >> np.uint64(64 - bits)
    return (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


# ---------------------------------------------------------------- ranks


def rank_buckets(rows: int) -> int:
    return max(64, -(-rows // RANK_ROWS))


def gapless_rank(df: DataFrame, keys: list[str], spread: list[str], order: list[str], out: str, rows: int) -> DataFrame:
    """Adds ``out``: 0, 1, 2, ... within ``keys``, without gaps, in hash order of ``spread``, then ``order``.

    Rows are counted per key and hash bucket, the counts are summed up, and each
    bucket is numbered by itself; a hot key is thus spread over all buckets. ``rows``
    is the number of rows of ``df``, from which the number of buckets follows.
    """
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(rank_buckets(rows))).cast("int")
    df = df.withColumn("_bucket", bucket)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*keys, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    ranked = df.withColumn("_inside", F.row_number().over(inside) - 1)
    for k in keys:
        offsets = offsets.withColumnRenamed(k, f"_k_{k}")
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_bucket") == F.col("_b")]
    joined = ranked.join(offsets.withColumnRenamed("_bucket", "_b"), on=_all(same), how="inner")
    return joined.withColumn(out, (F.col("_inside") + F.col("_before")).cast("long")).drop(
        "_bucket", "_b", "_inside", "_before", *[f"_k_{k}" for k in keys]
    )


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


# ---------------------------------------------------------------- components


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over undirected edges (a, b) of longs.

    Alternates two contractions until only stars are left: every neighbour larger than a node is
    linked to the smallest neighbour, then every smaller one. The number of rounds grows with the
    logarithm of the longest path. Each round is staged; the minimum per node is a combining
    aggregate and is joined back, so a node with very many edges is never gathered.
    """
    now = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    while not _stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select("u", F.col("m").alias("v")).union(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        now = stage(small.distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller node that has none itself."""
    if edges.isEmpty():
        return True
    low = edges.select("u", F.lit(1).alias("up")).union(edges.select(F.col("v").alias("u"), F.lit(0).alias("up")).distinct())
    per = low.groupBy("u").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("n"))
    return per.where("up > 1 or (up = 1 and n > 1)").isEmpty()
