"""Best-fit packing of token sequences: the plan is made on the histogram of lengths."""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvagrid.llm.common import byte_texts, gapless_rank, map_arrow
from silvagrid.plans.staging import stage

CAPACITY = 2048
END_ID = 0
SPECIAL = "<|endoftext|>"


@lru_cache(maxsize=1)
def _by_file(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def _by_ranks(path: str):
    """The same vocabulary as ranks, five times as fast; None where the library or its file is missing."""
    try:
        import public_tokenizers
        import tiktoken

        with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    except (ImportError, FileNotFoundError):
        return None
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_ids(text: str, path: str) -> np.ndarray:
    """Ids of a text and the end id. Ordinary text gets the same ids from the ranks as from the file (a test
    compares them); texts with the special token's string go to the file's tokenizer."""
    fast = _by_ranks(path) if SPECIAL not in text else None
    ids = fast.encode_ordinary(text) if fast else _by_file(path).encode(text, add_special_tokens=False).ids
    return np.array([*ids, END_ID], "<u4")


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: full ones at the end, the first may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))] if n else []


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: key, piece, start, length, ids (little-endian unsigned 32-bit), ids_crc32."""

    def run(batch: pa.RecordBatch) -> dict:
        keys, rows = [], []
        for k, t in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1))):
            ids = token_ids(t.decode("utf-8", "replace"), tokenizer)
            for i, (start, length) in enumerate(cut(len(ids), capacity)):
                blob = ids[start : start + length].tobytes()
                keys.append(k)
                rows.append((i, start, length, blob, zlib.crc32(blob)))
        cols = list(zip(*rows))
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        names = ["piece", "start", "length", "ids", "ids_crc32"]
        return {key: pa.array(keys, batch.column(0).type)} | {n: pa.array(c, t) for n, c, t in zip(names, cols, kinds)}

    kind = dict(docs.dtypes)[key]
    schema = f"`{key}` {kind}, piece int, start long, length long, ids binary, ids_crc32 long"
    return map_arrow(docs.select(key, text), run, schema)


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Slots of the packing of ``counts[length]`` items, as runs: one row for many equal sequences.

    Columns: length, first rank, items, items per sequence, first sequence, offset. The items of
    ``length`` ranked from ``first rank`` on fill sequences from ``first sequence`` on, so many
    to each, the first of them at ``offset``.

    Items above a third of the capacity are matched: the longest one left is given the longest
    other one that fits, so that no sequence holds more than two of them. Smaller items, longest
    first, go to the sequence with the smallest gap that takes them, else to a new one. Groups of
    equal sequences are handled at once: work and size depend on the capacity, not on the items.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    if any(n < 1 or n > capacity for n in left):
        raise ValueError("lengths must lie between 1 and the capacity")
    used = dict.fromkeys(left, 0)
    plan: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[list[int]]] = {}
    sequences = 0

    def place(length: int, per: int, groups: int, first: int, offset: int) -> None:
        plan.append((length, used[length], per * groups, per, first, offset))
        used[length] += per * groups
        left[length] -= per * groups

    def leave(gap: int, groups: int, first: int) -> None:
        if gap and groups:
            gaps.setdefault(gap, []).append([groups, first])

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for a in large:
        while left[a]:
            b = next((n for n in large if left[n] > (n == a) and n + a <= capacity), None)
            if b is None:
                m = left[a]
                place(a, 1, m, sequences, 0)
                leave(capacity - a, m, sequences)
            elif b == a:
                m = left[a] // 2
                place(a, 2, m, sequences, 0)
                leave(capacity - 2 * a, m, sequences)
            else:
                m = min(left[a], left[b])
                place(a, 1, m, sequences, 0)
                place(b, 1, m, sequences, a)
                leave(capacity - a - b, m, sequences)
            sequences += m
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            gap = min((g for g in gaps if g >= n), default=None)
            if gap is None:
                per = capacity // n
                m = max(1, left[n] // per)
                gaps[capacity] = [[m, sequences]]
                sequences += m
                continue
            groups, first = gaps[gap][-1]
            per = min(gap // n, left[n])
            m = min(groups, left[n] // per)
            place(n, per, m, first, capacity - gap)
            gaps[gap][-1] = [groups - m, first + m]
            if groups == m:
                gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
            leave(gap - per * n, m, first)
    return np.array(plan, np.int64).reshape(-1, 6)


def pack(pieces: DataFrame, key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (key, piece, length, ...).

    ``pieces`` should be staged, as it is read twice. Only the histogram of lengths, at most
    ``capacity`` numbers, reaches the driver; the plan made of it is bounded likewise. Pieces are
    ranked within their length by counts per hash bucket and find their place by search.
    """
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = packing_plan(histogram, capacity)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    place = plan[:, 0] << 48 | plan[:, 1]
    ranked = gapless_rank(pieces, ["length"], [key, "piece"], [key, "piece", "ids_crc32"], "_rank", sum(histogram.values()))
    ranked = ranked.select(*pieces.columns, "_rank")
    schema = ranked.drop("_rank").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema

    def run(batch: pa.RecordBatch) -> dict:
        length = batch.column("length").to_numpy()
        rank = batch.column("_rank").to_numpy()
        slot = plan[np.searchsorted(place, length << 48 | rank, side="right") - 1]
        nth = rank - slot[:, 1]
        out = {n: c for n, c in zip(batch.schema.names, batch.columns) if n != "_rank"}
        return out | {
            "sequence_id": pa.array(slot[:, 4] + nth // slot[:, 3]),
            "offset": pa.array(slot[:, 5] + nth % slot[:, 3] * length),
        }

    return map_arrow(ranked, run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenizes, cuts and packs whole documents: one row per piece, ids left out.

    NULL and empty text is the end id alone. Repeated rows are packed each; a NULL key is kept.
    An empty table gives an empty result. Other columns are not carried.
    """
    return pack(stage(tokenized_pieces(docs, tokenizer, capacity, key, text).drop("ids"), "pieces"), key, capacity)
