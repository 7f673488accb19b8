"""Benchmark passages in documents, found by template windows and checked by their slots."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silvagrid.llm.common import bitmap, byte_texts, map_arrow, marked, mix, span_hashes, stream
from silvagrid.plans.staging import stage


@dataclass(frozen=True)
class Templates:
    """Parameters: tokens per window, literal tokens from which other values may stand in its slots, item
    tokens that make a leak, or which share of a short item, bits of the prefilter."""

    window: int = 8
    literals: int = 5
    tokens: int = 13
    share: float = 0.6
    bits: int = 22


#: Words that are a unit after a number.
UNITS = (
    "km m cm mm mi mile miles ft feet foot inch inches yd yard yards kg g mg lb lbs pound pounds oz ounce ounces "
    "l ml liter liters litre litres s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years usd eur gbp dollar dollars cent cents euro euros percent pct kmh mph hz khz mhz ghz "
    "w kw mw v a j kj cal kcal degree degrees c f k b kb mb gb tb"
).split()

_NUMBER, _NAME, _UNIT = (np.uint64(x) for x in stream(23, 3))
_KIND = np.zeros(256, np.int8)
_KIND[48:58] = 2
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_STOPS = np.zeros(256, bool)
_STOPS[[10, 33, 46, 58, 63]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 11, 12, 13, 32, 34, 39, 40, 41]] = True


def _unit_hashes() -> np.ndarray:
    raw = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    ends = np.cumsum([len(u) + 1 for u in UNITS]) - 1
    return np.sort(span_hashes(raw, ends - [len(u) for u in UNITS], ends))


def template(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes with placeholders for numbers, names and units, value hashes, and which are slots.

    Tokens are runs of digits or of letters; all other characters only part them. Case is folded
    (A-Z and Latin-1). A number is a run of digits; a unit is a listed word right after a number;
    a name is a word with one capital at its start that does not begin a sentence. Neighbouring
    placeholders of one type become one, its value being that of all of them together.
    """
    raw = np.frombuffer(text, np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool)
    kind = np.zeros(len(raw) + 2, np.int8)
    kind[1:-1] = _KIND[raw]
    edge = np.flatnonzero(np.diff(kind))
    starts = edge[kind[edge + 1] > 0]
    ends = edge[kind[edge] > 0]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool)
    latin = np.zeros(len(raw), bool)
    latin[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
    upper = _UPPER[raw]
    folded = raw + np.where(upper | latin, 32, 0).astype(np.uint8)
    values = span_hashes(folded, starts, ends)
    number = kind[starts + 1] == 2
    capitals = np.concatenate([[0], np.cumsum(upper | latin)])
    solid = np.where(_BLANK[raw], -1, np.arange(len(raw)))
    before = np.concatenate([[-1], np.maximum.accumulate(solid)])[starts]
    begins = (before < 0) | _STOPS[raw[before]]
    head = upper[starts] | (latin[np.minimum(starts + 1, len(raw) - 1)] & (ends - starts > 1))
    name = ~number & head & (capitals[ends] - capitals[starts] == 1) & (ends - starts > 1) & ~begins
    after = np.concatenate([[False], number[:-1]])
    unit = after & ~number & np.isin(values, _UNITS)
    name &= ~unit
    tokens = np.select([number, unit, name], [_NUMBER, _UNIT, _NAME], values)
    slot = number | unit | name
    lone = np.concatenate([[True], ~(slot[1:] & (tokens[1:] == tokens[:-1]))])
    at = np.flatnonzero(lone)
    nth = np.arange(len(values)) - np.repeat(at, np.diff([*at, len(values)]))
    joined = np.add.reduceat(values * (nth.astype(np.uint64) * np.uint64(2) + np.uint64(1)), at)
    return tokens[at], joined, slot[at]


_UNITS = _unit_hashes()


def _chained(tokens: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows of ``size`` tokens that begin at ``at``."""
    h = np.full(len(at), np.uint64(size))
    for j in range(size):
        h = (h ^ tokens[at + j]) * np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(29)
    return mix(h)


def windows(tokens: np.ndarray, values: np.ndarray, slot: np.ndarray, size: int, literals: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` tokens and whether each has enough literal tokens.

    A window with fewer says too little without its slots: its hash is that of its tokens with the values
    of the slots, so that it is met only where it stands word for word.
    """
    n = len(tokens) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    plain = np.concatenate([[0], np.cumsum(~slot)])
    enough = plain[size:] - plain[:-size] >= literals
    h = np.empty(n, np.uint64)
    h[enough] = _chained(tokens, np.flatnonzero(enough), size)
    if not enough.all():
        filled = np.where(slot, mix(tokens + values * np.uint64(0xD6E8FEB86659FD93)), tokens)
        h[~enough] = ~_chained(filled, np.flatnonzero(~enough), size)
    return h, enough


def _need(size: int, p: Templates) -> int:
    return min(p.literals, -(-size * p.literals // p.window))


_ROW = [("pos", pa.int64()), ("h", pa.int64()), ("slots", pa.list_(pa.int64()))]
_SCHEMA = "pos long, h long, slots array<long>"


def _window_rows(text: bytes, sizes: list[int], p: Templates, keep) -> list[tuple]:
    tokens, values, slot = template(text)
    rows = []
    for size in sizes:
        h, enough = windows(tokens, values, slot, size, _need(size, p))
        for i in np.flatnonzero(keep(h)).tolist():
            part = slice(i, i + size)
            filled = values[part][slot[part]].view(np.int64).tolist() if enough[i] else []
            rows.append((i, int(h[i : i + 1].view(np.int64)[0]), filled))
    return rows


def benchmark_windows(benchmark: DataFrame, p: Templates, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, tokens, size, pos, h, slots) of all windows; an item shorter than a window is one."""

    def run(batch: pa.RecordBatch) -> dict:
        out = []
        for key, t in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1))):
            n = len(template(t)[0])
            size = min(n, p.window)
            if size:
                out += [(key, n, size, *r) for r in _window_rows(t, [size], p, lambda h: np.ones(len(h), bool))]
        cols = list(zip(*out)) or [()] * 6
        kinds = [batch.column(0).type, pa.int64(), pa.int64(), *(t for _, t in _ROW)]
        return {n: pa.array(c, t) for n, c, t in zip(["item_id", "tokens", "size", "pos", "h", "slots"], cols, kinds)}

    rows = benchmark.select(F.col(item).alias("item_id"), F.col(text).alias("text"))
    return map_arrow(rows, run, f"item_id {dict(rows.dtypes)['item_id']}, tokens long, size long, {_SCHEMA}")


def _hits(docs: DataFrame, bench: DataFrame, p: Templates, key: str, text: str) -> DataFrame:
    """(doc_id, pos, h, slots): windows of documents that pass a bit map of the benchmark's.

    The map has 2 ** ``p.bits`` bits whatever the benchmark's size; what passes by chance falls
    out in the join.
    """
    marks = bitmap(bench, "h", p.bits)
    sizes = [r["size"] for r in bench.select("size").distinct().collect()]

    def run(batch: pa.RecordBatch) -> dict:
        out = [
            (k, *r)
            for k, t in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)))
            for r in _window_rows(t, sizes, p, lambda h: marked(marks, h))
        ]
        cols = list(zip(*out)) or [()] * 4
        return {n: pa.array(c, t) for n, c, t in zip(["doc_id", "pos", "h", "slots"], cols, [batch.column(0).type, *(t for _, t in _ROW)])}

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return map_arrow(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, {_SCHEMA}")


def _covered(places: Column, size: Column) -> Column:
    """Tokens covered by windows at sorted distinct places."""
    gaps = F.zip_with(F.slice(places, F.lit(2), F.size(places)), F.slice(places, F.lit(1), F.size(places) - 1), lambda b, a: F.least(b - a, size))
    return F.aggregate(gaps, size, lambda acc, x: acc + x)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, p: Templates = Templates(), key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, covered, item_tokens, slots, changed) of documents that hold a benchmark item.

    Windows are joined on their hash; those with few literal tokens only where their slots agree too.
    Along each alignment of a document with an item, the slots
    must agree one to one: the same item value always with the same document value, and the
    reverse; otherwise only the windows that stand there word for word count. ``changed`` of ``slots``
    values differ: 0 is a verbatim leak, more a question with other parameters. A leak covers ``p.tokens`` tokens of the item, or ``p.share`` of a short one.

    NULL and empty texts and items have no windows. Rows with the same id count as one document,
    rows with the same item id as one item. An empty table gives an empty result.
    """
    bench = stage(benchmark_windows(benchmark, p, item, item_text), "benchmark")
    hits = _hits(docs, bench, p, key, text)
    theirs = bench.select("h", "item_id", "tokens", "size", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"))
    joined = hits.join(theirs, "h")
    pairs = F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d"))
    diagonal = joined.select(
        "doc_id", "item_id", "tokens", "size", (F.col("pos") - F.col("item_pos")).alias("diagonal"), "item_pos",
        F.forall(pairs, lambda x: x["i"] == x["d"]).alias("same"), F.explode_outer(pairs).alias("pair"),
    )
    aligned = diagonal.groupBy("doc_id", "item_id", "diagonal").agg(
        F.max("tokens").alias("tokens"),
        F.max("size").alias("size"),
        F.collect_set("item_pos").alias("places"),
        F.collect_set(F.when(F.col("same"), F.col("item_pos"))).alias("same"),
        F.collect_set("pair").alias("pairs"),
    )
    # what stands word for word counts even where other slots of the alignment contradict each other
    n = F.size("pairs")
    fits = (n == F.size(F.array_distinct("pairs.i"))) & (n == F.size(F.array_distinct("pairs.d")))
    aligned = aligned.withColumn("fits", fits).withColumn("places", F.when(F.col("fits"), F.col("places")).otherwise(F.col("same")))
    changed = F.when(F.col("fits"), F.size(F.filter("pairs", lambda x: x["i"] != x["d"]))).otherwise(0)
    whole = aligned.where(F.size("places") > 0).groupBy("doc_id", "item_id").agg(
        F.max("tokens").alias("item_tokens"),
        F.max("size").alias("size"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"),
        F.max(n).cast("long").alias("slots"),
        F.max(changed).cast("long").alias("changed"),
    )
    whole = whole.withColumn("covered", _covered(F.col("places"), F.col("size")))
    need = F.least(F.lit(p.tokens), F.ceil(F.col("item_tokens") * p.share))
    return whole.where(F.col("covered") >= need).select("doc_id", "item_id", "covered", "item_tokens", "slots", "changed")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, p: Templates = Templates(), key: str = "doc_id", **names: str) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all columns and other rows stay."""
    leaks = find_leaks(docs, benchmark, p, key, **names).select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(leaks, F.col(key).eqNullSafe(F.col("_leak")), "left_anti")
