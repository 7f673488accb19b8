"""Importance resampling towards a target corpus, with features counted once per distinct line.

Texts repeat whole lines, so that most of the counting work is on lines seen before. Newlines part
words, hence a text's features are those of its lines, plus the runs of words that go over a line's
end. Lines are brought together over the whole corpus, each distinct one is counted once and its counts
are multiplied by how often it stands somewhere; the runs over line ends are counted separately.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silvagrid.llm.common import byte_texts, folding, slices, word_lists
from silvagrid.plans.joins import attach
from silvagrid.plans.staging import stage

LINES = folding(digits=True, lines=True)


@dataclass(frozen=True)
class Resampling:
    """Parameters: longest run of words that is a feature, hash buckets, unit of gains, words a document
    needs to be drawn, percent of those that are drawn, seed, bytes of lines that a task holds."""

    longest: int = 1
    buckets: int = 10_000
    unit: int = 1000
    least_words: int = 20
    percent: int = 10
    seed: int = 2024
    held: int = 8 << 20


class Features:
    """Buckets of the runs of words; those of single words are remembered, up to a bound."""

    def __init__(self, p: Resampling) -> None:
        self.p, self.known = p, {}

    def bucket(self, feature: bytes) -> int:
        found = self.known.get(feature)
        if found is None:
            if len(self.known) >= 1 << 17:
                self.known.clear()
            found = self.known[feature] = crc32(feature) % self.p.buckets
        return found

    def inside(self, line: bytes) -> Iterator[list[int]]:
        """Of all runs within a line, in lists of bounded length; a run goes with its last word."""
        before: list[bytes] = []
        for words in word_lists(line, LINES):
            out = [self.bucket(w) for w in words]
            if self.p.longest > 1:
                row = before + words
                for n in range(2, self.p.longest + 1):
                    first = max(0, len(before) + 1 - n)
                    out += [crc32(b" ".join(row[i : i + n])) % self.p.buckets for i in range(first, len(row) - n + 1)]
                before = row[-(self.p.longest - 1) :]
            yield out

    def across(self, lines: Iterable[bytes]) -> Iterator[list[int]]:
        """Of the runs over at least one line end, one list per line: the runs that end in it."""
        reach = self.p.longest - 1
        before: list[bytes] = []
        for line in lines:
            head, tail, n = _ends(line, reach)
            row, out = before + head, []
            for end in range(len(before) + 1, len(row) + 1):
                for start in range(max(0, end - reach - 1), len(before)):
                    out.append(crc32(b" ".join(row[start:end])) % self.p.buckets)
            if out:
                yield out
            before = tail if n >= reach else (before + tail)[-reach:]


def _ends(line: bytes, reach: int) -> tuple[list[bytes], list[bytes], int]:
    """First and last ``reach`` words of a line, and how many words it has."""
    head, tail, n = [], [], 0
    for words in word_lists(line, LINES):
        head += words[: max(0, reach - len(head))]
        tail = (tail + words)[-reach:]
        n += len(words)
    return head, tail, n


def distinct_lines(docs: DataFrame, p: Resampling, text: str) -> DataFrame:
    """(line, times): each distinct folded line that has a character left, and how often it occurs in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: Counter[bytes] = Counter()
        size = 0
        for batch in batches:
            for t in byte_texts(batch.column(0)):
                parts = t.translate(LINES).split(b"\n")
                lines.update(parts)
                size += len(t)  # more than is held, as repeats are in it
                if size >= p.held:
                    yield _line_rows(lines)
                    lines, size = Counter(), 0
        yield _line_rows(lines)

    parts = docs.select(F.col(text).cast("string")).mapInArrow(run, "line binary, times long")
    return parts.groupBy("line").agg(F.sum("times").alias("times"))


def _line_rows(lines: Counter[bytes]) -> pa.RecordBatch:
    lines.pop(b"", None)
    return pa.RecordBatch.from_arrays([pa.array(list(lines), pa.binary()), pa.array(list(lines.values()), pa.int64())], ["line", "times"])


def _summed(parts: DataFrame, p: Resampling) -> np.ndarray:
    """The sum of the tasks' counts; ``p.buckets`` rows reach the driver, whatever the corpus' size."""
    rows = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(p.buckets, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def _rows(total: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])


def bucket_counts(docs: DataFrame, p: Resampling = Resampling(), text: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def of_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(p), np.zeros(p.buckets, np.int64)
        for batch in batches:
            found, times, size = [], [], 0
            for line, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part in features.inside(line):
                    found.append(np.array(part, np.int64))
                    times.append(k)
                    size += len(part)
                    if size >= 1 << 20:
                        _add(total, found, times)
                        found, times, size = [], [], 0
            _add(total, found, times)
        yield _rows(total)

    def over_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(p), np.zeros(p.buckets, np.int64)
        for batch in batches:
            for t in byte_texts(batch.column(0)):
                for part in features.across(t.split(b"\n")):
                    np.add.at(total, part, 1)
        yield _rows(total)

    counts = _summed(distinct_lines(docs, p, text).mapInArrow(of_lines, "bucket int, n long"), p)
    if p.longest > 1:
        counts += _summed(docs.select(F.col(text).cast("string")).mapInArrow(over_ends, "bucket int, n long"), p)
    return counts


def _add(total: np.ndarray, found: list[np.ndarray], times: list[int]) -> None:
    if found:
        np.add.at(total, np.concatenate(found), np.repeat(np.array(times, np.int64), [len(x) for x in found]))


def bucket_gains(corpus: np.ndarray, target: np.ndarray, p: Resampling = Resampling()) -> np.ndarray:
    """``floor(unit * ln(share in the target / share in the corpus))`` per bucket, counts raised by one."""
    s, t = float(corpus.sum()) + p.buckets, float(target.sum()) + p.buckets
    return np.array([math.floor(p.unit * math.log((y + 1.0) * s / ((x + 1.0) * t))) for x, y in zip(corpus.tolist(), target.tolist())], np.int64)


def document_weights(docs: DataFrame, gains: np.ndarray, p: Resampling, key: str, text: str) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of all rows; a line that comes again in a slice is not summed again."""
    schema = f"doc_id {dict(docs.dtypes)[key]}, n_words long, n_features long, weight long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(p)
        for batch in batches:
            out = []
            for part in slices(byte_texts(batch.column(1))):
                seen: dict[bytes, tuple[int, int, int]] = {}
                for t in part:
                    words = n = gain = 0
                    lines = t.translate(LINES).split(b"\n")
                    for line in lines:
                        if line not in seen:
                            seen[line] = _line_sums(line, features, gains)
                        a, b, c = seen[line]
                        words, n, gain = words + a, n + b, gain + c
                    if p.longest > 1:
                        for found in features.across(lines):
                            n, gain = n + len(found), gain + int(gains[found].sum())
                    out.append((words, n, gain // n if n else 0))
            words, n, weight = (pa.array(x, pa.int64()) for x in zip(*out)) if out else (pa.array([], pa.int64()),) * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), words, n, weight], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(key, F.col(text).cast("string")).mapInArrow(run, schema)


def _line_sums(line: bytes, features: Features, gains: np.ndarray) -> tuple[int, int, int]:
    words = sum(map(len, word_lists(line, LINES)))
    n = gain = 0
    for part in features.inside(line):
        n, gain = n + len(part), gain + int(gains[np.array(part, np.int64)].sum())
    return words, n, gain


def resample(
    docs: DataFrame, target: DataFrame, p: Resampling = Resampling(), key: str = "doc_id", text: str = "text", target_text: str = "text",
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): documents drawn without replacement, likelier ones of the target first.

    A feature is a run of 1 to ``p.longest`` words (letters and digits, A-Z lowered). A document's weight is
    the floored mean of its features' gains, its score the weight plus a draw that the id and the seed
    decide (the Gumbel trick). Of the documents with ``p.least_words`` words, ``p.percent`` in a hundred of
    the highest scores are drawn; equal scores go to the smaller id. Undrawn rows have no rank.

    NULL and empty texts have no features and weight 0. A NULL id is drawn for as the empty one and comes
    before all others among equal scores. Repeated rows are documents of their own. Empty tables: an empty
    corpus gives an empty result, an empty target counts as no features. Other columns are not read.
    """
    gains = bucket_gains(bucket_counts(docs, p, text), bucket_counts(target, p, target_text), p)
    weighed = document_weights(docs, gains, p, key, text)
    name = F.concat(F.lit(f"{p.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(F.encode(name, "utf-8"), 256), 1, 8), 16, 10).cast("double")
    drawn = F.floor(-p.unit * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weighed.withColumn("score", F.col("weight") + drawn)
    return _drawn(stage(scored, "scored"), p)


def _drawn(scored: DataFrame, p: Resampling) -> DataFrame:
    """Adds ranks by a sort over all tasks: rows of lower partitions are counted, no task sees more than its part."""
    enough = scored.where(F.col("n_words") >= p.least_words)
    number = enough.count() * p.percent // 100
    placed = enough.repartitionByRange(F.desc("score"), F.asc("doc_id")).withColumn("part", F.spark_partition_id())
    placed = stage(placed, "placed")
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("score"), F.asc("doc_id")))
    ranked = attach(placed.withColumn("inside", inside), starts, ["part"])
    place = F.col("before") + F.col("inside")
    columns = ["doc_id", "n_features", "weight", "score"]
    rank = F.when(place <= number, place).alias("rank")
    return ranked.select(*columns, rank).unionByName(
        scored.where(F.col("n_words") < p.least_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    )
