"""How the sources of a language differ in their terms, with a frequent-pattern tree of term rows.

A term row holds the counts of one term in the sources of its language, zeros left out. The distance
of two sources is a sum over all terms, but only terms that both sources use need a look at both
counts: with every count taken as zero the sum is known, a count in one source alone changes it by an
amount that depends on that count only, and what is left is a correction per term and pair of counts.
Rows are inserted into a tree in a fixed order of sources; rows that begin alike share nodes, so that a
correction is worked out once for each node and ancestor and multiplied by the rows below.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silvagrid.llm.common import byte_texts, folding, map_arrow, word_lists
from silvagrid.plans.staging import stage

LETTERS = folding(digits=False)


@dataclass(frozen=True)
class Divergence:
    """Parameters: documents of a language a kept term needs, what every count is raised by, the unit
    of shares, ranks of the term part, counted terms a task holds, tree nodes a task holds."""

    least_docs: int = 3
    prior: int = 1
    unit: int = 1_000_000_000
    ranks: int = 200
    held: int = 1 << 18
    nodes: int = 1 << 17


def term_counts(docs: DataFrame, p: Divergence, lang: str, source: str, text: str) -> DataFrame:
    """(lang, source, term, n, docs), added up per task; a task holds ``p.held`` terms and writes them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for key, t in zip(keys, byte_texts(batch.column(2))):
                n, docs_with = groups.setdefault(key, (Counter(), Counter()))
                before, own = len(n), set()
                for words in word_lists(t, LETTERS):
                    n.update(words)
                    own.update(words)
                docs_with.update(own)
                held += len(n) - before
                if held >= p.held:
                    yield from _count_rows(groups)
                    groups, held = {}, 0
        yield from _count_rows(groups)

    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    return rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _count_rows(groups: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs) in groups.items():
        if n:
            terms = list(n)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(terms), pa.string()),
                "source": pa.array([source] * len(terms), pa.string()),
                "term": pa.array(terms, pa.binary()).cast(pa.string()),
                "n": pa.array([n[t] for t in terms], pa.int64()),
                "docs": pa.array([docs[t] for t in terms], pa.int64()),
            })


def share(n: Column | str, total: Column | str, kept: Column | str, p: Divergence) -> Column:
    """``1 + floor(unit * (n + prior) / (total + prior * kept))``, exact; NULL where no term is kept."""
    n, total, kept = (F.col(x) if isinstance(x, str) else x for x in (n, total, kept))
    wide = F.lit(p.unit).cast("decimal(10,0)") * (n + p.prior).cast("decimal(19,0)")
    below = (total + p.prior * kept).cast("decimal(19,0)")
    return F.when(kept > 0, 1 + F.call_function("div", wide, F.when(kept > 0, below)))


def distance(p: Column, q: Column) -> Column:
    """``floor((p - q) ** 2 / q)``; shares are at most unit + 1, so that the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class PatternTree:
    """Term rows of one language as a tree; an item is (source number, share, share of a zero count)."""

    def __init__(self) -> None:
        self.child: dict[tuple[int, tuple[int, int, int]], int] = {}
        self.parent, self.items, self.rows = [-1], [(-1, 1, 1)], [0]

    def insert(self, path: list[tuple[int, int, int]], rows: int) -> None:
        at = 0
        for item in path:
            below = self.child.get((at, item))
            if below is None:
                below = self.child[at, item] = len(self.parent)
                self.parent.append(at)
                self.items.append(item)
                self.rows.append(0)
            self.rows[below] += rows
            at = below

    def corrections(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """a, b, and the sums of what (a against b) and (b against a) lack, over all nodes and their ancestors."""
        parent = np.array(self.parent)
        source, share_, zero = (np.array(x, np.int64) for x in zip(*self.items))
        rows = np.array(self.rows, np.int64)
        node, above, found = np.arange(1, len(parent)), parent[1:], []
        while True:
            inner = above > 0
            node, above = node[inner], above[inner]
            if not len(node):
                break
            pa_, pb, za, zb, m = share_[above], share_[node], zero[above], zero[node], rows[node]
            ab = m * (_f(pa_, pb) - _f(pa_, zb) - _f(za, pb) + _f(za, zb))
            ba = m * (_f(pb, pa_) - _f(zb, pa_) - _f(pb, za) + _f(zb, za))
            found.append(_summed(source[above], source[node], ab, ba))
            above = parent[above]
        if not found:
            return (np.zeros(0, np.int64),) * 4
        return _summed(*(np.concatenate(x) for x in zip(*found)))


def _summed(a: np.ndarray, b: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return (a[first], b[first], *(np.add.reduceat(v[order], first) for v in values))


_PAIR = "lang string, a int, b int, ab long, ba long"


def tree_corrections(paths: DataFrame, p: Divergence) -> DataFrame:
    """(lang, a, b, ab, ba) from (lang, path, rows), which come sorted, so that rows alike meet in one tree.

    A task holds the tree of one language, of ``p.nodes`` nodes or little more, and writes out its sums
    when it is full; a node that is begun again in the next tree counts with the rows it has there.
    """

    def out(lang: str, tree: PatternTree) -> pa.RecordBatch:
        a, b, ab, ba = tree.corrections()
        columns = [pa.array([lang] * len(a), pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(ab), pa.array(ba)]
        return pa.RecordBatch.from_arrays(columns, ["lang", "a", "b", "ab", "ba"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, tree = None, PatternTree()
        for batch in batches:
            lists = batch.column(1)
            ends = lists.offsets.to_pylist()
            values = lists.values  # not flatten(): the offsets count from its start
            flat = list(zip(*(values.field(i).to_pylist() for i in range(3))))
            for i, (key, rows) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                if key != lang or len(tree.parent) >= p.nodes:
                    if len(tree.parent) > 1:
                        yield out(lang, tree)
                    lang, tree = key, PatternTree()
                tree.insert(flat[ends[i] : ends[i + 1]], rows)
        if len(tree.parent) > 1:
            yield out(lang, tree)

    return paths.mapInArrow(run, _PAIR)


def audit_sources(
    docs: DataFrame, p: Divergence = Divergence(), lang: str = "lang", source: str = "source", text: str = "text",
) -> DataFrame:
    """(lang, source, part, item, value, rank): distances between the sources of each language, and each source's own terms.

    Terms are runs of letters and of characters beyond ASCII, A-Z lowered. A language keeps the terms of at
    least ``p.least_docs`` of its documents. Part ``pair``: the distance to each other source, over all kept
    terms. Part ``term``: kept terms whose share in the source exceeds that in the language, the first
    ``p.ranks`` of them. Ranks go by value, downwards, then by item.

    NULL text, language and source count as ''. A group without kept terms still has its pairs, with zero
    counts; where a language keeps no term their value is 0. Repeated rows are documents of their own. An
    empty table gives an empty result. Columns of other names, whatever they are, are not read.
    """
    counts = term_counts(docs, p, lang, source, text)
    per_source = counts.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    rows = per_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n_lang"), F.collect_list(F.struct("source", "n")).alias("row")
    )
    rows = stage(rows.where(F.col("docs") >= p.least_docs).drop("docs"), "term_rows")
    groups = stage(_groups(docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"))]), rows, p), "groups")
    cells = rows.select("lang", "term", "n_lang", F.explode("row").alias("cell")).select("lang", "term", "n_lang", "cell.source", "cell.n")
    cells = cells.join(groups, ["lang", "source"]).withColumn("p", share("n", "total", "kept", p))
    cells = stage(cells.select("lang", "source", "number", "term", "p", "zero", share("n_lang", "lang_total", "kept", p).alias("q")), "cells")
    return _own_terms(cells, p).unionByName(_pairs(cells, groups, p))


def _groups(named: DataFrame, rows: DataFrame, p: Divergence) -> DataFrame:
    """Each (lang, source): terms used, their sum, those of the language, a number by terms used, the share of a zero count."""
    used = rows.select("lang", F.explode("row").alias("cell")).groupBy("lang", F.col("cell.source").alias("source"))
    used = used.agg(F.sum("cell.n").alias("total"), F.count("*").alias("used"))
    langs = rows.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n_lang").alias("lang_total"))
    all_ = named.distinct().join(used, ["lang", "source"], "left").join(langs, "lang", "left")
    all_ = all_.fillna(0, ["total", "used", "kept", "lang_total"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("used"), "source"))
    return all_.select("lang", "source", "total", "kept", "lang_total", number.alias("number"), share(F.lit(0), "total", "kept", p).alias("zero"))


def _own_terms(cells: DataFrame, p: Divergence) -> DataFrame:
    above = cells.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    return _ranked(above).where(F.col("rank") <= p.ranks)


def _ranked(df: DataFrame) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")))


def _pairs(cells: DataFrame, groups: DataFrame, p: Divergence) -> DataFrame:
    """The distance of each group to every other of its language; the result has a row for each of these pairs."""
    one = groups.select("lang", "source", "kept", F.col("number").alias("a"), F.col("zero").alias("za"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("b"), F.col("zero").alias("zb"))
    both = one.join(other, "lang").where("a <> b")

    paths = cells.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("number", "p", "zero"))).alias("path"))
    paths = paths.groupBy("lang", "path").agg(F.count("*").alias("rows")).repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    mixed = tree_corrections(paths, p)

    # a count in one source alone: once per source and share, against zero in every other source
    alone = cells.groupBy("lang", F.col("number").alias("n"), "p", F.col("zero").alias("z")).agg(F.count("*").alias("rows"))
    against = groups.select("lang", F.col("number").alias("x"), F.col("zero").alias("zx"))
    alone = alone.join(against, "lang").where("n <> x").groupBy("lang", F.col("n").alias("a"), F.col("x").alias("b"))
    c, z, zx = F.col("p"), F.col("z"), F.col("zx")
    alone = alone.agg(
        _exact(F.col("rows"), distance(c, zx) - distance(z, zx)).alias("ab"), _exact(F.col("rows"), distance(zx, c) - distance(zx, z)).alias("ba")
    )
    wide = "decimal(38,0)"
    sums = mixed.select("lang", "a", "b", F.col("ab").cast(wide).alias("ab"), F.col("ba").cast(wide).alias("ba")).unionByName(alone)
    sums = sums.select("lang", "a", "b", F.col("ab").alias("more")).union(sums.select("lang", "b", "a", "ba"))
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("more").alias("more"))
    none = F.col("kept").cast(wide) * distance(F.col("za"), F.col("zb"))
    value = F.when(F.col("kept") == 0, F.lit(0)).otherwise(none + F.coalesce("more", F.lit(0)))
    found = both.join(sums, ["lang", "a", "b"], "left")
    return _ranked(found.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value")))


def _exact(rows: Column, change: Column) -> Column:
    return F.sum(rows.cast("decimal(18,0)") * change.cast("decimal(19,0)")).cast("decimal(38,0)")
