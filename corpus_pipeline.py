"""A training corpus from raw documents: quality, repeated lines, near copies, benchmark leaks, packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silvagrid.llm import decontaminate, linededup, neardup, packing, quality
from silvagrid.llm.common import table
from silvagrid.llm.queries import byte_bpe
from silvagrid.plans.staging import stage

#: Near copies have a similarity of 0.8 or more; 16 trees miss a pair of 0.8 once in 100,000 times.
COPIES = neardup.Forest(percent=80, trees=16)
#: A document of which so many characters in 100 stood in earlier documents is a copy and leaves with its scraps.
REPEATED = 80
#: The stages learn from labels, count over the whole corpus and search it: SQL cannot express them.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject, by the threshold of its own labels.

    NULL and empty texts have a score like any other; repeated rows stay or go together.
    """
    model = quality.fit_quality(docs, quality.training_labels(table(spark, sf_dir, "labels")))
    return quality.keep_good(docs, model, quality.ACCEPT)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that occurred in an earlier one; those made of such passages go.

    A document goes if it lost ``REPEATED`` characters in 100 or more: what is left of a copy is like nothing
    any more, so that no later stage could know it. Documents that lost less stay, blank texts and NULL too. Rows with the same id are one document to the search; each row is judged by what it lost.
    """
    before = docs.withColumn("_size", _size("text"))
    left = linededup.drop_repeated_lines(before, linededup.Chunking(any_line=True)).withColumn("_left", _size("text"))
    copy = (F.col("_size") > 0) & (100 * (F.col("_size") - F.col("_left")) >= REPEATED * F.col("_size"))
    return left.where(~copy).select(*docs.columns)


def _size(text: str) -> Column:
    return F.length(F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\r\x0b\x0c")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies; documents without words all stay.

    Rows with the same id are one document and stay or go together, rows without an id stay.
    """
    found = neardup.near_duplicates(docs, COPIES)
    copies = found.where(~F.col("kept")).select(F.col("doc_id").alias("_copy")).distinct()
    return docs.join(copies, F.col("doc_id").eqNullSafe(F.col("_copy")), "left_anti")


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. NULL and empty texts hold none; rows of one id stay or go together."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences; a NULL or empty text is a piece of the end id alone."""
    return packing.pack_documents(docs, byte_bpe())


STAGES = [
    ("quality", good_quality),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", one_of_each_group),
    ("decontamination", without_leaks),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
