"""Rendezvous hashing over weighted shards, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silvagrid.llm.common import gapless_rank

#: Hex digits of the digest used per (key, shard): 52 bits fit a double exactly.
DIGITS = 13


def _score(key: Column, shard: int, weight: float) -> Column:
    digest = F.md5(F.encode(F.concat(key, F.lit(f":{shard}")), "utf-8"))
    drawn = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long")
    return F.log((drawn + F.lit(0.5)) / F.lit(float(16**DIGITS))) / F.lit(float(weight))


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard of the highest score ``ln(u) / weight``, u drawn from (key, shard) alone.

    A shard gets rows in proportion to its weight; a shard that is added takes rows only into
    itself, one that goes gives up only its own. A weight of 0 gets nothing. NULL keys count as
    one key. Equal scores go to the smaller shard.
    """
    text = F.coalesce(key.cast("string"), F.lit("\x00null"))
    scored = [F.struct(_score(text, i, w).alias("s"), F.lit(-i).alias("n")) for i, w in enumerate(weights) if w > 0]
    best = F.greatest(*scored) if len(scored) > 1 else scored[0]
    return (-best["n"]).cast("int")


def assign_shards(df: DataFrame, weights: list[float], grown: list[float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, size, crc32 of the text, law, shard, slot in the shard, shard under ``grown``.

    Size is the UTF-8 length (NULL: 0) plus 8. Slots are 0, 1, 2, ... in each shard. Repeated
    rows and NULL keys are kept, each with a slot of its own. Only the small columns are shuffled.
    Existing columns of other names are not carried.
    """
    bytes_ = F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")
    rows = df.select(
        F.col(key),
        (F.octet_length(bytes_) + 8).cast("long").alias("size"),
        F.crc32(bytes_).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col(key), weights).alias("shard"),
        rendezvous(F.col(key), grown).alias("grown_shard"),
    )
    return gapless_rank(rows, ["shard"], [key], [key, "text_crc32"], "slot", df.select(key).count())
