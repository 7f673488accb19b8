"""Removal of repeated passages by content-defined chunks of lines, with DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silvagrid.plans.staging import stage


@dataclass(frozen=True)
class Chunking:
    """Parameters: one line in ``every`` ends a chunk; words from which a line is a chunk by itself;
    lines and words that any other run of repeated chunks needs in order to be removed."""

    every: int = 2
    long_line: int = 50
    min_lines: int = 2
    min_words: int = 20
    #: Whether runs of lines that begin or end at any line count too, not only chunks.
    any_line: bool = False
    #: Size of the bit maps that keep untouched texts out of shuffles.
    bits: int = 24


#: Bytes that count as a word where a script has no spaces; words with spaces are shorter on average.
WORD_BYTES = 12


def _words(line: Column) -> Column:
    """Words of a line, as spaces plus one, or by its bytes if that is more."""
    spaces = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))
    return F.greatest(spaces + 1, F.call_function("div", F.octet_length(line), F.lit(WORD_BYTES)).cast("int"))


def _solid(chunk: Column) -> Column:
    """Whether there is more than white space; blank lines are no passage, however many."""
    return F.btrim(chunk, F.lit(" \t\n\r\x0b\x0c")) != ""


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _slice(lines: Column, start: Column, n: Column) -> Column:
    return F.array_join(F.slice(lines, start + 1, n), "\n")


def _bitmap(rows: DataFrame, column: str, bits: int) -> Column:
    """An array of 64-bit words, the same size for any input, marked by the hashes of ``column``."""
    place = F.shiftrightunsigned(F.xxhash64(column), 64 - bits)
    words = rows.select(F.shiftright(place, 6).alias("w"), place.bitwiseAND(63).cast("int").alias("b"))
    words = words.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("v"))
    every = rows.sparkSession.range(1 << bits - 6).join(words, F.col("id") == F.col("w"), "left")
    packed = every.agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("v", F.lit(0).cast("long")).alias("v")))).alias("x"))
    return packed.select("x.v").scalar()


def _marked(words: Column, column: str, bits: int) -> Column:
    """Whether the hash of ``column`` is marked; some others are too, by chance."""
    place = F.shiftrightunsigned(F.xxhash64(column), 64 - bits)
    return F.bit_get(F.get(words, F.shiftright(place, 6).cast("int")), place.bitwiseAND(63).cast("int")) == 1


def chunks(docs: DataFrame, p: Chunking = Chunking(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, place, start, n, words, h, bytes): all chunks of lines; ``start`` counts lines from 0.

    A chunk ends after a line where a hash rolled over the hashes of this line and the one before
    falls into one of ``p.every`` classes, and around every long line. Where chunks end thus
    depends on the lines next to it only: text put in before shifts chunks but does not change them.
    """
    lines = docs.select(F.col(key).alias("key"), _lines(text).alias("lines"))
    lines = lines.withColumns({
        "hashes": F.transform("lines", lambda x: F.xxhash64(x)),
        "words": F.transform("lines", _words),
    })

    def begins(i: Column) -> Column:
        rolled = F.xxhash64(F.get("hashes", i - 2), F.get("hashes", i - 1))
        wide = F.greatest(F.get("words", i), F.get("words", i - 1)) >= p.long_line
        return (i == 0) | (F.pmod(rolled, F.lit(p.every)) == 0) | wide

    count = F.size("lines")
    lines = lines.withColumn("starts", F.filter(F.sequence(F.lit(0), count - 1), begins))
    spans = F.transform(
        "starts",
        lambda s, k: F.struct(s.alias("start"), (F.coalesce(F.get("starts", k + 1), count) - s).alias("n")),
    )
    words = F.aggregate(F.slice("words", F.col("start") + 1, F.col("n")), F.lit(0), lambda a, b: a + b)
    rows = lines.select("key", "lines", "words", F.posexplode(spans).alias("place", "x")).select(
        "key", "place", "lines", "words", "x.start", "x.n"
    )
    rows = rows.select("key", "place", "start", "n", words.alias("words"), _slice(F.col("lines"), F.col("start"), F.col("n")).alias("chunk"))
    return rows.where(_solid(F.col("chunk"))).select("key", "place", "start", "n", "words", F.xxhash64("chunk").alias("h"), F.octet_length("chunk").alias("bytes"))


def passages(docs: DataFrame, p: Chunking = Chunking(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, place, start, n, words, h, bytes): from each line on and up to each line, the shortest run that is long enough.

    Such a run depends on its own lines only. Any run of lines that is long enough is covered by
    the runs of this kind inside of it, so what occurred before is found to the line, whatever stands around it.
    ``place`` is NULL.
    """
    most = max(p.min_lines, p.min_words)  # each line has a word at least
    lines = docs.select(F.col(key).alias("key"), _lines(text).alias("lines"))
    lines = lines.withColumn("words", F.transform("lines", _words))

    def enough(n: Column, words: Column) -> Column:
        return ((n >= p.min_lines) & (words >= p.min_words)) | (words >= p.long_line)

    def shortest(ahead: Column) -> Column:
        none = F.struct(F.lit(0).alias("n"), F.lit(0).alias("words"))
        grown = F.aggregate(ahead, none, lambda acc, x: F.when(enough(acc["n"], acc["words"]), acc).otherwise(
            F.struct((acc["n"] + 1).alias("n"), (acc["words"] + x).alias("words"))
        ))
        return F.transform(F.array(grown), lambda r: F.when(enough(r["n"], r["words"]), r["n"]).otherwise(0))[0]

    def length(i: Column, step: int) -> Column:
        one, two = F.get("words", i), F.get("words", i + step)
        first = F.greatest(i - most + 1, F.lit(0))
        ahead = F.slice("words", i + 1, F.lit(most)) if step > 0 else F.reverse(F.slice("words", first + 1, i - first + 1))
        return F.when(enough(F.lit(1), one), 1).when(enough(F.lit(2), one + two), 2).otherwise(shortest(ahead))

    def code(start: Column, n: Column) -> Column:
        return F.when(n > 0, F.shiftleft(start.cast("long"), 31) + n)

    every = F.sequence(F.lit(0), F.size("lines") - 1)
    lines = lines.withColumns({
        "down": F.transform(every, lambda i: code(i, length(i, 1))),
        "up": F.transform(every, lambda i: F.transform(F.array(length(i, -1)), lambda n: code(i - n + 1, n))[0]),
    })
    rows = lines.select("key", "lines", "words", F.explode(F.array_compact(F.array_union("down", "up"))).alias("x"))
    start, n = F.shiftright("x", 31).cast("int"), F.col("x").bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
    rows = rows.select("key", "lines", "words", start.alias("start"), n.alias("n"))
    words = F.aggregate(F.slice("words", F.col("start") + 1, F.col("n")), F.lit(0), lambda a, b: a + b)
    rows = rows.select("key", "start", "n", words.alias("words"), _slice(F.col("lines"), F.col("start"), F.col("n")).alias("chunk"))
    return rows.where(_solid(F.col("chunk"))).select(
        "key", F.lit(None).cast("int").alias("place"), "start", "n", "words", F.xxhash64("chunk").alias("h"), F.octet_length("chunk").alias("bytes")
    )


def repeated_chunks(docs: DataFrame, p: Chunking = Chunking(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start, n, chunk): occurrences but the first of repeated chunks, in runs long enough.

    The first is the one of the smallest key, then line; ``chunk`` is the lines found there. Chunks of
    a document that follow one another and all occurred before make a run; it counts if it has
    ``p.min_lines`` lines and ``p.min_words`` words, or ``p.long_line`` words, so that short lines that
    are common stay. With ``p.any_line`` any run of lines counts that has as many and occurred
    before as a whole. Where an occurrence overlaps the first one, only what lies behind that counts.
    Hashes are counted by a combining aggregate; occurrences that follow one another here and there
    are joined, and only they carry text.
    """
    found = chunks(docs, p, key, text)
    if p.any_line:
        found = found.unionByName(passages(docs, p, key, text))
    found = stage(found, "chunks")
    same = ["h", "bytes"]
    at = F.struct("key", "start", "n")
    first = found.groupBy(*same).agg(F.min(at).alias("first"), F.max(at).alias("last")).where(~F.col("first").eqNullSafe(F.col("last")))
    first = stage(first.select(*same, "first.key", "first.start"), "first")
    named = first.withColumnsRenamed({"key": "f_key", "start": "f_start"})
    inside = F.col("key").eqNullSafe(F.col("f_key"))
    again = found.join(named, same).where(~(inside & (F.col("start") == F.col("f_start"))))
    own = Window.partitionBy("key", F.col("place").isNull()).orderBy("place")
    run = Window.partitionBy("key", F.col("place").isNull(), "_run")
    again = again.withColumn("_run", F.col("place") - F.dense_rank().over(own))
    length, words = F.sum("n").over(run), F.sum("words").over(run)
    enough = F.col("place").isNull() | ((length >= p.min_lines) & (words >= p.min_words)) | (words >= p.long_line)
    again = again.withColumn("_enough", enough).where("_enough")
    again = again.select("key", "f_key", (F.col("f_start") - F.col("start")).alias("shift"), F.col("start").alias("s"), (F.col("start") + F.col("n")).alias("e"))
    again = again.withColumn("s", F.when(inside, F.greatest("s", F.col("e") + F.col("shift"))).otherwise(F.col("s"))).where("s < e")
    near = Window.partitionBy("key", "f_key", "shift").orderBy("s", "e")
    before = F.max("e").over(near.rowsBetween(Window.unboundedPreceding, -1))
    again = again.withColumn("_new", F.coalesce((F.col("s") > before).cast("int"), F.lit(1)))
    again = again.withColumn("_span", F.sum("_new").over(near.rowsBetween(Window.unboundedPreceding, 0)))
    again = again.groupBy("key", "f_key", "shift", "_span").agg(F.min("s").alias("start"), F.max("e").alias("e"))
    again = again.select("key", "start", (F.col("e") - F.col("start")).alias("n"), "f_key", (F.col("start") + F.col("shift")).alias("f_start"))
    again = stage(again.withColumn("place", F.xxhash64("f_key", "f_start", "n")), "again")
    wanted = again.select("place", "f_key", "f_start", "n").distinct()
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    texts = texts.where(_marked(_bitmap(wanted, "f_key", p.bits), "key", p.bits))
    texts = texts.join(wanted, F.col("key").eqNullSafe(F.col("f_key")))
    texts = texts.select("place", F.slice(_lines("text"), F.col("f_start") + 1, F.col("n")).alias("chunk")).distinct()
    return again.join(texts, "place").select("key", "start", "n", "chunk")


def drop_repeated_lines(docs: DataFrame, p: Chunking = Chunking(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the lines of chunks that occurred before, anywhere in the corpus.

    Only documents that lose lines, and a few more that a bit map lets through, are shuffled.
    A line goes only if its bytes equal those at the first occurrence. All rows, columns and
    their order stay; the text of a document whose every chunk is repeated becomes empty, NULL
    stays NULL. ``n_chars``, if there, is set to the new length where the text changed. Rows with
    the same key count as one document, NULL keys as one key.
    """
    spans = repeated_chunks(docs, p, key, text).groupBy("key").agg(
        F.collect_list(F.struct("start", "n", "chunk")).alias("_spans")
    )
    spans = stage(spans.withColumnRenamed("key", "_key"), "spans")
    touched = _marked(_bitmap(spans, "_key", p.bits), key, p.bits)
    joined = docs.where(touched).join(spans, F.col(key).eqNullSafe(F.col("_key")), "left")
    lines = _lines(text)

    def equal(x: Column) -> Column:
        same = F.zip_with(F.slice(lines, x["start"] + 1, x["n"]), x["chunk"], lambda a, b: F.coalesce(a == b, F.lit(False)))
        return F.array_compact(F.transform(same, lambda y, k: F.when(y, x["start"] + k)))

    joined = joined.withColumn("_gone", F.array_distinct(F.flatten(F.transform("_spans", equal))))
    # by sets of numbers, not line by line against all that went; the lines are a column of their own, as
    # a function's body would take ``text`` for the new one
    joined = joined.withColumn("_lines", lines)
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.coalesce("_gone", F.array().cast("array<int>")))
    left = F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n")
    changed = F.size(F.coalesce("_gone", F.array().cast("array<int>"))) > 0
    out = {text: F.when(changed, left).otherwise(F.col(text))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(changed, F.length(left).cast(kind)).otherwise(F.col("n_chars"))
    return docs.where(~touched).unionByName(joined.withColumns(out).select(*docs.columns))
