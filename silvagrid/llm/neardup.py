"""Near-duplicate groups by an LSH forest, links confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvagrid.llm.common import bitmap, byte_slices, byte_texts, components, hash_words, map_arrow, marked, mix, slices, stream
from silvagrid.plans.joins import attach
from silvagrid.plans.staging import stage


@dataclass(frozen=True)
class Forest:
    """Parameters: words per shingle, threshold in percent, trees, signature values per tree,
    depth at which regions begin, rows that a region may hold before it is divided deeper."""

    words: int = 5
    percent: int = 85
    trees: int = 12
    depth: int = 6
    first: int = 3
    region: int = 16
    #: Values of the longer signature of rows outside of a large region's main group.
    fine_values: int = 1024
    #: Parts that make a block when rows outside of a large region's main group are compared with all.
    spread: int = 16
    #: Size of the bit map that picks the texts to be confirmed.
    bits: int = 25

    @property
    def values(self) -> int:
        return self.trees * self.depth

    @property
    def estimate(self) -> float:
        """Share of equal signature values from which a pair is confirmed, 4.5 deviations below the threshold."""
        return self._below(self.values, 4.5)

    @property
    def fine_estimate(self) -> float:
        """The same for the longer signature, 5.5 deviations."""
        return self._below(self.fine_values, 5.5)

    def _below(self, values: int, deviations: float) -> float:
        q = self.percent / 100
        return q - deviations * (q * (1 - q) / values) ** 0.5


_STEP = np.uint64(0x9FB21C651E98DF25)
_MANY = 1 << 15


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of all texts, and each text's offset.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered. A text with fewer words than a shingle has
    its whole sequence as one; one without words has none.
    """
    hashes, at = hash_words(texts)
    n = len(hashes)
    full = np.zeros(max(n - words + 1, 0), np.uint64)
    factor = np.uint64(1)
    for j in range(words):
        full += hashes[j : j + len(full)] * factor
        factor = np.uint64((int(factor) * int(_STEP)) & (2**64 - 1))
    full = mix(full)
    sets, offsets = [], np.zeros(len(texts) + 1, np.int64)
    for i, (s, e) in enumerate(zip(at[:-1], at[1:])):
        if e - s >= words:
            one = np.sort(full[s : e - words + 1])
            one = one[np.concatenate([[True], one[1:] != one[:-1]])]
        elif e > s:
            value = sum(int(h) * pow(int(_STEP), j, 1 << 64) for j, h in enumerate(hashes[s:e])) + (int(e - s) << 56) + 1
            one = mix(np.array([value & (2**64 - 1)], np.uint64))
        else:
            one = full[:0]
        sets.append(one)
        offsets[i + 1] = offsets[i] + len(one)
    return (np.concatenate(sets) if sets else full[:0]), offsets


def signatures(values: np.ndarray, offsets: np.ndarray, count: int) -> np.ndarray:
    """texts x count smallest hashes (uint32); rows of empty sets are 0."""
    out = np.zeros((len(offsets) - 1, count), np.uint32)
    flip, times = stream(11, count), stream(13, count) | np.uint64(1)
    filled = np.flatnonzero(np.diff(offsets))
    i = 0
    while i < len(filled):
        j = i + 1
        while j < len(filled) and offsets[filled[j] + 1] - offsets[filled[i]] <= _MANY:
            j += 1
        rows = filled[i:j]
        part = values[offsets[rows[0]] : offsets[rows[-1] + 1]]
        starts = offsets[rows] - offsets[rows[0]]
        for k in range(count):
            out[rows, k] = np.minimum.reduceat((part ^ flip[k]) * times[k], starts) >> np.uint64(32)
        i = j
    return out


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def sketches(docs: DataFrame, key: str, text: str, p: Forest) -> DataFrame:
    """key, n_shingles, two hashes of the whole set, signature (4 bytes a value)."""

    def run(batch: pa.RecordBatch) -> dict:
        parts = list(zip(*[one(part) for part in slices(byte_texts(batch.column(1)))]))
        n, lo, hi, sig = (np.concatenate(x) for x in parts)
        return {
            "doc_id": batch.column(0),
            "n": pa.array(n),
            "lo": _longs(lo),
            "hi": _longs(hi),
            "sig": pa.array([s.tobytes() for s in sig], pa.binary()),
        }

    def one(texts: list[bytes]) -> tuple:
        values, offsets = shingle_sets(texts, p.words)
        signed = signatures(values, offsets, p.values)
        sums = np.zeros((2, len(offsets)), np.uint64)
        for row, v in zip(sums, (mix(values), mix(values ^ np.uint64(0x5DEECE66D)))):
            np.cumsum(v, out=v)
            row[1:] = np.concatenate([[np.uint64(0)], v])[offsets[1:]]
        return np.diff(offsets), np.diff(sums[0]), np.diff(sums[1]), signed

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_arrow(rows, run, "doc_id long, n long, lo long, hi long, sig binary")


def _prefixes(classes: DataFrame, p: Forest) -> DataFrame:
    """A row per class and tree: hashes of the signature's first values, one for each depth."""
    depths = range(p.first, p.depth + 1)

    def run(batch: pa.RecordBatch) -> dict:
        reps = batch.column(0).to_numpy()
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(len(reps), p.trees, p.depth)
        state = np.broadcast_to(stream(17, p.trees), (len(reps), p.trees)).copy()
        out = {}
        for d in range(p.depth):
            state = mix((state ^ sig[:, :, d]) * _STEP + np.uint64(d + 1))
            if d + 1 in depths:
                out[f"d{d + 1}"] = _longs(state.ravel())
        return {"rep": pa.array(np.repeat(reps, p.trees))} | out

    return map_arrow(classes.select("rep", "sig"), run, "rep long, " + ", ".join(f"d{d} long" for d in depths))


def regions(classes: DataFrame, p: Forest) -> DataFrame:
    """(region, part, parts, rep, wide): classes with a common signature prefix, at most about ``p.region`` each.

    In each tree a class lies in the region of its first ``p.first`` values. A region with more
    rows is divided by further values, each row going to the shallowest region small enough.
    Where even that fails, or leaves a row alone, the deepest large region is dealt into random
    parts: its rows agree in so many values that any of them are neighbours. ``wide`` is the region
    of the first values if that was divided.
    """
    trees = _prefixes(classes, p)
    first = f"d{p.first}"
    many = trees.groupBy(first).agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    shared = stage(attach(trees, many, [first]), "trees")
    small = shared.where(F.col("c") <= p.region).select(F.col(first).alias("region"), F.lit(0).alias("part"), F.lit(1).alias("parts"), "rep", F.lit(None).cast("long").alias("wide"))
    deeper = [F.struct(F.lit(d).alias("level"), F.col(f"d{d}").alias("h")) for d in range(p.first + 1, p.depth + 1)]
    deep = shared.where(F.col("c") > p.region).select("rep", first, "c", F.explode(F.array(*deeper)).alias("x"))
    deep = deep.select("rep", first, "c", "x.level", "x.h")
    sizes = deep.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    picked = attach(deep, sizes, ["h"], "left").groupBy("rep", first).agg(
        F.first("c").alias("c"),
        F.min(F.when(F.col("m").between(2, p.region), F.struct("level", "h"))).alias("fit"),
        F.max(F.when(F.col("m") > p.region, F.struct("level", "h", "m"))).alias("big"),
    )
    region = F.coalesce("fit.h", "big.h", first)
    size = F.when(F.col("fit").isNull(), F.coalesce("big.m", "c")).otherwise(1)
    large = picked.select(region.alias("region"), F.ceil(size / p.region).cast("int").alias("parts"), "rep", F.col(first).alias("wide"))
    part = F.pmod(F.xxhash64("rep", "region"), F.col("parts")).cast("int")
    large = large.select("region", part.alias("part"), "parts", "rep", "wide")
    return small.unionByName(large)


def _wide(placed: DataFrame, p: Forest) -> DataFrame:
    """(region, part, parts, rep): the rows of each region that was divided, by the first ``p.first`` values again."""
    rows = placed.where("wide is not null").select(F.col("wide").alias("region"), "rep")
    sizes = rows.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / p.region).cast("int").alias("parts"))
    rows = attach(rows, sizes, ["region"])
    return rows.select("region", F.pmod(F.xxhash64("rep", "region"), F.col("parts")).cast("int").alias("part"), "parts", "rep")


def _likely(located: DataFrame, p: Forest) -> DataFrame:
    """(a, b, equal): for each row of a region the row with the most equal signature values, if enough."""
    gathered = _gather(located.withColumn("outer", F.lit(True)))

    def run(batch: pa.RecordBatch) -> dict:
        found = [np.zeros((0, 3), np.int64)]
        for _, ids, _, _, _, equal, least in _estimates(batch, p, p.values, p.estimate):
            order = np.argsort(ids)
            j = order[equal[:, order].argmax(axis=1)]
            top = equal[np.arange(len(ids)), j]
            keep = top >= least
            found.append(np.stack([ids[keep], ids[j][keep], top[keep]], axis=1))
        return {k: pa.array(c) for k, c in zip(("a", "b", "equal"), np.concatenate(found).T)}

    return map_arrow(gathered, run, "a long, b long, equal long")


_NEAR = "region long, part long, rep long, n long, label long, outer boolean, sig binary"


def _links_inside(located: DataFrame, sets: DataFrame, p: Forest, values: int, estimate: float) -> DataFrame:
    """(a, b): labels of a region that are linked, by pairs of its rows confirmed on full sets.

    Rows that have a row of another label with a similar signature in their part are sent once per part,
    with their full set; the pairs are made where the part is, and only links between labels not linked
    before leave it. Rows with ``outer`` are compared with all others, the rest not among themselves.
    """

    def near(batch: pa.RecordBatch) -> dict:
        rows = []
        for s, ids, _, own, ahead, equal, least in _estimates(batch, p, values, estimate):
            i, j = np.nonzero((equal >= least) & (own[ahead, None] != own[None]))
            rows.append(s + np.union1d(ahead[i], j))
        rows = np.concatenate([np.zeros(0, np.int64), *rows])
        lists = batch.column("rows")
        flat = lists.flatten()
        owner = pa.array(np.searchsorted(lists.offsets.to_numpy() - lists.offsets[0].as_py(), rows, side="right") - 1)
        return {c: batch.column(c).take(owner) for c in ("region", "part")} | {
            c: flat.field(c).take(pa.array(rows)) for c in ("rep", "n", "label", "outer", "sig")
        }

    rows = stage(map_arrow(_gather(located), near, _NEAR), "near").join(sets, "rep")
    rows = rows.select("region", "part", "rep", "label", "outer", "sig", "members")
    found = rows.groupBy("region", "part").applyInArrow(lambda t: _confirmed_links(t, p, values, estimate), "a long, b long")
    return found.distinct()


def _gather(located: DataFrame) -> DataFrame:
    """One row per part of a region; both are in the exchange, as a region may be large."""
    rows = F.collect_list(F.struct("rep", "n", "label", "outer", "sig")).alias("rows")
    dealt = located.withColumn("part", F.col("part").cast("long")).repartition("region", "part")
    return dealt.groupBy("region", "part").agg(rows).where(F.size("rows") > 1)


def _equal(sig: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    return np.stack([(sig == sig[i]).sum(axis=1) for i in ahead]) if len(ahead) else np.zeros((0, len(sig)), np.int64)


def _estimates(batch: pa.RecordBatch, p: Forest, values: int, estimate: float) -> Iterator[tuple]:
    """Per part: its first row, ids, sizes, labels, rows compared, their equal values with all rows (-1 where sizes
    rule a link out), and how many are enough."""
    least = int(np.ceil(estimate * values))
    lists = batch.column("rows")
    flat = lists.flatten()
    cuts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    rep, n, label, outer = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("rep", "n", "label", "outer"))
    sig = np.concatenate([np.zeros(0, np.uint8), *byte_slices(flat.field("sig"), np.uint8)]).reshape(len(rep), values)
    for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        ids, m = rep[s:e], n[s:e]
        ahead = np.flatnonzero(outer[s:e])
        fits = 100 * np.minimum(m[ahead, None], m[None]) >= p.percent * np.maximum(m[ahead, None], m[None])
        equal = np.where(fits & (ids[ahead, None] != ids[None]), _equal(sig[s:e], ahead), -1)
        yield s, ids, m, label[s:e], ahead, equal, least


def _confirmed_links(rows: pa.Table, p: Forest, values: int, estimate: float) -> pa.Table:
    """Pairs of labels of one part that are linked, likeliest first; what is already linked is not looked at again."""
    rows = rows.combine_chunks()
    label, outer = (rows.column(c).to_numpy() for c in ("label", "outer"))
    sig, members = (byte_slices(rows.column(c).chunk(0), kind) for c, kind in (("sig", np.uint8), ("members", np.uint64)))
    n = np.array([len(x) for x in members])
    ahead = np.flatnonzero(outer)
    equal = _equal(np.concatenate(sig).reshape(len(label), values), ahead)
    fits = 100 * np.minimum(n[ahead, None], n[None]) >= p.percent * np.maximum(n[ahead, None], n[None])
    i, j = np.nonzero(fits & (equal >= int(np.ceil(estimate * values))) & (label[ahead, None] != label[None]))
    order = np.argsort(-equal[i, j], kind="stable")
    group, links = {int(x): int(x) for x in label}, []

    def root(x: int) -> int:
        while group[x] != x:
            group[x] = x = group[group[x]]
        return x

    for a, b in zip(ahead[i][order].tolist(), j[order].tolist()):
        x, y = root(int(label[a])), root(int(label[b]))
        if x != y and similar(members[a], members[b], p.percent):
            group[max(x, y)] = min(x, y)
            links.append((min(x, y), max(x, y)))
    return pa.table({k: pa.array([x[q] for x in links], pa.int64()) for q, k in enumerate(("a", "b"))})


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union of two sorted sets."""
    joined = np.sort(np.concatenate([x, y]), kind="stable")
    common = int((joined[1:] == joined[:-1]).sum())
    return 100 * common >= percent * (len(joined) - common)


def _fine(reps: DataFrame, sets: DataFrame, p: Forest) -> DataFrame:
    """(rep, sig): a long signature, one byte a value, of the sets of ``reps``."""

    def run(batch: pa.RecordBatch) -> dict:
        members = byte_slices(batch.column(1), np.uint64)
        signed = signatures(np.concatenate(members), np.cumsum([0, *map(len, members)]), p.fine_values).astype(np.uint8)
        return {"rep": batch.column(0), "sig": pa.array([s.tobytes() for s in signed], pa.binary())}

    return map_arrow(sets.join(reps, "rep", "left_semi"), run, "rep long, sig binary")


def _mixed(wide: DataFrame) -> DataFrame:
    """The rows of regions that are not one group."""
    labels = wide.groupBy("region").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    return attach(wide, labels.select("region"), ["region"], "left_semi")


def _strays(wide: DataFrame, p: Forest) -> DataFrame:
    """Rows of regions that were divided, dealt again so that each row outside of its region's
    largest group meets every row of the region.

    Blocks of such rows meet blocks of all rows, both bounded; nothing is done where a region is one group.
    """
    sizes = wide.groupBy("region", "label").agg(F.count(F.lit(1)).alias("c"))
    main = sizes.groupBy("region").agg(F.max(F.struct("c", "label")).alias("x"), F.sum("c").alias("all"))
    mine = F.ceil((F.col("all") - F.col("x.c")) / (p.region * p.spread)).cast("int")
    main = main.where(F.col("all") > F.col("x.c")).select("region", F.col("x.label").alias("main"), mine.alias("groups"))
    rows = attach(wide, main, ["region"]).withColumn("blocks", F.ceil(F.col("parts") / p.spread).cast("int"))
    rows = rows.withColumn("block", F.pmod("part", F.col("blocks")))
    every = rows.withColumn("outer", F.lit(False)).withColumn("mine", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    ahead = rows.where("label <> main").withColumn("mine", F.pmod(F.xxhash64("region", "rep"), F.col("groups")).cast("int"))
    ahead = ahead.withColumn("outer", F.lit(True)).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    both = every.unionByName(ahead, allowMissingColumns=True)
    return both.withColumn("part", F.col("mine").cast("long") * F.col("blocks") + F.col("block")).select("region", "part", "rep", "n", "label", "outer", "sig")


def confirm(pairs: DataFrame, sets: DataFrame, p: Forest) -> DataFrame:
    """The rows of ``pairs`` (a, b, ...) with 100 * intersection >= percent * union, counted on full sets."""
    one = sets.select(F.col("rep").alias("a"), F.col("members").alias("of_a"))
    two = sets.select(F.col("rep").alias("b"), F.col("members").alias("of_b"))
    names = pairs.columns
    both = pairs.join(one, "a").join(two, "b").select(*names, "of_a", "of_b")

    def run(batch: pa.RecordBatch) -> dict:
        sides = (byte_slices(batch.column(c), np.uint64) for c in ("of_a", "of_b"))
        keep = pa.array([similar(x, y, p.percent) for x, y in zip(*sides)])
        return {n: batch.column(n).filter(keep) for n in names}

    return map_arrow(both, run, pairs.schema)


def near_duplicates(docs: DataFrame, p: Forest = Forest(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id (long), n_shingles, component_id, kept.

    Rows with equal sets form a class (128 bits of hash and the size agree) and are linked through
    its smallest id. Classes meet in the regions of the forest. First each class is linked with its
    likeliest partner; then the pairs of a region that still lie in different groups are confirmed
    too, where the region's part is. At last, in regions that were divided, rows still outside of the
    main group are compared with all rows that agree in the first values, wherever these went. No pairs
    leave a task but links between groups, so a large group of copies costs its rows, not their square.

    Empty sets are linked with nothing. Repeated rows are kept, each with its group; rows of one id with
    different texts are one document, near to what any of them is near to. A NULL id is
    grouped with equal sets only, and with no id among them its component_id is NULL and it is kept.
    An empty table gives an empty result; other columns are not carried.
    """
    sketched = stage(sketches(docs, key, text, p), "sketches")
    same = ["n", "lo", "hi"]
    reps = stage(sketched.where("n > 0").groupBy(*same).agg(F.min("doc_id").alias("rep")), "classes")
    members = stage(
        sketched.join(reps, same, "left").withColumn("rep", F.when(F.col("n") > 0, F.col("rep")).otherwise(F.col("doc_id"))),
        "members",
    )
    classes = members.where("n > 0 and doc_id = rep").dropDuplicates(["rep", *same])
    placed = stage(regions(classes, p), "regions")
    short = classes.select("rep", "n", F.concat(*[F.substring("sig", 4 * i + 1, 1) for i in range(p.values)]).alias("sig"))
    located = placed.join(short, "rep").withColumn("label", F.col("rep"))
    partner = _likely(located, p).groupBy("a").agg(F.max(F.struct("equal", (-F.col("b")).alias("b"))).alias("x"))
    partner = stage(partner.select("a", (-F.col("x.b")).alias("b")), "partners")
    wide = stage(_wide(placed, p), "wide")
    ids = partner.select(F.col("a").alias("rep")).union(partner.select(F.col("b").alias("rep"))).union(wide.select("rep")).distinct()
    sets = stage(_sets(docs, ids, key, text, p), "sets")
    pairs = partner.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    groups = [components(confirm(pairs, sets, p).union(_same_id(members)))]
    rest = _relabel(located, "label", groups).withColumn("outer", F.lit(True))
    groups.append(components(_links_inside(rest, sets, p, p.values, p.estimate)))
    wide = wide.join(classes.select("rep", "n"), "rep").withColumn("label", F.col("rep"))
    mixed = stage(_mixed(_relabel(wide, "label", groups)), "mixed")
    fine = stage(_fine(mixed.select("rep").distinct(), sets, p), "fine")
    strays = _strays(mixed.join(fine, "rep"), p)
    groups.append(components(_links_inside(strays, sets, p, p.fine_values, p.fine_estimate)))
    out = _relabel(members.withColumn("component_id", F.col("rep")), "component_id", groups)
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _same_id(members: DataFrame) -> DataFrame:
    """(a, b): links of the classes that one id has rows in."""
    rows = members.where("n > 0 and doc_id is not null")
    several = rows.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("doc_id", "a")
    return rows.join(several, "doc_id").select("a", F.col("rep").alias("b")).where("a < b").distinct()


def _relabel(rows: DataFrame, column: str, groups: list[DataFrame]) -> DataFrame:
    """``column`` replaced by its component, one grouping after the other."""
    for g in groups:
        named = g.select(F.col("node").alias(column), F.col("component").alias("_group"))
        rows = rows.join(named, column, "left").withColumn(column, F.coalesce("_group", column)).drop("_group")
    return rows


def _sets(docs: DataFrame, ids: DataFrame, key: str, text: str, p: Forest) -> DataFrame:
    """(rep, members): the sorted full set, as bytes, of each text that an id in ``ids`` has."""
    ids = ids.withColumn("h", F.xxhash64("rep"))
    map_ = bitmap(ids, "h", p.bits)
    rows = docs.select(F.col(key).cast("long").alias("rep"), F.col(text).alias("text")).withColumn("h", F.xxhash64("rep"))

    def pick(batch: pa.RecordBatch) -> dict:
        keep = pa.array(marked(map_, batch.column(2).to_numpy().view(np.uint64)))
        return {"rep": batch.column(0).filter(keep), "text": batch.column(1).filter(keep)}

    rows = map_arrow(rows, pick, "rep long, text string").join(ids.drop("h"), "rep", "left_semi").distinct()

    def run(batch: pa.RecordBatch) -> dict:
        blobs = []
        for part in slices(byte_texts(batch.column(1))):
            values, offsets = shingle_sets(part, p.words)
            blobs += [values[s:e].tobytes() for s, e in zip(offsets[:-1], offsets[1:])]
        return {"rep": batch.column(0), "members": pa.array(blobs, pa.binary())}

    return map_arrow(rows, run, "rep long, members binary")
