"""Licence phrases and notices in texts, by a positional index of the rarest licence words.

How rare a licence word is, is counted over the whole corpus. Each template is indexed under its rarest
words, with their positions. A text's licence words are looked up, rarest first; words of one template
that stand at the same distances as in the template give a place, and there the template's mandatory
phrases and the share of its words decide.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvagrid.llm.common import byte_texts, folding, map_arrow, word_lists

WORDS = folding(digits=True)


@dataclass(frozen=True)
class Template:
    """A licence text. ``phrases`` must all stand near their place; without any, the text itself is one
    phrase. ``share`` of its words must be there."""

    label: str
    text: str
    phrases: tuple[str, ...] = ()
    share: float = 0.8
    base: bool = False


@dataclass(frozen=True)
class Scan:
    """Parameters: words a template is indexed under, how many of them must agree on a place, and by how
    many words places may differ."""

    rare: int = 4
    agree: int = 3
    slack: int = 6


#: Phrases that always label a text.
BASE = [
    Template("mit", "mit license", base=True),
    Template("apache", "apache license", base=True),
    Template("gpl", "general public license", base=True),
]
#: Openings and notices of public licences, with the phrases that tell them from others.
NOTICES = [
    Template("cc-by", "licensed under cc by"),
    Template("cc-by-nc", "licensed under cc by nc"),
    Template("cc-by", "creative commons attribution"),
    Template("mpl", "mozilla public license"),
    Template("lgpl", "lesser general public license"),
    Template("agpl", "affero general public license"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software",
        ("obtaining a copy of this software", "without restriction"),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
        ("source and binary forms", "must retain the above copyright notice"),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        ("for any purpose with or without fee", "appear in all copies"),
    ),
    Template(
        "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        ("in compliance with the license",),
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        ("redistribute it and or modify it", "published by the free software foundation"),
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain.",
        ("free and unencumbered software",),
    ),
]


def words_of(text: bytes) -> list[bytes]:
    return [w for part in word_lists(text, WORDS) for w in part]


@dataclass(frozen=True)
class Indexed:
    """A template as word numbers, its rarest words with their positions, its phrases with their places."""

    template: Template
    words: np.ndarray
    rare: list[tuple[int, np.ndarray]]
    phrases: list[tuple[int, np.ndarray, int]]
    counts: np.ndarray


class LicenseIndex:
    """All templates, indexed by words in order of rarity; its size is that of the templates."""

    def __init__(self, templates: list[Template], rarity: dict[bytes, float], p: Scan) -> None:
        self.p = p
        self.number = {w: i for i, w in enumerate(vocabulary(templates))}
        self.indexed = [self._index(t, rarity) for t in templates]
        self.anchors = np.zeros(len(self.number) + 1, bool)
        for t in self.indexed:
            self.anchors[[w for w, _ in t.rare]] = True

    def _index(self, t: Template, rarity: dict[bytes, float]) -> Indexed:
        listed = words_of(t.text.encode())
        words = np.array([self.number[w] for w in listed], np.int32)
        order = sorted(set(listed), key=lambda w: (-rarity[w], w))[: self.p.rare if t.phrases else 1]
        rare = [(self.number[w], np.flatnonzero(words == self.number[w])) for w in order]
        phrases = []
        for text in t.phrases:
            own = words_of(text.encode())
            at = next(i for i in range(len(listed)) if listed[i : i + len(own)] == own)
            anchor = min(range(len(own)), key=lambda i: (-rarity[own[i]], i))
            phrases.append((at, np.array([self.number[w] for w in own], np.int32), anchor))
        return Indexed(t, words, rare, phrases, np.bincount(words, minlength=len(self.number)))

    def scan(self, text: bytes) -> tuple[int, list[tuple[Template, np.ndarray, float]]]:
        """How many words a text has, and of each template in it the sorted places and the best share."""
        parts = [np.fromiter(map(self.number.get, w, repeat(-1)), np.int32, len(w)) for w in word_lists(text, WORDS)]
        ids = np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else np.zeros(0, np.int32)
        at = np.flatnonzero(ids >= 0)
        if not self.anchors[ids[at]].any():
            return len(ids), []
        at = at[np.argsort(ids[at], kind="stable")]
        limits = np.searchsorted(ids[at], np.arange(len(self.number) + 1))
        found = []
        for t in self.indexed:
            places, share = self._places(ids, at, limits, t)
            if len(places):
                found.append((t.template, places, share))
        return len(ids), found

    def _places(self, ids: np.ndarray, at: np.ndarray, limits: np.ndarray, t: Indexed) -> tuple[np.ndarray, float]:
        if not t.phrases:
            word, positions = t.rare[0]
            return _stands(ids, at[limits[word] : limits[word + 1]] - positions[0], t.words), 1.0
        starts = [np.sort((at[limits[w] : limits[w + 1], None] - positions).ravel()) for w, positions in t.rare]
        need = min(self.p.agree, len(starts))
        # if ``need`` of the words agree on a place, one of the first len - need + 1 is among them
        places = np.unique(np.concatenate([s[_votes(s, starts, self.p.slack) >= need] for s in starts[: len(starts) - need + 1]]))
        for offset, phrase, anchor in t.phrases:
            if len(places):
                there = _stands(ids, at[limits[phrase[anchor]] : limits[phrase[anchor] + 1]] - anchor, phrase)
                places = places[_near(places + offset, there, self.p.slack)]
        shares = np.array([self._share(ids, s, t) for s in places.tolist()])
        good = shares >= t.template.share
        return places[good], float(shares[good].max()) if good.any() else 0.0

    def _share(self, ids: np.ndarray, start: int, t: Indexed) -> float:
        window = ids[max(0, start - self.p.slack) : max(0, start + len(t.words) + self.p.slack)]
        have = np.bincount(window[window >= 0], minlength=len(t.counts))
        return int(np.minimum(have, t.counts).sum()) / len(t.words)


def _stands(ids: np.ndarray, starts: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Those starts at which all words of a phrase stand one after the other."""
    starts = starts[(starts >= 0) & (starts <= len(ids) - len(phrase))]
    for k, word in enumerate(phrase):
        starts = starts[ids[starts + k] == word]
    return starts


def _near(wanted: np.ndarray, sorted_: np.ndarray, slack: int) -> np.ndarray:
    i = np.searchsorted(sorted_, wanted - slack)
    return np.append(sorted_, np.iinfo(np.int64).max)[i] <= wanted + slack


def _votes(places: np.ndarray, starts: list[np.ndarray], slack: int) -> np.ndarray:
    return sum(_near(places, s, slack).astype(np.int64) for s in starts)


def vocabulary(templates: list[Template]) -> list[bytes]:
    return sorted({w for t in templates for w in words_of(t.text.encode())})


def license_rarity(docs: DataFrame, templates: list[Template], text: str = "text") -> dict[bytes, float]:
    """Inverse document frequency of each licence word over all texts; one row per word reaches the driver."""
    listed = vocabulary(templates)
    known = set(listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs_with: Counter[bytes] = Counter()
        n = 0
        for batch in batches:
            n += batch.num_rows
            for t in byte_texts(batch.column(0)):
                docs_with.update({w for part in word_lists(t, WORDS) for w in known.intersection(part)})
        words = [b"", *docs_with]  # the empty word stands for the number of texts
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([n, *docs_with.values()], pa.int64())], ["word", "n"])

    rows = docs.select(F.col(text).cast("string")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    n = {bytes(r["word"]): r["n"] for r in rows}
    return {w: math.log((n.get(b"", 0) + 1) / (n.get(w, 0) + 1)) for w in listed}


def scan_licenses(
    docs: DataFrame, templates: list[Template] | None = None, p: Scan = Scan(), key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lowered. ``n_base`` counts all places
    of base phrases, ``first_word`` and ``last_word`` are the smallest and largest of them (words from 0).
    ``labels`` also holds those of the notices found. ``score`` is the largest share of a template's words
    at a place of it, 1 for a phrase, 0 without any.

    NULL and empty texts have no words, no labels ('') and NULL places. Rows are independent: repeated rows
    and NULL ids are each scanned. An empty table gives an empty result. Other columns are not read.
    """
    templates = BASE + NOTICES if templates is None else templates
    index = LicenseIndex(templates, license_rarity(docs, templates, text), p)

    def run(batch: pa.RecordBatch) -> dict:
        out = []
        for t in byte_texts(batch.column(1)):
            n, found = index.scan(t)
            base = [(t, places) for t, places, _ in found if t.base]
            first = min((int(x[0]) for _, x in base), default=None)
            last = max((int(x[-1]) for _, x in base), default=None)
            labels = [",".join(sorted({t.label for t, *_ in x})) for x in (base, found)]
            out.append((n, sum(len(x) for _, x in base), first, last, *labels, max((s for *_, s in found), default=0.0)))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        return {"doc_id": batch.column(0)} | {n: pa.array(c, k) for n, c, k in zip(names, zip(*out), kinds)}

    schema = (
        f"doc_id {dict(docs.dtypes)[key]}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double"
    )
    return map_arrow(docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string")), run, schema)
