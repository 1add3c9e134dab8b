"""License notices in texts by an exact set-similarity join with templates.

A template's distinct words stand in order of their frequency in all documents,
rarest first. A text block that holds at least ``need`` of a template's n words
must hold one of the first n - need + 1 (prefix filter), must have ``need`` words
itself (length filter), and once its rarest common word is known to be the i-th,
at most n - i words can be common (positional filter). Blocks that pass are
compared in full, so every block that meets the threshold is found and no other.

Blocks are lines, cut where they are long, and besides, for each template, every
run of words up to twice its length, whatever line ends stand in it: a notice
wrapped over lines is found like one on a single line.

Like templates meet the same blocks. A match is told, so it names a license, if it holds a word that no
other license's template has, and no overlapping match explains all its words and more of them.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases whose words must stand one after the other, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices by label, as their licenses word them.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the GNU Lesser General Public License"),
    ("agpl", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("agpl", "under the GNU Affero General Public License"),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "the author has waived all copyright and related or neighboring rights to this work"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-3-clause", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 or c == 10 else 32 for c in range(256))


@dataclass(frozen=True)
class Scan:
    """Parameters: share of a template's words a block must hold; a line longer
    than ``window`` words is cut into windows of that many, each starting half a window on."""

    templates: Sequence[tuple[str, str]] = TEMPLATES
    phrases: Mapping[str, str] | None = None
    threshold: float = 0.8
    window: int = 64


def lines_of(text: str | None) -> list[list[bytes]]:
    """Words of each line: A-Z lower-cased, runs of ASCII letters and digits and of non-ASCII characters."""
    return [line.split() for line in (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split(b"\n")]


def _words(text: str) -> list[bytes]:
    return [w for line in lines_of(text) for w in line]


def word_counts(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """How often each word of a bounded vocabulary stands in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                total.update(w for line in lines_of(text.as_py()) for w in line if w in vocabulary)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["word", "n"]
        )

    counted = docs.select(F.col("text").cast("string")).mapInArrow(count, "word binary, n long")
    return {bytes(r["word"]): r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


@dataclass(frozen=True)
class _Index:
    prefix: dict[bytes, list[tuple[int, int]]]  # word -> (template, position)
    ordered: list[list[bytes]]  # distinct words of each template, rarest first
    need: list[int]
    labels: list[str]
    widths: list[int]  # words of the longest run compared with each template
    own: list[set[bytes]]  # its words that no template of another label has; all if there are none


def _index(scan: Scan, counts: Mapping[bytes, int]) -> _Index:
    ordered, need, labels, widths = [], [], [], []
    prefix: dict[bytes, list[tuple[int, int]]] = {}
    for label, text in scan.templates:
        tokens = sorted(set(_words(text)), key=lambda w: (counts.get(w, 0), w))
        least = math.ceil(scan.threshold * len(tokens) - 1e-9)
        for position in range(len(tokens) - least + 1):
            prefix.setdefault(tokens[position], []).append((len(ordered), position))
        ordered.append(tokens)
        need.append(least)
        labels.append(label)
        widths.append(2 * len(_words(text)))
    others = [{w for tokens, x in zip(ordered, labels) if x != label for w in tokens} for label in labels]
    own = [set(tokens) - other or set(tokens) for tokens, other in zip(ordered, others)]
    return _Index(prefix, ordered, need, labels, widths, own)


def _block_matches(block: set[bytes], index: _Index) -> Iterator[tuple[int, float]]:
    """Templates the block meets, with their containment."""
    first: dict[int, int] = {}  # template -> position of its rarest word in the block
    for word in block.intersection(index.prefix):
        for template, position in index.prefix[word]:
            first[template] = min(position, first.get(template, position))
    for template, position in first.items():
        tokens, need = index.ordered[template], index.need[template]
        if len(block) < need or len(tokens) - position < need:
            continue
        both = sum(w in block for w in tokens[position:])
        if both >= need:
            yield template, both / len(tokens)


Match = tuple[int, int, int]  # template, first word, end


def _blocks(lines: list[list[bytes]], index: _Index, window: int) -> Iterator[Match]:
    """The blocks of lines that meet a template."""
    start = 0
    for line in lines:
        if len(line) <= window:
            cuts = [(0, len(line))]
        else:
            cuts = [(i, min(i + window, len(line))) for i in range(0, len(line) - window // 2, window // 2)]
        if not index.prefix.keys().isdisjoint(line):
            for low, high in cuts:
                for template, _ in _block_matches(set(line[low:high]), index):
                    yield template, start + low, start + high
        start += len(line)


def _runs(flat: list[bytes], index: _Index, told: bool) -> Iterator[Match]:
    """The runs of words that meet a template, over line ends too; ``told``: and hold one of its own words.

    Of runs that overlap, the one with most of the template's words counts; of
    equals the one that ends first, then the shortest.
    """
    for template, _ in _block_matches(set(flat), index):  # the words must stand somewhere before they can stand together
        tokens = set(index.ordered[template])
        places = [i for i, w in enumerate(flat) if w in tokens]
        own = index.own[template] if told else tokens
        for first, end, _ in _best_runs(flat, places, index.widths[template], index.need[template], own):
            yield template, first, end


def _shared(match: Match, flat: list[bytes], index: _Index) -> set[bytes]:
    template, first, end = match
    return set(flat[first:end]).intersection(index.ordered[template])


def _named(found: Iterable[Match], flat: list[bytes], index: _Index) -> list[tuple[str, int, int, float]]:
    """(label, first word, end, containment) of each match."""
    return sorted(
        (index.labels[match[0]], match[1], match[2], len(_shared(match, flat, index)) / len(index.ordered[match[0]])) for match in found
    )


def _told(found: Iterable[Match], flat: list[bytes], index: _Index) -> Iterator[Match]:
    """Of blocks or of runs the matches with one of the template's own words that no overlapping match of another label beats.

    A match beats another whose shared words it shares too, if they are more or a larger part of its template.
    """
    rows = []
    for match in sorted(set(found), key=lambda m: (m[1], m[2], m[0])):
        shared = _shared(match, flat, index)
        rows.append((match, shared, (len(shared), len(shared) / len(index.ordered[match[0]]))))
    longest = max((match[2] - match[1] for match, _, _ in rows), default=0)
    firsts = [match[1] for match, _, _ in rows]
    for (template, first, end), shared, strength in rows:
        if index.own[template].isdisjoint(shared):
            continue
        near = rows[bisect_left(firsts, first - longest) : bisect_left(firsts, end)]
        if not any(
            other[2] > first and rank > strength and index.labels[other[0]] != index.labels[template] and shared <= more
            for other, more, rank in near
        ):
            yield template, first, end


def _best_runs(flat: list[bytes], places: list[int], width: int, need: int, own: set[bytes]) -> Iterator[tuple[int, int, int]]:
    """(first, end, distinct words) of runs apart from each other, best first; ``places`` are those of a template's words."""
    runs, left, inside = [], 0, Counter()
    for place in places:
        inside[flat[place]] += 1
        while place - places[left] >= width or inside[flat[places[left]]] > 1:
            inside[flat[places[left]]] -= 1
            if not inside[flat[places[left]]]:
                del inside[flat[places[left]]]
            left += 1
        if len(inside) >= need and not own.isdisjoint(inside):
            runs.append((-len(inside), place + 1, -places[left]))
    heapify(runs)
    taken: list[tuple[int, int]] = []  # (end, first), ascending
    while runs:
        both, end, first = heappop(runs)
        both, first = -both, -first
        after = bisect_left(taken, (end, -1))
        if after < len(taken) and taken[after][1] < end:  # it ends in a better run
            continue
        low = taken[after - 1][0] if after else 0
        if first >= low:
            insort(taken, (end, first))
            yield first, end, both
            continue
        seen: set[bytes] = set()  # what is left of it after the better run before
        for place in reversed(places[bisect_left(places, low) : bisect_left(places, end)]):
            if flat[place] not in seen:
                seen.add(flat[place])
                first = place
        if len(seen) >= need and not own.isdisjoint(seen):
            heappush(runs, (-len(seen), end, -first))


def phrase_places(lines: list[list[bytes]], phrases: Mapping[tuple[bytes, ...], str]) -> list[tuple[int, str]]:
    """(first word, label) wherever a phrase's words stand one after the other, over line ends too."""
    flat = [w for line in lines for w in line]
    last_words: dict[bytes, list[tuple[bytes, ...]]] = {}
    for phrase in phrases:
        last_words.setdefault(phrase[-1], []).append(phrase)
    places = []
    for last, candidates in last_words.items():
        at = -1
        for _ in range(flat.count(last)):
            at = flat.index(last, at + 1)
            for phrase in candidates:
                begin = at - len(phrase) + 1
                if begin >= 0 and tuple(flat[begin : at + 1]) == phrase:
                    places.append((begin, phrases[phrase]))
    return sorted(places)


_FOUND = "struct<n_words:long,places:array<struct<word:long,label:string>>,blocks:array<struct<label:string,first:long,end:long,containment:double>>,notices:array<struct<label:string,first:long,end:long,containment:double>>,decided:array<struct<label:string,first:long,end:long,containment:double>>>"


def scanned(docs: DataFrame, scan: Scan = Scan()) -> DataFrame:
    """``docs`` (text, ...) with n_words, places (phrase starts), blocks (template
    matches of lines), notices (template matches of runs of words over line ends) and
    decided (of both, those that tell the license, see above; the others only say that there is a notice).

    Whole texts are read. Null and empty texts have no words and empty lists.
    Columns of the names added are replaced, other columns stay, repeated rows
    get equal results, an empty table stays empty. What reaches the driver is one
    count per template word; index and phrases sent to the tasks are as small as the templates.
    """
    vocabulary = {w for _, text in scan.templates for w in _words(text)}
    index = _index(scan, word_counts(docs, vocabulary))
    phrases = {tuple(_words(p)): label for p, label in (PHRASES if scan.phrases is None else scan.phrases).items()}
    window = scan.window

    @F.arrow_udf(_FOUND)
    def find(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts:
            lines = lines_of(text.as_py())
            flat = [w for line in lines for w in line]
            blocks, runs = list(_blocks(lines, index, window)), list(_runs(flat, index, False))
            told = {*_told(blocks, flat, index), *(_told(_runs(flat, index, True), flat, index) if runs else ())}
            rows.append(
                {
                    "n_words": len(flat),
                    "places": [{"word": w, "label": x} for w, x in phrase_places(lines, phrases)],
                    **{
                        name: [{"label": x, "first": a, "end": b, "containment": c} for x, a, b, c in _named(found, flat, index)]
                        for name, found in (("blocks", blocks), ("notices", runs), ("decided", told))
                    },
                }
            )
        place = pa.struct([("word", pa.int64()), ("label", pa.string())])
        block = pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())])
        kinds = [("n_words", pa.int64()), ("places", pa.list_(place)), ("blocks", pa.list_(block)), ("notices", pa.list_(block))]
        kinds.append(("decided", pa.list_(block)))
        return pa.array(rows, pa.struct(kinds))

    kept = docs.drop("n_words", "places", "blocks", "notices", "decided")
    return kept.withColumn("_found", find(F.col("text").cast("string"))).select(*kept.columns, "_found.*")
