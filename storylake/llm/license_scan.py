"""License scans: MinHash bands over overlapping windows, then exact containment.

A text is cut into blocks; neighbouring blocks form overlapping windows, in one size class for
each power of two, so that every run of words as long as a template lies whole in a window of
its class.  Templates whose MinHash agrees with a window's in any band are candidates; the
number of bands is set from the least similarity that such a window can have, for a miss
probability of MISS at most.  Candidates are verified on word shingles.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storylake.llm.support import mix, text_chunks, word_hashes, word_spans

#: Words of a shingle.
SHINGLE = 3

#: Probability that the bands miss a template that stands whole in a text.
MISS = 1e-6

# Public license notices, as (license, notice).
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy "
        "of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version",
    ),
    ("GPL-2.0", "licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    ("MPL-2.0", "subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted",
    ),
)

#: Bytes between words here: all ASCII but letters and digits.
_GAPS = np.zeros(256, dtype=bool)
_GAPS[:128] = True
_GAPS[48:58] = _GAPS[65:91] = _GAPS[97:123] = False
_WORD = re.compile(rb"[A-Za-z0-9\x80-\xff]+")


def words_of(text: str) -> list[bytes]:
    """ASCII letters, digits and all other characters make words; A-Z count as a-z."""
    return [w.lower() for w in _WORD.findall(text.encode("utf-8"))]


def shingles_of(words: Sequence[bytes]) -> set[tuple[bytes, ...]]:
    return {tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}


@dataclass(frozen=True)
class Template:
    number: int
    license: str
    shingles: frozenset
    places: dict[tuple[bytes, ...], list[int]]
    n_words: int


@dataclass(frozen=True)
class TemplateIndex:
    """Templates by size class (block length) and band value."""

    templates: tuple[Template, ...]
    bands: dict[int, int]  # bands of each block length
    found: dict[int, list[dict[int, list[int]]]]  # block length -> band -> value -> numbers
    seeds: np.ndarray


def _band_values(hashes: np.ndarray, seed: np.uint64) -> np.ndarray:
    values = (hashes ^ seed) * np.uint64(0x94D049BB133111EB)
    return (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def build_index(
    notices: Sequence[tuple[str, str]], miss: float = MISS, containment: float = 1.0
) -> TemplateIndex:
    """Index of templates of at least SHINGLE + 1 words, for windows of that containment."""
    templates = []
    for number, (name, text) in enumerate(notices):
        words = words_of(text)
        if len(words) <= SHINGLE:
            raise ValueError(f"notice {number} has fewer than {SHINGLE + 1} words")
        places: dict[tuple[bytes, ...], list[int]] = {}
        for i in range(len(words) - SHINGLE + 1):
            places.setdefault(tuple(words[i : i + SHINGLE]), []).append(i)
        templates.append(Template(number, name, frozenset(places), places, len(words)))
    bands: dict[int, int] = {}
    for t in templates:
        block = _block_length(t.n_words)
        # A window has the shingles that begin in three blocks, that share of the template's
        # among them.
        lost = math.floor((1 - containment) * (t.n_words - SHINGLE + 1))
        least = max(1, len(t.shingles) - lost) / (3 * block)
        need = math.ceil(math.log(miss) / math.log(1 - min(least, 0.999)))
        bands[block] = max(bands.get(block, 1), need)
    seeds = mix(np.arange(1, max(bands.values(), default=1) + 1, dtype=np.uint64) * np.uint64(977))
    found: dict[int, list[dict[int, list[int]]]] = {b: [{} for _ in range(n)] for b, n in bands.items()}
    for t, (_, text) in zip(templates, notices):
        raw = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
        hashes = _shingle_hashes(word_hashes(raw, np.array([0, len(raw)]), _GAPS)[0])
        block = _block_length(t.n_words)
        for band in range(bands[block]):
            value = int(_band_values(hashes, seeds[band]).min())
            found[block][band].setdefault(value, []).append(t.number)
    return TemplateIndex(tuple(templates), bands, found, seeds)


def _block_length(n_words: int) -> int:
    """Half the least power of two that holds the template: 2, 4, 8, ..."""
    return max(2, 1 << max(0, (n_words - 1).bit_length() - 1))


def _shingle_hashes(words: np.ndarray) -> np.ndarray:
    n = max(0, len(words) - SHINGLE + 1)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(SHINGLE):
        total += words[j : j + n] * np.uint64(2 * j + 3)
    return mix(total)


def _candidates(words: np.ndarray, rows: np.ndarray, index: TemplateIndex) -> set[tuple[int, int, int]]:
    """(row, first word of the window in the row, template) where a band agrees."""
    n = max(0, len(words) - SHINGLE + 1)
    if not n:
        return set()
    hashes = _shingle_hashes(words)
    row = rows[:n]
    whole = row == rows[SHINGLE - 1 :]
    first_of_row = np.searchsorted(rows, row)
    place = np.arange(n) - first_of_row
    hits: set = set()
    smallest = min(index.bands)
    # Blocks of the smallest length; larger ones are minima over neighbours.
    block = place // smallest
    new = np.ones(n, dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (block[1:] != block[:-1])
    begin = np.flatnonzero(new)
    top = np.uint64(2**64 - 1)
    for band in range(max(index.bands.values())):
        values = np.where(whole, _band_values(hashes, index.seeds[band]), top)
        least = np.minimum.reduceat(values, begin)
        b_row, b_place, length = row[begin], block[begin], smallest
        while length <= max(index.bands):
            if index.bands.get(length, 0) > band:
                # The window of block i reaches two blocks further within its row.
                window = least.copy()
                for step in (1, 2):
                    if len(least) > step:
                        near = b_row[step:] == b_row[:-step]
                        window[:-step] = np.where(
                            near, np.minimum(window[:-step], least[step:]), window[:-step]
                        )
                table = index.found[length][band]
                keys = np.fromiter(table, dtype=np.uint64, count=len(table))
                for i in np.flatnonzero(np.isin(window, keys)).tolist():
                    for number in table[int(window[i])]:
                        hits.add((int(b_row[i]), int(b_place[i]) * length, number))
            pair = b_place // 2
            fresh = np.ones(len(pair), dtype=bool)
            fresh[1:] = (b_row[1:] != b_row[:-1]) | (pair[1:] != pair[:-1])
            starts = np.flatnonzero(fresh)
            least = np.minimum.reduceat(least, starts)
            b_row, b_place, length = b_row[starts], pair[starts], length * 2
    return hits


def _alignment(window: Sequence[bytes], template: Template) -> tuple[float, int, int]:
    """Share of a template's shingles that stand in a window in order, words and place of the run.

    No word counts for two places of the template, so shingles that overlap there overlap in the
    window too, and others follow each other; of equal shares the shortest run, then the earliest.
    """
    # Shingles and first word of the best chain by its last shingle.
    chains: dict[tuple[int, int], tuple[int, int]] = {}
    best = (0, 0, 0)
    for i in range(len(window) - SHINGLE + 1):
        for j in template.places.get(tuple(window[i : i + SHINGLE]), ()):
            # The latest beginning gives the shortest run.
            before = chains.get((i - 1, j - 1), (0, i))
            for (i2, j2), chain in chains.items():
                if i2 <= i - SHINGLE and j2 <= j - SHINGLE and chain > before:
                    before = chain
            chains[i, j] = (before[0] + 1, before[1])
            best = max(best, (before[0] + 1, before[1] - i - SHINGLE, -before[1]))
    return best[0] / (template.n_words - SHINGLE + 1), -best[1], -best[2]


def scan_licenses(
    docs: DataFrame,
    notices: Sequence[tuple[str, str]] = NOTICES,
    containment: float = 0.9,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row and notice found in it: id, notice, license, containment, first_word,
    n_words.

    ``containment`` is the share of the notice's word shingles that stand in a window in their
    order; words inserted in a notice break only the shingles they part.  The best window found
    counts; ``first_word`` and ``n_words`` are place and length of the shortest run of it with
    that share, the earliest of equals.  A window of that containment is found but for a chance of
    MISS (which the bands set); a run of more words than the power of two that holds the notice
    may lie in no window whole.  Rows without a notice (null and empty texts too) give none;
    null ids and repeated rows are scanned like others; further columns are ignored.  Map-only;
    the templates, whose number is that of ``notices``, travel as a broadcast variable.
    """
    shared = docs.sparkSession.sparkContext.broadcast(build_index(notices, containment=containment))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            out: list[tuple] = []
            for start, data, ends in text_chunks(batch["text"]):
                words, rows = word_hashes(data, ends, _GAPS)
                hits = _candidates(words, rows, index)
                if not hits:
                    continue
                spans = word_spans(data, ends, _GAPS)
                best: dict[tuple[int, int], tuple[float, int, int]] = {}
                for row, at, number in sorted(hits):
                    template = index.templates[number]
                    first = int(np.searchsorted(rows, row)) + at
                    stop = min(first + 3 * _block_length(template.n_words), int(np.searchsorted(rows, row + 1)))
                    window = [
                        data[spans[0][i] : spans[1][i]].tobytes().lower() for i in range(first, stop)
                    ]
                    share, span, skip = _alignment(window, template)
                    # Most contained first, then the shortest, then the earliest.
                    rank = (-share, span, at + skip)
                    if share >= containment and rank < best.get((row, number), (0.0, 0, 0)):
                        best[row, number] = rank
                out += [(start + row, n, -rank[0], *rank[1:]) for (row, n), rank in best.items()]
            rows_, numbers, shares, spans_, firsts = zip(*out) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"].take(pa.array(rows_, pa.int64())),
                    pa.array(numbers, pa.int32()),
                    pa.array([index.templates[n].license for n in numbers], pa.string()),
                    pa.array(shares, pa.float64()),
                    pa.array(firsts, pa.int64()),
                    pa.array(spans_, pa.int64()),
                ],
                ["id", "notice", "license", "containment", "first_word", "n_words"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(
        run,
        f"id {kind}, notice int, license string, containment double, first_word long, n_words long",
    )
    return found.withColumnRenamed("id", id_col)
