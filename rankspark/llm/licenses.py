"""Licence scans: lines, whole texts and passages against templates, by word bigrams.

Texts and templates are lower-cased (A-Z) and cut into words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`.
The Dice coefficient of two sets of bigrams is 2 |A and B| / (|A| + |B|).  It reaches ``t`` only
if |A| lies between |B| t / (2 - t) and |B| (2 - t) / t, so a text is compared only with
templates of such sizes.  Passages are all runs of words whose bigrams are no more than that,
across line breaks or within a line; those with enough bigrams of a template are tried.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rankspark.llm import words as W

DICE = 0.8
#: Most words of all templates together, as they are sent to every worker.
TEMPLATE_WORDS = 1_000_000
_CELLS = 1 << 20  # bigrams of passages compared at a time

#: Notices and short texts of public licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice "
        "appear in all copies."
    ),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions:"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
        "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}


def _bigrams(c: W.Chunk, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit, name) of the different bigrams of neighbouring words of one unit."""
    prefix = W.prefix_hashes(c.names())
    at = np.flatnonzero(unit[1:] == unit[:-1]) if len(unit) else np.zeros(0, np.int64)
    name = W.span_hash(prefix, at, at + 2)
    order = np.lexsort((name, unit[at]))
    own, name = unit[at][order], name[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (name[1:] != name[:-1])
    return own[new], name[new]


class _Templates:
    def __init__(self, templates: Mapping[str, str], dice: float) -> None:
        self.names = sorted(templates)
        chunks = list(W.chunks(pa.array([templates[n] for n in self.names], pa.large_string()), W.ALNUM, lower=True))
        owners, names = [], []
        for c in chunks:
            doc = np.repeat(np.arange(len(c)), np.diff(c.first))
            own, name = _bigrams(c, doc)
            owners.append(own + c.row)
            names.append(name)
        owner, name = np.concatenate(owners), np.concatenate(names)
        order = np.argsort(name, kind="stable")
        self.owner, self.name = owner[order], name[order]
        self.size = np.bincount(owner, minlength=len(self.names))
        self.low, self.high = self.size * dice / (2 - dice), self.size * (2 - dice) / dice
        self.dice = dice

    def best(self, unit: np.ndarray, name: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(unit, template, coefficient) of all pairs that reach the threshold."""
        size = np.bincount(unit, minlength=n)
        fits = np.zeros(n, bool)
        for low, high in zip(self.low, self.high, strict=True):
            fits |= (size >= low) & (size <= high)
        fits &= size > 0
        use = fits[unit]
        unit, name = unit[use], name[use]
        a, b = np.searchsorted(self.name, name, "left"), np.searchsorted(self.name, name, "right")
        times = b - a
        pair = np.repeat(unit, times)
        step = np.arange(len(pair)) - np.repeat(np.cumsum(times) - times, times)
        template = self.owner[np.repeat(a, times) + step]
        near = (size[pair] >= self.low[template]) & (size[pair] <= self.high[template])
        key, both = np.unique(pair[near] * len(self.names) + template[near], return_counts=True)
        pair, template = np.divmod(key, len(self.names))
        dice = 2 * both / (size[pair] + self.size[template])
        good = dice >= self.dice
        return pair[good], template[good], dice[good]


@dataclass
class _Run:
    """The bigrams of a chunk as they stand, and what passages of them need."""

    name: np.ndarray
    word: np.ndarray  # the first word of each
    end: np.ndarray  # where the bigrams of its text end
    before: np.ndarray  # where the same bigram stood before, or -1

    @classmethod
    def of(cls, c: W.Chunk) -> _Run:
        doc = np.repeat(np.arange(len(c)), np.diff(c.first))
        word = np.flatnonzero(doc[1:] == doc[:-1])
        name = W.span_hash(W.prefix_hashes(c.names()), word, word + 2)
        order = np.argsort(name, kind="stable")
        before = np.full(len(name), -1)
        again = np.flatnonzero(name[order][1:] == name[order][:-1])
        before[order[again + 1]] = order[again]
        return cls(name, word, np.searchsorted(doc[word], doc[word], "right"), before)


def _passages(run: _Run, known: _Templates) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(template, first, last bigram, coefficient): from each start the passage that comes closest.

    Passages begin and end with bigrams of the template, as the others come closer without
    their ends.  Those of more bigrams than ``high`` hold others that are not the template's.
    """
    at = np.minimum(np.searchsorted(known.name, run.name), len(known.name) - 1)
    hit = np.flatnonzero(known.name[at] == run.name)
    for template in np.flatnonzero(known.size):
        own = np.sort(known.name[known.owner == template])
        place = np.minimum(np.searchsorted(own, run.name[hit]), len(own) - 1)
        here = hit[own[place] == run.name[hit]]
        length = int(known.high[template])
        inside = np.zeros(len(run.name) + 1, bool)
        inside[here] = True
        near = np.searchsorted(here, np.minimum(here + length, run.end[here])) - np.arange(len(here))
        start = here[near >= known.low[template] - 1e-9]
        rows = max(1, _CELLS // length)
        for k in range(0, len(start), rows):
            s = start[k : k + rows, None]
            cell = s + np.arange(length)
            within = cell < run.end[s]
            cell = np.where(within, cell, len(run.name) - 1)
            new = within & (run.before[cell] < s)
            shared = np.cumsum(new & inside[cell], axis=1)
            dice = np.where(within, 2 * shared / (np.cumsum(new, axis=1) + len(own)), 0)
            best = dice.argmax(axis=1)
            value = dice[np.arange(len(best)), best]
            good = value >= known.dice
            yield int(template), s[good, 0], (s[:, 0] + best)[good], value[good]


def _lines(c: W.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The line of each word; of each line its number in its text, from 1, and its text."""
    starts = np.union1d(c.offset[:-1], np.flatnonzero(c.data == 0x0A) + 1)
    of = np.searchsorted(c.offset, starts, "right") - 1
    number = np.arange(len(starts)) - np.searchsorted(starts, c.offset[of]) + 1
    return np.searchsorted(starts, c.start, "right") - 1, number, of


def _closer(
    c: W.Chunk, known: _Templates, line: np.ndarray, number: np.ndarray, of: np.ndarray, top: np.ndarray, found: list
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, line, template, coefficient) of passages that come closer than what was found."""
    run = _Run.of(c)
    n = len(known.names)
    least = np.zeros(len(c) * n)
    for pair, _, template, value in found:
        np.maximum.at(least, pair * n + template, value)
    keys, lines, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for template, first, last, value in _passages(run, known):
        begin, end = line[run.word[first]], line[run.word[last] + 1]
        key = of[begin] * n + template
        use = ((begin != end) | (value > top[begin])) & (value > least[key])
        keys.append(key[use])
        lines.append(number[begin[use]])
        values.append(value[use])
    key, at, value = np.concatenate(keys), np.concatenate(lines), np.concatenate(values)
    order = np.lexsort((at, -value, key))
    key, head = np.unique(key[order], return_index=True)
    return key // n, at[order][head], key % n, value[order][head]


_RESULT = "doc_id long, license string, dice double, line int, n_matches long"


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, dice: float = DICE) -> DataFrame:
    """(doc_id, text) -> doc_id, license, dice, line, n_matches, one row per input row.

    Compared are the whole text (line 0), each line (from 1), and passages: runs of words across
    lines, or within a line if they come closer than that line does to any template.  Of a
    template's passages in a text the closest counts, with the line where it begins, and only if
    it comes closer than the whole text and every line.  ``license`` names the template that
    comes closest, if any reaches ``dice``: the highest coefficient, then the first line, then
    passages before others, by the size of their templates, then the first name.
    ``n_matches`` counts pairs of a template and a text, line or passage that reach it.  Null texts, and texts of fewer than two words, match nothing; an
    empty table gives no rows; other columns are ignored.
    """
    if not 0 < dice <= 1:
        raise ValueError("the threshold must lie above 0 and up to 1")
    if sum(len(t) for t in templates.values()) > 6 * TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {TEMPLATE_WORDS} words")
    if not templates:
        raise ValueError("no templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Templates(templates, dice)
        for batch in batches:
            for c in W.chunks(batch.column(1), W.ALNUM, lower=True):
                doc = np.repeat(np.arange(len(c)), np.diff(c.first))
                line, number, of = _lines(c)
                pair, template, value = known.best(*_bigrams(c, doc), len(c))
                found = [(pair, np.zeros(len(pair), np.int64), template, value)]
                top = np.zeros(len(number))
                pair, template, value = known.best(*_bigrams(c, line), len(number))
                found.append((of[pair], number[pair], template, value))
                np.maximum.at(top, pair, value)
                found.append(_closer(c, known, line, number, of, top, found))
                passage = np.repeat([0, 0, 1], [len(x[0]) for x in found])
                own, at, template, value = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.lexsort((template, -passage * known.size[template], at, -value, own))
                own, at, template, value = own[order], at[order], template[order], value[order]
                head, place, count = np.unique(own, return_index=True, return_counts=True)
                chosen, n_matches = np.full(len(c), -1), np.zeros(len(c), np.int64)
                chosen[head], n_matches[head] = place, count
                none = chosen < 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[c.row : c.row + len(c)],
                        pa.array([None if k < 0 else known.names[template[k]] for k in chosen], pa.string()),
                        pa.array([None if k < 0 else value[k] for k in chosen], pa.float64()),
                        pa.array(np.where(none, 0, at[chosen] if len(at) else 0).astype(np.int32), mask=none),
                        pa.array(n_matches),
                    ],
                    ["doc_id", "license", "dice", "line", "n_matches"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _RESULT)

