"""License scans: MinHash bands over text windows, then exact containment.

A template is the set of its five-word shingles (a shorter one is one shingle
of all its words).  Templates are sorted into size classes whose bounds grow
by a quarter.  For a class of up to S shingles the text is covered by windows
that start every t = max(1, S // 4) shingles and are long enough that any run
of S shingles lies inside one of them.  A window retrieves the templates that
agree with it on all MinHash values of a band, by a search in the band's sorted
keys, so its cost hardly follows the number of templates.

A run that holds at least ``CONTAINMENT`` of a template has a resemblance to
its window of at least ``least_resemblance(S)`` (0.39 to 0.67), and each class
has as many bands as that needs for a collision probability of ``GUARANTEE``.
Retrieved templates are then verified exactly: the share of the template's
shingles that stand in the window.

Templates are a parameter of the job (a short list, at most
``MOST_TEMPLATES``), so they travel with the task; the texts never move.

Defined cases: NULL and empty texts have no match; very long texts are
scanned whole, window by window; repeated rows match alike; an empty table
gives an empty result; a template that occurs several times is reported once
per separate place; columns other than the id and the text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from riskspark.sources.tables import table

from .catalog import query
from .decontamination import normal_words
from .words import mix, windows

SHINGLE = 5
CONTAINMENT = 0.8
#: One row per band: templates are few and every retrieval is verified, so
#: recall per hash counts for more than selectivity.
ROWS = 1
GUARANTEE = 0.999
MOST_TEMPLATES = 5_000

#: Usual notices of public licences.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT-licensed": "This project is licensed under the MIT License",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
    "You may obtain a copy of the License at",
    "GPL-3.0-notice": "GNU General Public License, version 3",
    "GPL-2.0-notice": "GNU General Public License, version 2",
    "LGPL-3.0-notice": "GNU Lesser General Public License, version 3",
    "LGPL-2.1-notice": "GNU Lesser General Public License, version 2.1",
    "AGPL-3.0-notice": "GNU Affero General Public License, version 3",
    # short enough that another version or kind leaves less than CONTAINMENT
    "GPL-3.0-or-later": "terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    "GPL-2.0-or-later": "terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
    "LGPL-3.0-or-later": "terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License",
    "LGPL-2.1-or-later": "terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
    "AGPL-3.0-or-later": "terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
    # all BSD licences open alike; then 2-Clause goes from its second clause to the disclaimer, 3-Clause has the names in between
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met",
    "BSD-2-Clause": "materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT",
    "BSD-3-Clause": "names of its contributors may be used to endorse or promote products derived from this software without specific prior written "
    "permission",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
    "above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "All-rights-reserved": "All rights reserved.",
}


def least_resemblance(most: int, containment: float = CONTAINMENT) -> float:
    """Least Jaccard resemblance of a window to a template of its class that it
    contains to the given share: the class's smallest template, a window full
    of other shingles (1 for a window of one shingle)."""
    smallest, step = most / 1.25 if most > 4 else most, max(1, most // 4)
    window = step * (-(-(most + step - 1) // step))
    if most == 1:
        return 1.0
    return containment * smallest / (window + (1 - containment) * smallest)


def collision_probability(resemblance: float, bands: int, rows: int = ROWS) -> float:
    return 1 - (1 - resemblance**rows) ** bands


def bands_for(resemblance: float, guarantee: float = GUARANTEE, rows: int = ROWS) -> int:
    """Least bands with ``collision_probability`` of at least ``guarantee``."""
    return 1 if resemblance >= 1 else max(1, ceil(log(1 - guarantee) / log(1 - resemblance**rows)))


@dataclass
class _Template:
    name: str
    shingles: np.ndarray  # sorted distinct hashes
    bands: np.ndarray  # one key per band


@dataclass
class _Class:
    """Templates of one shingle length (words) with up to ``most`` shingles."""

    length: int
    most: int
    bands: int
    members: list[_Template]

    def file(self) -> None:
        """Sorts the members' keys, band by band, for ``retrieve``."""
        table = np.array([t.bands for t in self.members])
        self.order = np.argsort(table, axis=0, kind="stable")
        self.sorted = np.take_along_axis(table, self.order, axis=0)

    def retrieve(self, band: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(member, window) wherever a window's key is a member's."""
        filed = self.sorted[:, band]
        low, high = np.searchsorted(filed, keys, "left"), np.searchsorted(filed, keys, "right")
        window = np.flatnonzero(high > low)
        n = (high - low)[window]
        place = np.repeat(low[window], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return self.order[place, band], np.repeat(window, n)

    @property
    def step(self) -> int:
        return max(1, self.most // 4)

    @property
    def chunks(self) -> int:
        """Steps per window."""
        return -(-(self.most + self.step - 1) // self.step)


def _factors(n: int) -> np.ndarray:
    """Odd multipliers; x * factor orders well-mixed hashes like a random permutation."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _band_key(minima: list[np.ndarray]) -> np.ndarray:
    key = minima[0]
    for low in minima[1:]:
        key = mix(key) ^ low
    return key


class _Windows:
    """Where a class's windows stand in the shingles of a batch of texts."""

    def __init__(self, kind: _Class, first: np.ndarray):
        step = kind.step
        per = -(-np.diff(first) // step)  # steps of each document, from its start
        ends = np.cumsum(per)
        self.start = np.repeat(first[:-1], per) + step * (np.arange(per.sum()) - np.repeat(ends - per, per))
        last = np.repeat(ends, per)
        here = np.arange(len(self.start))
        self.kind, self.cut = kind, np.flatnonzero(here + kind.chunks > last)  # windows cut short by the text's end
        self.room = (last - here)[self.cut]

    def minima(self, value: np.ndarray) -> np.ndarray:
        low = np.minimum.reduceat(value, self.start) if self.kind.step > 1 else value
        out = low.copy()
        for c in range(1, self.kind.chunks):
            np.minimum(out[:-c], low[c:], out=out[:-c])
        out[self.cut] = low[self.cut]
        for c in range(1, self.kind.chunks):
            inside = self.cut[self.room > c]
            out[inside] = np.minimum(out[inside], low[inside + c])
        return out


class Scanner:
    """Templates prepared for scanning; small and picklable."""

    def __init__(self, templates: dict[str, str], containment: float = CONTAINMENT, guarantee: float = GUARANTEE):
        if len(templates) > MOST_TEMPLATES:
            raise ValueError(f"more than {MOST_TEMPLATES} templates")
        self.containment = containment
        classes: dict[tuple[int, int], _Class] = {}
        for name, text in templates.items():
            words = normal_words(pa.array([text]))
            length = min(SHINGLE, len(words.hash))
            if not length:
                raise ValueError(f"template {name} has no words")
            shingles = np.unique(windows(words.hash, words.first, length)[1])
            most = self._bound(len(shingles))
            kind = classes.setdefault((length, most), _Class(length, most, bands_for(least_resemblance(most, containment), guarantee), []))
            lows = [np.array([(shingles * f).min()]) for f in _factors(kind.bands * ROWS)]
            keys = [_band_key(lows[b * ROWS : (b + 1) * ROWS])[0] for b in range(kind.bands)]
            kind.members.append(_Template(name, shingles, np.array(keys)))
        self.classes = [classes[k] for k in sorted(classes)]
        for kind in self.classes:
            kind.file()

    @staticmethod
    def _bound(n: int) -> int:
        """Smallest class bound that holds n shingles; bounds grow by a quarter."""
        bound = 1
        while bound < n:
            bound = max(bound + 1, bound * 5 // 4)
        return bound

    def scan(self, texts) -> list[list[tuple[str, float, int, int]]]:
        """(template, containment, first word, end word) of each text's matches."""
        words = normal_words(texts)
        out: list[list[tuple[str, float, int, int]]] = [[] for _ in range(len(words.count))]
        doc = words.doc()
        for length in sorted({c.length for c in self.classes}):
            at, h = windows(words.hash, words.first, length)
            if not len(h):
                continue
            first = np.searchsorted(doc[at], np.arange(len(words.count) + 1))
            places = [_Windows(c, first) for c in self.classes if c.length == length]
            found: list[set[tuple[int, int]]] = [set() for _ in places]
            factors = _factors(ROWS * max(p.kind.bands for p in places))
            for band in range(max(p.kind.bands for p in places)):
                values = [h * f for f in factors[band * ROWS : (band + 1) * ROWS]]
                for p, hits in zip(places, found, strict=True):
                    if band < p.kind.bands:
                        member, window = p.kind.retrieve(band, _band_key([p.minima(v) for v in values]))
                        hits.update(zip(member.tolist(), window.tolist(), strict=True))
            for p, hits in zip(places, found, strict=True):
                self._verify(p, hits, h, at, doc, first, words.first, out)
        return out

    def _verify(self, p: _Windows, hits, h, at, doc, first, first_word, out) -> None:
        size = p.kind.step * p.kind.chunks
        for m, group in _by_first(hits):
            template, last_doc = p.kind.members[m], -1
            for w in group:
                i = int(p.start[w])
                d = int(doc[at[i]])
                j = min(i + size, int(first[d + 1]))
                hit = np.flatnonzero(np.isin(h[i:j], template.shingles))
                share = len(np.unique(h[i:j][hit])) / len(template.shingles)
                if share < self.containment - 1e-12:
                    continue
                match = (template.name, share, int(at[i + hit[0]] - first_word[d]), int(at[i + hit[-1]] - first_word[d]) + p.kind.length)
                if d == last_doc and match[2] < out[d][-1][3]:  # the next window over the same place
                    if share > out[d][-1][1]:
                        out[d][-1] = match
                else:
                    out[d].append(match)
                last_doc = d


def _by_first(pairs: set[tuple[int, int]]):
    by: dict[int, list[int]] = {}
    for m, w in sorted(pairs):
        by.setdefault(m, []).append(w)
    return by.items()


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, **settings) -> DataFrame:
    """One row per match: id, license, containment, start_word, end_word
    (positions among the text's normal words)."""
    scanner = Scanner(TEMPLATES if templates is None else templates, **settings)
    names = [id_col, "license", "containment", "start_word", "end_word"]

    def run(batches):
        for batch in batches:
            step = max(1, batch.num_rows * (2 << 20) // max(1, batch.nbytes))
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                found = scanner.scan(part.column(text_col))
                rows = [(k, *f) for k, fs in enumerate(found) for f in fs]
                if not rows:
                    continue
                index, lic, share, a, b = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col).take(pa.array(index)), pa.array(lic), pa.array(share, pa.float64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names
                )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, license string, containment double, start_word long, end_word long")


@query("op1_license_scan")
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents."""
    return scan_licenses(table(spark, sf_dir, "documents"))
