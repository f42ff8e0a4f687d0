"""License scans: MinHash bands over text windows retrieve templates, shingles verify them.

Each template has its own window length: its words and a stride less one, so that a window
starting at a multiple of the stride holds any verbatim copy whole.  A window's shingles
(``SHINGLE`` words, or all of a shorter template) are sketched by ``BANDS`` bands of ``ROWS``
minimum hashes; a template that shares a band with a window is a candidate.  The bands retrieve
every window that holds ``REACH`` of a template's distinct shingles: their similarity is at
least ``least_similarity``, and the bands miss it with a chance below
``(1 - similarity ** ROWS) ** BANDS``, which ``prepare`` checks to be under ``MISS``.

A candidate is verified exactly, over the window and ``slack`` words on either side: a template
shingle at word p of the text and word q of the template speaks for a copy that begins at
p - q, and later if words were put in between.  Where shingles with such beginnings within
``slack`` of each other are ``CONTAINMENT`` of all, there is a copy; so a copy may be broken by a
page header, and each of several copies has a place of its own.

A window without any template shingle has nothing in common with a template, so only
windows around such shingles are sketched.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.llm.words import NOT_ALNUM, cut_words, pieces, window_hashes, word_hashes
from entityloom.llm.workers import map_batches

SHINGLE = 5
CONTAINMENT = 0.8
REACH = 0.5
ROWS = 2
BANDS = 224
MISS = 1e-6
SLACK = 24
CHUNK_WINDOWS = 4096

# Notices by which works name their license, and short licenses whole.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "This project is licensed under the Apache License 2.0",
    ],
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this'
        " file except in compliance with the License. You may obtain a copy of the License at"
    ),
    "MIT": [
        "Released under the MIT License.",
        "licensed under the MIT License",
        "The MIT License (MIT)",
    ],
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        ' software and associated documentation files (the "Software"), to deal in the Software'
        " without restriction, including without limitation the rights to use, copy, modify,"
        " merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "MIT-conditions": (
        "The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software."
    ),
    "MIT-disclaimer": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,'
        " INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR"
        " PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE"
        " FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR"
        " OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER"
        " DEALINGS IN THE SOFTWARE."
    ),
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies.",
        "licensed under the ISC License",
    ],
    "BSD-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met"
    ),
    "BSD-2-Clause": (
        "Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer. Redistributions in binary form must reproduce"
        " the above copyright notice, this list of conditions and the following disclaimer in the"
        " documentation and/or other materials provided with the distribution."
    ),
    "BSD-3-Clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to"
        " endorse or promote products derived from this software without specific prior written"
        " permission."
    ),
    "BSD-disclaimer": (
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY'
        " EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF"
        " MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    ),
    "GPL-2.0-notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation; either"
        " version 2 of the License, or (at your option) any later version."
    ),
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "licensed under the GNU GPLv3",
    ],
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version."
    ),
    "LGPL": "GNU Lesser General Public License",
    "LGPL-2.1-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms"
        " of the GNU Lesser General Public License as published by the Free Software Foundation;"
        " either version 2.1 of the License, or (at your option) any later version."
    ),
    "AGPL": "GNU Affero General Public License",
    "AGPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms"
        " of the GNU Affero General Public License as published by the Free Software Foundation,"
        " either version 3 of the License, or (at your option) any later version."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a"
        " copy of the MPL was not distributed with this file, You can obtain one at"
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to"
        " copy, modify, publish, use, compile, sell, or distribute this software, either in source"
        " code form or as a compiled binary, for any purpose, commercial or non-commercial, and by"
        " any means."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event"
        " will the authors be held liable for any damages arising from the use of this software."
    ),
    "CC0-1.0": "CC0 1.0 Universal Public Domain Dedication",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License"
    ),
    "CC-BY-SA-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International"
        " License"
    ),
    "all-rights-reserved": "All rights reserved.",
}

# Identifiers that stand behind "SPDX-License-Identifier:".
SPDX = (
    "0BSD AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0"
    " CC-BY-SA-4.0 CC0-1.0 EPL-2.0 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only"
    " GPL-3.0-or-later ISC LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only"
    " LGPL-3.0-or-later MIT MIT-0 MPL-2.0 Unlicense Zlib"
).split()


def catalogue_texts() -> dict[str, list[str]]:
    """All texts by name: the notices, and a line for each identifier, named ``SPDX:<identifier>``."""
    texts = {name: [t] if isinstance(t, str) else list(t) for name, t in TEMPLATES.items()}
    texts |= {f"SPDX:{name}": [f"SPDX-License-Identifier: {name}"] for name in SPDX}
    return texts


class Template(NamedTuple):
    name: str
    words: int
    stride: int
    span: int  # words of a window
    shingles: np.ndarray  # distinct, sorted
    places: np.ndarray  # the word at which each of them first begins

    @property
    def slack(self) -> int:
        """Words that may be put into a copy; fewer than it has, or two copies could be one."""
        return min(max(SLACK, self.words // 2), self.words - 1)


class Catalogue(NamedTuple):
    """The templates of one shingle length."""

    shingle: int
    templates: list[Template]
    factors: np.ndarray  # one multiplier for each minimum hash
    known: np.ndarray  # sorted shingles of all templates
    bands: list[np.ndarray]  # for each template, its bands' keys


def least_similarity(template: Template, shingle: int) -> float:
    """The smallest similarity of a template and a window that holds ``REACH`` of its shingles."""
    need = int(np.ceil(REACH * len(template.shingles) - 1e-9))
    window = template.span - shingle + 1
    return need / (window + len(template.shingles) - need)


def sketch(rows: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Band keys of windows given as rows of shingles: (windows, bands)."""
    lows = np.empty((len(rows), len(factors)), np.uint64)
    for i, factor in enumerate(factors):
        lows[:, i] = ((rows ^ (rows >> np.uint64(31))) * factor).min(axis=1)
    out = np.zeros((len(rows), len(factors) // ROWS), np.uint64)
    for r in range(ROWS):
        out = out * np.uint64(0x9E3779B97F4A7C15) + lows[:, r::ROWS]
    return out


def prepare(texts: dict[str, str | Sequence[str]] | None = None, seed: int = 9) -> list[Catalogue]:
    """License texts by name, one or several each, as catalogues; raises if the bands could
    miss too much."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(1, 2**63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    by_shingle: dict[int, list[Template]] = {}
    given = catalogue_texts() if texts is None else texts
    named = [(n, t) for n, ts in sorted(given.items()) for t in ([ts] if isinstance(ts, str) else ts)]
    for name, text in named:
        hashes = word_hashes(cut_words(pa.array([text]), NOT_ALNUM, lower=True))
        n = len(hashes)
        if not n:
            raise ValueError(f"{name}: a template needs a word")
        shingle, stride = min(SHINGLE, n), max(1, n // 8)
        parts, places = np.unique(window_hashes(hashes, shingle), return_index=True)
        template = Template(name, n, stride, n + stride - 1, parts, places)
        if (1 - least_similarity(template, shingle) ** ROWS) ** BANDS > MISS:
            raise ValueError(f"{name}: the bands miss more than {MISS}")
        by_shingle.setdefault(shingle, []).append(template)
    return [
        Catalogue(
            shingle,
            templates,
            factors,
            np.unique(np.concatenate([t.shingles for t in templates])),
            [sketch(t.shingles[None, :], factors)[0] for t in templates],
        )
        for shingle, templates in sorted(by_shingle.items())
    ]


def windows_of(
    near: np.ndarray, first: np.ndarray, last: np.ndarray, template: Template, shingle: int
):
    """Starts of the template's windows that hold any of the places ``near``.

    first, last: where the text of each place begins and ends.  Windows start at multiples of
    the stride from the text's beginning; a text shorter than a window is one window.
    """
    reach = template.span - shingle
    step = template.stride
    top = np.maximum(last - template.span - first, 0)
    top = -(-top // step)  # the last window may reach past the text's end
    low = np.maximum(-(-(near - reach - first) // step), 0)
    high = np.minimum((near - first) // step, top)
    count = np.maximum(high - low + 1, 0)
    ends = np.cumsum(count)
    inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count)
    starts = np.repeat(first + low * step, count) + inside * step
    starts, at = np.unique(starts, return_index=True)
    return starts, np.repeat(last, count)[at]


def scan(texts: pa.Array, catalogues: list[Catalogue]) -> list[tuple[int, str, int, int, float]]:
    """Every place of each license in each text: the text's number, the license's name, the
    first word, the words from the first to the last shingle held, and the share held.

    Places of one license do not overlap; of those that would, the one with more words held stays.
    """
    cut = cut_words(texts, NOT_ALNUM, lower=True)
    hashes = word_hashes(cut)
    found: dict[tuple[int, str], list[tuple[int, float, int, int]]] = {}
    for catalogue in catalogues:
        for template, text, start, end, held in copies(hashes, cut.first, catalogue):
            share = held / len(template.shingles)
            found.setdefault((text, template.name), []).append((-held, -share, start, end))
    rows = []
    for (text, name), places in found.items():
        taken: list[tuple[int, int]] = []
        for _, share, start, end in sorted(places):
            at = bisect_left(taken, (end,))
            if not at or taken[at - 1][1] <= start:
                insort(taken, (start, end))
                rows.append((text, name, start, end - start, -share))
    return sorted(rows)


def copies(hashes: np.ndarray, first_word: np.ndarray, catalogue: Catalogue):
    """Copies of each template: the text's number, first word, end and distinct shingles held."""
    shingle = catalogue.shingle
    rolled = window_hashes(hashes, shingle)
    if not len(rolled):
        return
    at = np.minimum(np.searchsorted(catalogue.known, rolled), len(catalogue.known) - 1)
    place = np.flatnonzero(catalogue.known[at] == rolled)
    doc = np.searchsorted(first_word, place, side="right") - 1
    inside = place + shingle <= first_word[doc + 1]
    place, doc = place[inside], doc[inside]
    for number, template in enumerate(catalogue.templates):
        at = np.minimum(np.searchsorted(template.shingles, rolled[place]), len(template.shingles) - 1)
        own = template.shingles[at] == rolled[place]
        if not own.any():
            continue
        here, where, spot = place[own], doc[own], template.places[at[own]]
        near = retrieved(rolled, here, first_word[where], first_word[where + 1], template, catalogue, number)
        if not near.any():
            continue
        yield from verified(here[near], where[near], spot[near], first_word, template, shingle)


def retrieved(rolled, place, first, last, template: Template, catalogue: Catalogue, number: int):
    """Which of the shingles at ``place`` lie in a window that shares a band with the template,
    or within its slack."""
    shingle = catalogue.shingle
    width = template.span - shingle + 1
    starts, ends = windows_of(place, first, last, template, shingle)
    change = np.zeros(len(place) + 1, np.int64)
    for low in range(0, len(starts), CHUNK_WINDOWS):
        begin, end = starts[low : low + CHUNK_WINDOWS], ends[low : low + CHUNK_WINDOWS]
        # Past the text's end a window repeats its last shingle.
        index = np.minimum(begin[:, None] + np.arange(width), (end - shingle)[:, None])
        keys = sketch(rolled[index], catalogue.factors)
        hit = begin[(keys == catalogue.bands[number]).any(axis=1)]
        np.add.at(change, np.searchsorted(place, hit - template.slack), 1)
        np.add.at(change, np.searchsorted(place, hit + width + template.slack), -1)
    return np.cumsum(change[:-1]) > 0


def verified(place, doc, spot, first_word, template: Template, shingle: int):
    """Copies among the retrieved shingles (at word ``place``, in the template at ``spot``)."""
    order = np.lexsort([place, place - spot, doc])
    place, doc, spot = place[order].tolist(), doc[order].tolist(), spot[order].tolist()
    need = max(1, int(np.ceil(CONTAINMENT * len(template.shingles) - 1e-9)))
    held: dict[int, int] = {}
    low, high, n = 0, 0, len(place)
    while low < n:
        # All shingles whose copy would begin within the slack of the lowest one's.
        while high < n and doc[high] == doc[low] and (
            place[high] - spot[high] <= place[low] - spot[low] + template.slack
        ):
            held[spot[high]] = held.get(spot[high], 0) + 1
            high += 1
        if len(held) >= need:
            own = first_word[doc[low]]
            start, end = min(place[low:high]), max(place[low:high]) + shingle
            yield template, doc[low], int(start - own), int(end - own), len(held)
            low, held = high, {}
            continue
        held[spot[low]] -= 1
        if not held[spot[low]]:
            del held[spot[low]]
        low += 1


def scan_licenses(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates: dict[str, str | Sequence[str]] | None = None,
) -> DataFrame:
    """``key, license, start_word, n_words, containment``: every place of each license in each
    row's whole text; places of one license do not overlap.

    ``templates`` gives texts by license, one or several each (by default ``catalogue_texts``).

    Words are runs of ASCII letters and digits and of characters above ASCII, A-Z lower-cased.
    Null and empty texts hold nothing, a text shorter than a template is one window; repeated
    rows, and rows with a null key, are scanned each.
    """
    catalogues = prepare(templates)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, 1):
                rows = scan(piece.column(1), catalogues)
                owner, names, start, spans, share = zip(*rows, strict=True) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0).take(pa.array(owner, pa.int64())),
                        pa.array(names, pa.string()),
                        pa.array(start, pa.int64()),
                        pa.array(spans, pa.int64()),
                        pa.array(share, pa.float64()),
                    ],
                    ["key", "license", "start_word", "n_words", "containment"],
                )

    kept = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = "license string, start_word long, n_words long, containment double"
    found = map_batches(kept, run, f"key {kind}, {schema}")
    return found.withColumnRenamed("key", key)
