"""License scans: winnowed fingerprints pick candidates, banded alignment measures them.

Texts and templates are words of letters and digits (A-Z lowered). Three-word shingles are hashed, and of every three neighbouring shingles the least hash (the last of
equal ones) is a fingerprint, so any five words in common share one. An inverted index fingerprint -> (template, place) gives candidate places in the
text. A template of fewer than ``SHORT`` words can reach the coverage without five words in a row, so the index also holds its rarest words, one more than may be missing: a
notice must have one of them. Hits near one diagonal form a candidate; if enough of the template's words are near, and a banded alignment of the template with the text around it reports the words that match, the coverage
(matched / template words) and the span in bytes. Of longer templates those are missed that have no five words of the template in a row. Of overlapping spans of a text the one with most matched words stays;
what a candidate has before and after the span taken is aligned again, until nothing reaches the coverage, so notices that are repeated close by are each reported.

Edge cases: null and empty texts match nothing; repeated rows are scanned each; equal matches go to the shorter template, then to the first in order; an empty table, or no templates, give an empty one. Work is in
proportion to the text, and alignments to the candidates (each as wide as a template).
"""

from __future__ import annotations

from bisect import bisect_left
from hashlib import blake2b
from heapq import heappop, heappush
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BYTE_HASH, _R, LOWER_LUT, byte_chunks, lean, mix64, padded

SHINGLE, WINNOW, BAND, COVERAGE, SHORT = 3, 3, 8, 0.6, 14
#: Words of short templates that tell little; the others count as the rarer the longer they are.
COMMON = "the of and to in by or any is for with as this that it be not on are".split()
SCHEMA = "doc_id long, license string, coverage double, matched long, start_byte long, end_byte long"
#: Public licence lines and notices in short form, of the SPDX ids that functions/licenses.py knows but CECT-1.0; no full texts.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "Licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "BSD-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "BSD-3-Clause-notice": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "BSD-4-Clause-notice": "All advertising materials mentioning features or use of this software must display the following acknowledgement",
    "0BSD": "Released under the Zero-Clause BSD License.",
    "0BSD-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "EPL-1.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "EPL-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "CC0-1.0": "Released under CC0 1.0.",
    "CC0-1.0-notice": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.",
    "Unlicense": "Released under the Unlicense.",
    "Unlicense-notice": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software",
    "Zlib": "Released under the zlib License.",
    "Zlib-notice": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "GPL-1.0": "Licensed under the GNU General Public License, version 1.",
    "GPL-2.0": "Licensed under the GNU General Public License, version 2.",
    "LGPL-2.0": "Licensed under the GNU Library General Public License, version 2.",
    "LGPL-2.1": "Licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-1.0": "Licensed under the Affero General Public License, version 1.",
    "AGPL-3.0": "Licensed under the GNU Affero General Public License, version 3.",
}
_GNU = "This {} is free software; you can redistribute it and/or modify it under the terms of the {} General Public License as published by the {}; either version {}, or (at your option) any later version."
_FSF = "Free Software Foundation"
for _name, _what, _kind, _of, _version in (
    ("GPL-1.0", "program", "GNU", _FSF, "1"), ("GPL-2.0", "program", "GNU", _FSF, "2 of the License"), ("LGPL-2.0", "library", "GNU Library", _FSF, "2 of the License"),
    ("LGPL-2.1", "library", "GNU Lesser", _FSF, "2.1 of the License"), ("LGPL-3.0", "library", "GNU Lesser", _FSF, "3 of the License"),
    ("AGPL-1.0", "program", "Affero", "Affero, Inc.", "1 of the License"), ("AGPL-3.0", "program", "GNU Affero", _FSF, "3 of the License"),
):
    TEMPLATES[f"{_name}-notice"] = _GNU.format(_what, _kind, _of, _version)
for _name, _long in (
    ("AFL", "Academic Free"), ("Artistic", "Artistic"), ("MPL", "Mozilla Public"), ("EPL", "Eclipse Public"), ("CPL", "Common Public"), ("CDDL", "Common Development and Distribution"),
):
    for _version in {"AFL": ("1.1", "1.2", "2.0", "2.1", "3.0"), "Artistic": ("1.0", "2.0"), "MPL": ("2.0",), "EPL": ("1.0", "2.0"), "CPL": ("1.0",), "CDDL": ("1.0", "1.1")}[_name]:
        TEMPLATES[f"{_name}-{_version}"] = f"Licensed under the {_long} License, version {_version}."
for _name, _long in (("", ""), ("-NC", "-NonCommercial"), ("-SA", "-ShareAlike"), ("-ND", "-NoDerivatives"), ("-NC-SA", "-NonCommercial-ShareAlike"), ("-NC-ND", "-NonCommercial-NoDerivatives")):
    TEMPLATES[f"CC-BY{_name}-4.0"] = f"Licensed under CC BY{_name} 4.0."
    TEMPLATES[f"CC-BY{_name}-4.0-notice"] = f"This work is licensed under a Creative Commons Attribution{_long} 4.0 International License."
for _n in "234":
    TEMPLATES[f"BSD-{_n}-Clause"] = f"Released under the BSD {_n}-Clause License."
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_LEAD = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, their byte spans within their text, and where each text's words begin (n + 1)."""
    buf, starts = padded(data, offsets, 1, 32)
    low = LOWER_LUT[buf]
    inside = _WORD[low]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    begin, end = edge[0::2], edge[1::2]
    h = np.zeros(len(begin), np.uint64)
    size = end - begin
    # a Horner step a letter, over the words that have it
    order = np.argsort(-size, kind="stable")
    live = len(order)
    sorted_size, at = size[order], begin[order]
    acc = np.zeros(len(order), np.uint64)
    longest = int(sorted_size[0]) if live else 0
    for k in range(min(longest, 24)):
        live = int(np.searchsorted(-sorted_size, -k, "left"))
        acc[:live] = acc[:live] * _R + _BYTE_HASH[low[at[:live] + k]]
    for i in range(int(np.searchsorted(-sorted_size, -24, "left"))):
        acc[i] = np.uint64(int.from_bytes(blake2b(low[at[i] : at[i] + sorted_size[i]].tobytes(), digest_size=8).digest(), "little"))
    h[order] = acc
    first = np.searchsorted(begin, np.append(starts, len(buf)))
    owner = np.repeat(starts, np.diff(first))
    return mix64(h + size.astype(np.uint64)), begin - owner, end - owner, first


def fingerprints(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the winnowed shingles of one run of words; a run shorter than the window keeps its least."""
    n = len(h) - SHINGLE + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g = sum(h[j : j + n] * _LEAD[j] for j in range(SHINGLE))
    g = mix64(g)
    if n < WINNOW:
        at = np.array([n - 1 - int(np.argmin(g[::-1]))])
        return at, g[at]
    windows = np.lib.stride_tricks.sliding_window_view(g, WINNOW)
    at = np.unique(np.arange(n - WINNOW + 1) + WINNOW - 1 - windows[:, ::-1].argmin(axis=1))
    return at, g[at]


class Index:
    """Templates as word hashes, and sorted by hash the fingerprints and the single words that lead to them."""

    def __init__(self, templates: dict[str, str]):
        self.names, self.words, marks, single = sorted(templates), [], [], []
        for i, name in enumerate(self.names):
            data = np.frombuffer(templates[name].encode(), np.uint8)
            h, begin, end, _ = words(data, np.array([0, len(data)]))
            self.words.append(h)
            marks += [(int(x), i, int(p)) for p, x in zip(*fingerprints(h), strict=True)]
            if len(h) < SHORT:
                spelt = [data[a:b].tobytes().decode().lower() for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
                rarest = sorted(range(len(h)), key=lambda p: (spelt[p] in COMMON, -len(spelt[p]), p))
                single += [(int(h[p]), i, p) for p in rarest[: len(h) - ceil(COVERAGE * len(h)) + 1]]
        self.sets = [set(h.tolist()) for h in self.words]
        self.marks, self.single = _Lookup(marks), _Lookup(single)

    def scan(self, h: np.ndarray, shingles: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(matched, template, first word, last word) in the words h; ``shingles``: hashes of the shingles at the places ``at`` that are in the index."""
        found: dict[tuple[int, int], list[tuple[int, int]]] = {}
        here = self.single.hits(h)
        for size, lookup, hashes, places in ((SHINGLE, self.marks, shingles, at), (1, self.single, h[here], here)):
            for g, p in zip(hashes.tolist(), places.tolist(), strict=True):
                for t, place in lookup.of(g):
                    found.setdefault((t, (p - place) // BAND), []).append((p, size))
        best: list[tuple] = []

        def propose(t: int, slot: int, a: int, b: int) -> None:
            """The best span of a candidate within the words a to b, if one of its hits and enough words of its template lie there."""
            if not any(a <= p and p + size <= b for p, size in found[t, slot]):
                return
            # no alignment goes beyond these words
            near = self.sets[t].intersection(h[max(a, (slot - 1) * BAND) : max(0, min(b, (slot + 2) * BAND + len(self.words[t]) + 1))].tolist())
            if sum(w in near for w in self.words[t].tolist()) < COVERAGE * len(self.words[t]):
                return
            if got := align(self.words[t], h, slot * BAND, a, b):
                matched, x, y = got
                if matched >= COVERAGE * len(self.words[t]):
                    heappush(best, (-matched, len(self.words[t]), y - x, t, x, y, slot, a, b))

        for t, slot in found:
            propose(t, slot, 0, len(h))
        kept: list[tuple[int, int, int, int]] = []
        starts: list[int] = []
        while best:
            matched, _, _, t, x, y, slot, a, b = heappop(best)
            # spans kept lie apart, so the first that ends at or after x is the only one to ask
            i = max(0, bisect_left(starts, x) - 1)
            i += i < len(kept) and kept[i][3] < x
            if i < len(kept) and kept[i][2] <= y:
                x, y = kept[i][2:]
            else:
                kept.insert(i, (-matched, t, x, y))
                starts.insert(i, x)
            # what the candidate has beside the span that is taken
            propose(t, slot, a, min(b, x))
            propose(t, slot, max(a, y + 1), b)
        return kept


class _Lookup:
    """hash -> (template, place) of all entries."""

    def __init__(self, entries: list[tuple[int, int, int]]):
        self.by: dict[int, list[tuple[int, int]]] = {}
        for g, t, place in entries:
            self.by.setdefault(g, []).append((t, place))
        self.hashes = np.array(sorted(self.by), np.uint64)

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Where the given hashes are in the index."""
        if not len(self.hashes):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.flatnonzero(self.hashes[at] == hashes)

    def of(self, g: int) -> list[tuple[int, int]]:
        return self.by.get(g, [])


def align(t: np.ndarray, h: np.ndarray, diagonal: int, a: int, b: int) -> tuple[int, int, int] | None:
    """Most words of template t in order within the words a to b of text h, near text place = template place + diagonal (diagonal to diagonal + BAND, and BAND around).

    Cells hold (matched words, -text words passed over, first and last matched place).
    """
    low = diagonal - BAND
    width = 3 * BAND
    row = [(0, 0, -1, -1)] * (width + 2)
    for i, word in enumerate(t.tolist()):
        new = [(0, 0, -1, -1)] * (width + 2)
        for c in range(width + 1):
            p = low + i + c
            best = row[c + 1]  # the template's word is passed over
            if c and new[c - 1][0]:
                left = new[c - 1]
                best = max(best, (left[0], left[1] - 1, left[2], left[3]))
            if a <= p < b and int(h[p]) == word:
                m, gap, first, _ = row[c]
                best = max(best, (m + 1, gap, first if m else p, p))
            new[c] = best
        row = new
    best = max(row[: width + 1])
    return (best[0], best[2], best[3]) if best[0] else None


@lean
def scan_rows(batches, templates):
    index = Index(templates)
    for batch in batches:
        ids = batch.column("doc_id")
        out: list[tuple] = []
        for i, _, data, offsets in byte_chunks(batch.column("text")):
            h, begin, end, first = words(data, offsets)
            n = max(0, len(h) - SHINGLE + 1)
            g = mix64(sum(h[j : j + n] * _LEAD[j] for j in range(SHINGLE)))
            hit = index.marks.hits(g)
            owner = np.searchsorted(first, hit, "right") - 1
            whole = hit + SHINGLE <= first[owner + 1]  # no shingle of two texts
            hit, owner = hit[whole], owner[whole]
            some = np.searchsorted(first, index.single.hits(h), "right") - 1
            for r in np.unique(np.concatenate([owner, some])).tolist():
                a, b = int(first[r]), int(first[r + 1])
                own = hit[owner == r]
                for matched, t, x, y in index.scan(h[a:b], g[own], own - a):
                    out.append((ids[i + r].as_py(), index.names[t], matched / len(index.words[t]), matched, int(begin[a + x]), int(end[a + y])))
        if out:
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "license", "coverage", "matched", "start_byte", "end_byte"])


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """A row for each licence notice found: doc_id, license, coverage, matched words, and the span in bytes of the UTF-8 text."""
    templates = TEMPLATES if templates is None else templates
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda it: scan_rows(it, templates), SCHEMA)
