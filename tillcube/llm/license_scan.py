"""Licence scan by Dice coefficients over word bigrams (operator 9).

Every line, every paragraph (lines up to a blank one), every whole text and
every window of a template's word count (so a notice inside a longer line or
a one-line text is found) is normalised (A-Z lower-cased; runs of digits,
letters and non-ASCII as words) and compared with the licence templates,
which are notices, standard headers and the full texts in ``licenses/``:
Dice = 2 |A and B| / (|A| + |B|) of the sets of word bigrams.  A template of
b bigrams can reach the threshold t only with a unit of a bigrams where
2 min(a, b) >= t (a + b), and a unit only if it holds enough bigrams of any
template; a window only if it holds t b / (2 - t) of the template's own.
This prunes nearly all units and windows before a set is built.

Of the windows of a template that overlap, the one of the best score (the
first of those) counts, and none that overlaps a matching line, paragraph or
text of the template.  Null and empty texts, and units of one word, match
nothing.  A unit that is its paragraph and line at once counts once; all
templates that reach the threshold are reported, so a notice of one version
or variant can name its close relatives too, with a lower score.
"""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .text import alnum, chunks, grams, tokenise

THRESHOLD = 0.8
# Notices of public licences.
_NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0 Universal."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the "
                 "GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the "
                 "GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                 "GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
                     "this software without specific prior written permission."),
    ("ISC", "Released under the ISC License."),
    ("ISC", "Licensed under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
            "the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)
# Full texts, without copyright lines where these are the owner's.
TEMPLATES = _NOTICES + tuple((p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "licenses").glob("*.txt")))
MATCH = "array<struct<license:string,score:double,start:long,end:long>>"


def bigrams(text: str) -> tuple[np.ndarray, int]:
    """Set of the bigrams, and their number with repeats."""
    data = np.frombuffer(text.encode(), np.uint8)
    pair = grams(tokenise(data, np.array([0, len(data)]), alnum, True).hash, 2)
    return np.unique(pair), len(pair)


def units(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(start, end) bytes of the lines, paragraphs and texts, each once."""
    n = len(data)
    ends = np.unique(np.concatenate([np.flatnonzero(data == 10), off[1:]]))     # a line ends before its \\n
    starts = np.unique(np.concatenate([np.flatnonzero(data == 10) + 1, off[:-1]]))
    starts = starts[starts < max(n, 1)]
    lines = np.stack([starts, ends[np.searchsorted(ends, starts)]], 1) if len(starts) else np.zeros((0, 2), np.int64)
    lines = lines[lines[:, 1] > lines[:, 0]]
    dark = np.concatenate([[0], np.cumsum(~np.isin(data, np.frombuffer(b" \t\r\x0b\x0c\n", np.uint8)))])
    lines = lines[dark[lines[:, 1]] > dark[lines[:, 0]]]
    if not len(lines):
        return lines
    text = np.searchsorted(off, lines[:, 0], "right")
    new = np.concatenate([[True], (lines[1:, 0] > lines[:-1, 1] + 1) | (text[1:] != text[:-1])])
    first = np.flatnonzero(new)
    paragraphs = np.stack([lines[first, 0], lines[np.append(first[1:], len(lines)) - 1, 1]], 1)
    whole = np.stack([off[:-1], off[1:]], 1)
    return np.unique(np.concatenate([lines, paragraphs, whole[whole[:, 1] > whole[:, 0]]]), axis=0)


def sliding(pair: np.ndarray, member: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct bigrams, and distinct ones that are members, of every window
    of ``m`` bigrams: one at i counts in the windows that start after its last
    occurrence before i."""
    n = len(pair)
    order = np.argsort(pair, kind="stable")
    last = np.full(n, -1)
    again = pair[order[1:]] == pair[order[:-1]]
    last[order[1:][again]] = order[:-1][again]
    at = np.arange(n)
    first = np.maximum(np.maximum(last + 1, at - m + 1), 0)

    def count(some):
        return np.cumsum(np.bincount(first[some], minlength=n + 1) - np.bincount(at[some] + 1, minlength=n + 1))[:n - m + 1]
    return count(at), count(np.flatnonzero(member))


def windows(pair, place, member, off, m: int, size: int, taken, cut: float):
    """(first word, score) of the best of the overlapping windows of ``m``
    bigrams that reach the cut; ``place`` are the members' places, ``off``
    the texts' words, ``taken`` word spans that no window may overlap."""
    need = max(1, int(np.ceil(cut * size / (2 - cut) - 1e-9)))   # members that it must hold
    if len(place) < need:
        return
    a, b = place[:len(place) - need + 1], place[need - 1:]
    text = np.searchsorted(off, a, "right") - 1
    lo, hi = np.maximum(b - m + 1, off[text]), np.minimum(a, off[text + 1] - m - 1)
    some = np.flatnonzero(lo <= hi)
    if not len(some):
        return
    lo, hi = lo[some], hi[some]
    new = np.flatnonzero(np.concatenate([[True], lo[1:] > np.maximum.accumulate(hi)[:-1] + 1]))
    starts, scores = [], []
    for x, y in zip(np.minimum.reduceat(lo, new).tolist(), np.maximum.reduceat(hi, new).tolist()):
        own, both = sliding(pair[x:y + m], member[x:y + m], m)
        score = 2 * both / (own + size)
        ok = np.flatnonzero(score >= cut)
        starts.append(x + ok)
        scores.append(score[ok])
    start, score = np.concatenate(starts), np.concatenate(scores)
    for x, y in taken:
        ok = (start >= y) | (start + m + 1 <= x)
        start, score = start[ok], score[ok]
    # overlapping runs, each by itself
    for run in np.split(np.arange(len(start)), np.flatnonzero(np.diff(start) > m) + 1):
        while len(run):
            best = run[np.argmax(score[run])]
            yield int(start[best]), float(score[best])
            run = run[np.abs(start[run] - start[best]) > m]


def matches(data, off, templates, cut: float):
    """(text, template, score, start, end) of the units and windows that match."""
    w = tokenise(data, off, alnum, True)
    sets = [b for _, b, _ in templates]
    if len(w.hash) < 2:
        return []
    vocabulary = np.unique(np.concatenate(sets))
    sizes = np.array([len(b) for b in sets])
    pair = grams(w.hash, 2)
    p = np.searchsorted(vocabulary, pair)
    p[p == len(vocabulary)] = 0
    hit = vocabulary[p] == pair
    known = np.concatenate([[0], np.cumsum(hit)])
    u = units(data, off)
    a, b = np.searchsorted(w.start, u[:, 0]), np.searchsorted(w.start, u[:, 1])     # words of the unit
    n = b - a - 1                                                                  # its bigrams, repeats counted
    ok = n > 0
    hits = np.where(ok, known[np.maximum(b - 1, 0)] - known[a], 0)
    # with h hits, 2 h >= t (|A| + |B|) and |A| >= h and |B| >= smallest are needed
    live = np.flatnonzero(ok & (hits * (2 - cut) >= cut * sizes.min()))
    out, taken = [], [[] for _ in sets]
    for i in live.tolist():
        own = np.unique(pair[a[i]:b[i] - 1])
        if hits[i] < n[i] and 2 * np.count_nonzero(vocabulary[np.minimum(np.searchsorted(vocabulary, own), len(vocabulary) - 1)] == own) < cut * (len(own) + sizes.min()):
            continue
        for t in np.flatnonzero(2 * np.minimum(len(own), sizes) >= cut * (len(own) + sizes)).tolist():
            both = len(np.intersect1d(own, sets[t], assume_unique=True))
            score = 2 * both / (len(own) + len(sets[t]))
            if score >= cut:
                out.append((int(np.searchsorted(off, u[i, 0], "right")) - 1, t, score, int(u[i, 0]), int(u[i, 1])))
                taken[t].append((a[i], b[i]))
    at = np.flatnonzero(hit)
    for t, (_, own, m) in enumerate(templates):
        place = at[np.isin(p[at], np.searchsorted(vocabulary, own), kind="table")]
        member = np.zeros(len(pair), bool)
        member[place] = True
        for s, score in windows(pair, place, member, w.off, m, len(own), taken[t], cut):
            out.append((int(np.searchsorted(w.off, s, "right")) - 1, t, score, int(w.start[s]), int(w.end[s + m])))
    return out


def scan(docs: DataFrame, templates=TEMPLATES, cut: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ``licenses`` (sorted, each once) and ``matches`` (licence,
    score, byte span of the unit or window in the UTF-8 text) of every document."""
    held = [(name, *bigrams(text)) for name, text in templates]
    held = [h for h in held if h[2]]
    item = pa.struct([("license", pa.string()), ("score", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("licenses", pa.list_(pa.string())), ("matches", pa.list_(item))])

    def run(batches):
        for rows, data, off in chunks(batches):
            found = [[] for _ in range(rows.num_rows)]
            for doc, t, score, start, end in matches(data, off, held, cut):
                # a text that is empty shares its offset with the next one
                found[doc].append({"license": held[t][0], "score": score, "start": start - int(off[doc]), "end": end - int(off[doc])})
            found = [sorted(f, key=lambda m: (m["start"], m["end"], m["license"], -m["score"])) for f in found]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([sorted({m["license"] for m in f}) for f in found], pa.list_(pa.string())), pa.array(found, pa.list_(item))], schema=schema)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id long, licenses array<string>, matches {MATCH}")
