"""License scan: winnowed template fingerprints pick candidates, banded alignment reports what matched (operator 7).

Templates and documents are read as lower-case runs of letters and digits. Hashes of ``k`` such words are winnowed
(the smallest of every ``window`` neighbours), and the templates' choices form a small inverted index. Templates of up to
``SHORT`` words are indexed by every run of words, of two words where changed words may leave no three together. All
runs of a document probe the index; hits on one template and near one diagonal are one candidate place. There the template is aligned
with the words around the diagonal inside a band (at most half the template wide), and matches of ``min_coverage`` of the template's words or more are
reported with their span. Only diagonals are aligned on which enough words stand inside the band to reach
``min_coverage``. The index grows with the templates only; documents are scanned whole, without a shuffle.

Null and empty texts have no rows. A text with a template several times has a row for each place; of overlapping
places, of any templates, the one with the most matched less missing words stays, so that a license is not reported
by its opening or as a relative. Repeated rows are reported for each row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from importlib.resources import files

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.words import hash_words, slices, windows

#: Short license lines and opening passages. Wholes (``BSD-3-Clause``), license texts (``-text``) and notices for source
#: files (``-notice``) are in ``license_texts``, one file each; ``-grant`` and ``-opening`` are the first part of one.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-grant": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD-opening": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-opening": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in "
        "the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
for _file in sorted(files("tamarack.llm").joinpath("license_texts").iterdir(), key=lambda f: f.name):
    _name, _text = _file.name.removesuffix(".txt"), _file.read_text("utf-8")
    TEMPLATES[_name] = _text
    if _name.endswith("-notice") and "GPL-" in _name:
        TEMPLATES[_name.replace("-notice", "-grant")] = _text.split("\n\n")[0]

#: Templates of up to so many words are indexed by every run.
SHORT = 64
#: Bytes that separate words: everything in ASCII but letters and digits.
BREAKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
SCHEMA = "doc_id bigint, license string, start_word bigint, end_word bigint, matched_words int, coverage double"
_SHAPE = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("matched_words", pa.int32()), ("coverage", pa.float64())])


def winnow(h: np.ndarray, window: int) -> np.ndarray:
    """Positions that are the smallest of some ``window`` neighbours (all of them if there are fewer)."""
    n = len(h)
    if n <= window:
        return np.flatnonzero(h == h.min()) if n else np.zeros(0, np.int64)
    low = h[: n - window + 1].copy()
    for i in range(1, window):
        np.minimum(low, h[i : n - window + 1 + i], out=low)
    ok = np.zeros(n, bool)
    for i in range(window):
        ok[i : n - window + 1 + i] |= h[i : n - window + 1 + i] == low
    return np.flatnonzero(ok)


def align(text: list[int], template: list[int], offset: int, band: int) -> tuple[int, int, int]:
    """Longest common subsequence of ``template`` with ``text``, text places within ``band`` of the diagonal that
    begins at ``offset``: matched words, first and last matched place."""
    m, width = len(template), 2 * band + 1
    before: list[tuple[int, int, int]] = [(0, 0, 0)] * (width + 1)  # matched, -span, first place; wider spans lose
    ends = [-1] * (width + 1)
    for i in range(m):
        now, last = [(0, 0, 0)] * (width + 1), [-1] * (width + 1)
        for j in range(width):
            at = offset + i + j - band
            best, end = before[j + 1], ends[j + 1]  # skip the template's word
            if j and now[j - 1] > best:  # skip the text's word
                best, end = now[j - 1], last[j - 1]
            if 0 <= at < len(text) and text[at] == template[i]:
                c, _, first = before[j]
                first = at if c == 0 else first
                hit = (c + 1, first - at, first)
                if hit > best:
                    best, end = hit, at
            now[j], last[j] = best, end
        before, ends = now, last
    k = max(range(width), key=lambda j: before[j])
    return before[k][0], before[k][2], ends[k]


@dataclass
class Index:
    """Templates as word hashes, and an inverted index of their fingerprints."""

    names: list[str]
    words: list[list[int]]
    grams: dict[int, tuple[np.ndarray, np.ndarray]]  # by words in a run: sorted fingerprints; template and position of each


def surviving(m: int, min_coverage: float) -> int:
    """Words that stay together at least somewhere when ``m`` words lose as many as ``min_coverage`` lets them."""
    lost = int(m - min_coverage * m + 1e-9)
    return -(-(m - lost) // (lost + 1))


def build(templates: dict[str, str], k: int, window: int, min_coverage: float) -> Index:
    names, words = sorted(templates), []
    found: dict[int, list[tuple]] = {}
    for t, name in enumerate(names):
        raw = np.frombuffer(templates[name].encode(), np.uint8)
        w = hash_words(raw, np.array([0, len(raw)]), lower=True, breaks=BREAKS)
        m = len(w.hash)
        words.append(w.hash.tolist())
        run = max(1, min(k, surviving(m, min_coverage))) if m <= SHORT else k
        h, at = windows(w, run)
        for p in range(len(h)) if m <= SHORT else winnow(h, window):
            found.setdefault(run, []).append((int(h[p]), t, int(at[p])))
    grams = {}
    for run, rows in found.items():
        rows.sort()
        grams[run] = np.array([r[0] for r in rows], np.uint64), np.array([r[1:] for r in rows], np.int64)
    return Index(names, words, grams)


def places(index: Index, doc_words: np.ndarray, hits: list[tuple[int, np.ndarray, np.ndarray]], band: int, min_coverage: float) -> list[tuple]:
    """Matches in one document: ``(template, first word, last word + 1, matched words, coverage)``. ``hits``: of each
    length of runs, the hashes that the index has and their places."""
    starts: dict[int, list[int]] = {}
    for run, probes, at in hits:
        keys, where = index.grams[run]
        lo, hi = np.searchsorted(keys, probes, "left"), np.searchsorted(keys, probes, "right")
        for p, a, b in zip(at.tolist(), lo.tolist(), hi.tolist(), strict=True):
            for t, q in where[a:b].tolist():
                starts.setdefault(t, []).append(p - q)
    found, have = [], np.unique(doc_words)
    for t, diagonals in starts.items():
        template = index.words[t]
        m = len(template)
        least = min_coverage * m
        as_array = np.array(template, np.uint64)
        if len(doc_words) < least or np.isin(as_array, have).sum() < least:
            continue
        reach = min(band, max(1, m // 2))  # short notices may follow each other closely
        near = []  # diagonals with the most words that the band may match
        for d in sorted(set(diagonals)):
            most = within(doc_words, as_array, d, reach)
            if most >= least:
                near.append((d, most))
        i = 0
        while i < len(near):
            j = i
            while j < len(near) and near[j][0] - near[i][0] <= reach:
                j += 1
            d = max(near[i:j], key=lambda x: x[1])[0]
            i = j
            lo_word = max(0, d - reach)
            n, first, end = align(doc_words[lo_word : d + m + reach + 1].tolist(), template, d - lo_word, reach)
            if n >= least:
                found.append((index.names[t], first + lo_word, end + lo_word + 1, n, n / m))
    kept: list[tuple] = []
    for x in sorted(found, key=lambda x: (x[3] / x[4] - 2 * x[3], x[1], x[0])):
        if all(x[2] <= y[1] or y[2] <= x[1] for y in kept):
            kept.append(x)
    return sorted(kept, key=lambda x: (x[1], x[0]))


def within(text: np.ndarray, template: np.ndarray, diagonal: int, reach: int) -> int:
    """How many of the template's words stand in the text at most ``reach`` places off the diagonal."""
    ok = np.zeros(len(template), bool)
    for off in range(diagonal - reach, diagonal + reach + 1):
        a, b = max(0, -off), min(len(template), len(text) - off)
        if a < b:
            ok[a:b] |= text[off + a : off + b] == template[a:b]
    return int(ok.sum())


def scan(docs: DataFrame, templates: dict[str, str] | None = None, k: int = 3, window: int = 3, band: int = 8, min_coverage: float = 0.8) -> DataFrame:
    """One row per document and matched place: ``license``, word span, matched words and coverage."""
    chosen = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = build(chosen, k, window, min_coverage)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            rows = []
            for base, w in slices(batch.column("text"), lower=True, breaks=BREAKS):
                hits: dict[int, list] = {}
                for span, (keys, _) in index.grams.items():
                    h, at = windows(w, span)
                    ok = np.isin(h, keys)
                    if not ok.any():
                        continue
                    h, at = h[ok], at[ok]
                    docs_hit, first = np.unique(w.doc[at], return_index=True)
                    for d, a, b in zip(docs_hit.tolist(), first.tolist(), [*first.tolist()[1:], len(h)], strict=True):
                        hits.setdefault(d, []).append((span, h[a:b], at[a:b] - w.first[d]))
                for d, found in sorted(hits.items()):
                    for name, s, e, n, c in places(index, w.hash[w.first[d] : w.first[d + 1]], found, band, min_coverage):
                        rows.append((ids[base + d], name, s, e, n, c))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _SHAPE, strict=True)], schema=_SHAPE)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
