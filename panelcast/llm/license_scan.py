"""License scans: winnowed fingerprints in an inverted index, then banded alignment.

1. Templates are word sequences.  The hashes of all ``gram``-word grams of a sequence are winnowed: of
   every ``window`` neighbouring grams the smallest is kept (the rightmost of equal ones), so any shared
   passage of ``gram + window - 1`` words shares a fingerprint.
2. The templates' fingerprints form an inverted index (fingerprint -> template, position).  A document's
   fingerprints that stand in it are anchors; each diagonal (document position less template position) with an
   anchor outside the spans found so far is a candidate, if enough of the template's words stand near it at all.
3. Each candidate is aligned in a band around its diagonal (equal word +2, other word or gap -1, local at
   both ends).  ``coverage`` is the share of the template's words that the alignment matches, and the
   span runs from its first to its last matched word.  Overlapping spans of one template keep the best.

The index depends on the templates, not on the documents; if it is larger than ``index_bytes``, the
documents are scanned once per block of templates that fits, so the broadcast stays bounded.  There is no shuffle.

Defined cases: null and empty texts match nothing; a null ``doc_id`` is carried along; repeated rows give
repeated matches; templates without words are left out, templates shorter than a gram are one gram; of equal
alignments the first in the text wins; extra columns are ignored; an empty table or no templates give
an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import chunks, shingle_hashes, table, text_bytes, word_hashes

# Notices and the opening words of well-known licences, by SPDX-like id.
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                    "that the following conditions are met",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                      "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                      "or (at your option) any later version.",
    "MIT-notice": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

# A-Z to a-z, and every ASCII character that is neither a letter nor a digit to a space.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass(frozen=True)
class ScanParams:
    gram: int = 2
    window: int = 3
    band: int = 8                   # words an alignment may shift
    min_coverage_pct: int = 80
    index_bytes: int = 32 << 20     # about 100 bytes a fingerprint


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


def grams(h: np.ndarray, gram: int) -> np.ndarray:
    return shingle_hashes(h, min(gram, max(1, len(h))))


def winnow(g: np.ndarray, window: int) -> np.ndarray:
    """Positions of the kept grams, in order: of each window the smallest, the rightmost of equal ones."""
    if len(g) <= window:
        return np.array([len(g) - 1 - int(g[::-1].argmin())]) if len(g) else np.empty(0, dtype=np.int64)
    view = np.lib.stride_tricks.sliding_window_view(g, window)[:, ::-1]
    return np.unique(np.arange(len(view)) + window - 1 - view.argmin(axis=1))


def align(doc: np.ndarray, tpl: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int] | None:
    """(matched words, first, end) of the best local alignment with document position - template position within
    ``band`` of ``diagonal``.  Words are compared as hashes; the earliest of equally good ends wins."""
    width = 2 * band + 1
    best = (0, 0, 0, 0)                        # score, -end, matched, start
    before = [(0, 0, -1)] * (width + 1)         # per diagonal: score, matched, start; one beyond the band
    for i, t in enumerate(tpl.tolist()):
        row = [(0, 0, -1)] * (width + 1)
        for d in range(width):
            j = i + diagonal - band + d
            if not 0 <= j < len(doc):
                continue
            s, m, a = before[d]                 # one word back in both
            if doc[j] == t:
                cell = (s + 2, m + 1, a if s else j)
            else:
                cell = (s - 1, m, a)
            up = before[d + 1]                  # a template word without partner
            if up[0] - 1 > cell[0]:
                cell = (up[0] - 1, up[1], up[2])
            left = row[d - 1] if d else (0, 0, -1)   # a document word without partner
            if left[0] - 1 > cell[0]:
                cell = (left[0] - 1, left[1], left[2])
            if cell[0] > 0:
                row[d] = cell
                if (cell[0], -j - 1) > best[:2]:
                    best = (cell[0], -j - 1, cell[1], cell[2])
        before = row
    return (best[2], best[3], -best[1]) if best[0] else None


class Index:
    def __init__(self, templates: dict[str, str], p: ScanParams):
        self.words = {k: word_hashes(words_of(t.encode())) for k, t in sorted(templates.items())}
        self.words = {k: w for k, w in self.words.items() if len(w)}
        self.post: dict[int, list[tuple[str, int]]] = defaultdict(list)
        self.gram_sizes = sorted({min(p.gram, len(w)) for w in self.words.values()})
        for k, w in self.words.items():
            g = grams(w, p.gram)
            for at in winnow(g, p.window).tolist():
                self.post[int(g[at])].append((k, at))
        self.keys = np.array(sorted(self.post), dtype=np.uint64)

    def size(self) -> int:
        return 100 * sum(map(len, self.post.values())) + 8 * sum(map(len, self.words.values()))

    def scan(self, h: np.ndarray, p: ScanParams) -> list[tuple[str, int, int, int]]:
        """(template, matched words, first word, end) of every match in a document's word hashes."""
        anchors: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k in self.gram_sizes:
            g = shingle_hashes(h, k)
            if not len(g):
                continue
            near = np.minimum(np.searchsorted(self.keys, g), len(self.keys) - 1)
            known = self.keys[near] == g
            if not known.any():
                continue  # most documents hold no indexed gram at all, so none of their fingerprints is one
            kept = winnow(g, p.window) if k == p.gram else np.arange(len(g))
            for at in kept[known[kept]].tolist():
                for name, tpl_at in self.post[int(g[at])]:
                    anchors[name].append((at, at - tpl_at))
        out = []
        for name in sorted(anchors):
            tpl = self.words[name]
            found: list[tuple[int, int, int]] = []
            tried: dict[int, int] = {}          # diagonal -> the position up to which it takes anchors
            for at, diagonal in sorted(anchors[name]):
                if tried.get(diagonal, 0) > at or any(f[1] <= at < f[2] for f in found[-4:]):
                    continue
                tried[diagonal] = at + len(tpl)
                low = max(0, diagonal - p.band, *(f[2] for f in found[-4:] if f[2] <= at))
                near = h[low:diagonal + len(tpl) + p.band + 1]
                if 100 * np.isin(tpl, near).sum() < p.min_coverage_pct * len(tpl):
                    continue  # too few of its words are there at all
                got = align(near, tpl, diagonal - low, p.band)
                if got and 100 * got[0] >= p.min_coverage_pct * len(tpl):
                    found.append((got[0], got[1] + low, got[2] + low))
            taken: list[tuple[int, int, int]] = []
            for f in sorted(found, key=lambda x: (-x[0], x[1])):
                if all(f[2] <= x[1] or f[1] >= x[2] for x in taken):
                    taken.append(f)
            out += [(name, *f) for f in sorted(taken, key=lambda x: x[1])]
        return out


def _blocks(templates: dict[str, str], p: ScanParams) -> list[dict[str, str]]:
    """The templates in runs whose index stays within ``index_bytes``."""
    out: list[dict[str, str]] = [{}]
    held = 0
    for k, t in sorted(templates.items()):
        size = Index({k: t}, p).size()
        if out[-1] and held + size > p.index_bytes:
            out.append({})
            held = 0
        out[-1][k] = t
        held += size
    return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, p: ScanParams = ScanParams(),
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, license, matched, template_words, coverage_pct, first_word, end_word)``, one row a match."""
    schema = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("matched", pa.int64()), ("template_words", pa.int64()),
                        ("coverage_pct", pa.int64()), ("first_word", pa.int64()), ("end_word", pa.int64())])
    kinds = "doc_id long, license string, matched long, template_words long, coverage_pct long, first_word long, end_word long"
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def mapper(block: dict[str, str]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(block, p)

            def rows(b: pa.RecordBatch):
                for i, t in zip(b.column("doc_id").to_pylist(), text_bytes(b, "text"), strict=True):
                    h = word_hashes(words_of(t))
                    for name, matched, first, end in index.scan(h, p) if index.words else ():
                        n = len(index.words[name])
                        yield i, name, matched, n, 100 * matched // n, first, end

            for b in batches:
                yield from chunks(rows(b), schema)

        return run

    out = None
    for block in _blocks(TEMPLATES if templates is None else templates, p):
        got = docs.mapInArrow(mapper(block), kinds)
        out = got if out is None else out.unionByName(got)
    return out


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    """Every license notice in every whole text of ``documents``."""
    return scan(table(spark, sf_dir, "documents", "doc_id", "text"))
