"""License scan: MinHash bands over overlapping text windows, then exact containment.

Words are lower-cased runs of letters and digits; shingles are five words. At level
``l`` the shingles are cut into blocks of ``2**l``, and two neighbouring blocks make a
window, so windows overlap by half and a template of at most ``2**l + 1`` shingles
that stands anywhere lies whole in one window of its level. A window and a template
that share a band's smallest hash are compared. With one row a band, a template of which
a share ``c`` of the shingles stands in the window is retrieved with probability
``1 - (1 - J) ** BANDS``, where ``J``, the resemblance, is ``c / 4`` at least (levels grow by
doubling): over 0.999 at ``c = 0.8``. What is retrieved is verified exactly: the share of the
template's shingles within its length of text must be ``MIN_CONTAINMENT`` or more.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factkeeper.llm.common import mix, powers, rolled, span_hashes, text_slices, word_spans

SHINGLE = 5
BANDS = 32
MIN_CONTAINMENT = 0.8

WORD = re.compile(r"[^\W_]+")

# Public license notices.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met""",
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation""",
    "mit-line": "Released under the MIT License.",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so""",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def _shingle_hashes(docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the shingle at each word of all documents (the largest number where it would
    run over the end) and the document of each word."""
    buf, starts, ends, doc = word_spans([" ".join(d).encode() for d in docs])
    out = np.full(len(starts), np.iinfo(np.uint64).max, dtype=np.uint64)
    if len(starts) >= SHINGLE:
        h = rolled(span_hashes(buf, starts, ends), SHINGLE)
        whole = doc[:len(h)] == doc[SHINGLE - 1:]
        out[:len(h)][whole] = h[whole]
    return out, doc


@dataclass
class Templates:
    """Templates of ``SHINGLE`` words or more, by level, with their bands' smallest hashes."""
    names: list[str]
    words: list[list[str]]

    def __post_init__(self):
        self.shingles = [{tuple(w[i:i + SHINGLE]): i for i in range(len(w) - SHINGLE + 1)} for w in self.words]
        self.seeds = powers(np.uint64(0x9E3779B97F4A7C15), BANDS + 1)[1:]
        self.levels: dict[int, list[int]] = {}
        self.minima = np.zeros((len(self.words), BANDS), dtype=np.uint64)
        for k, w in enumerate(self.words):
            h, _ = _shingle_hashes([w])
            h = h[:len(w) - SHINGLE + 1]
            self.minima[k] = [mix(h ^ s).min() for s in self.seeds]
            self.levels.setdefault(max(0, math.ceil(math.log2(max(1, len(h) - 1)))), []).append(k)

    def retrieve(self, shingles: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(template, window's size, first words of windows) that share a band."""
        found: dict[int, list[np.ndarray]] = {}
        none = shingles == np.iinfo(np.uint64).max
        for band, seed in enumerate(self.seeds):
            low = mix(shingles ^ seed)
            low[none] = np.iinfo(np.uint64).max
            for level in range(max(self.levels, default=-1) + 1):
                if level:
                    if len(low) % 2:
                        low = np.append(low, np.iinfo(np.uint64).max)
                    low = np.minimum(low[::2], low[1::2])
                if level not in self.levels:
                    continue
                window = np.minimum(low, np.append(low[1:], np.iinfo(np.uint64).max))
                mine = np.array(self.levels[level])
                wanted = self.minima[mine, band]
                at = np.flatnonzero(np.isin(window, wanted))
                for k in mine:
                    if len(at):
                        hit = at[window[at] == self.minima[k, band]]
                        if len(hit):
                            found.setdefault(int(k), []).append(hit << level)
        for k, hits in found.items():
            level = next(lv for lv, of in self.levels.items() if k in of)
            yield k, 2 << level, np.unique(np.concatenate(hits))

    def verify(self, k: int, words: list[str], lo: int, hi: int) -> list[tuple[int, int, float]]:
        """(first word, word after the last, containment) of the template in words [lo, hi)."""
        own, n = self.shingles[k], len(self.words[k]) - SHINGLE + 1
        hits = [(p, i) for p in range(max(0, lo), min(hi, len(words) - SHINGLE + 1))
                if (i := own.get(tuple(words[p:p + SHINGLE]))) is not None]
        slack, out, taken = n // 5, [], -1
        for start in sorted({p - i for p, i in hits}):
            near = [(p, i) for p, i in hits if start - slack <= p < start + n + slack and p > taken]
            share = len({i for _, i in near}) / len(own)
            if near and share >= MIN_CONTAINMENT:
                taken = near[-1][0]
                out.append((near[0][0], taken + SHINGLE, share))
        return out

    def scan(self, texts: list[str | None]) -> list[tuple[int, str, int, int, float]]:
        """(text, template, start, stop, containment); offsets in code points of the lower-cased text.

        Windows run over the words of all texts, so every text that a window touches is verified."""
        docs = [words_of(t) for t in texts]
        shingles, doc = _shingle_hashes(docs)
        base = np.cumsum([0, *map(len, docs)])
        found: dict[tuple[int, int, int], tuple[int, float]] = {}
        for k, size, starts in self.retrieve(shingles):
            n = len(self.words[k])
            for at in starts.tolist():
                for d in np.unique(doc[at:at + size]).tolist():
                    for first, after, share in self.verify(k, docs[d], at - int(base[d]) - n, at - int(base[d]) + size + n):
                        found[d, k, first] = max(found.get((d, k, first), (0, 0.0)), (after, share))
        out = []
        offsets: dict[int, list[tuple[int, int]]] = {}
        for (d, k, first), (after, share) in sorted(found.items()):
            if d not in offsets:
                offsets = {d: [m.span() for m in WORD.finditer(texts[d].lower())]}
            out.append((d, self.names[k], offsets[d][first][0], offsets[d][after - 1][1], share))
        return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """``doc_id, license, start, stop, containment``: every place where a template stands.

    Null and empty texts hold none; templates of fewer than ``SHINGLE`` words can't be found
    and raise; repeated rows give repeated results; an empty table gives an empty one."""
    chosen = TEMPLATES if templates is None else templates
    words = {name: words_of(t) for name, t in chosen.items()}
    short = [name for name, w in words.items() if len(w) < SHINGLE]
    if short:
        raise ValueError(f"templates of fewer than {SHINGLE} words: {short}")
    sent = docs.sparkSession.sparkContext.broadcast(Templates(list(words), list(words.values())))
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
    names = ["doc_id", "license", "start", "stop", "containment"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            ids = b.column("doc_id").to_pylist()
            rows = [(ids[d], *x) for d, *x in sent.value.scan(b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, kinds)], names)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, license string, start long, stop long, containment double"))
