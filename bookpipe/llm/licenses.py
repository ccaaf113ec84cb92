"""License scan: MinHash bands over overlapping windows retrieve templates, containment verifies them."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookpipe.llm.neardup import MINIMA, minima
from bookpipe.llm.text import emit, mixed, shingles, texts, word_hashes

WORDS, CONTAINMENT = 5, 0.8
# Two minima per band, 64 bands: windows at similarity 0.5 share a band with chance 1 - 1e-8.
BAND_ROWS = 2

# Wording of public license notices.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
                "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
                "distribute, sublicense, and/or sell copies of the Software",
    "MIT-notice": "This project is licensed under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-terms": "You may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "BSD-notice": "Use of this source code is governed by a BSD-style license",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-text": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                "by the Free Software Foundation",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-text": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "Proprietary": "All rights reserved. No part of this work may be reproduced without written permission.",
}

FOUND = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("start", pa.int64()), ("n_words", pa.int64()), ("containment", pa.float64())])


def band_keys(grams: np.ndarray) -> np.ndarray:
    best = minima(grams).reshape(-1, BAND_ROWS).astype(np.uint64)
    key = mixed(np.arange(MINIMA // BAND_ROWS, dtype=np.uint64))
    for column in best.T:
        key = mixed(key * np.uint64(31) + column)
    return key


class Templates:
    """Shingles of the templates and their bands. ``texts`` maps names to wordings; a wording without a word is left out."""

    def __init__(self, texts: dict[str, str]):
        self.words = {k: w for k, t in sorted(texts.items()) if len(w := word_hashes(t.encode(), ascii_space=False))}
        self.grams = {k: np.unique(shingles(w, WORDS)) for k, w in self.words.items()}
        self.bands: dict[int, set[str]] = defaultdict(set)
        for k, g in self.grams.items():
            for key in band_keys(g).tolist():
                self.bands[key].add(k)
        # By number of words of a shingle: the shingles of all templates, and the window sizes where each may help.
        pairs = defaultdict(set)
        for k, w in self.words.items():
            for g in self.grams[k].tolist():
                pairs[(min(WORDS, len(w)), g)].add(len(w))
        self.known = {}
        for n in {n for n, _ in pairs}:
            own = sorted((g, sorted(s)) for (m, g), s in pairs.items() if m == n)
            self.known[n] = (np.array([g for g, _ in own], np.uint64), [s for _, s in own])

    def scan(self, text: bytes) -> list[tuple[str, int, int, float]]:
        """Best place of each template: (name, first word, words, containment), the first of equals.

        Windows have the words of a template and overlap by seven eighths, so an occurrence has most of its
        shingles in one. Windows without any template shingle would contain nothing, and are passed over.
        """
        words = word_hashes(text, ascii_space=False)
        windows: set[tuple[int, int]] = set()
        for n, (known, sizes) in self.known.items():
            grams = shingles(words, n) if len(words) >= n else words[:0]
            at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            for p in np.flatnonzero(known[at] == grams).tolist():
                for size in sizes[at[p]]:
                    step = max(1, size // 8)
                    first, last = -(-max(0, p - size + n) // step), min(p, max(0, len(words) - size) + step - 1) // step
                    windows.update((size, k * step) for k in range(first, last + 1))
        best: dict[str, tuple[float, int, int]] = {}
        for size, start in sorted(windows):
            step = max(1, size // 8)
            names = set().union(*(self.bands.get(k, ()) for k in band_keys(np.unique(shingles(words[start : start + size], WORDS))).tolist()))
            low = max(0, start - step)
            around = shingles(words[low : start + size + step], WORDS) if names else None
            for name in names:
                own = self.grams[name]
                if len(self.words[name]) < WORDS:
                    around = shingles(words[low : start + size + step], len(self.words[name]))
                here = np.flatnonzero(np.isin(around, own))
                share = len(np.unique(around[here])) / len(own)
                if share >= CONTAINMENT and (share, -(low + int(here[0]))) > best.get(name, (0.0, 0))[:2]:
                    best[name] = (share, -(low + int(here[0])), len(self.words[name]))
        found = [(k, -s, n, share) for k, (share, s, n) in sorted(best.items())]
        # Wordings that differ in a word, such as a version, match in one place; the fullest match stays there.
        return [x for x in found if not any(y[3] > x[3] and y[1] < x[1] + x[2] and x[1] < y[1] + y[2] for y in found)]


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """License wordings in documents: doc_id, license, start (word), n_words, containment; a row per document and wording.

    Where wordings overlap, only the most contained one is reported. The verified containment is the share of a template's 5-word shingles found around the window, 0.8 or
    more. Null and empty texts hold nothing; repeated rows each give their rows; a null doc_id is
    reported as null. Other columns are ignored; an empty table gives no row. The templates go to every
    task; their number does not grow with the data.
    """
    held = Templates(TEMPLATES if templates is None else templates)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(d, *x) for d, t in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True) for x in held.scan(t)]
            if rows:
                yield emit(FOUND, zip(*rows, strict=True))

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, license string, start long, n_words long, containment double")
