"""Licence notices in texts, by a trained classifier of paragraphs.

A paragraph is a line, two lines that follow each other, or all lines up to one without words, so that a notice may be
wrapped and stand behind comment marks; a long one is read in overlapping windows. Hashed word unigrams and bigrams go into a
logistic regression over the licence families and one unknown class, trained by stochastic gradient descent in
numpy: families from templates with words left out and strange words put in, the unknown class from a bounded
sample of paragraphs of the documents. Held-back paragraphs calibrate the least probability for a family, so
that at most a stated share of ordinary paragraphs reaches it. A prediction counts once a template of its family
confirms it: enough of the template's word pairs must occur in the paragraph. If another family's template explains the
same pairs and occurs more fully, that family counts. Titles that are all of a paragraph and SPDX tags are told by their
words alone.

Rows and edge cases: one row comes out per row that goes in. Null text counts as empty and holds nothing. Rows are
independent of each other but for the model, so ids may be null or repeat. Of overlapping windows with one
family the most fully confirmed counts, of equal ones the shortest, then the most probable, then the first. Without documents the unknown class is learned from
scrambled templates alone. Other columns are not read.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.shared import chunks, text_of
from daytally.llm.spans import code_points
from daytally.llm.words import IS_MARK, Words, mix

# How licences are named and announced.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "This file is licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at apache org licenses LICENSE-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License version 2",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1",
        "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License",
        "Released under the BSD license",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0",
    ),
    "ISC": (
        "Licensed under the ISC License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "CC0": (
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense",
    ),
    "Proprietary": (
        "All rights reserved. No part of this publication may be reproduced without prior written permission",
        "Confidential and proprietary. Unauthorized copying of this file is strictly prohibited",
    ),
}
# Titles, which count only where they stand alone.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "Apache-2.0": ("Apache License", "Apache License 2.0", "Apache License, Version 2.0", "Apache License Version 2.0, January 2004"),
    "GPL": ("GNU General Public License", "GNU General Public License v2.0", "GNU General Public License v3.0",
            "GNU General Public License Version 2, June 1991", "GNU General Public License Version 3, 29 June 2007"),
    "LGPL": ("GNU Lesser General Public License", "GNU Lesser General Public License Version 2.1, February 1999",
             "GNU Lesser General Public License Version 3, 29 June 2007"),
    "AGPL": ("GNU Affero General Public License", "GNU Affero General Public License Version 3, 19 November 2007"),
    "BSD": ("BSD License", "BSD 2-Clause License", "BSD 3-Clause License", "The BSD License"),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License Version 2.0"),
    "ISC": ("ISC License", "The ISC License"),
    "CC-BY-NC": ("Creative Commons Attribution-NonCommercial 4.0 International",),
    "CC-BY-SA": ("Creative Commons Attribution-ShareAlike 4.0 International",),
    "CC-BY": ("Creative Commons Attribution 4.0 International",),
    "CC0": ("CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"),
    "Unlicense": ("The Unlicense",),
    "Proprietary": (),
}
# What follows SPDX-License-Identifier, alone or in an expression up to the end of the line.
TAGS = {
    "MIT": ("MIT",), "Apache-2.0": ("Apache-2.0",), "GPL": ("GPL",), "LGPL": ("LGPL",), "AGPL": ("AGPL",), "BSD": ("BSD",),
    "MPL-2.0": ("MPL-2.0",), "ISC": ("ISC",), "CC-BY-NC": ("CC-BY-NC",), "CC-BY-SA": ("CC-BY-SA",),
    "CC-BY": ("CC-BY-1.0", "CC-BY-2.0", "CC-BY-2.5", "CC-BY-3.0", "CC-BY-4.0"), "CC0": ("CC0",), "Unlicense": ("Unlicense",),
}
FAMILIES = tuple(TEMPLATES)
UNKNOWN = len(FAMILIES)
# Words of a window and of the step to the next one.
WINDOW, STEP = 40, 20
BITS = 14
# The bound of the sample of ordinary paragraphs: those with the smallest hashes.
SAMPLE = 4000
# Variants made of each template, and epochs.
VARIANTS, EPOCHS, RATE, DECAY = 60, 8, 0.5, 1e-5
# At most this share of ordinary paragraphs may reach the least probability.
FALSE_SHARE = 0.001
# Share of a template's word pairs that confirms it.
CONFIRM = 0.7


@dataclass
class Model:
    weight: np.ndarray
    bias: np.ndarray
    least: float


def pair_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring words, or of a word alone."""
    return mix(words[:-1] * np.uint64(3) + words[1:]) if len(words) > 1 else words


class Paragraphs:
    """Windows of the lines and paragraphs of some texts: first word, one past the last, and the buckets of their words."""

    def __init__(self, column: pa.Array):
        self.words = w = Words(column, IS_MARK)
        # Lines are told apart across rows too.
        self.line = line = np.searchsorted(np.flatnonzero(w.data == 0x0A), w.start) + w.row
        new = np.ones(len(w.start), bool)
        new[1:] = line[1:] != line[:-1]
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(w.start)))
        # Lines that go on from the one before, without one that has no words between.
        on = np.zeros(len(first), bool)
        on[1:] = (w.row[first[1:]] == w.row[first[:-1]]) & (line[first[1:]] == line[first[:-1]] + 1)
        second = np.flatnonzero(on)
        second = second[count[second - 1] + count[second] <= WINDOW]
        top = np.flatnonzero(~on)
        first, last = (np.concatenate(x) for x in (
            (first, first[second - 1], first[top]),
            (first + count, first[second] + count[second], np.append(first[top[1:]], len(w.start)) if len(top) else top)))
        many = np.maximum(1, -(-(last - first - WINDOW) // STEP) + 1)
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        start = np.repeat(first, many) + step * STEP
        stop = np.minimum(start + WINDOW, np.repeat(last, many))
        # Each window once; whole ones may be titles.
        whole = np.repeat(many == 1, many)
        order = np.lexsort((~whole, stop, start))
        start, stop, whole = start[order], stop[order], whole[order]
        once = np.ones(len(start), bool)
        once[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
        self.first, self.last, self.whole = start[once], stop[once], whole[once]
        shift = np.uint64(64 - BITS)
        self.one = (w.hash >> shift).astype(np.int64)
        self.two = np.zeros(len(w.hash), np.int64)
        if len(w.hash):
            self.two[:-1] = (pair_hashes(w.hash) >> shift).astype(np.int64) if len(w.hash) > 1 else 0

    def features(self, k: int) -> np.ndarray:
        a, b = self.first[k], self.last[k]
        return np.concatenate([self.one[a:b], self.two[a:b - 1]])

    def logits(self, model: Model) -> np.ndarray:
        """Log odds of each class for each window."""
        def sums(bucket: np.ndarray) -> np.ndarray:
            total = np.zeros((len(bucket) + 1, model.weight.shape[1]))
            np.cumsum(model.weight[bucket], axis=0, out=total[1:])
            return total

        one, two = sums(self.one), sums(self.two)
        total = one[self.last] - one[self.first] + two[self.last - 1] - two[self.first]
        return total / np.sqrt(2 * (self.last - self.first) - 1)[:, None] + model.bias


def probabilities(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def template_pairs() -> list[list[set[int]]]:
    words = [Words(pa.array(list(texts)), IS_MARK) for texts in TEMPLATES.values()]
    return [[set(pair_hashes(w.hash[a:b]).tolist()) for a, b in zip(w.first[:-1], w.first[1:])] for w in words]


def confirmed(window: np.ndarray, templates: list[set[int]]) -> float:
    """The greatest share of a template's word pairs that the window holds."""
    own = set(pair_hashes(window).tolist())
    return max(len(t & own) / len(t) for t in templates)


def fixed_words(texts: dict[str, tuple[str, ...]]) -> dict[bytes, int]:
    """The words of each title or tag, and its family."""
    out = {}
    for family, each in texts.items():
        w = Words(pa.array(list(each), pa.string()), IS_MARK)
        out |= {w.hash[a:b].tobytes(): FAMILIES.index(family) for a, b in zip(w.first[:-1], w.first[1:])}
    return out


def titled(p: Paragraphs, titles: dict[bytes, int]) -> Iterator[tuple[int, int, int]]:
    """Whole paragraphs that are a title: first word, one past the last, family."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(p.words.hash)])
    sums = np.array([np.frombuffer(t, np.uint64).sum() for t in titles], np.uint64)
    for k in np.flatnonzero(p.whole & np.isin(total[p.last] - total[p.first], sums)).tolist():
        a, b = int(p.first[k]), int(p.last[k])
        if (family := titles.get(p.words.hash[a:b].tobytes())) is not None:
            yield a, b, family


def tagged(p: Paragraphs, tags: dict[bytes, int]) -> Iterator[tuple[int, int, int]]:
    """SPDX tags: first word, one past the last, family."""
    h = p.words.hash
    spdx = Words(pa.array(["SPDX-License-Identifier"]), IS_MARK).hash
    last = max(len(t) // h.itemsize for t in tags)
    there = (h[:-2] == spdx[0]) & (h[1:-1] == spdx[1]) & (h[2:] == spdx[2]) & (p.line[:-2] == p.line[2:])
    for a in np.flatnonzero(there).tolist():
        at, end = a + 3, int(np.searchsorted(p.line, p.line[a], side="right"))
        while at < end:
            size = next((n for n in range(min(last, end - at), 0, -1) if h[at:at + n].tobytes() in tags), 0)
            if size:
                yield a, at + size, tags[h[at:at + size].tobytes()]
            at += max(1, size)


def decided(window: np.ndarray, family: int, templates: list[list[set[int]]]) -> tuple[int, float]:
    """The family, or the one that explains the same pairs more fully, and the share of its template."""
    own = set(pair_hashes(window).tolist())
    best = [max((len(t & own) / len(t), k) for k, t in enumerate(each)) for each in templates]
    if best[family][0] < CONFIRM:
        return family, best[family][0]
    held = templates[family][best[family][1]] & own
    rivals = [g for g in range(len(templates)) if best[g][0] > best[family][0]
              and 2 * len(templates[g][best[g][1]] & held) >= len(held)]
    family = max(rivals, key=lambda g: best[g][0], default=family)
    return family, best[family][0]


def _ordinary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows with the smallest hashes of a task, as words."""
    kept: dict[int, bytes] = {}
    limit = np.iinfo(np.int64).max
    for batch in chunks(batches):
        p = Paragraphs(batch.column("text"))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(p.words.hash)])
        place = mix(total[p.last] - total[p.first]).view(np.int64)
        low = np.flatnonzero(place <= limit)
        for k in low[np.argsort(place[low], kind="stable")[:SAMPLE]].tolist():
            kept[int(place[k])] = p.words.hash[p.first[k]:p.last[k]].tobytes()
        kept = dict(sorted(kept.items())[:SAMPLE])
        if len(kept) == SAMPLE:
            limit = max(kept)
    yield pa.RecordBatch.from_arrays([pa.array(kept.keys(), pa.int64()), pa.array(kept.values(), pa.binary())], ["place", "words"])


def _variants(strange: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Templates with words left out and strange words around, and scrambled ones as unknown."""
    rng, out = np.random.default_rng(8), []
    for label, texts in enumerate(TEMPLATES.values()):
        w = Words(pa.array(list(texts)), IS_MARK)
        for a, b in zip(w.first[:-1], w.first[1:]):
            own = w.hash[a:b]
            for k in range(VARIANTS):
                words = own[rng.random(len(own)) > (0.1 if k else 0)]
                around = [rng.choice(strange, rng.integers(0, 20)) if k % 2 and len(strange) else own[:0] for _ in range(2)]
                out.append((np.concatenate([around[0], words, around[1]]), label))
            for _ in range(6):
                out.append((rng.choice(own, max(1, len(own) // 3)), UNKNOWN))
    return out


def _buckets(words: np.ndarray) -> np.ndarray:
    two = pair_hashes(words) if len(words) > 1 else words[:0]
    return (np.concatenate([words, two]) >> np.uint64(64 - BITS)).astype(np.int64)


def fit(ordinary: list[np.ndarray]) -> Model:
    """Train on three quarters of the ordinary windows and all variants; calibrate on the rest."""
    held, taught = ordinary[::4], [w for k, w in enumerate(ordinary) if k % 4]
    strange = np.unique(np.concatenate(taught)) if taught else np.zeros(0, np.uint64)
    data = [(w, label) for w, label in _variants(strange) if len(w)] + [(w, UNKNOWN) for w in taught]
    weight, bias = np.zeros((1 << BITS, UNKNOWN + 1), np.float32), np.zeros(UNKNOWN + 1)
    rng = np.random.default_rng(9)
    rows = [(*np.unique(_buckets(w), return_counts=True), np.sqrt(2 * len(w) - 1), label) for w, label in data]
    for epoch in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            bucket, count, norm, label = rows[k]
            x = count / norm
            p = probabilities((x @ weight[bucket] + bias)[None])[0]
            p[label] -= 1
            step = RATE / (1 + epoch)
            weight[bucket] -= step * (np.outer(x, p) + DECAY * weight[bucket])
            bias -= step * 0.1 * p
    model = Model(weight, bias, 0.5)
    if held:
        logits = np.array([weight[_buckets(w)].sum(0) / np.sqrt(2 * len(w) - 1) + bias for w in held])
        model.least = max(0.5, float(np.quantile(probabilities(logits)[:, :UNKNOWN].max(1), 1 - FALSE_SHARE)))
        model.least = min(model.least, 0.95)
    return model


def train(docs: DataFrame, text_column: str = "text") -> Model:
    sample = docs.select(text_of(text_column).alias("text")).mapInArrow(_ordinary, "place long, words binary")
    rows = sample.dropDuplicates(["place"]).orderBy("place").limit(SAMPLE).collect()
    every = [t for templates in template_pairs() for t in templates]
    windows = [np.frombuffer(bytes(r.words), np.uint64) for r in sorted(rows)]
    # A window that a template confirms is not ordinary.
    titles = fixed_words(TITLES)
    return fit([w for w in windows if confirmed(w, every) < CONFIRM and w.tobytes() not in titles])


def _scan(sent):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, templates, titles, tags = sent.value, template_pairs(), fixed_words(TITLES), fixed_words(TAGS)
        for batch in chunks(batches):
            p = Paragraphs(batch.column("text"))
            w, found = p.words, {}
            if len(p.first):
                chance = probabilities(p.logits(model))
                family = chance[:, :UNKNOWN].argmax(1)
                best = chance[np.arange(len(family)), family]
                for k in np.flatnonzero(best >= model.least).tolist():
                    f, a, b = int(family[k]), int(p.first[k]), int(p.last[k])
                    f, share = decided(w.hash[a:b], f, templates)
                    if share >= CONFIRM:
                        found.setdefault(int(w.row[a]), []).append((-share, b - a, -float(best[k]), a, b, f))
                for a, b, f in (*titled(p, titles), *tagged(p, tags)):
                    found.setdefault(int(w.row[a]), []).append((-1.0, b - a, -1.0, a, b, f))
            names, spans, count = [""] * batch.num_rows, [""] * batch.num_rows, [0] * batch.num_rows
            for row, windows in found.items():
                kept = []
                for *_, a, b, f in sorted(windows):
                    if not any(f == g and a < d and c < b for c, d, g in kept):
                        kept.append((a, b, f))
                low = int(w.offsets[row])
                place = code_points(w.data[low:int(w.offsets[row + 1])])
                kept = [(int(place[w.start[a] - low]), int(place[w.end[b - 1] - low]), FAMILIES[f]) for a, b, f in sorted(kept)]
                names[row] = ",".join(sorted({f for *_, f in kept}))
                spans[row] = ",".join(f"{f}:{a}:{b}" for a, b, f in kept)
                count[row] = len(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(count, pa.int64()), pa.array(names), pa.array(spans)],
                ["doc_id", "n_notices", "families", "spans"])

    return work


def licences(docs: DataFrame, model: Model | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_notices, families, spans`` for each row of ``docs``.

    ``spans`` names every notice as family:start:end, in code points, the end not included. ``model`` is what
    ``train`` returns; without it the model is trained on ``docs``.
    """
    model = train(docs, text_column) if model is None else model
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), text_of(text_column).alias("text"))
    return rows.mapInArrow(_scan(sent), "doc_id long, n_notices long, families string, spans string")
