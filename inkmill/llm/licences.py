"""Licence statements in documents, by a trained paragraph classifier.

A multinomial logistic regression over word n-grams of the licence templates
is trained on seeded variants of the templates, on statements of licences that
are not listed (the unknown class) and on ordinary sentences. Its temperature
is set on variants held out from training, so that the probability with which
a family is named is calibrated; below ``floor`` the answer is unknown.

Templates then confirm what the classifier says. A family stands if one of its
templates has all its key phrases in the text, word by word, and enough of its
word pairs, and if no other family's best template has more. An unknown
licence stands if a licence is spoken of beside a word of licensing.

Paragraphs end at blank lines, also within comment signs; a single line break
is a blank like any other, so wrapped statements are whole. Paragraphs, and
each line by itself, are read in overlapping windows, so whole texts are
scanned whatever their length.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from inkmill.llm.work import same_or_null

#: Licence families and statements that name them; key phrases are in brackets.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the [Apache License, Version 2.0].",
        "Licensed under the [Apache License, Version 2.0] (the \"License\"); you may not use this file except in compliance with the License.",
        "This project is released under the [Apache License 2.0]",
        "[SPDX-License-Identifier: Apache-2.0]",
    ),
    "mit": (
        "Released under the [MIT License].",
        "This software is licensed under the [MIT License]",
        "[Permission is hereby granted, free of charge, to any person obtaining a copy] of this software and associated documentation files, to deal in the Software without restriction",
        "[SPDX-License-Identifier: MIT]",
    ),
    "isc": (
        "Licensed under the [ISC License].",
        "[Permission to use, copy, modify, and/or distribute this software for any purpose] with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
        "[SPDX-License-Identifier: ISC]",
    ),
    "gpl-3.0": (
        "This work is licensed under the [GNU General Public License, version 3].",
        "This program is free software: you can redistribute it and/or modify it under the terms of the [GNU General Public License] as published by the Free Software Foundation, either [version 3 of the License], or any later version",
        "Distributed under the [GPL version 3]",
        "[SPDX-License-Identifier: GPL-3.0]-only",
    ),
    "gpl-2.0": (
        "This work is licensed under the [GNU General Public License, version 2].",
        "This program is free software; you can redistribute it and/or modify it under the terms of the [GNU General Public License] as published by the Free Software Foundation; either [version 2 of the License], or any later version",
        "Distributed under the [GPL version 2]",
        "[SPDX-License-Identifier: GPL-2.0]-only",
    ),
    "agpl-3.0": (
        "Licensed under the [GNU Affero General Public License, version 3].",
        "This program is free software: you can redistribute it and/or modify it under the terms of the [GNU Affero General Public License] as published by the Free Software Foundation, either [version 3 of the License], or any later version",
        "Distributed under the [AGPL version 3]",
        "[SPDX-License-Identifier: AGPL-3.0]-only",
    ),
    "lgpl-3.0": (
        "Licensed under the [GNU Lesser General Public License, version 3].",
        "This library is free software: you can redistribute it and/or modify it under the terms of the [GNU Lesser General Public License] as published by the Free Software Foundation, either [version 3 of the License], or any later version",
        "released under the [LGPL version 3]",
        "[SPDX-License-Identifier: LGPL-3.0]-only",
    ),
    "cc-by-4.0": (
        "Licensed under [CC BY 4.0].",
        "This work is licensed under a [Creative Commons Attribution 4.0 International] License.",
        "[SPDX-License-Identifier: CC-BY-4.0]",
    ),
    "cc-by-nc-4.0": (
        "Licensed under [CC BY-NC 4.0].",
        "This work is licensed under a [Creative Commons Attribution-NonCommercial 4.0 International] License.",
        "[SPDX-License-Identifier: CC-BY-NC-4.0]",
    ),
    "cc-by-sa-4.0": (
        "Licensed under [CC BY-SA 4.0].",
        "This work is licensed under a [Creative Commons Attribution-ShareAlike 4.0 International] License.",
        "[SPDX-License-Identifier: CC-BY-SA-4.0]",
    ),
    "cc0-1.0": (
        "Released under [CC0 1.0 Universal], no rights reserved.",
        "To the extent possible under law, the author has [waived all copyright and related rights] to this work, CC0 1.0 public domain dedication",
        "[SPDX-License-Identifier: CC0-1.0]",
    ),
    "bsd-3-clause": (
        "Licensed under the [BSD 3-Clause] License.",
        "[Redistribution and use in source and binary forms], with or without modification, are permitted provided that the following conditions are met",
        "[SPDX-License-Identifier: BSD-3-Clause]",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the [Mozilla Public License, v. 2.0].",
        "Licensed under the [Mozilla Public License, version 2.0].",
        "[SPDX-License-Identifier: MPL-2.0]",
    ),
    "reserved": (
        "[All rights reserved].",
        "No part of this publication may be reproduced without prior written permission of the publisher. [All rights reserved].",
    ),
}
#: Statements of no listed licence ({} takes an invented name), and sentences that only sound like one.
UNLISTED = (
    "Licensed under the {} License, version {}.",
    "Licensed under the {} License.",
    "Licensed under the {}, Version {}.",
    "Released under the {} License.",
    "This work is licensed under the {} Public License.",
    "Released under the terms of the {} licence agreement",
    "You may use this software under the {} License",
    "Distributed under {} terms, see the license file for details",
    "Distributed under the {} Software License, Version {}.",
    "The contents of this file are subject to the terms of the {} License",
    "This program is made available under the terms of the {} Public License v. {}",
    "This work is licensed under the GNU {} License, version {}.",
    "This work is licensed under a Creative Commons {} {} License.",
    "SPDX-License-Identifier: {}-{}",
)
ORDINARY = (
    "He renewed his driving license at the office last week",
    "The restaurant lost its license to serve drinks",
    "Her fishing licence expired under the terms of the old act",
    "A driver's license is available for use in the new year",
    "The city issued a public notice and a general version of the plan",
    "Version 2.0 of the software was released on Monday",
    "She used poetic licence in the third version of the text",
    "Apache helicopters and the creative director were under attack",
    "The mozilla browser opened a public page under the tab",
    "MIT students released a free documentary",
    "The foundation published terms of use for the source",
    "This work is about the general public and its rights",
    "by nc and cc to 4 or 0 under",
    "The committee licensed a new restaurant under the bridge",
    "The council licensed under the old rules for taxis",
    "Permission was granted by the mayor to use the hall",
    "All rights of way were reserved for the guests of the hotel",
    "The notice was distributed under the door of every room",
)
#: What an unlisted licence is called, and the words beside which it is one.
NAMES = ("license", "licence", "version")
ACTS = ("licensed", "licenced", "released", "distributed", "available", "subject", "terms", "use", "redistribute", "spdx")
#: Words that may surround anything; n-grams of these alone are no features.
COMMON = frozenset("a about all an and any are as at be by can do file following for from has have he her his if in is it its may no not of on or s see she that the their they this to use v was were with without work you der die das und la le les de des en el los que y et un une mit".split())

_TOKEN = re.compile(rb"\n[\s*#/;%|>-]*\n[\s*#/;%|>-]*|\n|[a-z0-9\x80-\xff]+")
_BREAK, _LINE = crc32(b"\n\n"), crc32(b"\n")
WINDOW, STRIDE, NEAR = 64, 32, 12


def _tokens(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and paragraph breaks, and the number of each one's line."""
    found = [t if t[0] != 10 else b"\n" if len(t) == 1 else b"\n\n" for t in _TOKEN.findall((text or "").lower().encode("utf-8", "surrogatepass"))]
    h = np.fromiter(map(crc32, found), np.uint64, len(found))
    ends = (h == _LINE) | (h == _BREAK)
    line = np.cumsum(ends) - ends
    words = h != _LINE
    return h[words], line[words]


def _plain(template: str) -> str:
    return template.replace("[", "").replace("]", "")


def _ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n tokens; runs over a paragraph break never equal a feature, as no template has one."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out = (out * np.uint64(0x100000001B3)) ^ h[k : len(h) - n + 1 + k]
    return out + np.uint64(n << 59)


@dataclass(frozen=True)
class Template:
    pairs: np.ndarray  # sorted word-pair hashes
    keys: tuple  # (length, hash) of every key phrase

    @staticmethod
    def of(text: str) -> Template:
        phrases = [_tokens(k)[0] for k in re.findall(r"\[(.*?)\]", text)]
        return Template(np.unique(_ngrams(_tokens(_plain(text))[0], 2)), tuple((len(k), int(_ngrams(k, len(k))[0])) for k in phrases))

    def share(self, words: np.ndarray) -> float:
        """Of the template's word pairs (of twelve, if it has more), the share that the words hold; 0 if a key phrase is missing."""
        if not all((_ngrams(words, n) == np.uint64(k)).any() for n, k in self.keys):
            return 0.0
        return min(1.0, np.isin(self.pairs, _ngrams(words, 2)).sum() / min(len(self.pairs), 12))


@dataclass(frozen=True)
class LicenceModel:
    classes: tuple[str, ...]  # none, unknown, families
    features: np.ndarray  # sorted hashes
    weights: np.ndarray  # feature x class
    bias: np.ndarray
    temperature: float
    templates: dict[str, tuple[Template, ...]]
    floor: float
    share: float

    def counts(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature numbers found in a token sequence, where each starts, and of how many tokens it is."""
        numbers, places, sizes = [], [], []
        for n in (1, 2, 3):
            g = _ngrams(h, n)
            at = np.searchsorted(self.features, g)
            hit = np.nonzero(self.features[np.minimum(at, len(self.features) - 1)] == g)[0]
            numbers.append(at[hit])
            places.append(hit)
            sizes.append(np.full(len(hit), n))
        return np.concatenate(numbers), np.concatenate(places), np.concatenate(sizes)

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def scan(self, text: str | None) -> list[tuple[int, str, float]]:
        """(paragraph, family or unknown, probability) of every licence that a paragraph states, by its surest window.

        A window that overlaps one that names a family is not unknown.
        """
        h, line = _tokens(text)
        if not len(h):
            return []
        numbers, places, sizes = self.counts(h)
        if not len(numbers):
            return []
        breaks = h == _BREAK
        paragraph = np.cumsum(breaks) - breaks
        windows = np.concatenate([self._windows(unit, numbers, places, sizes) for unit in (paragraph, line)], axis=1)
        spans, of = np.unique(windows[:2], axis=1, return_inverse=True)
        once = np.unique(np.stack([of.ravel(), windows[2]]), axis=1)  # a repeated n-gram counts once
        logits = np.tile(self.bias, (spans.shape[1], 1))
        np.add.at(logits, once[0], self.weights[once[1]])
        p = self.probabilities(logits)
        named, unsure = {}, []
        for row in np.nonzero(p[:, 0] < 0.5)[0]:
            a, b = spans[:, row].tolist()
            family, sure = self._confirmed(p[row], h[a:b]), float(1 - p[row, 0])
            if family == "unknown":
                unsure.append((a, b, sure))
            elif family:
                key = int(paragraph[a]), family
                named[key] = max(named.get(key, (0.0,)), (sure, a, b))
        taken = [(a, b) for _, a, b in named.values()]
        found = {key: best[0] for key, best in named.items()}
        for a, b, sure in unsure:
            if not any(a < d and c < b for c, d in taken):
                key = int(paragraph[a]), "unknown"
                found[key] = max(found.get(key, 0.0), sure)
        return [(*key, sure) for key, sure in sorted(found.items())]

    def _windows(self, unit: np.ndarray, numbers: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """(start, stop, feature number) of every feature in each of the two windows of its unit that it starts in."""
        whole = unit[places] == unit[places + sizes - 1]
        numbers, places = numbers[whole], places[whole]
        edge = np.concatenate([[True], unit[1:] != unit[:-1]])
        starts = np.maximum.accumulate(np.where(edge, np.arange(len(unit)), 0))
        ends = np.append(np.nonzero(edge)[0][1:], len(unit))[np.cumsum(edge) - 1]
        stretch = (places - starts[places]) // STRIDE
        out = []
        for k in (stretch, np.maximum(stretch - 1, 0)):
            first = starts[places] + k * STRIDE
            out.append(np.stack([first, np.minimum(first + WINDOW, ends[places]), numbers]))
        return np.concatenate(out, axis=1)

    def _confirmed(self, p: np.ndarray, words: np.ndarray) -> str | None:
        """The family that probability and templates agree on, unknown, or None where nothing speaks of a licence."""
        shares = {f: max(t.share(words) for t in of) for f, of in self.templates.items()}
        k, most = int(np.argmax(p[1:])) + 1, max(shares.values())
        if k >= 2 and p[k] / (1 - p[0]) >= self.floor and most >= self.share and shares[self.classes[k]] == most:
            return self.classes[k]
        names = np.nonzero(np.isin(words, _NAMES))[0]
        acts = np.nonzero(np.isin(words, _ACTS))[0]
        spoken = len(names) and len(acts) and (np.abs(names[:, None] - acts) <= NEAR).any()
        return "unknown" if spoken else None


_NAMES, _ACTS = (np.array([crc32(w.encode()) for w in of], np.uint64) for of in (NAMES, ACTS))


def _variants(rng: random.Random, per_template: int, left_out: tuple[str, ...] = ()) -> Iterator[tuple[str, str]]:
    """(class, text) of seeded training paragraphs."""

    def invented() -> str:
        return "".join(rng.choice("bcdfglmnprstv") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))

    def around(text: str) -> str:
        filler = [rng.choice((invented(), rng.choice(sorted(COMMON)))) for _ in range(rng.choice((0, 0, 3, 10, 30)))]
        cut = rng.randint(0, len(filler))
        return " ".join([*filler[:cut], text, *filler[cut:]])

    def worn(text: str) -> str:
        """A text of which the ends are lost, never a key phrase."""
        words, first, last = text.split(), text[: text.index("[")].count(" "), text[: text.rindex("]") + 1].count(" ")
        if len(words) > 8 and rng.random() < 0.7:
            words = words[rng.randint(0, min(first, len(words) // 3)) : max(last + 1, len(words) - rng.randint(0, len(words) // 3))]
        return " ".join(words)

    families = {f: of for f, of in TEMPLATES.items() if f not in left_out}
    for family, texts in families.items():
        for text in texts:
            for _ in range(per_template):
                yield family, around(_plain(worn(text) if rng.random() < 0.4 else text))
    for _ in range(per_template * 24):
        names = " ".join(invented().title() for _ in range(rng.randint(1, 3)))
        yield "unknown", around(rng.choice(UNLISTED).format(names, rng.choice(("1.0", "2.0", "3", "4.1", "7"))))
    for _ in range(per_template * 8):
        yield "none", around(rng.choice(ORDINARY))
        yield "none", around(" ".join(rng.sample(_plain(rng.choice(rng.choice(list(families.values())))).split(), 2)) if rng.random() < 0.7 else " ".join(rng.sample(rng.choice(ORDINARY).split(), 4)))
        yield "none", around("")


def train_licences(seed: int = 3, per_template: int = 40, steps: int = 250, l2: float = 1e-3, floor: float = 0.6, share: float = 0.55, left_out: tuple[str, ...] = ()) -> LicenceModel:
    """Train on seeded variants (about four thousand short paragraphs, on the driver); every fifth sets the temperature.

    ``left_out``: families that the model is not to know.
    """
    rng = random.Random(seed)
    rows = list(_variants(rng, per_template, left_out))
    rng.shuffle(rows)
    known = {f: of for f, of in TEMPLATES.items() if f not in left_out}
    classes = ("none", "unknown", *known)
    common = {crc32(w.encode()) for w in COMMON}
    features: set[int] = set()
    for text in [_plain(t) for texts in known.values() for t in texts] + [u.format("", "") for u in UNLISTED]:
        h = _tokens(text)[0]
        special = np.array([x not in common for x in h.tolist()])
        for n in (1, 2, 3):
            g = _ngrams(h, n)
            features |= {int(x) for k, x in enumerate(g) if special[k : k + n].any()}
    listed = np.array(sorted(features), np.uint64)
    templates = {f: tuple(map(Template.of, texts)) for f, texts in known.items()}
    model = LicenceModel(classes, listed, np.zeros((len(listed), len(classes))), np.zeros(len(classes)), 1.0, templates, floor, share)
    x = np.zeros((len(rows), len(listed)))
    for k, (_, text) in enumerate(rows):
        x[k, model.counts(_tokens(text)[0])[0]] = 1.0
    y = np.eye(len(classes))[[classes.index(c) for c, _ in rows]]
    held = np.arange(len(rows)) % 5 == 0
    w, b, gw, gb = model.weights.copy(), model.bias.copy(), 1e-8, 1e-8
    for _ in range(steps):
        e = (model.probabilities(x[~held] @ w + b) - y[~held]) / (~held).sum()
        dw, db = x[~held].T @ e + l2 * w / 10, e.sum(0)
        gw, gb = gw + dw * dw, gb + db * db
        w, b = w - 0.5 * dw / np.sqrt(gw), b - 0.5 * db / np.sqrt(gb)
    logits = x[held] @ w + b

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(1, keepdims=True)
        return float(-((z - np.log(np.exp(z).sum(1, keepdims=True))) * y[held]).sum())

    temperature = min((0.3 * 1.15**k for k in range(24)), key=loss)
    return LicenceModel(classes, listed, w, b, temperature, templates, floor, share)


def find_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: LicenceModel | None = None) -> DataFrame:
    """Licence statements of every document: id, found array<struct<paragraph, family, probability>>.

    A map over the scan. A paragraph's family is listed once. ``family`` is
    unknown where a statement is no listed licence or no template confirms it. Null, empty and plain texts
    give an empty array; repeated rows and null ids are kept; extra columns are
    ignored; an empty table gives an empty table.
    """
    model = model or train_licences()
    kind = pa.list_(pa.struct([("paragraph", pa.int64()), ("family", pa.string()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                found = [[{"paragraph": a, "family": f, "probability": p} for a, f, p in model.scan(t)] for t in rows.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column(0).cast(pa.int64()), pa.array(found, kind)], ["id", "found"])

    return same_or_null(docs, id_col, text_col).mapInArrow(run, "id long, found array<struct<paragraph:long,family:string,probability:double>>")
