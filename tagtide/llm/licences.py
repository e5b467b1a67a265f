"""Licence scan: a trained paragraph classifier, an unknown class, template comparison.

Paragraphs are classified by logistic regression over sparse word n-grams into licence
families and ``unknown``. It is trained on variants of the notices below (words left out,
other words around them) against paragraphs of the corpus, a bounded sample of
``MOST_PARAGRAPHS``, and mixtures of single notice words with corpus words. A temperature
fitted on variants kept back makes the probabilities honest; the least probability that
counts as known is set so that at most ``FALSE_SHARE`` of the kept-back unknown ones pass.
Lines longer than ``WINDOW`` words are read in windows that overlap by half, so the whole
text counts. Notices may be wrapped: lines between those without words are one paragraph,
in which every place of a notice's length is held against that notice, whatever comment
signs its lines begin with. A place is confirmed if it holds most of the notice's n-grams,
with every name and version in it, and the classifier prefers its family to unknown; so
one line can name several families. Its span is that of its lines.

Nulls and odd rows: null text is the empty text, without findings; repeated rows are
scanned each; ties go to the family first in order; an empty table gives no rows; further
columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtide.llm.folds import hashed_share

MOST_PARAGRAPHS = 3_000
#: Longer paragraphs are no training examples; the scan reads them all.
LONGEST_EXAMPLE = 4_000
VARIANTS = 30
WINDOW = 120
CONFIRMED = 0.7
FALSE_SHARE = 0.002
SEED = 10
UNKNOWN = "unknown"
TOKEN = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")

# Short notices that licences ask for or that are customary, by family.
NOTICES = {
    "AGPL-3.0": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero"
        " General Public License as published by the Free Software Foundation.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in"
        " compliance with the License.",
    ],
    "BSD": [
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0-1.0": [
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 2 of the License, or any"
        " later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or any"
        " later version.",
    ],
    "LGPL-3.0": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation, either version 3 of the License, or"
        " any later version.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
SPDX = "SPDX-License-Identifier:"
IDENTIFIERS = {
    "AGPL-3.0": ["AGPL-3.0-only", "AGPL-3.0-or-later", "AGPL-3.0"],
    "BSD": ["BSD-3-Clause", "BSD-2-Clause"],
    "GPL-2.0": ["GPL-2.0-only", "GPL-2.0-or-later", "GPL-2.0"],
    "GPL-3.0": ["GPL-3.0-only", "GPL-3.0-or-later", "GPL-3.0"],
    "LGPL-3.0": ["LGPL-3.0-only", "LGPL-3.0-or-later", "LGPL-3.0"],
}
for _family, _notices in NOTICES.items():
    _notices += [f"{SPDX} {name}" for name in IDENTIFIERS.get(_family, [_family])]
FAMILIES = [*NOTICES, UNKNOWN]
#: Words that tell a licence from others in the same wording; versions do as well.
NAMES = frozenset(
    "affero apache attribution attribution-noncommercial attribution-sharealike bsd bsd-style by by-nc by-sa cc cc0 lesser"
    " mit mozilla redistribution unencumbered unlicense waived".split()
)
#: These inside a notice of the GPL name one of its sisters.
OTHERS = {family: frozenset("affero lesser library".split()) for family in ("GPL-2.0", "GPL-3.0")}


def ngrams(words: list[str]) -> set[str]:
    """Words, pairs and triples."""
    return {*words, *map(" ".join, zip(words, words[1:], strict=False)), *map(" ".join, zip(words, words[1:], words[2:], strict=False))}


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


TEMPLATES = [(i, ngrams(tokens(t))) for i, family in enumerate(NOTICES) for t in NOTICES[family]]


#: The first word of SPDX lines, and the words between the names in them.
TAG = SPDX.rstrip(":").lower()
EXPRESSION = frozenset("and or with".split())


@dataclass
class Place:
    """What is needed to find one notice in a list of words."""

    family: int
    words: list[str]

    def __post_init__(self) -> None:
        self.grams = ngrams(self.words)
        self.pairs = set(zip(self.words, self.words[1:], strict=False))
        self.marks = {w for w in self.words if w in NAMES or any(c.isdigit() for c in w)}
        self.others = OTHERS.get(list(NOTICES)[self.family], frozenset())
        #: A notice's words may have others between them.
        self.reach = len(self.words) + 2 + len(self.words) // 5

        self.spdx = self.words[0] == TAG

    def named(self, words: list[str], low: int) -> int:
        """The word after this name in the expression that follows a tag at ``low``, or 0.

        An expression names several, of any number, with one word between two.
        """
        for at in range(low + 1, len(words), 2):
            if words[at] == self.words[1]:
                return at + 1
            if at + 1 >= len(words) or words[at + 1] not in EXPRESSION:
                break
        return 0

    def share(self, words: list[str]) -> float:
        return len(ngrams(words) & self.grams) / len(self.grams)

    def found(self, words: list[str], hits: list[int]) -> Iterator[tuple[int, int]]:
        """Ranges of ``words`` that hold most of the notice, without what adds nothing."""
        after = 0
        for at, low in enumerate(hits):
            if low < after:
                continue
            if self.spdx:
                if high := self.named(words, low):
                    yield low, high
                continue
            # the share of the pairs bounds that of all n-grams well enough to pass most places by
            near = hits[at : bisect_left(hits, low + self.reach - 1, lo=at)]
            if 2 * len({(words[i], words[i + 1]) for i in near}) < len(self.pairs):
                continue
            low, high = max(after, low - 1), min(len(words), low + self.reach)
            best = self.share(words[low:high])
            if best < CONFIRMED:
                continue
            while high - low > 1 and self.share(words[low : high - 1]) >= best:
                high -= 1
            while high - low > 1 and self.share(words[low + 1 : high]) >= best:
                low += 1
            held = set(words[low:high])
            # a place of another licence is passed by whole: its end and the next one's start are no notice
            if self.others & held:
                after = high
            elif self.marks <= held:
                yield low, high
                after = high


PLACES = [Place(i, tokens(t)) for i, family in enumerate(NOTICES) for t in NOTICES[family]]
BY_PAIR: dict[tuple[str, str], list[int]] = {}
for _number, _place in enumerate(PLACES):
    for _pair in sorted(_place.pairs):
        BY_PAIR.setdefault(_pair, []).append(_number)


def likeness(found: set[str], family: int) -> float:
    """The share of a notice's n-grams that a paragraph holds, of the best notice."""
    return max(len(found & template) / len(template) for i, template in TEMPLATES if i == family)


@dataclass
class Model:
    columns: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float

    def logits(self, found: set[str]) -> np.ndarray:
        at = [self.columns[g] for g in found if g in self.columns]
        return self.bias + (self.weights[at].sum(axis=0) / np.sqrt(len(at)) if at else 0.0)

    def odds(self, found: set[str]) -> np.ndarray:
        scaled = self.logits(found) / self.temperature
        odds = np.exp(scaled - scaled.max())
        return odds / odds.sum()

    def known(self, found: set[str], family: int) -> float:
        """The family's probability against unknown: other families may be there as well."""
        odds = self.odds(found)
        return float(odds[family] / (odds[family] + odds[-1]))

    def classify(self, found: set[str]) -> tuple[int, float]:
        """The family and its probability; the last family is unknown."""
        odds = self.odds(found)
        best = int(odds.argmax())
        return (best, float(odds[best])) if odds[best] >= self.least else (len(FAMILIES) - 1, float(odds[-1]))


def variants(words: list[str], other: list[list[str]], generator: np.random.Generator) -> list[list[str]]:
    out = [words]
    for _ in range(VARIANTS):
        kept = [w for w in words if generator.random() > 0.1] or words
        around = other[int(generator.integers(len(other)))] if other else []
        at, size = int(generator.integers(len(around) + 1)), int(generator.integers(0, 25))
        out.append(around[max(0, at - size) : at] + kept + around[at : at + int(generator.integers(0, 25))])
    return out


def train(paragraphs: list[str], rounds: int = 200, rate: float = 2.0) -> Model:
    """Softmax regression over the n-grams of the notices, on ``paragraphs`` as unknown ones."""
    generator = np.random.default_rng(SEED)
    plain = [t for t in map(tokens, paragraphs) if t]
    # A corpus holds notices too: those would be wrong examples of the unknown.
    plain = [t for t in plain if max(likeness(ngrams(t), i) for i in range(len(NOTICES))) < 0.5]
    rows, labels = [], []
    for i, family in enumerate(NOTICES):
        for notice in NOTICES[family]:
            found = variants(tokens(notice), plain, generator)
            rows += found
            labels += [i] * len(found)
    all_words = sorted({w for notices in NOTICES.values() for n in notices for w in tokens(n)})
    mixed = []
    for _ in range(20 * VARIANTS):
        around = plain[int(generator.integers(len(plain)))][:40] if plain else []
        picked = [all_words[int(j)] for j in generator.integers(len(all_words), size=int(generator.integers(1, 8)))]
        mixed.append(list(generator.permutation([*around, *picked])))
    rows += plain + mixed
    labels += [len(FAMILIES) - 1] * (len(plain) + len(mixed))
    columns = {g: j for j, g in enumerate(sorted(set().union(*(t for _, t in TEMPLATES))))}
    matrix, y = np.zeros((len(rows), len(columns)), dtype=np.float32), np.array(labels)
    for i, row in enumerate(rows):
        at = [columns[g] for g in ngrams(row) if g in columns]
        matrix[i, at] = 1 / np.sqrt(max(1, len(at)))
    kept_back = generator.random(len(rows)) < 0.2
    x, target = matrix[~kept_back], np.eye(len(FAMILIES), dtype=np.float32)[y[~kept_back]]
    # families and unknown paragraphs weigh the same, whatever their numbers
    weight = (1 / np.maximum(1, target.sum(axis=0)))[y[~kept_back]][:, None].astype(np.float32) / len(FAMILIES)
    weights = np.zeros((len(columns), len(FAMILIES)), dtype=np.float32)
    bias = np.zeros(len(FAMILIES), dtype=np.float32)
    speed, speed_bias = np.zeros_like(weights), np.zeros_like(bias)

    def softmax(z: np.ndarray) -> np.ndarray:
        odds = np.exp(z - z.max(axis=1, keepdims=True))
        return odds / odds.sum(axis=1, keepdims=True)

    for _ in range(rounds):
        error = (softmax(x @ weights + bias) - target) * weight
        speed = 0.9 * speed - rate * (x.T @ error + 1e-4 * weights)
        speed_bias = 0.9 * speed_bias - rate * error.sum(axis=0)
        weights += speed
        bias += speed_bias
    back = matrix[kept_back] @ weights + bias
    truth = y[kept_back]
    grid = np.geomspace(0.25, 4, 25)
    loss = [-np.log(softmax(back / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    false = softmax(back[truth == len(FAMILIES) - 1] / temperature)[:, :-1].max(axis=1, initial=0.0)
    least = max(0.5, float(np.quantile(false, 1 - FALSE_SHARE))) if len(false) else 0.5
    return Model(columns, weights.astype(np.float64), bias.astype(np.float64), temperature, min(least, 0.99))


def fit(docs: DataFrame, most: int = MOST_PARAGRAPHS) -> Model:
    """Trains on paragraphs of about ``most`` documents, one each, picked by a hash."""
    paragraphs = docs.select("doc_id", F.split(F.col("text").cast("string"), "\n").alias("p")).where("p IS NOT NULL")
    picked = paragraphs.where(hashed_share(most, docs.count(), "doc_id"))
    picked = picked.select("doc_id", F.get("p", F.pmod(F.xxhash64("doc_id"), F.size("p")).cast("int")).alias("p"))
    short = picked.where(F.char_length("p") <= LONGEST_EXAMPLE)
    return train([r["p"] for r in short.orderBy("doc_id", "p").collect()])


def paragraph_windows(words: list[str]) -> Iterator[list[str]]:
    for low in range(0, max(1, len(words) - WINDOW // 2), WINDOW // 2):
        yield words[low : low + WINDOW]


def confirmed(words: list[str], model: Model) -> Iterator[tuple[int, int, int, float]]:
    """(first word, word after the last, family, probability) of the notices in a paragraph."""
    tags = [i for i, word in enumerate(words) if word == TAG]
    hits: dict[int, list[int]] = {n: tags for n, place in enumerate(PLACES) if place.spdx} if tags else {}
    for i, pair in enumerate(zip(words, words[1:], strict=False)):
        for number in BY_PAIR.get(pair, ()):
            if PLACES[number].spdx:
                continue
            hits.setdefault(number, []).append(i)
    for number, at in hits.items():
        for low, high in PLACES[number].found(words, at):
            place = PLACES[number]
            # an SPDX line is read for each of its names as if it held no other
            probability = model.known(place.grams if place.spdx else ngrams(words[low:high]), place.family)
            if probability >= model.least:
                yield low, high, place.family, probability


def scan_text(text: str, model: Model) -> tuple[list[tuple[int, int, int]], int, float]:
    """Confirmed (start, end, family) of lines; places predicted; best probability."""
    spans, predicted, best, start = [], 0, 0.0, 0
    paragraph: list[tuple[int, int, list[str]]] = []  # start, end and words of its lines
    for line in [*text.split("\n"), ""]:
        words = tokens(line)
        if words:
            paragraph.append((start, start + len(line), words))
        elif paragraph:
            found, places, odds = scan_paragraph(paragraph, model)
            spans += found
            predicted += places
            best = max(best, odds)
            paragraph = []
        start += len(line) + 1
    return spans, predicted, best


def scan_paragraph(
    lines: list[tuple[int, int, list[str]]], model: Model
) -> tuple[list[tuple[int, int, int]], int, float]:
    words = [w for *_, some in lines for w in some]
    # without one pair of a notice's words nothing can be confirmed
    if TAG not in words and not any(map(BY_PAIR.__contains__, zip(words, words[1:], strict=False))):
        return [], 0, 0.0
    places, spans, best = set(), set(), 0.0
    for n, (*_, some) in enumerate(lines):
        if any(map(BY_PAIR.__contains__, zip(some, some[1:], strict=False))):
            if any(model.classify(ngrams(w))[0] < len(FAMILIES) - 1 for w in paragraph_windows(some)):
                places.add((n, n))
    line_of = [n for n, (*_, some) in enumerate(lines) for _ in some]
    for low, high, family, probability in confirmed(words, model):
        first, last = line_of[low], line_of[high - 1]
        places.add((first, last))
        spans.add((first, last, family))
        best = max(best, probability)
    # one notice may hold a shorter one of its family; what shares lines is one place
    own = {x for x in spans if not any(x != y and x[2] == y[2] and y[0] <= x[0] and x[1] <= y[1] for y in spans)}
    predicted, reach = 0, -1
    for first, last in sorted(places):
        predicted += first > reach
        reach = max(reach, last)
    return [(lines[a][0], lines[b][1], family) for a, b, family in sorted(own)], predicted, best


def report(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, licences, n_predicted, n_confirmed, confidence and spans per document."""
    model = fit(docs) if model is None else model
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in range(0, batch.num_rows, 1024):
                few = batch.slice(cut, 1024)
                out: list[tuple] = []
                for text in few.column(1).to_pylist():
                    spans, predicted, best = scan_text(text or "", model)
                    told = ",".join(f"{FAMILIES[f]}:{s}:{e}" for s, e, f in spans)
                    named = ",".join(sorted({FAMILIES[f] for *_, f in spans}))
                    out.append((named, predicted, len(spans), best, told))
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.string()]
                columns = [pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [few.column(0), *columns], ["doc_id", "licences", "n_predicted", "n_confirmed", "confidence", "spans"]
                )

    return rows.mapInArrow(
        run, f"doc_id {kind}, licences string, n_predicted long, n_confirmed long, confidence double, spans string"
    )
