"""Licence notices: a sparse word n-gram logistic regression over paragraphs names the licence family or
none, its probabilities are calibrated, and a comparison with templates confirms what it says."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

from .common import doc_texts, slices

#: paragraphs of the corpus that stand for the unknown class in training, at most
CORPUS_PARAGRAPHS = 4000
#: probability that a family needs, and share of a template's word trigrams that confirms it
PROBABILITY, CONFIRM = 0.5, 0.6
#: distances between the starts of the parts of a paragraph that is longer than this, in words
PART_WORDS = 200
UNKNOWN = "unknown"

#: notices by family (fixed values: customary wordings of public licences)
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License.",
        "Licensed under the GNU Lesser General Public License, version 2.1."],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Released under the BSD 3-Clause License."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at mozilla.org."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
}
#: notices of licences outside the families (fixed values): every second one is learned as unknown, the others calibrate it
FOREIGN = [
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "Licensed under the GNU Affero General Public License, version 3.",
    "This package is free software; you may redistribute it under the terms of the Artistic License 2.0.",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    "This software is provided 'as-is', without any express or implied warranty, under the zlib License.",
    "Distributed under the Boost Software License, Version 1.0.",
    "Licensed under the European Union Public Licence, version 1.2.",
    "This file is subject to the terms of the Common Development and Distribution License, version 1.0.",
    "This is free and unencumbered software released into the public domain.",
    "Released under the Microsoft Public License.",
    "This font software is licensed under the SIL Open Font License, version 1.1.",
    "All rights reserved. No part of this software may be copied or distributed without a commercial license.",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "Licensed under the ISC License.",
    "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
    "Licensed under the Unlicense.", "Released under the Artistic License.", "Published under the Open Database License.", "Licensed under the EPL 1.0."]

#: words too common to speak for a licence alone (fixed values)
_COMMON = frozenset("a an and any any are as at be by can copy either file following for free if in is it list may met met must "
                    "not of on one or person shall source terms that the this to under use use version was with without work you your "
                    "above all any charge code either except form forms later library program portions provided".split())

_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
FAMILIES = [UNKNOWN, *TEMPLATES]


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


#: words of templates that can speak for a licence; a paragraph without any has no n-gram of the classifier
SPEAKING = frozenset(w for ts in TEMPLATES.values() for t in ts for w in words_of(t)) - _COMMON


#: trigrams of the templates, with their family
SHAPES = [(f, {tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))}) for f, ts in TEMPLATES.items() for w in map(words_of, ts)]
#: words that stand before a comment's text in some languages; other comment signs hold no word
_REMARK = re.compile(r"[^\w\n]*(?:dnl|rem)\b", re.IGNORECASE)


def ngrams(words: list[str]) -> set[str]:
    """N-grams of one to three words that hold a speaking word."""
    last = len(words)
    return {" ".join(words[i:i + k]) for at, w in enumerate(words) if w in SPEAKING
            for k in (1, 2, 3) for i in range(max(0, at - k + 1), min(at, last - k) + 1)}


def overlap(words: list[str], family: str | None = None) -> float:
    """Greatest share of a template's trigrams (of ``family``, or of any) that stand in ``words``."""
    have = {tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))}
    return max(len(have & shape) / len(shape) for f, shape in SHAPES if family is None or f == family)


def parts(words: list[str]):
    """(part, first word, words) of the overlapping parts that hold a speaking word."""
    for part, at in enumerate(range(0, max(1, len(words) - PART_WORDS // 2), PART_WORDS // 2)):
        piece = words[at:at + PART_WORDS]
        if not SPEAKING.isdisjoint(piece):
            yield part, at, piece


def runs(text: str, alone):
    """Lists of (number, words) of consecutive lines that hold words, without comment signs. A line of which ``alone``
    is true is a list of its own and parts those around it."""
    run: list = []
    for n, line in enumerate(text.split("\n")):
        m = _REMARK.match(line)
        words = words_of(line[m.end():] if m else line)
        if words and not alone(words):
            run.append((n, words))
            continue
        if run:
            yield run
            run = []
        if words:
            yield [(n, words)]
    if run:
        yield run


def stated(words: list[str]) -> bool:
    return not SPEAKING.isdisjoint(words) and overlap(words) >= CONFIRM


def pieces(text: str):
    """Words of all lines and of all joined lines, in parts, that can be judged."""
    for run in runs(text, stated):
        for _, words in run:
            yield from (w for _, _, w in parts(words))
        if len(run) > 1:
            yield from (w for _, _, w in parts([w for _, words in run for w in words]))


def notices(text: str, judge):
    """(number of the first line, part, *judgement) of the paragraphs of a text that ``judge(words)`` says something of:
    (family, probability, overlap, confirmed) or None. Paragraphs are lines that are confirmed alone, and the joined
    consecutive lines between these and blank lines; a line that alone names a family, which the joined parts around it do
    not name, is told too."""
    seen: dict = {}

    def of_line(words):
        key = " ".join(words)
        if key not in seen:
            seen[key] = [(part, at, said) for part, at, piece in parts(words) if (said := judge(piece))]
        return seen[key]

    for run in runs(text, lambda words: any(said[3] for _, _, said in of_line(words))):
        joined = []
        if len(run) > 1:
            joined = [(part, at, said) for part, at, piece in parts([w for _, words in run for w in words]) if (said := judge(piece))]
            yield from ((run[0][0], part, *said) for part, _, said in joined)
        first = 0
        for n, words in run:
            for part, at, said in of_line(words):
                if not any(said[0] == s[0] and x <= first + at < x + PART_WORDS for _, x, s in joined):
                    yield (n, part, *said)
            first += len(words)


def may_speak(text: str) -> bool:
    """Whether a text can hold a speaking word: a quick look, exact where it says no."""
    return not SPEAKING.isdisjoint(_WORD.findall(text.lower()))


class Model:
    def __init__(self, feature: dict[str, int], weights: np.ndarray, temperature: float = 1.0, doubt: float = 0.0):
        self.feature, self.weights, self.temperature, self.doubt = feature, weights, temperature, doubt

    def logits(self, words: list[str]) -> np.ndarray:
        return self.weights[[0, *(self.feature[g] for g in ngrams(words) if g in self.feature)]].sum(axis=0)

    def chances(self, words: list[str]) -> np.ndarray:
        """Probabilities of the classes: the temperature flattens what the fit is too sure of, ``doubt`` is added to unknown."""
        z = self.logits(words) / self.temperature
        z[0] += self.doubt
        e = np.exp(z - z.max())
        return e / e.sum()

    def judge(self, words: list[str], probability: float, confirm: float) -> tuple | None:
        """(family, probability, overlap, confirmed) of a part that states a licence."""
        p = self.chances(words)
        k = int(p.argmax())
        if not k or p[k] < probability:
            return None
        share = overlap(words, FAMILIES[k])
        return FAMILIES[k], float(p[k]), share, share >= confirm


def _variants(words: list[str], around: list[list[str]]) -> list[list[str]]:
    """A notice whole, with every word left out once, and inside corpus words."""
    return [words] * 4 + [words[:i] + words[i + 1:] for i in range(len(words)) if len(words) > 8] + [a + words + a for a in around[:20]]


def _training(corpus: list[list[str]]) -> list[tuple[list[str], int, int]]:
    """(words, class, notice) of labelled paragraphs: the variants of each template; for the unknown class those of foreign
    notices, corpus paragraphs (notice -1), and single speaking words among them, which prove nothing. Notices are numbered
    so that all variants of one can be held out together."""
    out = []
    around = [w[:12] for w in corpus if w][:40] or [["some", "other", "words"]]
    notices = [(words_of(t), k) for k, ts in enumerate(TEMPLATES.values(), 1) for t in ts] + [(words_of(t), 0) for t in FOREIGN]
    variants = [_variants(words, around) for words, _ in notices]
    told = Counter(w for ws in variants for w in {tuple(w) for w in ws})  # what several notices come down to tells none of them
    for n, (_, k) in enumerate(notices):
        out += [(w, k, n) for w in variants[n] if told[tuple(w)] == 1]
    out += [(w, 0, -1) for w in corpus]
    speaking = sorted(SPEAKING)
    out += [([*around[i % len(around)], w, *around[(i + 1) % len(around)]], 0, -1) for i, w in enumerate(speaking) for _ in range(2)]
    return out


def _descend(rows: list[tuple[list[str], int, int]], rounds: int) -> Model:
    """Multinomial logistic regression by gradient descent with momentum, all classes of equal weight."""
    feature: dict[str, int] = {}
    for words, *_ in rows:
        for g in sorted(ngrams(words)):
            feature.setdefault(g, len(feature) + 1)
    k = len(FAMILIES)
    owner, col = [], []
    for i, (words, *_) in enumerate(rows):
        for c in (0, *(feature[g] for g in ngrams(words))):
            owner.append(i)
            col.append(c)
    owner, col = np.array(owner), np.array(col)
    y = np.array([r[1] for r in rows])
    share = 1.0 / (k * np.maximum(np.bincount(y, minlength=k), 1)[y])
    w, v = np.zeros((len(feature) + 1, k)), np.zeros((len(feature) + 1, k))
    target = np.eye(k)[y]
    for _ in range(rounds):
        z = np.zeros((len(rows), k))
        np.add.at(z, owner, w[col])
        e = np.exp(z - z.max(axis=1, keepdims=True))
        d = (e / e.sum(axis=1, keepdims=True) - target) * share[:, None]
        grad = np.zeros_like(w)
        np.add.at(grad, col, d[owner])
        v = 0.9 * v - 2.0 * (grad + 1e-5 * w)
        w = w + v
    return Model(feature, w)


def _held_out(n: int) -> bool:
    """Whether notice n calibrates: every third template (its family is learned from the others, where it has any), every second foreign one."""
    first = sum(map(len, TEMPLATES.values()))
    return n >= 0 and (n % 3 == 2 if n < first else (n - first) % 2 == 1)


def train(corpus: list[list[str]], rounds: int = 300) -> Model:
    """The classifier, fitted to all families' templates, the corpus and the foreign notices that are not held out.

    Its temperature and the doubt added to the unknown class are calibrated on whole notices that a first fit has not seen: held-out
    templates and foreign licences, each notice of equal weight. A held-out template whose wording says nothing of its family
    to that fit is as well unknown, so probabilities are no surer than the evidence."""
    rows = _training(corpus)
    first = _descend([r for r in rows if not _held_out(r[2])], rounds)
    rest = [r for r in rows if _held_out(r[2])]
    z = np.stack([first.logits(words) for words, *_ in rest])
    y = np.array([r[1] for r in rest])
    size = np.bincount([r[2] for r in rest])
    weight = 1.0 / size[[r[2] for r in rest]]

    def loss(t, doubt):
        s = z / t
        s[:, 0] += doubt
        s -= s.max(axis=1, keepdims=True)
        logp = s - np.log(np.exp(s).sum(axis=1, keepdims=True))
        return -(weight * np.maximum(logp[np.arange(len(y)), y], -12)).sum() / weight.sum()

    grid = [(t, d) for t in (0.7, 1.0, 1.4, 2.0, 2.8, 4.0) for d in (0.0, 0.5, 1.0, 1.5, 2.0, 3.0)]
    learned = len(TEMPLATES) and sum(map(len, TEMPLATES.values()))
    model = _descend([r for r in rows if r[2] < learned or not _held_out(r[2])], rounds)
    model.temperature, model.doubt = min(grid, key=lambda g: loss(*g))
    return model


def fit(docs: DataFrame) -> Model:
    """A model whose unknown class is learned from at most CORPUS_PARAGRAPHS paragraphs of ``docs``, those with the least
    hashes among the parts of paragraphs that hold a speaking word and no trigram of a template, as whole as they are judged."""
    shapes = set().union(*(shape for _, shape in SHAPES))

    def run(batches):
        for _, texts in slices(batches):
            found = Counter()
            for t in texts:
                if may_speak(t):
                    found.update(" ".join(w) for w in pieces(t)
                                 if not any(tuple(w[i:i + 3]) in shapes for i in range(len(w))))
            yield pa.record_batch([pa.array(list(found), pa.string())], ["paragraph"])

    found = materialize(doc_texts(docs).mapInArrow(run, "paragraph string").distinct()
                        .select("paragraph", F.pmod(F.xxhash64("paragraph"), F.lit(1 << 30)).alias("h")), "paragraphs")
    # of the least hashes a share of four times the need is enough; the exact choice is made among them
    n, share = found.count(), 4.0 * CORPUS_PARAGRAPHS
    while True:
        part = found.where(F.col("h") <= F.lit(min(1.0, share / max(n, 1)) * (1 << 30)))
        rows = part.orderBy("h", "paragraph").limit(CORPUS_PARAGRAPHS).collect()
        if len(rows) >= min(n, CORPUS_PARAGRAPHS):
            return train([r.paragraph.split(" ") for r in rows])
        share *= 4


def find(docs: DataFrame, probability: float = PROBABILITY, confirm: float = CONFIRM) -> DataFrame:
    """``doc_id, paragraph, part, family, probability, template_overlap, confirmed``: every paragraph of every document whose
    likeliest class is a licence family with at least ``probability``. ``confirmed`` says that ``confirm`` of the word trigrams of
    one of the family's templates stand in it. Paragraphs are runs of consecutive lines without comment signs, numbered by their
    first line, counted from 0; blank lines and lines that are confirmed alone cut them (see ``notices``). One of more than
    PART_WORDS words is judged in overlapping parts. A paragraph without a speaking word has no feature and is unknown.

    Null and empty texts give no row; repeated rows give repeated rows; empty tables give empty results; ties go to the
    family first in order. Other columns are not read."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs))
    schema = ("doc_id long, paragraph long, part long, family string, probability double, template_overlap double, "
              "confirmed boolean")

    def run(batches):
        m = model.value
        for ids, texts in slices(batches):
            rows = []
            for i, t in zip(ids, texts):
                if not may_speak(t):
                    continue
                rows += [(i, *x) for x in notices(t, lambda words: m.judge(words, probability, confirm))]
            kinds = [pa.int64()] * 3 + [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
            cols = list(zip(*rows)) if rows else [[]] * len(kinds)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], [f.split()[0] for f in schema.split(", ")])

    return doc_texts(docs).mapInArrow(run, schema)
