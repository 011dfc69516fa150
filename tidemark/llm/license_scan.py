"""Licence notices by a trained paragraph classifier.

Logistic regression over sparse word n-grams reads windows of a text and names a licence family or the unknown class; its
temperature is fitted on examples it has not seen. Only what it names is compared with the templates of that family, which
confirm the notice with a score and say where it stands. The examples are the templates, cut, thinned and set into corpus
words, and as unknown, shuffled templates and windows of paragraphs, sampled by hash over whole texts up to a stated number.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import doc_columns, map_rows

#: The wording of public licence notices by family.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Apache License 2.0",
        "Licensed under the Apache 2.0 license",
        "SPDX-License-Identifier: Apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
    ],
    "BSD": [
        "Released under the BSD License",
        "BSD 3-Clause License",
        "BSD 2-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0",
        "licensed under a Creative Commons Attribution 4.0 International License",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3",
        "GNU General Public License",
        "GNU GPL v3",
        "GNU GPL v2",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by",
    ],
    "LGPL": [
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "GNU Lesser General Public License",
        "GNU LGPL v3",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "MIT": [
        "Released under the MIT License",
        "MIT License",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Mozilla Public License Version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
}
FAMILIES = ["unknown", *TEMPLATES]
#: Parameters: words of a window and its step, shorter reads inside it, examples of a template, sampled paragraphs,
#: acceptance by the classifier and by the template, training.
WINDOW, STEP, READS, COPIES, SAMPLE, MIN_PROBABILITY, MIN_TEMPLATE = 48, 24, (24, 12, 6), 24, 2000, 0.5, 0.7
ROUNDS, RATE, DECAY = 300, 2.0, 1e-4
SPARE = 4  # words that a notice may have beyond its template
#: Words of a template that may start a read: long ones, and the short names of licences.
WORD, KEY_LETTERS, NAMES = re.compile(r"[^\W_]+"), 5, {"bsd", "gnu", "gpl", "lgpl", "mit", "mpl", "spdx"}
FOUND = "struct<start_word:long,n_words:long,family:string,probability:double,template:double>"
SCANNED = f"doc_id long, n_words long, n_windows long, found array<{FOUND}>"


def _grams(words: list[str]) -> list[str]:
    keys = [w for w in words if len(w) >= KEY_LETTERS or w in NAMES]
    return keys + [" ".join(words[i : i + n]) for n in (2, 3) for i in range(len(words) - n + 1)]


@dataclass
class Model:
    vocabulary: dict[str, int]
    keys: frozenset
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    templates: dict[str, list[frozenset]]

    def features(self, words: list[str]) -> np.ndarray:
        """Numbers of the known n-grams among the words, each once; all weigh the same, and their squares add up to one."""
        return np.array(sorted({self.vocabulary[g] for g in _grams(words) if g in self.vocabulary}), np.int64)

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.tile(self.bias, (len(rows), 1))
        for i, at in enumerate(rows):
            if len(at):
                out[i] += self.weights[at].sum(axis=0) / np.sqrt(len(at))
        return out

    def probabilities(self, reads: list[list[str]]) -> np.ndarray:
        """Calibrated probabilities of the families, the unknown class first."""
        return _softmax(self.logits([self.features(r) for r in reads]) / self.temperature)

    def match(self, words: list[str], family: str) -> float:
        """Largest share of a template's word pairs that the words hold."""
        pairs = set(zip(words, words[1:]))
        return max(len(t & pairs) / len(t) for t in self.templates[family])

    def place(self, words: list[str], family: str) -> list[int]:
        """Where the words hold the template that ``match`` rates: its pairs in the shortest stretch with most of them."""
        pairs = list(zip(words, words[1:]))
        template = max(self.templates[family], key=lambda t: (len(t.intersection(pairs)) / len(t), len(t)))
        at = [i for i, pair in enumerate(pairs) if pair in template]
        inside = lambda s: [i for i in at if s <= i < s + len(template) + SPARE]
        best = max(map(inside, at), key=lambda some: (len({pairs[i] for i in some}), some[0] - some[-1]))
        return sorted({k for i in best for k in (i, i + 1)})

    def named(self, words: list[str]) -> dict[str, float]:
        """The families that the classifier names, from all words or from a shorter stretch of them, and how sure it is."""
        reads = [words]
        for size in READS:
            reads += [words[at : at + size] for at in range(0, max(len(words) - size // 2, 1), size // 2)] if size < len(words) else []
        reads = [r for r in reads if not self.keys.isdisjoint(r)]
        found: dict[str, float] = {}
        for p in self.probabilities(reads) if reads else ():
            family, chance = FAMILIES[int(p.argmax())], float(p.max())
            if family != "unknown" and chance >= MIN_PROBABILITY:
                found[family] = max(chance, found.get(family, 0.0))
        return found

    def notices(self, words: list[str]) -> list[tuple[str, float, float, list[int]]]:
        """(family, probability, template share, places) of every confirmed notice.

        The classifier names families; a template of that family must then be found in the words, or the name is refused.
        Of several confirmed ones that with the fullest template goes first, then the surest, then by name. A found notice is
        taken out and the rest read again, so notices side by side do not hide each other.
        """
        out, left = [], list(words)
        while True:
            rated = [(self.match(left, family), chance, family) for family, chance in sorted(self.named(left).items())]
            rated = [r for r in rated if r[0] >= MIN_TEMPLATE]
            if not rated:
                return out
            share, chance, family = max(rated)
            places = self.place(left, family)
            out.append((family, chance, share, places))
            for i in places:
                left[i] = ""


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def sampled(docs: DataFrame, sample: int = SAMPLE) -> list[list[str]]:
    """Words of windows of about ``sample`` paragraphs, the lines of all texts: each is taken by the hash of its text, and the
    window in it by the same hash. Only these windows reach the driver."""
    texts = doc_columns(docs, "doc_id", "text").where("text IS NOT NULL")
    lines = texts.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1).alias("n")).first().n or 0
    line = texts.select(F.explode(F.split("text", "\n")).alias("line")).where(F.length("line") > 0)
    chance = F.pmod(F.xxhash64("line", F.lit(5)), F.lit(1 << 40)) < int(min(1.0, sample / max(lines, 1)) * (1 << 40))
    words = F.split(F.lower("line"), r"[^\p{L}\p{N}]+")
    start = F.pmod(F.xxhash64("line"), F.greatest(F.size("words") - WINDOW, F.lit(1))).cast("int") + 1
    some = line.where(chance).distinct().select("line", words.alias("words")).select(F.slice("words", start, WINDOW).alias("words"))
    return sorted([w for w in r.words if w] for r in some.collect())


def examples(model: Model, wordings: dict[str, list[list[str]]], lines: list[list[str]], copies: int, rng) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and family numbers: wordings as they are, thinned and set into other words; shuffled ones and lines as unknown."""
    filler = [w for line in lines for w in line] or ["filler"]
    rows, truth = [], []

    def example(words: list[str], family: int) -> None:
        around = [filler[i] for i in rng.integers(len(filler), size=int(rng.integers(WINDOW)))]
        cut = int(rng.integers(len(around) + 1))
        rows.append(model.features(around[:cut] + words + around[cut:]))
        truth.append(family)

    for number, family in enumerate(FAMILIES[1:], 1):
        for words in wordings[family]:
            for copy in range(copies):
                example([w for w in words if copy % 2 == 0 or rng.random() > 0.08], number)
                if len(words) > 3:
                    example([words[i] for i in rng.permutation(len(words))], 0)
    for words in lines:
        if max(model.match(words, f) for f in model.templates) < 0.5:
            rows.append(model.features(words))
            truth.append(0)
    return rows, np.array(truth)


def fit(docs: DataFrame, sample: int = SAMPLE, seed: int = 7) -> Model:
    """Model from the templates and the windows of about ``sample`` paragraphs of all documents.

    Sampled windows that hold half of a template are no unknown examples. An empty table trains on templates alone.
    """
    lines = sampled(docs, sample)
    wordings = {f: [WORD.findall(t.lower()) for t in texts] for f, texts in TEMPLATES.items()}
    vocabulary = {g: i for i, g in enumerate(dict.fromkeys(g for ws in wordings.values() for w in ws for g in _grams(w)))}
    templates = {f: [frozenset(zip(w, w[1:])) for w in ws] for f, ws in wordings.items()}
    keys = frozenset(g for g in vocabulary if " " not in g)
    model = Model(vocabulary, keys, np.zeros((len(vocabulary), len(FAMILIES))), np.zeros(len(FAMILIES)), 1.0, templates)
    rows, truth = examples(model, wordings, lines, COPIES, np.random.default_rng(seed))
    tested = np.arange(len(truth)) % 5 == 0
    learnt, known = [r for r, t in zip(rows, tested) if not t], truth[~tested]
    # the non-zero cells by feature: sums of a feature's cells are one pass over them
    at, owner = np.concatenate([*learnt, np.zeros(0, np.int64)]), np.repeat(np.arange(len(learnt)), [len(r) for r in learnt])
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    value = 1 / np.sqrt(np.array([max(len(r), 1) for r in learnt]))[owner][:, None]
    features, first = np.unique(at, return_index=True)
    by_row = np.argsort(owner, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(owner[by_row]) > 0])
    held, target = owner[by_row][starts], np.eye(len(FAMILIES))[known]
    step = RATE / np.sqrt(len(learnt)) * 10
    for _ in range(ROUNDS):
        logits = np.tile(model.bias, (len(learnt), 1))
        logits[held] += np.add.reduceat((model.weights[at] * value)[by_row], starts)
        error = (_softmax(logits) - target) / np.sqrt(len(learnt))
        model.weights *= 1 - DECAY
        model.weights[features] -= step * np.add.reduceat(error[owner] * value, first)
        model.bias -= step * error.sum(axis=0)
    logits, known = model.logits([r for r, t in zip(rows, tested) if t]), truth[tested]
    losses = {t: -np.log(_softmax(logits / t)[np.arange(len(known)), known] + 1e-12).mean() for t in (0.5, 0.7, 1, 1.4, 2)}
    model.temperature = min(losses, key=losses.get)
    return model


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """Confirmed notices of every whole text: (doc_id, n_words, n_windows, found).

    A text is read in overlapping windows across its line ends, without the notices that were found before; parts of a
    notice that two windows see are one. A window without any key word of the templates is unknown.
    A null or empty text has no words; null ids and repeated rows stay; further columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch):
        m, counts, windows, out = shared.value, [], [], []
        for text in batch.column(1):
            words, found, taken, stretches = WORD.findall((text.as_py() or "").lower()), [], set(), []
            starts = range(0, max(len(words) - WINDOW, 0) + STEP, STEP) if words else ()
            for start in starts if not m.keys.isdisjoint(words) else ():
                part = [w if start + i not in taken else "" for i, w in enumerate(words[start : start + WINDOW])]
                if m.keys.isdisjoint(part):
                    continue
                for family, probability, template, places in m.notices(part):
                    taken.update(start + i for i in places)
                    low, high = start + places[0], start + places[-1]
                    same = next((x for x in stretches if x[0] == family and x[1] <= high and low <= x[2]), None)
                    if same:
                        old = found[same[3]]
                        old["probability"], old["template"] = max(old["probability"], probability), max(old["template"], template)
                        same[1:3] = min(same[1], low), max(same[2], high)
                        continue
                    stretches.append([family, low, high, len(found)])
                    found.append(dict(start_word=start, n_words=len(part), family=family, probability=probability, template=template))
            counts.append(len(words))
            windows.append(len(starts))
            out.append(found)
        kind = pa.struct([("start_word", pa.int64()), ("n_words", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("template", pa.float64())])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(windows, pa.int64()), pa.array(out, pa.list_(kind))],
            names=["doc_id", "n_words", "n_windows", "found"],
        )

    return map_rows(doc_columns(docs, "doc_id", "text"), work, SCANNED)
