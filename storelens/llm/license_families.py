"""Licence notices in documents, by a trained paragraph classifier.

A paragraph is a line, a part of a line, or the lines over which a notice is
wrapped. Its words, and runs of two and three of them, are hashed to sparse features of a multinomial logistic regression over licence families
and an unknown class. It is trained here on the families' usual notices with
words dropped, doubled and put around them, and on other paragraphs: invented ones
that speak of licences in another sense, shuffled notices, and lines of a bounded
sample of the documents that share no run of three words with a template.
Probabilities are calibrated with a temperature on paragraphs not trained on. A
paragraph is reported if a family is likelier than the unknown class and all
others by a margin, and a template of that family confirms it: most of the
template's runs of two words occur in the paragraph.

Notices inside long lines and wrapped ones are looked for in runs of lines that
each have a word, so a blank line or a bare comment sign ends them. Windows of a
template's length, with some room for other words, slide over the words of such a
run; one that holds most of the template's runs of two words is classified and
confirmed as a paragraph of its own, whatever else its line says. It is reported
from its first to its last line, or by itself if it is part of one line. What a
line as a whole already says, it does not say again, so a line may have several
families, but each once.

Nulls and empty texts have no paragraphs. Documents without an id are reported
with a null id; the same row twice is reported twice; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import prepared, rows_as
from storelens.llm.textbytes import LOWER, RangeHash, batch_slices, find_words, mix

# Usual notices by family; fixed values.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "This project is licensed under the terms of the MIT license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Released under the Apache 2.0 license",
        "you may not use this file except in compliance with the License",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "Licensed under the GNU General Public License version 2 or later",
        "Released under the GPL version 3",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 3",
        "under the terms of the GNU Lesser General Public License",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3",
        "under the terms of the GNU Affero General Public License",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License",
        "Released under the BSD license",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License, version 2.0",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "CC0": [
        "Released under CC0 1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    ],
    "ISC": [
        "Licensed under the ISC License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ],
    "EPL-2.0": [
        "Licensed under the Eclipse Public License, Version 2.0",
        "This program is made available under the terms of the Eclipse Public License",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
    "Proprietary": ["All rights reserved", "Unauthorized copying of this file is strictly prohibited"],
}
# How source files name a family in a line of their own.
SPDX = {
    "MIT": ["MIT"],
    "Apache-2.0": ["Apache-2.0"],
    "GPL": ["GPL-2.0", "GPL-3.0"],
    "LGPL": ["LGPL-2.1", "LGPL-3.0"],
    "AGPL": ["AGPL-3.0"],
    "BSD": ["BSD-2-Clause", "BSD-3-Clause"],
    "MPL-2.0": ["MPL-2.0"],
    "CC-BY": ["CC-BY-4.0"],
    "CC-BY-SA": ["CC-BY-SA-4.0"],
    "CC-BY-NC": ["CC-BY-NC-4.0"],
    "CC0": ["CC0-1.0"],
    "ISC": ["ISC"],
    "EPL-2.0": ["EPL-2.0"],
    "Unlicense": ["Unlicense"],
}
for _family, _names in SPDX.items():
    TEMPLATES[_family] += [f"SPDX-License-Identifier: {name}" for name in _names]

#: Paragraphs that speak of licences without granting one.
OTHER = [
    "The driver must renew the license before the end of the year",
    "a fishing license is required on the lake and the river",
    "He was granted permission to use the public road under the old law",
    "The version of the story told in general is free of charge for the public",
    "she works as a licensed electrician under the terms of the contract",
    "all rights of the person are protected by the general law of the state",
    "software is used in source and binary form by many people in this work",
    "the license plate of the car was found under the bridge",
    "this project was released in the spring and is now in version two",
    "the university of the commons gave attribution to the author of the work",
    "the car was released under a dealer license plate and sold",
    "the identifier of the license is printed on the card of the driver",
]

BITS = 18
FAMILIES = (*TEMPLATES, "unknown")
#: A family's probability must be so much, and so much of a template be found.
CONFIDENCE, CONFIRMED = 0.6, 0.7
#: Words more than a template, half of its own and so many, that a wrapped one may have.
ROOM = 6
#: Bounds of the sample of other paragraphs: documents, lines, characters of a line.
SAMPLE_DOCUMENTS, SAMPLE_LINES, SAMPLE_CHARS = 1000, 3000, 2000

# Words are runs of letters and digits here; other ASCII separates.
_PLAIN = LOWER.copy()
_PLAIN[[b for b in range(128) if not chr(b).isalnum() and b != 0x0A]] = 0x20


def line_features(offsets: np.ndarray, data: np.ndarray):
    """(row, start, end) of each line with a word, its features: for each word, run
    of two and run of three a line number and a 64-bit hash, by size of run; and the
    words: for each its place in the bytes, end, number of its line among these lines
    and among all lines, and the hash of it and the next word, whatever the line."""
    plain = _PLAIN[data]
    words = find_words(offsets, plain)
    hashes = RangeHash(plain)(words.starts, words.ends)
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    starts = starts[starts < len(data)]
    line = np.searchsorted(starts, words.starts, "right") - 1
    used, number = np.unique(line, return_inverse=True)
    row = np.searchsorted(offsets, starts[used], "right") - 1
    following = np.append(starts, len(data))[used + 1] if len(used) else starts[:0]
    ends = np.minimum(following, offsets[row + 1]) if len(used) else following
    runs, grown, pairs = [(number, mix(hashes + np.uint64(1)))], hashes, hashes[:0]
    for size in (2, 3):
        grown = mix(grown[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[size - 1 :])
        # runs across lines stay in ``grown``, so that places stay aligned
        whole = number[: len(grown)] == number[size - 1 :]
        runs.append((number[: len(grown)][whole], grown[whole] + np.uint64(size)))
        pairs = grown + np.uint64(size) if size == 2 else pairs
    return row, starts[used], ends, runs, (words.starts, words.ends, number, line, pairs)


def _of_lines(lines: list[str]):
    data = np.frombuffer("\n".join(lines).encode(), dtype=np.uint8)
    return line_features(np.array([0, len(data)]), data)[:4]


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Classifier:
    weights: np.ndarray  # bucket x family, zero for features never trained on
    bias: np.ndarray
    temperature: float
    templates: list[list[np.ndarray]]  # by family, the two-word runs of each
    lengths: list[list[int]]  # by family, the words of each

    def probabilities(self, lines: int, runs) -> np.ndarray:
        logits = np.tile(self.bias, (lines, 1))
        size = np.zeros(lines)
        for number, hashes in runs:
            buckets = _bucket(hashes)
            size += np.bincount(number, minlength=lines)
            known = self.known[buckets]
            number, buckets = number[known], buckets[known]
            for k in range(len(FAMILIES)):
                logits[:, k] += np.bincount(number, weights=self.weights[buckets, k], minlength=lines)
        return _softmax(logits / self.temperature)

    def __post_init__(self):
        self.known = self.weights.any(axis=1)

    def places(self, row: np.ndarray, words) -> list[tuple[int, int]]:
        """(first, last word) of the places that hold most of a template's runs of
        two words."""
        _, _, number, line, pairs = words
        if len(pairs) == 0:
            return []
        # a run of lines with words in one row
        fresh = (np.diff(line) > 1) | (np.diff(row[number]) > 0)
        part = np.concatenate([[0], np.cumsum(fresh)])
        known = np.unique(np.concatenate([t for own in self.templates for t in own]))
        table = np.zeros(1 << BITS, dtype=bool)
        table[_bucket(known)] = True
        places = np.flatnonzero(table[_bucket(pairs)] & ~fresh)
        places = places[np.isin(pairs[places], known)]
        found = set()
        for own, lengths in zip(self.templates, self.lengths):
            for template, length in zip(own, lengths):
                at = places[np.isin(pairs[places], template)]
                least = int(np.ceil(CONFIRMED * len(template)))
                width = length + length // 2 + ROOM
                stops = np.searchsorted(at, at + width)
                stops = np.minimum(stops, np.searchsorted(part[at], part[at], "right"))
                kept = []
                for i in np.flatnonzero(stops - np.arange(len(at)) >= least).tolist():
                    inside = at[i : stops[i]]
                    value, first = np.unique(pairs[inside], return_index=True)
                    if len(value) >= least:
                        # up to where the last of the runs has been seen
                        kept.append((-len(value), int(inside[first.max()] - at[i]), int(at[i])))
                # the fullest first, the others beside them; and so by fewest other words
                for by in (lambda w: w, lambda w: (w[0] + w[1], w)):
                    free: list[tuple[int, int]] = []
                    for _, size, begin in sorted(kept, key=by):
                        end = begin + size + 1
                        if all(end < a or b < begin for a, b in free):
                            free.append((begin, end))
                    found |= set(free)
        return sorted(found)

    def confirm(self, family: int, pairs: np.ndarray) -> float:
        """The largest share of a template's two-word runs that the line has."""
        return max(float(np.isin(t, pairs).mean()) for t in self.templates[family])


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _examples(others: list[str], seed: int = 13) -> tuple[list[str], np.ndarray]:
    """Notices with words dropped, doubled and around them, and other lines."""
    rng = np.random.default_rng(seed)
    filler = sorted({w for line in OTHER for w in line.split()})
    lines, labels = [], []
    for k, notices in enumerate(TEMPLATES.values()):
        for notice in notices:
            for turn in range(24):
                words = notice.split()
                if turn:
                    words = [w for w in words if len(words) < 6 or rng.random() > 0.05]
                    around = list(rng.choice(filler, int(rng.integers(0, 7))))
                    cut = int(rng.integers(0, len(around) + 1))
                    words = around[:cut] + words + around[cut:]
                lines.append(" ".join(words))
                labels.append(k)
            words = notice.split()
            for turn in range(8):  # what a window may hold that begins or ends inside of it
                away = int((1 - CONFIRMED) * (len(words) - 1))
                cut = int(rng.integers(0, away + 1)) if turn % 2 else away
                lines.append(" ".join(words[cut:] if turn < 4 else words[: len(words) - cut]))
                labels.append(k)
            for _ in range(4 if len(words) > 4 else 0):  # the same words without their order grant nothing
                shuffled = list(rng.permutation(words))[: max(3, len(words) // 2)]
                lines.append(" ".join(map(str, shuffled)))
                labels.append(len(FAMILIES) - 1)
    for line in OTHER * 12:
        words = line.split()
        begin = int(rng.integers(0, len(words) // 2))
        lines.append(" ".join(words[begin:]))
        labels.append(len(FAMILIES) - 1)
    lines += others
    labels += [len(FAMILIES) - 1] * len(others)
    return lines, np.array(labels)


def fit(others: list[str], epochs: int = 60, seed: int = 4) -> Classifier:
    lines, labels = _examples(others)
    _, _, _, runs = _of_lines(lines)
    number = np.concatenate([n for n, _ in runs])
    hashed = np.concatenate([h for _, h in runs])
    used, feature = np.unique(_bucket(hashed), return_inverse=True)
    rng = np.random.default_rng(seed)
    held = rng.random(len(lines)) < 0.2
    w, bias = np.zeros((len(used), len(FAMILIES))), np.zeros(len(FAMILIES))
    truth = np.eye(len(FAMILIES))[labels]
    cost = 1 / np.bincount(labels, minlength=len(FAMILIES))[labels] ** 0.5
    cost = np.where(held, 0, cost / cost.mean())[:, None]

    def logits_of(w, bias):
        return np.stack([np.bincount(number, weights=w[feature, k], minlength=len(lines)) for k in range(len(FAMILIES))], 1) + bias

    speed = np.full_like(w, 1e-8)
    for _ in range(epochs):
        error = (_softmax(logits_of(w, bias)) - truth) * cost
        grad = np.stack([np.bincount(feature, weights=error[number, k], minlength=len(used)) for k in range(len(FAMILIES))], 1)
        grad += 1e-3 * w
        speed += grad**2
        w -= 0.3 * grad / np.sqrt(speed)
        bias -= 0.01 * error.sum(axis=0) / len(lines)
    logits = logits_of(w, bias)[held]
    losses = {t: -np.log(_softmax(logits / t)[np.arange(held.sum()), labels[held]] + 1e-12).mean() for t in np.geomspace(0.25, 8, 31)}
    weights = np.zeros((1 << BITS, len(FAMILIES)), dtype=np.float32)
    weights[used] = w
    templates, lengths = [], []
    for notices in TEMPLATES.values():
        templates.append([np.unique(_of_lines([n])[3][1][1]) for n in notices])
        lengths.append([len(_of_lines([n])[3][0][1]) for n in notices])
    return Classifier(weights, bias, float(min(losses, key=losses.get)), templates, lengths)


def train(docs: DataFrame, text_col: str = "text") -> Classifier:
    """The classifier for a table: other paragraphs come from about
    SAMPLE_DOCUMENTS of its texts, SAMPLE_LINES lines at most, of which
    longer ones than SAMPLE_CHARS are not taken."""
    prepared(docs.sparkSession)
    texts = rows_as(docs, text=text_col).where("text is not null")
    share = max(texts.count() // SAMPLE_DOCUMENTS, 1)
    sample = texts.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0)
    lines = sample.select(F.explode(F.split("text", "\n")).alias("line")).distinct()
    lines = lines.where((F.trim("line") != "") & (F.length("line") <= SAMPLE_CHARS))
    rows = lines.orderBy(F.xxhash64("line"), "line").limit(SAMPLE_LINES).collect()
    known = np.concatenate([_of_lines([n])[3][2][1] for notices in TEMPLATES.values() for n in notices])
    others = []
    for row in rows:
        threes = _of_lines([row["line"]])[3][2][1]
        if not np.isin(threes, known).any():
            others.append(row["line"])
    return fit(others)


def _notices(classifier: Classifier, lines: int, runs) -> Iterator[tuple[int, int, float, float]]:
    """(line, family, probability, confirmed share) of the lines that are notices."""
    chances = classifier.probabilities(lines, runs)
    best = chances.argmax(axis=1) if lines else np.zeros(0, dtype=np.int64)
    likely = np.flatnonzero((best < len(FAMILIES) - 1) & (chances.max(axis=1, initial=0) >= CONFIDENCE))
    number, pairs = runs[1]
    for i in likely.tolist():
        low, high = np.searchsorted(number, [i, i + 1])
        share = classifier.confirm(int(best[i]), pairs[low:high])
        if share >= CONFIRMED:
            yield i, int(best[i]), chances[i, best[i]], share


def scan(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start_byte, end_byte, family, probability, confirmed) of every
    paragraph that is a licence notice; ``confirmed`` is the template's share."""
    prepared(docs.sparkSession)
    docs = rows_as(docs, doc_id=id_col, text=text_col)
    ids = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, offsets, data in batch_slices(batches, "text", ["doc_id"]):
            row, starts, ends, runs, words = line_features(offsets, data)
            out, said = [], set()
            for i, family, chance, share in _notices(classifier, len(row), runs):
                begin = offsets[row[i]]
                said.add((i, family))
                out.append((row[i], starts[i] - begin, ends[i] - begin, FAMILIES[family], chance, share))
            places = classifier.places(row, words)
            texts = [data[words[0][a] : words[1][b]] for a, b in places]
            # each place as a line of its own
            joined = [np.append(np.where((t == 0x0A) | (t == 0x0D), 0x20, t), 0x0A).astype(np.uint8) for t in texts]
            if joined:
                own = line_features(np.array([0, sum(map(len, joined))]), np.concatenate(joined))
                windows = []
                for i, family, chance, share in _notices(classifier, len(places), own[3]):
                    first, last = (int(words[2][w]) for w in places[i])
                    windows.append((-share, -chance, *places[i], first, last, family))
                taken: list[tuple[int, int]] = []
                for share, chance, low, high, first, last, family in sorted(windows):
                    # of places that overlap, the one that has most of a template
                    if any(low <= b and a <= high for a, b in taken):
                        continue
                    taken.append((low, high))
                    if any((line, family) in said for line in range(first, last + 1)):
                        continue
                    said |= {(line, family) for line in range(first, last + 1)}
                    begin = offsets[row[first]]
                    span = (starts[first], ends[last]) if first < last else (words[0][low], words[1][high])
                    out.append((row[first], span[0] - begin, span[1] - begin, FAMILIES[family], -chance, -share))
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [
                    kept.column(0).take(pa.array(columns[0], pa.int64())),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.int64()),
                    pa.array(columns[3], pa.string()),
                    pa.array(columns[4], pa.float64()),
                    pa.array(columns[5], pa.float64()),
                ],
                names=["doc_id", "start_byte", "end_byte", "family", "probability", "confirmed"],
            )

    kinds = "start_byte long, end_byte long, family string, probability double, confirmed double"
    return docs.mapInArrow(run, f"doc_id {ids}, {kinds}")
