"""Licence scan: a trained paragraph classifier confirmed by templates.

Consecutive lines that are not blank make a block, so that a wording wrapped over lines is whole.
Blocks with enough of the word pairs of some template are laid beside it: the stretch of words that
holds most of its pairs is confirmed if it holds enough, the likest wording first, and its words are
taken for no other, so a block may name several licences. Titles (alone on a line) and SPDX tags
need every word. A wording counts for the line it begins on.

A paragraph is a bag of hashed word n-grams of one to three words. Multinomial
logistic regression over these sparse features gives a probability for each licence family and for
``unknown``. It is trained here on paragraphs derived from the templates (words dropped, repeated,
set in capitals, other words before and after) and on ordinary paragraphs of at most
``SAMPLE_DOCUMENTS`` documents (lowest id hash first). A third of the training rows is kept apart to
fit the temperature of the probabilities and the least probability a family needs: no lower than
``LEAST``, and above what all but one in a thousand ordinary paragraphs reach. Of a confirmed wording
the words of the stretch, its line and its whole block are scored; one of them must go to the family,
unless the wording is there to the last pair.

Every block of every whole text is looked at. Null and empty texts and paragraphs without words
have no licence. Without documents the ordinary class is learnt from made-up paragraphs alone.
Repeated rows get equal results; a column named like the added one is replaced.
"""

from __future__ import annotations

import pickle
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearledger.llm.bytewords import CHUNK_BYTES, SIGNS, lowered, mix, text_bytes, word_hashes, words

#: The wording by which each family is recognised.
TEMPLATES = {
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License - see the LICENSE file for details.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
    ),
    "MPL": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ),
    "Unlicense": (
        "Released into the public domain under the Unlicense.",
        "This is free and unencumbered software released into the public domain.",
    ),
}
FAMILIES = tuple(TEMPLATES)
#: Titles, alone on a line, and SPDX identifiers.
TITLES = {
    "Apache": ("Apache License", "Apache License Version 2.0", "Apache License Version 2.0, January 2004"),
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "BSD": ("BSD License", "BSD 2-Clause License", "BSD 3-Clause License", "The BSD License"),
    "GPL": ("GNU General Public License", "GNU General Public License Version 2", "GNU General Public License Version 3"),
    "LGPL": ("GNU Lesser General Public License", "GNU Lesser General Public License Version 2.1", "GNU Lesser General Public License Version 3"),
    "AGPL": ("GNU Affero General Public License", "GNU Affero General Public License Version 3"),
    "MPL": ("Mozilla Public License", "Mozilla Public License Version 2.0"),
    "CC-BY": ("Creative Commons Attribution 4.0 International", "CC BY 4.0"),
    "CC-BY-SA": ("Creative Commons Attribution-ShareAlike 4.0 International", "CC BY-SA 4.0"),
    "CC-BY-NC": ("Creative Commons Attribution-NonCommercial 4.0 International", "CC BY-NC 4.0"),
    "ISC": ("ISC License", "The ISC License"),
    "Unlicense": ("The Unlicense",),
}
SPDX = {
    "apache": "Apache", "mit": "MIT", "0bsd": "BSD", "bsd": "BSD", "gpl": "GPL", "lgpl": "LGPL", "agpl": "AGPL", "mpl": "MPL",
    "cc-by-sa": "CC-BY-SA", "cc-by-nc": "CC-BY-NC", "cc-by": "CC-BY", "isc": "ISC", "unlicense": "Unlicense",
}
UNKNOWN = len(FAMILIES)
BUCKETS = 1 << 13
SAMPLE_DOCUMENTS = 300
VARIANTS = 60
MADE_UP = 400
ROUNDS = 120
LEAST = 0.5
CONFIRMED = 0.6
U64 = np.uint64
_MULTIPLY = mix(np.arange(1, 4, dtype=U64)) | U64(1)


def paragraph_features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(paragraph, bucket, value) of the n-grams of paragraphs given by their bounds (n + 1).

    Values make each paragraph's sum one over the root of its n-grams."""
    low = lowered(data)
    starts, ends, first = words(low, bounds, SIGNS)
    h = word_hashes(low, starts, ends)
    of = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    rolled, rows, buckets = np.zeros(len(h), U64), [], []
    for n in range(min(3, len(h))):
        rolled = (rolled[: len(h) - n] if n == 0 else rolled[:-1]) + h[n:] * _MULTIPLY[n]
        whole = of[: len(h) - n] == of[n:]
        rows.append(of[: len(h) - n][whole])
        buckets.append((mix(rolled[whole]) % U64(BUCKETS)).astype(np.int64))
    row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    bucket = np.concatenate(buckets) if buckets else np.zeros(0, np.int64)
    size = np.bincount(row, minlength=len(bounds) - 1)
    return row, bucket, 1 / np.sqrt(size[row])


@dataclass
class Classifier:
    """Weights (bucket, class), a bias a class, the temperature and the least probability."""

    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: float = LEAST

    def logits(self, row, bucket, value, n) -> np.ndarray:
        out = np.tile(self.bias, (n, 1))
        for c in range(self.weights.shape[1]):
            out[:, c] += np.bincount(row, self.weights[bucket, c] * value, n)
        return out / self.temperature

    def probabilities(self, row, bucket, value, n) -> np.ndarray:
        z = self.logits(row, bucket, value, n)
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[int]) -> Classifier:
    """Fit to paragraphs; every third one is used for calibration only."""
    label = np.array(labels)
    apart = np.arange(len(texts)) % 3 == 2

    def features(which):
        raw = [t.encode() for t, w in zip(texts, which, strict=True) if w]
        bounds = np.append(0, np.cumsum([len(r) for r in raw])).astype(np.int64)
        return *paragraph_features(np.frombuffer(b"".join(raw), np.uint8), bounds), len(raw)

    row, bucket, value, n = features(~apart)
    y = np.eye(UNKNOWN + 1)[label[~apart]]
    model = Classifier(np.zeros((BUCKETS, UNKNOWN + 1)), np.zeros(UNKNOWN + 1))
    weight = 1 / np.maximum(y.sum(axis=0), 1)[label[~apart]]  # classes count alike
    weight /= weight.sum()
    m = [np.zeros_like(model.weights), np.zeros_like(model.bias)]
    v = [np.zeros_like(model.weights), np.zeros_like(model.bias)]
    for step in range(1, ROUNDS + 1):
        g = (model.probabilities(row, bucket, value, n) - y) * weight[:, None]
        grad = np.column_stack([np.bincount(bucket, g[row, c] * value, BUCKETS) for c in range(UNKNOWN + 1)])
        for i, (p, d) in enumerate(((model.weights, grad + 1e-6 * model.weights), (model.bias, g.sum(axis=0)))):
            m[i] += 0.1 * (d - m[i])
            v[i] += 0.01 * (d * d - v[i])
            p -= 0.1 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-9)
    row, bucket, value, n = features(apart)
    truth = label[apart]
    if n:
        z = model.logits(row, bucket, value, n)

        def loss(t):
            s = z / t
            s -= s.max(axis=1, keepdims=True)
            return -(s[np.arange(n), truth] - np.log(np.exp(s).sum(axis=1))).mean()

        model.temperature = float(min(np.arange(0.4, 4.01, 0.1), key=loss))
        ordinary = model.probabilities(row, bucket, value, n)[truth == UNKNOWN, :UNKNOWN]
        if len(ordinary):
            model.least = float(max(LEAST, np.quantile(ordinary.max(axis=1), 0.999)))
    return model


def pairs(text: str) -> set[tuple[str, ...]]:
    """The word pairs of a text, or its single word."""
    w = re.findall(r"[0-9a-z\u0080-\U0010ffff]+", text.lower())
    return set(zip(w[:-1], w[1:], strict=True)) or {tuple(w)}


_PAIRS = {f: [pairs(t) for t in ts] for f, ts in TEMPLATES.items()}


def likeness(text: str, family: str) -> float:
    """The largest share of a template's word pairs that the text holds."""
    own = pairs(text)
    return max(len(own & t) / len(t) for t in _PAIRS[family])


_WORD = re.compile(r"[0-9a-z\u0080-\U0010ffff]+")
_TITLES = {tuple(_WORD.findall(t.lower())): f for f, ts in TITLES.items() for t in ts}
_TAG = re.compile(r"spdx-license-identifier:([^\n]*)")
_NAME = re.compile(r"(?<![0-9a-z.-])(" + "|".join(sorted(SPDX, key=len, reverse=True)) + r")(?:-(?:\d[0-9a-z.-]*|[a-z]+-\d[0-9a-z.-]*))?(?![0-9a-z])")


def _pair_hashes(h: np.ndarray) -> np.ndarray:
    return mix(h[:-1] * _MULTIPLY[0] + h[1:] * _MULTIPLY[1])


def _hashed_pairs(text: str) -> np.ndarray:
    data = lowered(np.frombuffer(text.encode(), np.uint8))
    starts, ends, _ = words(data, np.array([0, len(data)]), SIGNS)
    return np.unique(_pair_hashes(word_hashes(data, starts, ends)))


_WORDINGS = [(f, t) for f, ts in _PAIRS.items() for t in ts]
_SIGNS_OF = [_hashed_pairs(t) for ts in TEMPLATES.values() for t in ts]
_ALL_SIGNS = np.unique(np.concatenate(_SIGNS_OF))
_HOLDS = np.array([np.isin(_ALL_SIGNS, s) for s in _SIGNS_OF])  # (wording, pair)


def telling_blocks(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether each block holds enough pairs of a wording, a tag or a line that may be a title."""
    n = len(bounds) - 1
    low = lowered(data)
    starts, ends, first = words(low, bounds, SIGNS)
    h = word_hashes(low, starts, ends)
    out = np.zeros(n, bool)
    if len(h) < 2:
        return out | np.isin(np.diff(first), [1])
    of = np.repeat(np.arange(n), np.diff(first))
    sign = _pair_hashes(h)
    at = np.minimum(np.searchsorted(_ALL_SIGNS, sign), len(_ALL_SIGNS) - 1)
    hit = np.flatnonzero((_ALL_SIGNS[at] == sign) & (of[:-1] == of[1:]))
    seen = np.unique(of[hit] * len(_ALL_SIGNS) + at[hit])
    block, pair = seen // len(_ALL_SIGNS), seen % len(_ALL_SIGNS)
    for wording in _HOLDS:
        out |= np.bincount(block[wording[pair]], minlength=n) >= CONFIRMED * wording.sum() - 1e-9
    for term in _TELLING:
        out[of[np.flatnonzero(h == term)]] = True
    return out


def _hash_of(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), np.uint8)
    return word_hashes(data, np.array([0]), np.array([len(data)]))[0]


#: Words that every title and tag has one of.
_TELLING = [_hash_of(w) for w in ("spdx", "license", "unlicense", "cc", "commons")]


def wordings(block: str) -> list[tuple[int, int, str, float]]:
    """(begin, end, family, likeness) of the wordings in a block, in characters; none overlap."""
    low = block.translate(_TO_LOWER)
    found = list(_WORD.finditer(low))
    w = [m[0] for m in found]
    if not w:
        return []
    options: list[tuple[float, int, int, int, str]] = []  # (likeness, pairs, first word, last word, family)
    own = list(zip(w[:-1], w[1:], strict=True))
    for family, template in _WORDINGS:
        hits = [i for i, p in enumerate(own) if p in template]
        if len({own[i] for i in hits}) < CONFIRMED * len(template):
            continue
        for a, i in enumerate(hits):
            seen: set[tuple[str, ...]] = set()
            best = None
            for j in hits[a:]:
                if j - i > 2 * len(template):
                    break
                if own[j] not in seen:
                    seen.add(own[j])
                    best = j
            if best is not None and len(seen) >= CONFIRMED * len(template):
                options.append((len(seen) / len(template), len(seen), i, best + 1, family))
    begins = [m.start() for m in found]
    place = {b: i for i, b in enumerate(begins)}
    for line in re.finditer(r"[^\n]+", low):
        inside = [place[m.start() + line.start()] for m in _WORD.finditer(line[0])]
        family = _TITLES.get(tuple(w[i] for i in inside))
        if family:
            options.append((1.0, len(inside), inside[0], inside[-1], family))
    for tag in _TAG.finditer(low):
        for name in _NAME.finditer(tag[1]):
            i = place.get(name.start() + tag.start(1))
            if i is not None:
                options.append((1.0, 1, i, i + len(_WORD.findall(name[0])) - 1, SPDX[name[1]]))
    taken = np.zeros(len(w), bool)
    out = []
    for alike, _, i, j, family in sorted(options, key=lambda o: (-o[0], -o[1], o[3] - o[2], o[2], o[4])):
        if not taken[i : j + 1].any():
            taken[i : j + 1] = True
            out.append((begins[i], found[j].end(), family, alike))
    return sorted(out)


_TO_LOWER = {i: i + 32 for i in range(65, 91)}


def training_rows(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(paragraph, label): templates varied, made-up and ordinary paragraphs."""
    spark = docs.sparkSession
    templates = spark.createDataFrame([(t, i) for i, f in enumerate(FAMILIES) for t in TEMPLATES[f]], "t string, label int")
    word = lambda seed: F.element_at(
        F.array(*[F.lit(w) for w in ("report", "data", "the", "source", "file", "page", "notes", "of", "work", "and", "list", "text")]),
        (F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.col("t")), F.lit(12)) + 1).cast("int"),
    )
    chance = lambda seed, n: F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.col("t")), F.lit(n))
    kept = F.array_join(
        F.filter(F.split("t", " "), lambda w, i: F.pmod(F.xxhash64(w, i, F.col("id")), F.lit(14)) > F.when(F.col("id") < 8, -1).otherwise(0)), " "
    )
    varied = templates.withColumn("id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(VARIANTS - 1)))).select(
        F.concat(
            F.when(chance(1, 3) == 0, F.concat(word(2), F.lit(" "), word(3), F.lit(" "))).otherwise(""),
            F.when(chance(4, 8) == 0, F.upper(kept)).otherwise(kept),
            F.when(chance(5, 3) == 0, F.concat(F.lit(" "), word(6), F.lit(" "), word(7), F.lit(" "), word(8))).otherwise(""),
        ).alias("paragraph"),
        "label",
    )
    made_up = spark.range(MADE_UP).withColumn("t", F.lit("")).select(
        F.array_join(F.array(*[word(s) for s in range(20, 28)], F.lit("license version"), word(30)), " ").alias("paragraph"),
        F.lit(UNKNOWN).alias("label"),
    )
    least = docs.select(F.col(f"`{key}`").alias("k")).distinct().orderBy(F.xxhash64("k"), "k").limit(SAMPLE_DOCUMENTS)
    sample = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).join(F.broadcast(least), "k")
    ordinary = sample.select(F.explode(F.split("t", "\n")).alias("paragraph"), F.lit(UNKNOWN).alias("label"))
    # lines that a template would confirm are no examples of ordinary text
    telling = "(?i)licen[sc]|copyright|creative commons|public domain|hereby granted|redistribut"
    ordinary = ordinary.where(~F.col("paragraph").rlike(telling) & (F.length("paragraph") > 0))
    return varied.unionByName(made_up).unionByName(ordinary)


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id") -> Classifier:
    """The classifier, trained in one task on the bounded rows of training_rows."""

    def trained(batches):
        rows = [r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        model = train([r[0] for r in rows], [r[1] for r in rows])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    rows = training_rows(docs, text, key).repartition(1).sortWithinPartitions(F.xxhash64("paragraph"), "paragraph", "label")
    return pickle.loads(rows.mapInArrow(trained, "model binary").first()["model"])


FOUND = "array<struct<paragraph:int,family:string,probability:double,likeness:double>>"


def scan(df: DataFrame, model: Classifier, text: str = "text", into: str = "licences") -> DataFrame:
    """Add the licences of each text: paragraph (number of the line), family, probability, likeness."""

    @F.arrow_udf(FOUND)
    def scanned(column: pa.Array) -> pa.Array:
        data, offsets = text_bytes(column)
        out: list[list[dict]] = []
        at, n = 0, len(column)
        while at < n:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
            out += _found(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], model)
            at = to
        kind = pa.struct([("paragraph", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("likeness", pa.float64())])
        return pa.array(out, pa.list_(kind))

    return df.withColumn(into, scanned(F.col(f"`{text}`")))


def _found(data: np.ndarray, offsets: np.ndarray, model: Classifier) -> list[list[dict]]:
    n = len(offsets) - 1
    out: list[list[dict]] = [[] for _ in range(n)]
    cuts = np.unique(np.concatenate([offsets, np.flatnonzero(data == 10) + 1]))  # a paragraph keeps its line end
    if len(cuts) < 2:
        return out
    row = np.searchsorted(offsets, cuts[:-1], "right") - 1
    first = np.searchsorted(cuts, offsets)
    blank = _blank_lines(data, cuts)
    # a block begins at each line that is blank, follows one, or begins a text
    begin = np.flatnonzero(blank | np.append(True, blank[:-1]) | np.append(True, row[1:] != row[:-1]))
    bounds = cuts[np.append(begin, len(cuts) - 1)]
    asked: list[tuple[int, str, float, tuple[str, str, str]]] = []
    for b in np.flatnonzero(telling_blocks(data, bounds)):
        raw = data[bounds[b] : bounds[b + 1]].tobytes()
        said = raw.decode("utf-8", "replace")
        for at, to, family, alike in wordings(said):
            line = int(begin[b]) + said.count("\n", 0, at)
            own = data[cuts[line] : cuts[line + 1]].tobytes().decode("utf-8", "replace")
            asked.append((line, family, alike, (said[at:to], own, said)))
    if not asked:
        return out
    parts = [t.encode() for *_, texts in asked for t in texts]
    ends = np.append(0, np.cumsum([len(t) for t in parts])).astype(np.int64)
    p = model.probabilities(*paragraph_features(np.frombuffer(b"".join(parts), np.uint8), ends), len(parts))
    for number, (line, family, alike, _) in enumerate(asked):
        chance = float(p[3 * number : 3 * number + 3, FAMILIES.index(family)].max())
        # a wording with every word needs no more than its words
        if alike == 1 or chance >= model.least:
            r = int(row[line])
            out[r].append({"paragraph": int(line - first[r]), "family": family, "probability": chance, "likeness": alike})
    return out


def _blank_lines(data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Whether each line holds nothing but spaces and control characters."""
    filled = np.append(0, np.cumsum(data > 32))
    return filled[cuts[1:]] == filled[cuts[:-1]]
