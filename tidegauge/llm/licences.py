"""Licence scan: cosine of TF-IDF vectors to templates, then inheritance from the nearest directory above.

Every line of a text, its first ``HEADER_LINES`` lines together, and the whole text are compared with
short and long templates of each licence; the best similarity from ``LEAST`` on names the file's own
licence. Between templates of one family that are about as similar, words for versions and variants
(2.1, lesser, affero) decide. A name without a version (GPL, BSD) gives way to one of its versions
found elsewhere in the text. The whole text is also compared with the full texts of licences; from
``FULL_LEAST`` on, if it has their version words, that decides.

Document frequencies of the templates' words are counted over all texts; a word that no template has
weighs like one never seen. A file without a licence of its own takes that of the licence file in its
directory or the nearest one above.

Defined cases: a null or empty text has no licence of its own; of equal similarities the earlier line
and then the first name in the alphabet counts; of several licence files in a directory the most similar;
a file with a null path inherits nothing; repeated rows each get a row; texts are read whole; an empty
table gives no rows; a file is kept as a struct, so no column can clash.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm import textops
from tidegauge.session import written

LEAST, FULL_LEAST = 0.6, 0.9
#: Templates of one family this near to the best are told apart by their variant words.
NEAR = 0.1
HEADER_LINES = 20
#: Directories with a licence are broadcast up to this number.
BROADCAST_FOLDERS = 100_000

#: Customary notices of public licences.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("BSD", "Licensed under the BSD License."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Copyright. All rights reserved. Confidential and proprietary."),
    ("GPL", "This work is licensed under the GNU General Public License."),
    ("LGPL", "This work is licensed under the GNU Lesser General Public License."),
    ("AGPL", "This work is licensed under the GNU Affero General Public License."),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License version 2 as published by the Free Software Foundation.",
    ),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    (
        "BSD-3-Clause",
        "Use of this source code is governed by a BSD 3-Clause license that can be found in the LICENSE file.",
    ),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal."),
    (
        "CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work under CC0 1.0 Universal Public Domain Dedication.",
    ),
    ("EPL-1.0", "Licensed under the Eclipse Public License - v 1.0."),
    (
        "EPL-1.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    ),
    ("EPL-2.0", "Licensed under the Eclipse Public License - v 2.0."),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
    ),
    ("ISC", "Licensed under the ISC License."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "MPL-1.1",
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may not use "
        "this file except in compliance with the License.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
for _name, _kind, _version in [
    ("GPL-1.0", "", "1"), ("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.0", "Library ", "2"),
    ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"), ("AGPL-3.0", "Affero ", "3"),
]:
    _work = "library" if _kind in ("Library ", "Lesser ") else "program"
    _grant = (
        f"This {_work} is free software; you can redistribute it and/or modify it under the terms of the GNU {_kind}General "
        f"Public License as published by the Free Software Foundation; either version {_version} of the License, or (at "
        "your option) any later version."
    )
    _warranty = (
        f" This {_work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        f"implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {_kind}General Public "
        f"License for more details. You should have received a copy of the GNU {_kind}General Public License along with "
        f"this {_work}. If not, see https://www.gnu.org/licenses/"
    )
    _short = f"This work is licensed under the GNU {_kind}General Public License, version {_version}."
    TEMPLATES += [(_name, t) for t in (_short, _grant, _grant + _warranty) if (_name, t) not in TEMPLATES]

#: Names without a version; theirs follow a hyphen.
UNVERSIONED = {"GPL", "LGPL", "AGPL", "BSD"}
_VARIANT = re.compile(r"v?([0-9](?:\.[0-9])?)|lesser|library|affero|by(?:-[a-z]{2})+|[0-9]-clause")

_WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")
LICENCE = T.StructType().add("licence", "string").add("cosine", "double").add("unit", "string").add("line", "integer")
_LICENCE_ARROW = pa.struct(
    [("licence", pa.string()), ("cosine", pa.float64()), ("unit", pa.string()), ("line", pa.int32())]
)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def variants(words) -> set[str]:
    """The words among these that tell versions and variants of licences apart."""
    found = filter(None, map(_VARIANT.fullmatch, words))
    return {(m[1] or m[0]).removesuffix(".0") for m in found}


def family(name: str) -> str:
    stem = name.split("-")[0]
    return "GPL" if stem in UNVERSIONED and stem != "BSD" else stem


def full_texts() -> list[tuple[str, str]]:
    """Names and full texts of licences."""
    files = (resources.files(__package__) / "licence_texts").iterdir()
    return sorted((f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")) for f in files if f.name.endswith(".txt"))


class FullTexts:
    """Full texts as dense vectors over their words."""

    def __init__(self, documents: int, frequency: dict[str, int], texts: list[tuple[str, str]]):
        self.names = [name for name, _ in texts]
        counts = [Counter(words_of(text)) for _, text in texts]
        self.number = {w: k for k, w in enumerate(sorted(set().union(*counts)))}
        self.unseen = math.log(documents + 1) + 1
        self.weight = np.array([math.log((documents + 1) / (frequency.get(w, 0) + 1)) + 1 for w in self.number])
        self.vectors = np.zeros((len(self.number), len(texts)))
        for k, own in enumerate(counts):
            self.vectors[[self.number[w] for w in own], k] = list(own.values())
        self.vectors *= self.weight[:, None]
        self.vectors /= np.sqrt((self.vectors**2).sum(0))
        self.versions = [self._versions(own) for own in counts]

    @staticmethod
    def _versions(words) -> set[str]:
        """Variant words as they are written, without bare numbers, which also number sections."""
        return {w.removeprefix("v") for w in words if _VARIANT.fullmatch(w) and not w.isdigit()}

    def best(self, counts: Counter) -> tuple[float, str] | None:
        """Similarity and name of the nearest full text whose version words are all there, if it is near enough."""
        known = [(self.number[w], n) for w, n in counts.items() if w in self.number]
        if not known:
            return None
        at, times = np.array(known).T
        own = times * self.weight[at]
        rest = sum(n * n for n in counts.values()) - int((times * times).sum())
        scores = own @ self.vectors[at] / math.sqrt(own @ own + rest * self.unseen**2)
        near = np.flatnonzero(scores >= FULL_LEAST).tolist()
        if not near:
            return None
        there = self._versions(counts)
        near = [(round(float(scores[k]), 12), self.names[k]) for k in near if self.versions[k] <= there]
        return max(near, key=lambda p: (p[0], _last(p[1])), default=None)


class Matcher:
    """Templates as sparse vectors, by word."""

    def __init__(self, documents: int, frequency: dict[str, int], templates=TEMPLATES, full=()):
        self.unseen = math.log(documents + 1) + 1
        vectors = [Counter(words_of(text)) for _, text in templates]
        self.weight = {
            w: math.log((documents + 1) / (frequency.get(w, 0) + 1)) + 1 for vector in vectors for w in vector
        }
        self.names = [name for name, _ in templates]
        self.variants = [variants(vector) for vector in vectors]
        self.index: dict[str, list[tuple[int, float]]] = {}
        for k, vector in enumerate(vectors):
            own = {w: n * self.weight[w] for w, n in vector.items()}
            norm = math.sqrt(sum(x * x for x in own.values()))
            for w, x in own.items():
                self.index.setdefault(w, []).append((k, x / norm))
        self.full = FullTexts(documents, frequency, full) if full else None

    def best(self, counts: Counter, least: float = LEAST) -> tuple[float, str] | None:
        """Similarity and name of the nearest template, if it is near enough."""
        known, rest = [], 0.0
        for w, n in counts.items():
            if w in self.weight:
                known.append((w, n * self.weight[w]))
            else:
                rest += n * n
        inside = sum(x * x for _, x in known)
        norm = inside + rest * self.unseen**2
        # The words that templates have bound the similarity to any of them.
        if inside < least * least * norm or not known:
            return None
        scores = [0.0] * len(self.names)
        for w, x in known:
            for k, y in self.index[w]:
                scores[k] += x * y
        length = math.sqrt(norm)
        top = max(scores)
        if top < least * length:
            return None
        kin = {family(n) for s, n in zip(scores, self.names) if s == top}
        there = variants(counts)
        near = [
            (-len(own ^ there), round(s / length, 12), n)
            for s, n, own in zip(scores, self.names, self.variants)
            if s >= max(least * length, top - NEAR * length) and family(n) in kin
        ]
        _, score, name = max(near, key=lambda p: (p[0], p[1], _last(p[2])))
        return score, name

    def licence(self, text: str) -> dict | None:
        lines = [Counter(words_of(line)) for line in text.split("\n")]
        header, whole = Counter(), Counter()
        for k, own in enumerate(lines):
            if k < HEADER_LINES:
                header.update(own)
            whole.update(own)
        match = self.full.best(whole) if self.full else None
        if match:
            return {"licence": match[1], "cosine": match[0], "unit": "file", "line": 0}
        units = [*((own, "line", k) for k, own in enumerate(lines)), (header, "header", 0), (whole, "file", 0)]
        found: dict[str, dict] = {}
        for counts, unit, line in units:
            match = self.best(counts) if counts else None
            if match and (match[1] not in found or match[0] > found[match[1]]["cosine"]):
                found[match[1]] = {"licence": match[1], "cosine": match[0], "unit": unit, "line": line}
        if not found:
            return None
        order = {"line": 0, "header": 1, "file": 2}
        ranked = sorted(found.values(), key=lambda f: (-f["cosine"], order[f["unit"]], f["line"]))
        first = ranked[0]["licence"]
        if first in UNVERSIONED:
            ranked = [f for f in ranked if f["licence"].startswith(first + "-")] or ranked
        return ranked[0]


def _last(name: str) -> tuple:
    """Orders names backwards, so that the first wins a tie."""
    return tuple(-ord(c) for c in name)


def document_frequencies(texts: DataFrame, text: str = "text", templates=TEMPLATES, full=()) -> tuple[int, dict[str, int]]:
    """The number of texts, and of those that hold each of the templates' words (a bounded list)."""
    vocabulary = {w for _, t in [*templates, *full] for w in words_of(t)}

    def count(batches):
        total, found = 0, Counter()
        for batch in batches:
            for value in batch[0].to_pylist():
                total += 1
                found.update(vocabulary.intersection(words_of(value or "")))
        rows = [("", total), *found.items()]  # no word is empty
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], names=["word", "n"]
        )

    counted = texts.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "word string, n long")
    totals = dict(counted.groupBy("word").agg(F.sum("n")).collect())
    return totals.pop("", 0), totals


def own_licence(files: DataFrame, text: str = "text", templates=TEMPLATES):
    """A column function: text to licence struct, with frequencies counted over ``files``."""
    full = full_texts()
    counted = document_frequencies(files, text, templates, full)
    matcher = files.sparkSession.sparkContext.broadcast(Matcher(*counted, templates, full))

    @F.arrow_udf(LICENCE)
    def licence(texts: pa.Array) -> pa.Array:
        return pa.array([matcher.value.licence(t or "") for t in texts.to_pylist()], _LICENCE_ARROW)

    return licence


def folder_of(path: Column) -> Column:
    return F.regexp_replace(path, r"(?s)/?[^/]*$", "")


def _nearest(folders: DataFrame, licensed: DataFrame) -> DataFrame:
    """``folder`` and ``above``: the licence of the nearest of itself and the folders above."""
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.size(parts), F.lit(0), F.lit(-1)), lambda k: F.struct(
        k.alias("depth"), F.array_join(F.slice(parts, F.lit(1), k), "/").alias("at")
    ))
    steps = folders.select("folder", F.explode(above).alias("step")).select("folder", "step.depth", F.col("step.at").alias("at"))
    if licensed.count() <= BROADCAST_FOLDERS:
        licensed = F.broadcast(licensed)
    found = steps.join(licensed, "at").select("folder", F.struct("depth", "at", "licence").alias("step"))
    return found.groupBy("folder").agg(F.max("step").alias("above"))


def scan(files: DataFrame, is_licence_file: Column | None = None, path: str = "path", text: str = "text") -> DataFrame:
    """Per file: ``file`` (all columns but the text), ``own``, ``licence``, ``inherited_from``.

    ``is_licence_file`` is a condition on ``file`` and ``own``; by default the customary file names.
    """
    textops.small_batches(files.sparkSession)
    kept = F.struct(*[F.col(f"`{c}`") for c in files.columns if c != text]).alias("file")
    licence = own_licence(files, text)(F.col(text).cast("string")).alias("own")
    scanned = written(files.select(kept, licence, folder_of(F.col(path)).alias("folder")))
    if is_licence_file is None:
        is_licence_file = F.col(f"file.{path}").rlike(r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$")
    best = F.max(F.struct(F.col("own.cosine").alias("cosine"), F.col("own.licence").alias("licence")))["licence"]
    licensed = written(
        scanned.where(is_licence_file & F.col("own.licence").isNotNull() & F.col("folder").isNotNull())
        .groupBy(F.col("folder").alias("at")).agg(best.alias("licence"))
    )
    folders = scanned.where("folder is not null").select("folder").distinct()
    return scanned.join(_nearest(folders, licensed), "folder", "left").select(
        "file",
        "own",
        F.coalesce("own.licence", "above.licence").alias("licence"),
        F.when(F.col("own.licence").isNull(), F.col("above.at")).alias("inherited_from"),
    )
