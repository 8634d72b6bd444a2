"""Licences by sparse TF-IDF cosine to templates, inherited from the nearest ancestor directory.

The vocabulary is the templates'; document frequencies come from all texts, added up map-side.
Windows of a template's length, laid wherever a text has one of the template's
cue words, are compared with it, so notices, headers and whole licence files are found in lines of any
length.  A file without a licence of its own takes that of the nearest directory above
it that has one: its path's ancestors are joined with the directories' licences.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mastline.llm.common import mapped, sized, written

THRESHOLD = 0.75
_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall
be included in all copies or substantial portions of the Software."""
_CLAUSES = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""
_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} Public License
as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version."""
# Notices, standard headers and bodies of common licences.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law
or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied.""",
        "Apache License Version 2.0, January 2004 TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    ],
    "BSD-2-Clause": ["Use of this source code is governed by the BSD 2-Clause License", f"{_CLAUSES} {_BSD_END}"],
    "BSD-3-Clause": [
        "Use of this source code is governed by the BSD 3-Clause License",
        f"""{_CLAUSES} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission. {_BSD_END}""",
    ],
    "CC-BY-4.0": ["Licensed under Creative Commons Attribution CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0 Universal"],
    "GPL-2.0": ["This program is licensed under the GNU General Public License, version 2", _GNU.format("General", 2)],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3", _GNU.format("General", 3)],
    "ISC": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""
    ],
    "LGPL-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3", _GNU.format("Lesser General", 3)],
    "MIT": ["Released under the MIT License", "Licensed under the MIT License", _GRANT],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "Unlicense": [
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means."""
    ],
}
# Words of which every template has one; a window is laid where the text has the template's.
CUES = ("license", "licensed", "copyright", "domain", "permission", "redistribution")
_NEGATIONS = {"no", "not", "never", "neither", "nor", "without", "isn", "nothing", "none"}
NEGATION_WORDS = 5  # before a statement in which a negation takes it back
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*\(?([A-Za-z0-9.+-]+)")
_CUE = re.compile("|".join(CUES), re.IGNORECASE)
_TERM = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


def frequencies(docs: DataFrame, vocabulary: frozenset[str]) -> tuple[dict[str, int], int]:
    """Texts that hold each word of the vocabulary, and texts in all; each task sends one row per word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = Counter(), 0
        for b in batches:
            for t in b.column(0):
                n += 1
                df.update(vocabulary.intersection(x.strip(".,;:()\"'|") for x in set((t.as_py() or "").lower().split())))
        df[""] = n
        yield pa.RecordBatch.from_arrays([pa.array(list(df), pa.string()), pa.array(list(df.values()), pa.int64())], ["term", "n"])

    rows = mapped(docs.select("text"), run, "term string, n long").groupBy("term").agg(F.sum("n")).collect()  # vocabulary's size
    found = dict(map(tuple, rows))
    return found, found.pop("", 0)


class Templates:
    """Unit vectors of the templates over their vocabulary, and where each has its cues."""

    def __init__(self, texts: dict[str, list[str]], df: dict[str, int], n: int):
        every = [(name, terms(t)) for name, forms in texts.items() for t in forms]
        self.names = [name for name, _ in every]
        self.vocabulary = frozenset(w for _, t in every for w in t)
        self.idf = {w: math.log((1 + n) / (1 + df.get(w, 0))) + 1 for w in self.vocabulary}
        self.size = [len(t) for _, t in every]
        self.vectors = [self.vector(t) for _, t in every]
        self.cued: dict[str, list[tuple[int, int]]] = {}  # template and place, by cue
        for k, (_, t) in enumerate(every):
            for cue in CUES:
                if cue in t:
                    self.cued.setdefault(cue, []).append((k, t.index(cue)))
        bare = [name for k, name in enumerate(self.names) if not any(k == i for x in self.cued.values() for i, _ in x)]
        if bare:
            raise ValueError(f"templates without any of the words {CUES}: {bare}")
        self.spdx = {name.lower(): name for name in self.names}

    def vector(self, words: list[str]) -> dict[str, float]:
        """Weights by word over the vocabulary, of a vector whose length counts all words; words beyond weigh one each."""
        count = Counter(words)
        weight = {w: c * self.idf[w] for w, c in count.items() if w in self.idf}
        beyond = sum(c * c for w, c in count.items() if w not in self.idf)
        length = math.sqrt(sum(x * x for x in weight.values()) + beyond) or 1.0
        return {w: x / length for w, x in weight.items()}

    def cosine(self, words: list[str], template: int) -> float:
        t = self.vectors[template]
        return sum(x * t[w] for w, x in self.vector(words).items() if w in t)

    def best(self, text: str, threshold: float) -> tuple[float, str] | None:
        """The highest cosine of a window of a template's length, laid at a cue, and the licence; longer templates, then first names, win ties.

        An SPDX line of a known licence counts one.  A statement that a negation precedes does not count.
        """
        for m in _SPDX.finditer(text):
            name = self.spdx.get(re.sub(r"-(only|or-later)$", "", m[1].lower()))
            if name:
                return 1.0, name
        words = terms(text)
        found = None
        for p, w in enumerate(words):
            for k, place in self.cued.get(w, ()):
                start, size = p - place, self.size[k]
                if start < 0 or start + size > len(words) + size // 4:
                    continue
                s = self.cosine(words[start : start + size], k)
                if s < threshold or _NEGATIONS.intersection(words[max(0, start - NEGATION_WORDS) : start]):
                    continue
                if found is None or (round(s, 9), size) > found[:2]:
                    found = (round(s, 9), size, self.names[k])
        return found and (found[0], found[2])


def statements(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, path, license, cosine) of every text of ``docs`` (doc_id, text, path).

    Null where no statement reaches the threshold.  Null texts count as empty.
    """
    vocabulary = frozenset(w for forms in templates.values() for t in forms for w in terms(t))
    df, n = frequencies(docs, vocabulary)
    ready = Templates(templates, df, n)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, cosines = [], []
            for t in b.column(1):
                text = t.as_py() or ""
                best = ready.best(text, threshold) if _CUE.search(text) else None
                names.append(best and best[1])
                cosines.append(best and min(1.0, best[0]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(names, pa.string()), pa.array(cosines, pa.float64())], ["doc_id", "path", "license", "cosine"])

    return mapped(docs.select("doc_id", "text", "path"), run, f"doc_id {kind}, path string, license string, cosine double")


def ancestors(path: Column) -> Column:
    """Directories above a path, the nearest first: a/b/c.txt has a/b, a and the empty root."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))


def inherit(files: DataFrame) -> DataFrame:
    """``files`` (doc_id, path, license, cosine, licence_file) with the licence each file has or inherits.

    A directory's licence is that of its licence file with the highest cosine, then the
    smallest doc_id.  Each distinct directory looks up its ancestors, not each file.
    Files without a path inherit nothing.
    """
    folder = F.regexp_replace(F.regexp_extract("path", r"^(.*)/[^/]*$", 1), "/+$", "")
    files = files.withColumn("folder", F.when(F.col("path").isNotNull(), folder))
    declared = files.where("licence_file and license is not null and folder is not null")
    best = declared.groupBy("folder").agg(F.max_by(F.struct("license", "doc_id"), F.struct("cosine", (-F.col("doc_id")).alias("low"))).alias("own"))
    best = written(best.select(F.col("folder").alias("above"), F.col("own.license").alias("inherited"), F.col("own.doc_id").alias("from_id")), "licence-folders")
    folders = files.where("folder is not null").select("folder").distinct()
    up = folders.select("folder", F.posexplode(ancestors(F.concat("folder", F.lit("/x")))).alias("steps", "above"))
    near = up.join(sized(best), "above").groupBy("folder").agg(F.min_by(F.struct("inherited", "from_id", "above"), "steps").alias("near"))
    joined = files.join(near, "folder", "left")
    own = F.col("license").isNotNull()
    return joined.select(
        "doc_id", "path",
        F.coalesce("license", "near.inherited").alias("license"), "cosine",
        F.when(own, "own").when(F.col("near").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~own, F.col("near.from_id")).alias("from_id"),
    )


def license_report(docs: DataFrame) -> DataFrame:
    """(doc_id, path, license, cosine, origin, from_id) of every row of ``documents``.

    The table has no paths, so they are made from source and doc_id: every hundredth document
    lies in its source's folder, every tenth in that of its thousand, the others in that of its
    hundred.  As it has no file names, a directory's licence file is its first document
    with a statement.  A row without doc_id has no path: it inherits and declares nothing.  Null and
    empty texts have no statement; rows that repeat a doc_id are files of one path, each with
    its own statement; texts are read whole, and other columns, whatever their names, not at all.
    An empty table gives no rows.
    """
    i = F.col("doc_id")
    thousand, hundred = F.expr("doc_id div 1000"), F.expr("doc_id div 100")
    folders = F.when(i % 100 == 0, F.array()).when(i % 10 == 0, F.array(thousand)).otherwise(F.array(thousand, hundred))
    parts = F.concat(F.array(F.coalesce("source", F.lit("unknown"))), folders.cast("array<string>"), F.array(i.cast("string")))
    path = F.when(i.isNotNull(), F.array_join(parts, "/"))
    rows = written(statements(docs.select("doc_id", "text", path.alias("path"))), "statements")
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    firsts = rows.where("license is not null").groupBy(folder.alias("f")).agg(F.min("doc_id").alias("first"))
    rows = rows.join(firsts, folder == F.col("f"), "left").withColumn("licence_file", F.coalesce(F.col("doc_id") == F.col("first"), F.lit(False)))
    return inherit(rows.select("doc_id", "path", "license", "cosine", "licence_file"))
