"""Operator 10: licence scans.

Texts are compared with licence templates as sparse TF-IDF vectors (cosine; document frequencies of the
templates' terms are counted over all files; other words count with the largest weight, so a template's words
inside ordinary prose do not match):

* notices and titles of a line (NOTICES) with every line, and with every run of up to RUN lines or sentences;
* file headers and whole licence texts (``license_texts``) with every window of their length, in words, at
  every word of the file (a shorter file as a whole). A file whose terms bound the cosine with a template
  below ``similarity`` has no such window, and is not searched.

An ``SPDX-License-Identifier`` tag declares what it names. What reaches ``similarity`` declares its licence
for the file: a *header*, anywhere in the text.
Licence files (LICENSE, LICENCE, COPYING, NOTICE, UNLICENSE, with or without an extension or suffix) declare theirs for
their directory and everything below it. A file without a declaration of its own inherits from
the nearest ancestor directory with one: the distinct directories are joined with their
ancestors' paths (a directory full of files is one row there), then the files with the
directories.

Defined cases: null and empty texts declare nothing; a null path has no directory and inherits
nothing; several matches: highest cosine, then template name; several licence files of one
directory: the same rule; repeated rows each get a row; extra columns are ignored; empty
tables give empty results.
"""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: The short notices and titles by which licences are declared.
NOTICES = {
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Apache License Version 2.0, January 2004"),
    "BSD-2-Clause": ("Licensed under the 2-Clause BSD License.", "BSD 2-Clause License"),
    "BSD-3-Clause": ("Licensed under the 3-Clause BSD License.", "BSD 3-Clause License"),
    "CC-BY-4.0": ("This work is licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA-4.0": ("This work is licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    "ISC": ("Licensed under the ISC License.", "ISC License"),
    "LGPL-2.1": ("This library is licensed under the GNU Lesser General Public License, version 2.1.", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    "LGPL-3.0": ("This library is licensed under the GNU Lesser General Public License, version 3.", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.", "MIT License", "The MIT License (MIT)"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Mozilla Public License Version 2.0"),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
_GNU = """This {what} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."""
_GNU_REST = """ This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details. You should have received a copy of the {name} along with this {what}. If not, see <https://www.gnu.org/licenses/>."""
_GNU_NAMES = (("AGPL-3.0", "program", "GNU Affero General Public License", "3"), ("GPL-2.0", "program", "GNU General Public License", "2"), ("GPL-3.0", "program", "GNU General Public License", "3"), ("LGPL-2.1", "library", "GNU Lesser General Public License", "2.1"), ("LGPL-3.0", "library", "GNU Lesser General Public License", "3"))
HEADERS = {key: tuple(x.format(what=what, name=name, version=version) for x in (_GNU, _GNU + _GNU_REST)) for key, what, name, version in _GNU_NAMES} | {
    "Apache-2.0": ("""Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",),
    "MPL-2.0": ("""This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",),
    "Unlicense": ("""This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",),
}


def full_texts() -> dict[str, tuple[str, ...]]:
    """The licence texts that lie beside this module (without titles' holders), by file name."""
    folder = Path(__file__).parent / "license_texts"
    return {p.stem: (p.read_text(encoding="utf-8"),) for p in sorted(folder.glob("*.txt"))}


RUN = 3  # lines or sentences compared together with a notice
SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*(\(?[A-Za-z0-9.+-]+\)?(?:[ \t]+(?:OR|AND|WITH)[ \t]+\(?[A-Za-z0-9.+-]+\)?)*)")
TERM = re.compile(r"\w+(?:[.-]\w+)*")
LICENCE_FILE = r"(?i)(^|/)(un)?(licen[cs]e|copying|notice)([-._][^/]*)?$"


def _terms(line: str) -> list[str]:
    return TERM.findall(line.lower())


def _frequencies(wanted: frozenset):
    def run(batches):
        df: Counter = Counter()
        for b in batches:
            for t in b.column("text").to_pylist():
                if t:
                    df.update(wanted.intersection(_terms(t)))
        yield pa.RecordBatch.from_arrays([pa.array(list(df), pa.string()), pa.array(list(df.values()), pa.int64())], names=["term", "n"])

    return run


def _units(text: str) -> list[list[list[str]]]:
    """The terms of its lines, and those of the sentences of each paragraph."""
    out = [[_terms(x) for x in text.split("\n")]]
    for paragraph in re.split(r"\n\s*\n", text):
        out.append([_terms(x) for x in re.split(r"(?<=[.!?;:])\s+", " ".join(paragraph.split()))])
    return [[t for t in unit if t] for unit in out]


class Matcher:
    def __init__(self, notices: dict[str, tuple], passages: dict[str, tuple], df: dict[str, int], files: int, similarity: float):
        self.similarity = similarity
        self.top = float(np.log(files + 1)) + 1
        self.idf = {t: float(np.log((files + 1) / (df.get(t, 0) + 1))) + 1 for t in wanted_terms(notices, passages)}
        self.names, self.vectors, self.sizes = [], [], []
        for texts in (notices, passages):
            for name in sorted(texts):
                for text in texts[name]:
                    n = Counter(_terms(text))
                    v = {t: k * self.idf[t] for t, k in n.items()}
                    norm = sum(x * x for x in v.values()) ** 0.5
                    self.names.append(name)
                    self.vectors.append({t: x / norm for t, x in v.items()})
                    self.sizes.append(n.total())
            if texts is notices:
                self.notices = len(self.names)
        self.postings: dict[str, list] = {}
        for k, own in enumerate(self.vectors[: self.notices]):
            for t, x in own.items():
                self.postings.setdefault(t, []).append((k, x))
        self.squares: dict[str, list] = {}
        for k, own in enumerate(self.vectors):
            for t, x in own.items():
                self.squares.setdefault(t, []).append((k, x * x))

    def notice(self, found: list[str], best: tuple) -> tuple:
        """The better of ``best`` and the notice nearest to these terms."""
        if self.postings.keys().isdisjoint(found):
            return best
        norm, dots = 0.0, [0.0] * self.notices
        for t, n in Counter(found).items():
            x = n * self.idf.get(t, self.top)
            norm += x * x
            for k, w in self.postings.get(t, ()):
                dots[k] += w * x
        k = max(range(self.notices), key=lambda i: round(dots[i], 12))
        c = dots[k] / norm**0.5
        return (self.names[k], c) if c > best[1] + 1e-12 else best

    def window(self, terms: list[str], k: int) -> float:
        """The highest cosine of template ``k`` with a window of its length."""
        own, size, n = self.vectors[k], self.sizes[k], {}
        weights = [self.idf.get(t, self.top) for t in terms]
        dot = norm = best = 0.0
        for i, t in enumerate(terms):
            x, c = weights[i], n.get(t, 0)
            n[t] = c + 1
            norm += x * x * (2 * c + 1)
            dot += own.get(t, 0.0) * x
            if i >= size:
                u, y = terms[i - size], weights[i - size]
                c = n[u]
                n[u] = c - 1
                norm -= y * y * (2 * c - 1)
                dot -= own.get(u, 0.0) * y
            if i >= size - 1 or i == len(terms) - 1:
                best = max(best, dot / norm**0.5)
        return best

    def best(self, text: str | None) -> tuple[str | None, float]:
        """Licence and cosine of what matches best."""
        text = text or ""
        best: tuple = (None, 0.0)
        terms: list[str] = []
        for line in text.split("\n"):
            found = _terms(line)
            terms += found
            best = self.notice(found, best)
        if tag := SPDX.search(text):
            return re.sub(r"(-only|-or-later|\+)(?![\w.+-])", "", tag[1]), 1.0
        reach = [0.0] * len(self.names)  # square of the highest cosine with anything made of the file's terms
        for t in set(terms):
            for k, x in self.squares.get(t, ()):
                reach[k] += x
        near = [k for k, x in enumerate(reach) if x >= (self.similarity - 1e-9) ** 2]
        if near and near[0] < self.notices:
            for units in _units(text):
                for n in range(1, RUN + 1):
                    for i in range(len(units) - n + 1):
                        best = self.notice([t for u in units[i : i + n] for t in u], best)
        for k in near:
            if k >= self.notices and (c := self.window(terms, k)) > best[1] + 1e-12:
                best = self.names[k], c
        return best[0], min(best[1], 1.0)


def wanted_terms(*texts: dict[str, tuple]) -> frozenset:
    return frozenset(t for part in texts for variants in part.values() for x in variants for t in _terms(x))


def _declared(matcher: Matcher, similarity: float):
    def run(batches):
        for b in batches:
            found = [matcher.best(t) for t in b.column("text").to_pylist()]
            names = [n if c >= similarity else None for n, c in found]
            yield pa.RecordBatch.from_arrays([b.column("file_id"), b.column("path"), pa.array(names, pa.string()), pa.array([c for _, c in found], pa.float64())], names=["file_id", "path", "own", "cosine"])

    return run


def scan_licenses(files: DataFrame, similarity: float = 0.85, notices: dict[str, tuple] = NOTICES, passages: dict[str, tuple] | None = None) -> DataFrame:
    """``file_id, path, license, origin (header, licence file, inherited or null), cosine, from_dir``
    for every row of ``files(file_id, path, text, ...)``."""
    rows = files.select("file_id", "path", "text")
    if passages is None:
        texts = full_texts()
        passages = {k: HEADERS.get(k, ()) + texts.get(k, ()) for k in sorted(HEADERS.keys() | texts)}
    wanted = wanted_terms(notices, passages)
    df = {r.term: r.n for r in rows.mapInArrow(_frequencies(wanted), "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    matcher = Matcher(notices, passages, df, rows.count(), similarity)
    kind = dict(rows.dtypes)["file_id"]
    own = written(rows.mapInArrow(_declared(matcher, similarity), f"file_id {kind}, path string, own string, cosine double"), "declared")
    own = own.withColumn("dir", F.regexp_extract("path", "^(.*)/[^/]*$", 1)).withColumn("dir", F.when(F.col("path").isNull(), None).otherwise(F.col("dir")))
    own = own.withColumn("is_file", F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False)))
    given = own.filter("is_file and own is not null and dir is not null").groupBy("dir").agg(F.max_by("own", F.struct("cosine", "own")).alias("given"))
    dirs = own.select("dir").filter("dir is not null").distinct()
    # every directory with each of its ancestors and itself; depth is the number of parts
    chain = F.transform(F.sequence(F.lit(0), F.size(F.split("dir", "/"))), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(F.split("dir", "/"), F.lit(1), n), "/").alias("up")))
    ups = dirs.select("dir", F.explode(chain).alias("c")).select("dir", "c.depth", "c.up").filter("depth > 0 or up = ''").join(given.withColumnRenamed("dir", "up"), "up")
    nearest = ups.groupBy("dir").agg(F.max_by(F.struct("given", "up"), "depth").alias("near"))
    joined = own.join(nearest, "dir", "left")
    origin = F.when(F.col("own").isNotNull(), F.when(F.col("is_file"), "licence file").otherwise("header")).when(F.col("near").isNotNull(), "inherited")
    return joined.select("file_id", "path", F.coalesce("own", "near.given").alias("license"), origin.alias("origin"), "cosine", F.when(F.col("own").isNull(), F.col("near.up")).alias("from_dir"))
