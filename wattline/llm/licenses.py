"""License scans: TF-IDF cosine to license templates, then inheritance from the nearest directory above.

Every line of a text, a short text as a whole, and every run of as many words as a template has around a cue word,
whatever the line breaks, is a passage. Templates are notices, headers and titles, and the whole text of short licenses. A passage's cosine to each template is taken over
sparse TF-IDF vectors, whose document frequencies are counted over the whole corpus for the templates' words; a word
that no template has counts as one that no document has, and so pushes a passage away from all templates. Relatives
share nearly all their words, so a passage must also have the template's version numbers and identifying words, must
not have another relative's restriction, and must not deny what the template says.

A file with a notice of its own has that license. Another one inherits from the nearest directory on its path that
holds a license file; directories are joined by path.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm import textbytes
from wattline.llm.common import cut, words

def _gnu(title: str, short: str, version: str, what: str) -> tuple[str, ...]:
    """Notices of a GNU license: naming it, its header in a source file, its title and its identifiers."""
    header = (
        f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {title} as "
        f"published by the Free Software Foundation, either version {version} of the License, or"
    )
    identifier = version if "." in version else f"{version}.0"
    return (
        f"This work is licensed under the GNU {title}, version {version}.",
        f"{header} any later version.",
        f"{header} (at your option) any later version.",
        f"GNU {title} Version {version}",
        f"SPDX-License-Identifier: {short}-{identifier}-or-later",
        f"SPDX-License-Identifier: {short}-{identifier}-only",
    )


def _creative_commons() -> dict[str, tuple[str, ...]]:
    """Notices of the attribution licenses, each with its restrictions."""
    restrictions = {"": "", "-SA": "-ShareAlike", "-NC": "-NonCommercial", "-ND": "-NoDerivatives",
                    "-NC-SA": "-NonCommercial-ShareAlike", "-NC-ND": "-NonCommercial-NoDerivatives"}
    return {
        f"CC-BY{short}-{version}": (
            f"Licensed under CC BY{short} {version}.",
            f"This work is licensed under a Creative Commons Attribution{long} {version} {scope} License.",
            f"SPDX-License-Identifier: CC-BY{short}-{version}",
        )
        for version, scope in (("4.0", "International"), ("3.0", "Unported"))
        for short, long in restrictions.items()
    }


# Passages of the licenses' own texts.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
)
_MIT_TEXT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
    "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    "Software. " + _AS_IS + "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
    "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_TEXT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
    'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
    "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
_BSD_LEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met."
)
_BSD_TWO = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_THIRD = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_UNLICENSE_TEXT = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
    "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
    "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the "
    "author or authors of this software dedicate any and all copyright interest in the software to the public domain."
)

#: Wording of notices and headers, titles, and the whole text of short licenses, by license. Fixed values.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
        "REPRODUCTION, AND DISTRIBUTION",
    ),
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
        _MIT_TEXT,
    ),
    "ISC": (
        "Released under the ISC License.",
        "This project is licensed under the terms of the ISC license.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted.",
        "SPDX-License-Identifier: ISC",
        _ISC_TEXT,
    ),
    "GPL-3.0": _gnu("General Public License", "GPL", "3", "program"),
    "GPL-2.0": _gnu("General Public License", "GPL", "2", "program"),
    "LGPL-3.0": _gnu("Lesser General Public License", "LGPL", "3", "library"),
    "LGPL-2.1": _gnu("Lesser General Public License", "LGPL", "2.1", "library"),
    "AGPL-3.0": _gnu("Affero General Public License", "AGPL", "3", "program"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Mozilla Public License Version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    **_creative_commons(),
    "CC0-1.0": (
        "Released under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work under CC0 1.0.",
    ),
    "BSD": (_BSD_LEAD,),  # the clauses that would tell which one are not there
    "BSD-2-Clause": (
        "Released under the 2-Clause BSD License.",
        "SPDX-License-Identifier: BSD-2-Clause",
        f"{_BSD_LEAD} {_BSD_TWO}",
        f"{_BSD_LEAD} {_BSD_TWO}{_BSD_END}",
    ),
    "BSD-3-Clause": (
        "Released under the 3-Clause BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        f"{_BSD_LEAD} {_BSD_TWO}{_BSD_THIRD}",
        f"{_BSD_LEAD} {_BSD_TWO}{_BSD_THIRD}{_BSD_END}",
    ),
    "Public-Domain": (
        "This work is dedicated to the public domain.",
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
        _UNLICENSE_TEXT,
    ),
}

#: Words that tell a license from its relatives: a passage has those of a template, and so it has the template's
#: numbers; of the restrictions it has no other ones. Fixed values.
RESTRICTIONS = frozenset("affero lesser endorse noncommercial nc sharealike sa noderivatives nd".split())
NAMES = frozenset("apache mit isc gnu gpl lgpl agpl mozilla mpl creative cc cc0 bsd unlicense".split()) | RESTRICTIONS
#: Words that deny a notice: a passage has no more of them than the template, counting so many words before it, as far
#: as they belong to its sentence.
DENIALS = frozenset("not never no cannot isn".split())
BEFORE = 6

#: Least cosine of a passage to a template.
THRESHOLD = 0.7
#: A text of at most so many words is also compared as a whole.
SHORT_WORDS = 60
#: A text with a notice is a license file if its name says so, or if passages with a license are this share of its words.
FILE_SHARE = 0.5
FILE_NAME = re.compile(
    r"(?!.*\.(?:py|pyi|c|cc|cpp|h|hpp|cs|java|kt|scala|js|jsx|ts|tsx|go|rs|rb|php|sh|json|xml|ya?ml|toml)$)"
    r"(?:un)?(?:licen[cs]es?|copying|copyright)(?:[-_.].*)?",
    re.IGNORECASE,
)

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LINE = re.compile(r"[\n-\r]")
_SENTENCE = re.compile(r"(?<=[.!?;:])[\t-\r ]|\n[\t\r ]*\n")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_words(text: str) -> list[str]:
    return _WORD.findall(text.translate(_LOWER))


def chosen(found: list[Match]) -> Match:
    """The match that names a text's license: the greatest cosine, ties to the first template, then the first place.

    A passage in which a longer template is found is not judged by a shorter one that it holds too, as all licenses of
    a family share sentences: matches that overlap a chosen one of more mass do not count.
    """
    taken = bytearray(max(match.end for match in found))
    kept: list[Match] = []
    for match in sorted(found, key=lambda m: (-round(m.mass, 9), m.template, m.start)):
        if 1 not in taken[match.start : match.end]:
            kept.append(match)
            taken[match.start : match.end] = b"\1" * (match.end - match.start)
    return max(kept, key=lambda m: (round(m.cosine, 9), -m.template, -m.start))


def vocabulary() -> list[str]:
    return sorted({word for texts in TEMPLATES.values() for text in texts for word in split_words(text)})


@dataclass
class Template:
    license: str
    weights: dict[str, float]
    size: float  # length of the weights
    width: int  # in words
    cues: frozenset[str]
    marks: frozenset[str]  # names, restrictions and numbers in it
    others: frozenset[str]  # restrictions that it does not have
    denials: int

    def agrees(self, passage: list[str], before: list[str]) -> bool:
        """Whether what tells the license from its relatives is the same, and nothing denies it."""
        held = set(passage)
        denied = sum(word in DENIALS for word in (*before, *passage))
        return self.marks <= held and not self.others & held and denied <= self.denials


@dataclass(frozen=True)
class Match:
    cosine: float
    template: int
    start: int
    end: int  # of its words in the text
    mass: float  # cosine times length of the template: what of the template was found


@dataclass
class Model:
    idf: dict[str, float]
    unknown: float
    templates: list[Template]
    cues: re.Pattern
    threshold: float

    def find(self, text: str | None, name: str = "") -> tuple[str | None, float, bool]:
        """License, cosine, and whether the text is a license file. Whole texts are read, whatever their length."""
        all_words, found = self.matches(text)
        if not found:
            return None, 0.0, False
        best = chosen(found)
        covered = bytearray(len(all_words))
        for match in found:
            covered[match.start : match.end] = b"\1" * (match.end - match.start)
        is_file = FILE_NAME.fullmatch(name) is not None or sum(covered) >= FILE_SHARE * len(all_words)
        return self.templates[best.template].license, best.cosine, is_file

    def matches(self, text: str | None) -> tuple[list[str], list[Match]]:
        """The text's words and its passages with a license: lines, a short text as a whole, and windows of words."""
        if not text or not self.cues.search(text.translate(_LOWER)):
            return [], []
        lines = [split_words(line) for line in _LINE.split(text)]
        all_words = [word for line in lines for word in line]
        present = set(all_words)
        possible = [i for i, template in enumerate(self.templates) if self._possible(template, present)]
        if not possible:
            return all_words, []
        spans, at = [(0, len(all_words))] if len(all_words) <= SHORT_WORDS else [], 0
        for line in lines:
            spans.append((at, at + len(line)))
            at += len(line)
        sentences = [0] * (len(all_words) + 1)  # where the sentence of each word begins
        at = 0
        for sentence in map(split_words, _SENTENCE.split(text)):
            sentences[at : at + len(sentence)] = [at] * len(sentence)
            at += len(sentence)
        found = []
        for i in possible:
            cues, width = self.templates[i].cues, min(self.templates[i].width, len(all_words))
            for start, end in spans:
                if not cues.isdisjoint(all_words[start:end]):
                    found += self._match(i, all_words, sentences, start, end)
            for start, cosine in self._windows(i, all_words, width):
                if cosine >= self.threshold - 1e-9:
                    found += self._match(i, all_words, sentences, start, start + width)
        return all_words, found

    def _possible(self, template: Template, present: set[str]) -> bool:
        """No passage's cosine exceeds the length of what the text has of the template."""
        if not template.marks <= present:
            return False
        shared = sum(x * x for word, x in template.weights.items() if word in present)
        return shared >= (self.threshold * template.size) ** 2 - 1e-9

    def _match(self, i: int, all_words: list[str], sentences: list[int], start: int, end: int) -> list[Match]:
        passage, template = all_words[start:end], self.templates[i]
        cosine = self._cosine(i, passage)
        before = all_words[max(sentences[start], start - BEFORE) : start]
        if cosine < self.threshold or not template.agrees(passage, before):
            return []
        return [Match(cosine, i, start, end, cosine * template.size)]

    def _cosine(self, i: int, passage: list[str]) -> float:
        template = self.templates[i]
        own = {word: (1 + math.log(n)) * self.idf.get(word, self.unknown) for word, n in Counter(passage).items()}
        length = math.sqrt(sum(x * x for x in own.values()))
        shared = sum(template.weights[word] * weight for word, weight in own.items() if word in template.weights)
        return shared / (length * template.size) if length else 0.0

    def _windows(self, i: int, all_words: list[str], width: int):
        """First words and cosines of all windows of a text that hold one of the template's cues, by sliding."""
        weights, size, cues = self.templates[i].weights, self.templates[i].size, self.templates[i].cues
        last = len(all_words) - width
        held: dict[str, int] = {}
        square = dot = 0.0
        begin = end = 0  # what is held

        def change(word: str, by: int) -> None:
            nonlocal square, dot
            n = held.get(word, 0)
            idf = self.idf.get(word, self.unknown)
            before = (1 + math.log(n)) * idf if n else 0.0
            after = (1 + math.log(n + by)) * idf if n + by else 0.0
            held[word] = n + by
            square += after * after - before * before
            dot += weights.get(word, 0.0) * (after - before)

        done = 0
        for at, word in enumerate(all_words):
            if word not in cues:
                continue
            for start in range(max(done, at - width + 1), min(at, last) + 1):
                if start >= end:
                    held, square, dot, begin, end = {}, 0.0, 0.0, start, start
                while begin < start:
                    change(all_words[begin], -1)
                    begin += 1
                while end < start + width:
                    change(all_words[end], 1)
                    end += 1
                yield start, dot / (math.sqrt(square) * size) if square > 0 else 0.0
                done = start + 1


def build(n_docs: int, frequency: dict[str, int], threshold: float = THRESHOLD) -> Model:
    """The templates' vectors from the corpus's document frequencies.

    ``cues`` are words of which a passage must have one to reach the threshold: what a template keeps without them is
    shorter than the threshold's share of its length, and the cosine can't exceed that share.
    """
    idf = {word: math.log((1 + n_docs) / (1 + frequency.get(word, 0))) + 1 for word in vocabulary()}
    templates = []
    for license, texts in TEMPLATES.items():
        for text in texts:
            own = split_words(text)
            weights = {word: (1 + math.log(n)) * idf[word] for word, n in Counter(own).items()}
            size = math.sqrt(sum(x * x for x in weights.values()))
            rest, cues = size * size, set()
            for word in sorted(weights, key=lambda w: (-weights[w], w)):
                if rest < (threshold * size) ** 2:
                    break
                cues.add(word)
                rest -= weights[word] ** 2
            marks = frozenset(word for word in own if word in NAMES or word.isdigit())
            denials = sum(word in DENIALS for word in own)
            templates.append(
                Template(license, weights, size, len(own), frozenset(cues), marks, RESTRICTIONS - marks, denials)
            )
    pattern = "|".join(sorted({re.escape(word) for template in templates for word in template.cues}))
    edge = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
    found = re.compile(f"(?<!{edge})(?:{pattern})(?!{edge})")
    return Model(idf, math.log(1 + n_docs) + 1, templates, found, threshold)


def fit(files: DataFrame, text: str = "text") -> Model:
    """Document frequencies of the templates' words over all files; what is collected is one row per such word.

    Null and empty texts count as files without words, and repeated rows count each time; without files all words of
    templates weigh the same.
    """
    known = vocabulary()
    marks = F.array_intersect(words(F.col(text)), F.array(*[F.lit(word) for word in known]))
    counted = files.select(F.explode(marks).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()
    return build(files.count(), {row.word: row.n for row in counted})


def own_license(model: Model, text: Column, path: Column) -> Column:
    """License, cosine, and whether the text is a license file, by its name too. Whole texts are read."""

    def of(texts: pa.Array, names: pa.Array) -> pa.Array:
        own = zip(textbytes.views(texts), names.to_pylist())
        found = [model.find(str(text, "utf-8", "replace"), name) for text, name in own]
        names, cosines, short = zip(*found) if found else ((), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(cosines, pa.float64()), pa.array(short, pa.bool_())],
            names=["license", "cosine", "is_file"],
        )

    return F.arrow_udf(of, "license string, cosine double, is_file boolean")(
        text, F.element_at(F.split(F.coalesce(path, F.lit("")), "/"), -1)
    )


def directories(path: Column) -> Column:
    """All directories on a path, outermost first: ``a/b/c`` lies in ````, ``a`` and ``a/b``."""
    parts = F.split(F.coalesce(path, F.lit("")), "/")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/")
    )


def inherit(scanned: DataFrame) -> DataFrame:
    """Rows ``key, path, license, cosine, is_file`` with the license each ends up with.

    Adds ``final`` and ``inherited_from`` (the directory, null unless inherited). A directory's license is that of its
    license file with the greatest cosine, ties to the least path; the nearest directory with one counts. Candidates
    are combined before they meet: per file one row per directory above it, and per directory one license.
    """
    home = F.element_at(directories(F.col("path")), -1)
    rank = F.struct(F.col("cosine").alias("cosine"), F.col("license").alias("license"))
    held = scanned.where("is_file").groupBy(home.alias("dir"))
    dirs = held.agg(F.max(rank).alias("best")).select("dir", F.col("best.license").alias("dir_license"))
    bare = scanned.where("license IS NULL").select("path").distinct()
    above = bare.select("path", F.posexplode(directories(F.col("path"))).alias("depth", "dir"))
    nearest = (
        above.join(dirs, "dir")
        .groupBy("path")
        .agg(F.max(F.struct("depth", "dir", "dir_license")).alias("near"))
        .select(F.col("path").alias("_path"), F.col("near.dir").alias("_dir"), F.col("near.dir_license").alias("_license"))
    )
    joined = scanned.join(nearest, scanned.path.eqNullSafe(F.col("_path")) & F.col("license").isNull(), "left")
    return joined.select(
        *scanned.columns,
        F.coalesce("license", "_license").alias("final"),
        F.when(F.col("license").isNull(), F.col("_dir")).alias("inherited_from"),
    )


def scan(files: DataFrame, path: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, path, license, cosine, is_file, final, inherited_from`` of every row.

    Null and empty texts have no license of their own; a null path lies in the root directory. Repeated rows give
    repeated results; ties between templates go to the first one.
    """
    model = fit(files, text)
    found = own_license(model, F.col(text), path)
    rows = files.select(F.col(key).alias("key"), path.alias("path"), found.alias("s")).select("key", "path", "s.*")
    return inherit(cut(rows))  # three branches read the scan's result: texts are scanned once
