"""License scans by patience alignment.

A template and a text are aligned on the words that occur exactly once in both: among those anchors the longest increasing subsequence of text places is
kept, and each gap between neighbouring anchors is aligned in the same way, after equal words at the gap's ends have been matched. The gaps before the first
and after the last anchor reach no further into the text than the template's own remaining words, so a notice in a
very long text costs no more than in a short one. Coverage is the share of the template's words that are matched.

A license may stand in a text several times, and then no word of it may be unique in the whole text. So a template is also aligned with stretches of the text, one
around each place where it can stand: a copy with the wanted coverage lacks few enough of the template's words that one of its rarest in this text must
be there, which gives the place. The best alignment counts.

A template is only aligned if the text can reach the wanted coverage at all: each distinct template word the text lacks costs at least
one word, and so with each stretch.

Words are runs of a-z and 0-9 of the lower-cased text. Defined cases: null and empty texts have no license; of equal coverages the longer
template wins, then the name in order; a text may hold several licenses, all are listed; nulls in other columns, extra columns and
repeated rows change nothing; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlens.llm.frames import fields, small_batches

WORDS = re.compile("[a-z0-9]+")
COVERAGE = 0.8

# Public license texts and notices.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES '
        "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."),
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MIT notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        'shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY '
        "OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
        "THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" "
        "AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
        "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial "
        "or non-commercial, and by any means."),
}


def increasing(places: Sequence[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence, by patience sorting."""
    tops: list[int] = []  # index of the smallest last place of the subsequences of each length
    values: list[int] = []
    before: list[int] = []
    for i, place in enumerate(places):
        pile = bisect_left(values, place)
        before.append(tops[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(i)
            values.append(place)
        else:
            tops[pile], values[pile] = i, place
    out, i = [], tops[-1] if tops else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(template: Sequence[str], text: Sequence[str], places: Mapping[str, list[int]] | None = None) -> list[tuple[int, int]]:
    """Matched pairs (template place, text place), both increasing. ``places`` are the text's places of template words."""
    if places is None:
        places = {}
        wanted = set(template)
        for j, word in enumerate(text):
            if word in wanted:
                places.setdefault(word, []).append(j)
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(template), 0, len(text), True)]
    while todo:
        i0, i1, j0, j1, whole = todo.pop()
        if not whole:
            # Equal words at both ends of an inner gap belong together.
            while i0 < i1 and j0 < j1 and template[i0] == text[j0]:
                pairs.append((i0, j0))
                i0, j0 = i0 + 1, j0 + 1
            while i0 < i1 and j0 < j1 and template[i1 - 1] == text[j1 - 1]:
                i1, j1 = i1 - 1, j1 - 1
                pairs.append((i1, j1))
        if i0 >= i1 or j0 >= j1:
            continue
        counts = Counter(template[i0:i1])
        anchors = []
        for i in range(i0, i1):
            word = template[i]
            found = places.get(word)
            if counts[word] == 1 and found:
                at = bisect_left(found, j0)
                if at < len(found) and found[at] < j1 and (at + 1 == len(found) or found[at + 1] >= j1):
                    anchors.append((i, found[at]))
        if not anchors:
            continue
        line = [anchors[k] for k in increasing([j for _, j in anchors])]
        pairs += line
        if whole:
            # Beyond the outer anchors only as many words can belong to the template as it has left.
            j0 = max(j0, line[0][1] - (line[0][0] - i0))
            j1 = min(j1, line[-1][1] + (i1 - line[-1][0]))
        ends = [(i0 - 1, j0 - 1), *line, (i1, j1)]
        todo += [(a + 1, c, b + 1, d, False) for (a, b), (c, d) in zip(ends, ends[1:])]
    return sorted(pairs)


class Scanner:
    def __init__(self, templates: Mapping[str, str], coverage: float):
        self.coverage = coverage
        self.templates = {name: WORDS.findall(text.lower()) for name, text in templates.items()}
        self.distinct = {name: set(words) for name, words in self.templates.items()}
        self.bags = {name: Counter(words) for name, words in self.templates.items()}
        self.vocabulary = set().union(*self.distinct.values()) if templates else set()

    def starts(self, name: str, places: Mapping[str, list[int]], spare: int) -> list[int]:
        """Places in the text where the template can begin, one of each run of places at most ``spare`` apart.

        A copy with the wanted coverage lacks fewer template words than the seeds are, so it holds a seed.
        """
        template = self.templates[name]
        seeds = sorted(range(len(template)), key=lambda i: len(places.get(template[i], ())))[:self.missing(name) + 1]
        out: list[int] = []
        for start in sorted({j - i for i in seeds for j in places.get(template[i], ())}):
            if not out or start - out[-1] > spare:
                out.append(start)
        return out

    def missing(self, name: str) -> int:
        """How many words of the template a copy may lack."""
        size = len(self.templates[name])
        return size - math.ceil(self.coverage * size)

    def best(self, name: str, words: Sequence[str], places: Mapping[str, list[int]]) -> list[tuple[int, int]]:
        """The pairs of the alignment that matches most, of equal ones the one of the fewest text words, then the first."""
        template = self.templates[name]
        best = align(template, words, places)
        for spare in (len(template) // 8, len(template) // 2):
            for start in self.starts(name, places, spare // 2):
                if len(best) == len(template) == best[-1][1] - best[0][1] + 1:
                    return best
                a, b = max(0, start - spare), max(0, min(len(words), start + len(template) + spare))
                stretch = words[a:b]
                if (Counter(stretch) & self.bags[name]).total() < max(len(best), self.coverage * len(template)):
                    continue
                pairs = [(i, j + a) for i, j in align(template, stretch)]
                if pairs and (-len(pairs), pairs[-1][1] - pairs[0][1]) < (-len(best), best[-1][1] - best[0][1] if best else 0):
                    best = pairs
        return best

    def scan(self, text: str | None) -> tuple[int, list[tuple[str, float, int, int, int]]]:
        """Number of words, and (name, coverage, matched words, first and last word) of every license found, the best first."""
        words = WORDS.findall(text.lower()) if text else []
        present = self.vocabulary.intersection(words)
        hopeful = [name for name, template in self.templates.items()
                   if len(self.distinct[name] - present) <= (1 - self.coverage) * len(template)]
        if not hopeful:
            return len(words), []
        places: dict[str, list[int]] = {}
        for j, word in enumerate(words):
            if word in present:
                places.setdefault(word, []).append(j)
        found = []
        for name in hopeful:
            template = self.templates[name]
            pairs = self.best(name, words, places)
            if len(pairs) >= self.coverage * len(template):
                found.append((name, len(pairs) / len(template), len(pairs), pairs[0][1], pairs[-1][1]))
        return len(words), sorted(found, key=lambda f: (-f[1], -f[2], f[0]))


def license_scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, n_words, the best license with its coverage and the words it spans, and the names of all licenses found."""
    chosen = docs.select("doc_id", "text")
    templates = dict(templates)

    def run(batches):
        scanner = Scanner(templates, coverage)
        for batch in batches:
            counts, best, names = [], [], []
            for text in batch.column("text"):
                n, found = scanner.scan(text.as_py())
                counts.append(n)
                best.append(found[0] if found else (None,) * 5)
                names.append([f[0] for f in found])
            columns = list(zip(*best)) if best else [()] * 5
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()),
                 *[pa.array(list(values), kind) for values, kind in zip(columns, kinds)], pa.array(names, pa.list_(pa.string()))],
                names=["doc_id", "n_words", "license", "coverage", "n_matched", "first_word", "last_word", "licenses"])

    return small_batches(chosen).mapInArrow(run, fields(chosen, ["doc_id"], (
        "n_words bigint, license string, coverage double, n_matched bigint, first_word bigint, last_word bigint, "
        "licenses array<string>")))
