"""License scans by conditional compression.

Texts are searched in windows around their cue words: ``reach`` words on both
sides, twice the words of the longest template, so that a notice lies in a
window whole, however its lines are wrapped and whatever comment prefix they
carry.  Windows overlap by ``reach`` words and are bounded in words, so a long
text is scanned whole, a window at a time.  In a window every place is found
where a template is confirmed by its exact wording differences: the words of
the template that the place lacks must be at most ``MAX_MISSING`` of them (none
of a short one), and the place must save at least ``MIN_REDUCTION`` when it is
compressed with the template as a raw zstandard dictionary.

A block is the lines of such places that share lines, with the cue lines
around them (joined over at most ``GAP`` lines between them).  It is compressed
alone and with each license template found in it; templates are ranked by how
much smaller the block gets.

Documents are judged row by row in one pass, without a shuffle.  Windows that
repeat are searched once for each task (a bounded memory of results).

Null and empty texts have no blocks; repeated rows give repeated results; a
null doc_id is kept; an empty table gives an empty result.  Only doc_id and
text are read.
"""

from __future__ import annotations

import difflib
import re
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Cues of several words may be broken over lines, with a comment prefix between.
CUES = (r"(?i)licen[sc]|copyright|\(c\) [0-9]{4}|all[^0-9a-z]+rights[^0-9a-z]+reserved|public[^0-9a-z]+domain|spdx"
        r"|warrant(y|ies)|redistribut")
WORD = re.compile(r"\S+")
EDGES = string.punctuation + "\u201c\u201d\u2018\u2019\u00ab\u00bb"
GAP = 2
LEVEL = 3
MIN_REDUCTION, MAX_MISSING = 0.2, 0.1
#: A block three times as long as the template has more to save elsewhere.
MIN_CANDIDATE = 0.1

# Short notices of public licenses, by name.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-text": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS "
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-text": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "LGPL-text": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT "
        "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    "AGPL-text": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."),
    "MIT-disclaimer": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."),
    "BSD-disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED."),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0.",
    "All-rights-reserved": "All rights reserved.",
}


def wording(text: str) -> list[str]:
    return [w for w in (x.strip(EDGES).lower() for x in text.split()) if w]


def blocks(text: str) -> list[tuple[int, int, str]]:
    """(first line, last line, text) of each run of cue lines."""
    lines = text.split("\n")
    cues = [i for i, line in enumerate(lines) if re.search(CUES, line)]
    out = []
    for i in cues:
        if out and i - out[-1][1] <= GAP + 1:
            out[-1][1] = i
        else:
            out.append([i, i])
    return [(a, b, "\n".join(lines[a:b + 1])) for a, b in out]


def backward(text: str, at: int, floor: int, n: int) -> int:
    """Where the ``n`` words before ``at`` begin, not before ``floor``."""
    step, low = 16 * n, at
    while low > floor:
        low = max(floor, low - step)
        starts = [m.start() for m in WORD.finditer(text, low, at)]
        if len(starts) > n:  # the first one may be a part of a word
            return starts[-n]
        step *= 2
    return floor


def forward(text: str, at: int, n: int) -> int:
    end = at
    for k, m in enumerate(WORD.finditer(text, at)):
        if k > n:  # the first one may be a part of a word
            break
        end = m.end()
    return end


def regions(text: str, reach: int) -> Iterator[tuple[int, int]]:
    """Stretches of the text that reach ``reach`` words to both sides of the cues in them."""
    begin = end = last = None
    for m in re.finditer(CUES, text):
        if begin is None:
            begin = backward(text, m.start(), 0, reach)
        elif m.start() - last > 2 * reach:  # nearer cues are surely within reach
            end = forward(text, last, reach)
            start = backward(text, m.start(), last, reach)
            if start > end:
                yield begin, end
                begin = start
        last = m.end()
    if begin is not None:
        yield begin, forward(text, last, reach)


def windows(text: str, reach: int) -> Iterator[list[tuple[str, int, int]]]:
    """(word, begin, end) in windows of 3 * ``reach`` words that overlap by ``reach``."""
    for begin, end in regions(text, reach):
        held, new = [], False
        for m in WORD.finditer(text, begin, end):
            if w := m.group().strip(EDGES).lower():
                held.append((w, m.start(), m.end()))
                new = True
                if len(held) == 3 * reach:
                    yield held
                    held, new = held[-reach:], False
        if new:
            yield held


def lacking(part: list[str], template: Counter) -> int:
    """At least so many words of the template are not in ``part``."""
    have = Counter(w for w in part if w in template)
    return sum(n - min(n, have[w]) for w, n in template.items())


def place_in(words: list[str], template: list[str], low: int, high: int) -> set[tuple[int, int, int, int]]:
    """(words missing, further words amid, first, last) of the places of the template in words[low:high]."""
    n, bag, found = len(template), Counter(template), set()

    def search(low: int, high: int) -> None:
        part = words[low:high]
        if lacking(part, bag) > MAX_MISSING * n:
            return
        same = [m for m in difflib.SequenceMatcher(None, part, template, False).get_matching_blocks() if m.size]
        best = None
        for i in range(len(same)):  # words that happen to match far off do not belong to the place
            size = 0
            for m in same[i:]:
                size += m.size
                extra = m.a + m.size - same[i].a - size
                if n - size <= MAX_MISSING * n and extra <= n:
                    here = (n - size, extra, low + same[i].a, low + m.a + m.size - 1)
                    best = min(best or here, here)
        if best:
            found.add(best)
            search(low, best[2])
            search(best[3] + 1, high)

    search(low, high)
    return found


@lru_cache(1 << 10)
def cue_word(template: str) -> str:
    """The word in which the first cue of a template's wording ends (or its longest word)."""
    cue = re.search(CUES, template)
    if not cue:
        return max(template.split(" "), key=len)
    return template[:cue.end()].rsplit(" ", 1)[-1] + template[cue.end():].split(" ", 1)[0]


def parts(words: list[str], template: list[str]) -> Iterator[tuple[int, int]]:
    """Candidate blocks of a window for a template of n words; a place spans at most
    2 n words, so one of them holds it whole.  A short template may lack no word:
    its blocks lie around the window's words that equal its cue."""
    n = len(template)
    if not n:
        return
    if MAX_MISSING * n >= 1:
        for begin in range(0, max(1, len(words) - n + 1), n):
            yield begin, begin + max(8, 3 * n)
        return
    cue, end = cue_word(" ".join(template)), -1
    for i, w in enumerate(words):
        if w == cue and i >= end:  # the next block begins where places around this word end
            end = i + max(8, 2 * n)
            yield max(0, i - 2 * n), end + 2 * n


def apart(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Best first, those that overlap none before them."""
    out, firsts, lasts = [], [], []
    for x in found:
        k = bisect_left(firsts, x[2])
        if (k == 0 or lasts[k - 1] < x[2]) and (k == len(firsts) or x[3] < firsts[k]):
            firsts.insert(k, x[2])
            lasts.insert(k, x[3])
            out.append(x)
    return out


class Scanner:
    def __init__(self, templates: dict[str, str]):
        self.words = {k: wording(t) for k, t in templates.items()}
        self.reach = 2 * max(map(len, self.words.values()), default=1)
        self.plain = self.compressor()
        self.given = {k: self.compressor(self.dictionary(t)) for k, t in templates.items()}
        self.given_words = {k: self.compressor(self.dictionary(" ".join(w))) for k, w in self.words.items()}
        self.search = lru_cache(1 << 12)(self._search)

    @staticmethod
    def dictionary(text: str) -> zstandard.ZstdCompressionDict:
        return zstandard.ZstdCompressionDict(text.encode(), zstandard.DICT_TYPE_RAWCONTENT)

    @staticmethod
    def compressor(given: zstandard.ZstdCompressionDict | None = None) -> zstandard.ZstdCompressor:
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=given, write_content_size=False, write_dict_id=False)

    def saved(self, block: str, name: str) -> float:
        """By how much the template makes the block smaller, as a share of the smaller of the two."""
        raw = block.encode("utf-8", "replace")
        alone = len(self.plain.compress(raw))
        return (alone - len(self.given_words[name].compress(raw))) / min(alone, len(" ".join(self.words[name])))

    def candidates(self, words: list[str]) -> list[tuple[float, str, int, int]]:
        """(share saved, license, low, high) of the blocks that a template makes smaller, best first."""
        found = [(self.saved(" ".join(words[a:b]), name), name, a, b)
                 for name, template in self.words.items() for a, b in parts(words, template)]
        return sorted((x for x in found if x[0] >= MIN_CANDIDATE), key=lambda x: (-x[0], *x[1:]))

    def _search(self, text: str) -> list[tuple[str, int, int, int, int]]:
        """(license, words missing, further words, first, last) of each place in a window of
        words: proposed and ranked by compression, confirmed by wording."""
        words, found = text.split(" "), {}
        for _, name, low, high in self.candidates(words):
            found.setdefault(name, set()).update(place_in(words, self.words[name], low, high))
        # A place is held against the template's length: it may have further words amid.
        return [(name, *x) for name, all_ in found.items() for x in apart(sorted(all_))
                if self.saved(" ".join(words[x[2]:x[3] + 1]), name) >= MIN_REDUCTION]

    def find(self, text: str) -> list[tuple[str, int, int, int, int]]:
        """(license, words missing, further words, begin, end) of each place in the text."""
        found = {}
        for window in windows(text, self.reach):
            for name, missing, extra, first, last in self.search(" ".join(w for w, _, _ in window)):
                found.setdefault(name, set()).add((missing, extra, window[first][1], window[last][2] - 1))
        return [(name, *x) for name, all_ in found.items() for x in apart(sorted(all_))]

    def blocks(self, text: str) -> list[tuple[int, int, str, list[tuple[str, float, int, int]]]]:
        """(first line, last line, block, its licenses): (license, share saved, words missing, further words), best first."""
        found = self.find(text)
        if not found:
            return []
        ends = [m.start() for m in re.finditer("\n", text)]
        spans = [(bisect_left(ends, begin), bisect_left(ends, end), (name, missing, extra))
                 for name, missing, extra, begin, end in found]
        merged = []
        for a, b, hit in sorted(spans + [(a, b, None) for a, b, _ in blocks(text)], key=lambda x: x[:2]):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b, {}])
            if hit:
                hits = merged[-1][2]
                hits[hit[0]] = min(hits.get(hit[0], hit[1:]), hit[1:])
        out = []
        for a, b, hits in merged:
            if hits:
                block = text[ends[a - 1] + 1 if a else 0:ends[b] if b < len(ends) else len(text)]
                raw = block.encode("utf-8", "replace")
                alone = len(self.plain.compress(raw))
                out.append((a, b, block, sorted(
                    ((name, 1 - len(self.given[name].compress(raw)) / alone, *x) for name, x in hits.items()),
                    key=lambda x: (-x[1], x[0]))))
        return out

    def score(self, block: str) -> list[tuple[str, float, int, int]]:
        """(license, share saved, words missing, further words), best first in each block, confirmed ones only."""
        return [x for _, _, _, hits in self.blocks(block) for x in hits]


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per document, block and confirmed license: doc_id, first_line,
    last_line, license, rank, reduction, n_missing, n_extra, block."""
    key = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "first_line", "last_line", "license", "rank", "reduction", "n_missing", "n_extra", "block"]
    types = [None, pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.string()]

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = None
        for rb in it:
            scanner = scanner or Scanner(templates or TEMPLATES)
            rows = [(i, a, b, name, rank, share, missing, extra, block)
                    for i, text in enumerate(rb.column(1).to_pylist())
                    for a, b, block, hits in scanner.blocks(text)
                    for rank, (name, share, missing, extra) in enumerate(hits, 1)]
            cols = list(zip(*rows)) or [()] * 9
            out = [rb.column(0).take(pa.array(cols[0], pa.int64()))]
            yield pa.RecordBatch.from_arrays(out + [pa.array(c, t) for c, t in zip(cols[1:], types[1:])], names)

    text = F.col("text").cast("string")
    return docs.where(text.rlike(CUES)).select("doc_id", text.alias("text")).mapInArrow(
        read, f"doc_id {key}, first_line int, last_line int, license string, rank int, reduction double, "
              "n_missing int, n_extra int, block string")
