"""License scan by conditional compression.

Each template is cut into pieces, one more than it may have differences (and slots), so wherever it stands within the limit one
piece stands unchanged: those are the cues, and none is missed. The words around a cue that the template can reach are a block.
A block is compressed on its own and with the template as a raw zstandard dictionary: the more of the template it holds, the
smaller it gets. All candidates of a text, each a block and a template with a cue in it, are tried by falling reduction; none is
left out; where several want some of the same words, their reductions are measured on one block. A candidate is confirmed by the exact differences in wording: the template's words must stand in the block in order, and
what is missing, and what stands in between, is counted. Numbers, years and names in braces in a template are slots that any word
fills. Words are compressed and compared, in lower case, so line ends and marks between them do not matter. Words that one licence
has taken are not read as another; what is left of a block is compressed and tried again.

Null and empty texts and texts without cues give no rows. Rows that repeat are scanned alike. Each place of a
licence gives a row; equal reductions go to the longer template, then the first by name. A very long text is one list of words
in one task, and its blocks are no longer than those of a short one. An empty table gives an empty result.
"""

from __future__ import annotations

import difflib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Notices, opening passages and some whole texts of public licences; words in braces are slots.
TEMPLATES = {
    "Apache-2.0": ("Licensed under the Apache License, Version {2.0}.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
                   "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                   "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
                   "specific language governing permissions and limitations under the License."),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions:",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
            "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
            "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
            "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
            "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
            "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "GPL": ("This work is licensed under the GNU General Public License, version {3}.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version {3} of the License, or (at your option) any later "
            "version."),
    "LGPL": ("Licensed under the GNU Lesser General Public License, version {3}.",
             "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
             "Public License as published by the Free Software Foundation; either version {2.1} of the License, or (at your option) "
             "any later version."),
    "AGPL": ("Licensed under the GNU Affero General Public License, version {3}.",),
    "MPL": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. {2.0}.",),
    "BSD": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met:", "Licensed under the BSD {3}-Clause License.",
            "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
            "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
            "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
            "distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
            "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE "
            "ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
            "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
            "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
            "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
            "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
            "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
            "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
            "distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
            "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE "
            "ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
            "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
            "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
            "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
            "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS "
            "IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
            "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
            "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
            "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "CC-BY": ("Licensed under CC BY {4.0}.", "This work is licensed under a Creative Commons Attribution {4.0} International License."),
    "CC-BY-SA": ("Licensed under CC BY-SA {4.0}.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike {4.0} International License."),
    "CC-BY-NC": ("Licensed under CC BY-NC {4.0}.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial {4.0} International License."),
    "CC-BY-ND": ("Licensed under CC BY-ND {4.0}.",
                 "This work is licensed under a Creative Commons Attribution-NoDerivatives {4.0} International License."),
    "CC0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
            "Dedicated to the public domain under CC0 {1.0}."),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "Proprietary": ("All rights reserved. No part of this publication may be reproduced without permission.",),
}

#: Differences allowed, as a part of the template's words.
MAX_DIFFERENCE = 0.15
#: Words in a cell of the index that finds candidates for the same words.
CELL = 128

# A word with a hyphen can be broken behind it, with comment marks before the next line.
_WORD = re.compile(r"[^\W_]+(?:(?:[.'’]|-(?:[ \t]*\r?\n[^\w\n]*)?)[^\W_]+)*")


def _words(text: str) -> list[str]:
    return [re.sub(r"-\W+", "-", w).lower() if "\n" in w else w.lower() for w in _WORD.findall(text)]


@lru_cache(maxsize=1)
def _templates() -> list[tuple[str, list[str], list[bool], zstandard.ZstdCompressor]]:
    out = []
    for name, texts in TEMPLATES.items():
        for text in texts:
            plain = text.replace("{", "").replace("}", "")
            slots = {m.group(1).lower() for m in re.finditer(r"\{([^}]*)\}", text)}
            words = _words(plain)
            dictionary = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            out.append((name, words, [w in slots for w in words], zstandard.ZstdCompressor(level=3, dict_data=dictionary)))
    return out


def _pieces(words: list[str], slots: list[bool]) -> list[tuple[int, int]]:
    """[low, high) of stretches without slots, one more than differences and slots can break."""
    ends = [-1, *(i for i, slot in enumerate(slots) if slot), len(words)]
    runs = [[a + 1, b, 1] for a, b in zip(ends[:-1], ends[1:], strict=True) if b > a + 1]
    for _ in range(_drift(words, slots) + 1 - len(runs)):
        longest = max(runs, key=lambda r: (r[1] - r[0]) / r[2])
        longest[2] += 1
    return [(a + (b - a) * i // n, a + (b - a) * (i + 1) // n) for a, b, n in runs for i in range(n)]


def _drift(words: list[str], slots: list[bool]) -> int:
    """Words by which a piece can lie off its place in the template."""
    return int(MAX_DIFFERENCE * len(words)) + sum(slots)


@lru_cache(maxsize=1)
def _cues() -> tuple[dict[str, list[tuple[list[str], int, int]]], list[str]]:
    """(pieces (words, template, place in it) by first word, words of which any text with a piece holds one)."""
    pieces: dict[str, list[tuple[list[str], int, int]]] = {}
    anchors: set[str] = set()
    for t, (_, words, slots, _) in enumerate(_templates()):
        for low, high in _pieces(words, slots):
            pieces.setdefault(words[low], []).append((words[low:high], t, low))
            if not anchors.intersection(words[low:high]):
                anchors.add(max(words[low:high], key=len))
    return pieces, sorted(anchors)


def candidate_blocks(words: list[str]) -> list[tuple[int, int, int]]:
    """(template, first word, end) of the stretches in which a template can stand; cues of one place share a stretch."""
    pieces, _ = _cues()
    starts: dict[int, set[int]] = {}
    for i, word in enumerate(words):
        for piece, t, low in pieces.get(word, ()):
            if words[i: i + len(piece)] == piece:
                starts.setdefault(t, set()).add(i - low)
    out = []
    for t, places in starts.items():
        _, template, slots, _ = _templates()[t]
        drift, group = _drift(template, slots), []
        for place in [*sorted(places), None]:
            if group and (place is None or place - group[0] > drift):
                out.append((t, max(0, group[0] - drift), min(len(words), group[-1] + len(template) + drift)))
                group = []
            group.append(place)
    return out


def compare(block: list[str], template: list[str], slots: list[bool]) -> tuple[int, int, int]:
    """(differences, first word, end) of the block's stretch that fits the template best."""
    matcher = difflib.SequenceMatcher(None, block, template, autojunk=False)
    runs = [m for m in matcher.get_matching_blocks() if m.size]
    if not runs:
        return len(template), 0, 0
    # The longest run fixes where the template lies; runs that would lie far from it belong to other text.
    main = max(runs, key=lambda m: m.size)
    runs = [m for m in runs if abs((m.a - m.b) - (main.a - main.b)) <= max(3, len(template) // 4)]
    first, end = runs[0].a, runs[-1].a + runs[-1].size
    matched = {m.b + i for m in runs for i in range(m.size)}
    missing = [i for i in range(len(template)) if i not in matched]
    free = sum(slots[i] for i in missing)
    extra = (end - first) - len(matched)
    if missing and missing[-1] == len(template) - 1 and slots[-1] and end < len(block):
        end += 1  # the last word is a slot
        extra += 1
    return len(missing) - free + max(0, extra - free), first, end


def scan(text: str | None) -> list[tuple[str, int, int, int, bool]]:
    """(licence, place of its block, bytes its block gets smaller by, differences, exact) of each licence confirmed in a text."""
    lowered = (text or "").lower()
    if not any(word in lowered for word in _cues()[1]):
        return []
    words = _words(text)
    blocks = candidate_blocks(words)
    if not blocks:
        return []
    plain = zstandard.ZstdCompressor(level=3)
    waiting: list[tuple] = []
    near: dict[int, set[tuple]] = {}
    taken = bytearray(len(words))

    def add(t: int, low: int, high: int) -> None:
        name, template, slots, compressor = _templates()[t]
        if len(template) - (high - low) - sum(slots) > MAX_DIFFERENCE * len(template):
            return  # too short to be confirmed
        data = " ".join(words[low:high]).encode()
        saved = len(plain.compress(data)) - len(compressor.compress(data))
        entry = (-saved, -len(template), name, low, high, t)
        heapq.heappush(waiting, entry)
        for cell in range(low // CELL, (high - 1) // CELL + 1):
            near.setdefault(cell, set()).add(entry)

    def drop(entry: tuple) -> None:
        for cell in range(entry[3] // CELL, (entry[4] - 1) // CELL + 1):
            near[cell].discard(entry)

    def rivals(low: int, high: int) -> list[tuple[int, tuple]]:
        """(reduction, candidate) of those that want some of the same words, all measured on the block of them together."""
        some = {e for cell in range(low // CELL, (high - 1) // CELL + 1) for e in near[cell] if e[3] < high and low < e[4]}
        some = [e for e in some if not any(taken[e[3]: e[4]])]
        data = " ".join(words[min(e[3] for e in some): max(e[4] for e in some)]).encode()
        size = len(plain.compress(data))
        found = [(size - len(_templates()[e[5]][3].compress(data)), e) for e in some]
        return sorted(found, key=lambda f: (-f[0], f[1][1:]))

    for block in blocks:
        add(*block)
    spans: list[tuple[int, int]] = []
    out = []
    while waiting:  # the largest reduction first
        entry = heapq.heappop(waiting)
        _, _, _, low, high, t = entry
        if entry not in near[low // CELL]:
            continue
        free = [(low + m.start(), low + m.end()) for m in re.finditer(rb"\0+", bytes(taken[low:high]))]
        if free != [(low, high)]:
            drop(entry)
            for part in free:
                add(t, *part)
            continue
        for saved, tried in rivals(low, high):
            _, _, name, begin, stop, t = tried
            _, template, slots, _ = _templates()[t]
            drop(tried)
            differences, first, end = compare(words[begin:stop], template, slots)
            if differences <= MAX_DIFFERENCE * len(template):
                taken[begin + first: begin + end] = b"\1" * (end - first)
                spans = spans or [m.span() for m in _WORD.finditer(text)]
                out.append((begin + first, (name, spans[begin][0], saved, differences, differences == 0)))
                add(t, begin, begin + first)
                add(t, begin + end, stop)
                break
        if entry in near[low // CELL]:
            heapq.heappush(waiting, entry)
    return [row for _, row in sorted(out)]


def found_licenses(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per licence found: doc_id, license, block_start, bytes_saved, n_differences, exact wording."""
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).where("text is not null")
    kind = base.schema["doc_id"].dataType.simpleString()

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, *r) for i, t in enumerate(batch.column(1).to_pylist()) for r in scan(t)]
            ids = batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([r[1] for r in rows], pa.string()), *(pa.array([r[i] for r in rows], pa.int64()) for i in (2, 3, 4)),
                 pa.array([r[5] for r in rows], pa.bool_())],
                names=["doc_id", "license", "block_start", "bytes_saved", "n_differences", "exact"])

    return base.mapInArrow(over, f"doc_id {kind}, license string, block_start bigint, bytes_saved bigint, n_differences bigint, "
                                 "exact boolean")
