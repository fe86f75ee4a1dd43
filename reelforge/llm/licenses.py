"""License scans by conditional compression.

The whole text is looked through for runs of GRAM words that a template sentence holds; whatever is confirmed below shares such
a run, so nothing is lost by it. Candidate blocks are the words within REACH of one, whatever marks, line
breaks or comment signs stand between them; blocks that overlap or touch are one, and long ones become overlapping windows.
Each block is compressed with zstandard alone and once per template, the template as raw dictionary; templates are
ranked by how many bytes the block shrinks. All are then confirmed by exact wording in this order, so a notice
counts alike however long its block is: the block must hold a sentence of the template word for word ('exact'), or with
a few words replaced, inserted or removed ('near', with the words that differ). Every template with a place of its own
in the block is reported; of places that two templates share, the better ranked one has it.

Defined cases: a null or empty text has no block; very long texts are looked through to their end, in windows of
BLOCK_WORDS words that overlap by OVERLAP, none is left out; equal scores go to the template named first; repeated rows are rows
of their own; an empty table gives no row; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Wording of public licenses and their usual notices, one sentence a string.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "AGPL-3.0": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ),
    "GPL-3.0": (
        "Licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "GPL-2.0": (
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": (
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
    ),
    "LGPL-2.1": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "BSD-2-Clause": (
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    ),
    "Zlib": (
        "Licensed under the zlib License.",
        "This software is provided 'as-is', without any express or implied warranty.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
        "This notice may not be removed or altered from any source distribution.",
    ),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
    ),
    "EPL-2.0": (
        "Licensed under the Eclipse Public License, version 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
    ),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Released under CC0 1.0 Universal."),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "proprietary": ("All rights reserved.", "Unauthorized copying of this file, via any medium is strictly prohibited."),
}

TAG = "spdx-license-identifier"
_ALSO = {k: tuple(f"{k}{end}" for end in ("", "-only", "-or-later")) for k in ("GPL-3.0", "GPL-2.0", "AGPL-3.0", "LGPL-3.0", "LGPL-2.1")} | {"proprietary": ()}
TEMPLATES = {k: (*(f"SPDX-License-Identifier: {x}" for x in _ALSO.get(k, (k,))), *v) for k, v in TEMPLATES.items()}

_WORD = re.compile(r"[A-Za-z0-9]+(?:[.\-/][A-Za-z0-9]+)*")
_MARKS = re.compile(r"[^\w\s]*")
#: Words in a row that a block and a sentence must share; a shorter quoted run is no evidence by itself.
GRAM = LEAST_WORDS = 3
#: Longer than the longest template sentence, so one that shares a run with the text lies in the block wholly, if LEAST_RATIO of it agrees.
REACH = 100
BLOCK_WORDS, OVERLAP = 400, 2 * REACH
LEAST_RATIO = 0.8
#: Sentences of fewer words must keep the words that are their license's alone.
SHORT = 12


def _words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


class Templates:
    """Templates with their compressors; made once per task."""

    def __init__(self, templates: dict[str, tuple[str, ...]] = TEMPLATES, level: int = 9):
        import zstandard

        self.names = list(templates)
        self.sentences = {k: [_words(s) for s in v] for k, v in templates.items()}
        self.counts = {k: [Counter(s) for s in v] for k, v in self.sentences.items()}
        # a short sentence without the words that no other license has names no license
        vocabulary = {k: {w for s in v for w in s} for k, v in self.sentences.items()}
        others = {k: set().union(*(w for o, w in vocabulary.items() if o != k)) for k in self.names}
        self.keys = {k: [frozenset(s) - others[k] if len(s) < SHORT else frozenset() for s in v] for k, v in self.sentences.items()}
        # tags are matched by themselves, whatever follows them
        grams = {tuple(s[i : i + GRAM]) for v in self.sentences.values() for s in v if s[0] != TAG for i in range(len(s) - GRAM + 1)}
        self.codes = {w: k + 1 for k, w in enumerate(sorted({TAG, *(w for g in grams for w in g)}))}
        self.grams = frozenset(tuple(map(self.codes.__getitem__, g)) for g in grams)
        self.plain = zstandard.ZstdCompressor(level=level, write_content_size=False)
        self.with_template = {}
        for k, v in templates.items():
            raw = zstandard.ZstdCompressionDict((" ".join(v)).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.with_template[k] = zstandard.ZstdCompressor(level=level, dict_data=raw, write_content_size=False)

    def candidates(self, text: str) -> list[tuple[int, int]]:
        """(start, end) of blocks: runs of words within REACH words of a run that a template holds, or of an SPDX tag."""
        codes = list(map(self.codes.get, _words(text)))
        tag = self.codes[TAG]
        hits = [i for i, g in enumerate(zip(codes, codes[1:], codes[2:])) if g in self.grams] if len(codes) >= GRAM else []
        if tag in codes:
            hits = sorted({*hits, *(i for i, c in enumerate(codes) if c == tag)})
        if not hits:
            return []
        out: list[list[int]] = []  # first word and end of each block
        for i in hits:
            lo, hi = max(0, i - REACH), min(len(codes), i + GRAM + REACH)
            if out and lo <= out[-1][1]:
                out[-1][1] = hi
            else:
                out.append([lo, hi])
        starts, ends = array("q"), array("q")
        for w in _WORD.finditer(text):
            starts.append(w.start())
            ends.append(w.end())
        return [
            (starts[k], _MARKS.match(text, ends[min(k + BLOCK_WORDS, hi) - 1]).end())
            for lo, hi in out
            for k in range(lo, max(lo + 1, hi - OVERLAP), BLOCK_WORDS - OVERLAP)
        ]

    def ranked(self, block: str) -> list[tuple[float, str]]:
        """(share of the compressed size that the template saves, name) of every template, most bytes saved first."""
        data = block.encode()
        alone = len(self.plain.compress(data))
        return sorted(((1 - len(c.compress(data)) / alone, k) for k, c in self.with_template.items()), key=lambda x: (-x[0], self.names.index(x[1])))

    def wording(self, words: list[str], name: str) -> Iterator[tuple[bool, int, int, int, int, list[int], str]]:
        """(exact, words that agree, words that are missing, first word, end, places of those that agree, words that differ) of each place."""
        held = Counter(words)
        for sentence, counts, keys in zip(self.sentences[name], self.counts[name], self.keys[name], strict=True):
            n = len(sentence)
            if sentence[0] == TAG:
                for first, at in _tagged(words):
                    if words[at] == sentence[1]:
                        yield True, at + 1 - first, 0, first, at + 1, list(range(first, at + 1)), ""
                continue
            # no alignment agrees in more words than both hold
            if n < LEAST_WORDS or sum(min(c, held[w]) for w, c in counts.items()) < LEAST_RATIO * n:
                continue
            matcher, todo = SequenceMatcher(None, sentence, words, autojunk=False), [(0, len(words))]
            while todo:  # align around the longest common run, then look on either side of it
                lo, hi = todo.pop()
                at = matcher.find_longest_match(0, n, lo, hi)
                if at.size < LEAST_WORDS:
                    continue
                first, end = at.b, at.b + at.size
                if at.size == n:
                    yield True, n, 0, first, end, list(range(first, end)), ""
                elif found := _aligned(sentence, words, max(lo, at.b - at.a - 3), min(hi, at.b - at.a + n + 3)):
                    first, end = found[3:5]
                    if keys <= {words[i] for i in found[5]}:
                        yield found
                todo += [(lo, first), (end, hi)]

    def find(self, text: str, blocks: list[tuple[int, int]] | None = None) -> list[tuple[str, int, int, float, str, str]]:
        """(license, start, end, share saved, 'exact' or 'near', differing words) of every license that a block names.

        A place whose agreeing words lie inside a better one is none of its own. Of a license's places in a block the
        best is given, from its first word to its last and the marks that touch it.
        """
        places = []
        for k, (a, b) in enumerate(self.candidates(text) if blocks is None else blocks):
            spots = [w.span() for w in _WORD.finditer(text, a, b)]
            words = [text[x:y].lower() for x, y in spots]
            for rank, (_, name) in enumerate(self.ranked(text[a:b])):
                for exact, same, missing, first, end, agree, diff in self.wording(words, name):
                    places.append(((not exact, -same, missing, k, rank), name, spots[first][0], spots[end - 1][1], [spots[i][0] for i in agree], diff))
        held: dict[int, list[tuple[int, int]]] = {}
        best: dict[tuple[int, str], tuple] = {}
        for key, name, a, b, agree, diff in sorted(places, key=lambda x: x[0]):
            k = key[3]
            if any(x <= agree[0] and agree[-1] < y for i in (k - 1, k, k + 1) for x, y in held.get(i, ())):
                continue
            held.setdefault(k, []).append((a, b))
            best.setdefault((k, name), (name, a, _MARKS.match(text, b).end(), key[0], diff))
        out = []
        for name, a, b, near, diff in best.values():
            quote = text[a:b].encode()
            saved = 1 - len(self.with_template[name].compress(quote)) / len(self.plain.compress(quote))
            out.append((name, a, b, saved, "near" if near else "exact", diff))
        return sorted(out, key=lambda f: (f[1], f[2], f[0]))


def _tagged(words: list[str]) -> Iterator[tuple[int, int]]:
    """(first word to quote, place) of each identifier in the expressions after SPDX tags."""
    for i, w in enumerate(words):
        if w == TAG and i + 1 < len(words):
            yield i, i + 1
            for j in range(i + 3, len(words), 2):
                if words[j - 1] not in ("or", "and", "with"):
                    break
                yield j, j


def _aligned(sentence: list[str], words: list[str], lo: int, hi: int) -> tuple[bool, int, int, int, int, list[int], str] | None:
    """The place of the sentence in words[lo:hi] if enough words agree."""
    ops = [(op, i1, i2, lo + j1, lo + j2) for op, i1, i2, j1, j2 in SequenceMatcher(None, sentence, words[lo:hi], autojunk=False).get_opcodes()]
    if ops[0][0] == "insert":
        ops = ops[1:]
    if ops[-1][0] == "insert":
        ops = ops[:-1]
    agree = [j for op, _, _, j1, j2 in ops if op == "equal" for j in range(j1, j2)]
    if len(agree) < LEAST_RATIO * len(sentence):
        return None
    # words beyond as many as are replaced at either end are none of the sentence's
    op, i1, i2, j1, j2 = ops[0]
    if op == "replace":
        ops[0] = op, i1, i2, max(j1, j2 - (i2 - i1)), j2
    op, i1, i2, j1, j2 = ops[-1]
    if op == "replace":
        ops[-1] = op, i1, i2, j1, min(j2, j1 + (i2 - i1))
    diff = [f"-{' '.join(sentence[i1:i2])}+{' '.join(words[j1:j2])}" for op, i1, i2, j1, j2 in ops if op != "equal"]
    return False, len(agree), len(sentence) - len(agree), ops[0][3], ops[-1][4], agree, "|".join(diff)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    templates = Templates()
    for batch in batches:
        rows = []
        for text in batch.column(1).to_pylist():
            blocks = templates.candidates(text) if text else []
            found = templates.find(text, blocks) if blocks else []
            rows.append((len(blocks), len(found), ",".join(sorted({f[0] for f in found})), [{"license": k, "start": a, "end": b, "saved": s, "wording": w, "diff": d} for k, a, b, s, w, d in found]))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.string(), _SPANS)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["doc_id", "n_blocks", "n_found", "licenses", "spans"])


_SPANS = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("saved", pa.float64()), ("wording", pa.string()), ("diff", pa.string())]))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_blocks, n_found, licenses (sorted, comma-joined) and spans of every whole text."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return d.mapInArrow(_scan, "doc_id long, n_blocks long, n_found long, licenses string, spans array<struct<license:string,start:long,end:long,saved:double,wording:string,diff:string>>")
