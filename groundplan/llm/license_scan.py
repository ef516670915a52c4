"""License scans by conditional compression.

The stretch around a cue word that a template could cover, blank lines or not, is a candidate block. Parts of a block are
compressed alone and once with each template as a zstandard raw dictionary; the share of bytes that a template saves ranks
the templates and rules none out. Exact wording decides: the words of template and block are aligned, every template word
must be there in order but for a few, and the words that tell licenses apart (names, versions) without exception. The
differences are returned. Notices of a template are taken from left to right; cues anywhere in a text are found.

Defined results: null and empty texts have no matches; repeated rows are scanned each for itself; of overlapping
notices of one license the best stands; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import difflib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from groundplan.llm import textscan
from groundplan.llm.frames import key_name, map_arrow, position

CUES = (b"licen", b"copyright", b"permission is hereby", b"redistribut", b"warrant", b"all rights reserved", b"public domain", b"spdx")


@dataclass(frozen=True)
class Template:
    license: str
    name: str
    text: str
    keys: tuple[str, ...]  # words without which it is another license


#: Usual notices of public licenses (fixed wording).
TEMPLATES: tuple[Template, ...] = (
    Template("Apache-2.0", "short", "Licensed under the Apache License, Version 2.0.", ("apache", "2.0")),
    Template(
        "Apache-2.0",
        "notice",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
        ("apache", "2.0"),
    ),
    Template("MIT", "short", "Released under the MIT License.", ("mit",)),
    Template("MIT", "licensed", "Licensed under the MIT License.", ("mit",)),
    Template(
        "MIT",
        "text",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
        ("permission", "sublicense"),
    ),
    Template("GPL-3.0", "short", "This work is licensed under the GNU General Public License, version 3.", ("gnu", "general", "3")),
    Template(
        "GPL-3.0",
        "notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        ("gnu", "general", "3"),
    ),
    Template("CC-BY-NC-4.0", "short", "Licensed under CC BY-NC 4.0.", ("cc", "by-nc", "4.0")),
    Template("CC-BY-NC-4.0", "long", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", ("commons", "attribution-noncommercial", "4.0")),
    Template("CC-BY-4.0", "long", "This work is licensed under a Creative Commons Attribution 4.0 International License.", ("commons", "attribution", "4.0")),
    Template("CC-BY-4.0", "short", "Licensed under CC BY 4.0.", ("cc", "by", "4.0")),
    Template("CC-BY-SA-4.0", "long", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ("commons", "attribution-sharealike", "4.0")),
    Template(
        "BSD-3-Clause",
        "text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        ("neither", "endorse"),
    ),
)
_WORD = re.compile(r"\S+")
_EDGE = "\"'()[]{}<>*,;:.!?#"


def words(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Lower-case words without punctuation at their edges, and where they stand."""
    out, at = [], []
    for m in _WORD.finditer(text):
        w = m[0].strip(_EDGE).lower()
        if w:
            out.append(w)
            at.append(m.span())
    return out, at


class Scanner:
    def __init__(self, templates: tuple[Template, ...] = TEMPLATES, level: int = 6, least_cover: float = 0.85):
        self.templates, self.least_cover = templates, least_cover
        self.words = [words(t.text)[0] for t in templates]
        self.places: list[dict[str, int]] = [{} for _ in templates]  # bits of the places of each word in its template
        for places, want in zip(self.places, self.words, strict=True):
            for i, w in enumerate(want):
                places[w] = places.get(w, 0) | 1 << i
        self.longest = max(len(t.text) for t in templates)
        params = zstandard.ZstdCompressionParameters.from_level(level, write_checksum=0, write_content_size=0, write_dict_id=0)
        self.plain = zstandard.ZstdCompressor(compression_params=params)
        self.given = [
            zstandard.ZstdCompressor(compression_params=params, dict_data=zstandard.ZstdCompressionDict(t.text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            for t in templates
        ]

    def blocks(self, text: bytes, cues: list[int]) -> list[tuple[int, int]]:
        """Byte spans around the cues within a template's reach, blank lines or not, joined where they touch."""
        reach = 2 * self.longest
        out: list[tuple[int, int]] = []
        for c in cues:
            a, b = max(0, c - reach), min(len(text), c + reach)
            while a > 0 and a < c and (text[a] & 0xC0) == 0x80:
                a += 1
            while b < len(text) and (text[b] & 0xC0) == 0x80:
                b += 1
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return out

    def saving(self, block: bytes) -> list[float]:
        """For each template, the share of the block's compressed bytes that it saves as a dictionary."""
        alone = len(self.plain.compress(block))
        return [(alone - len(c.compress(block))) / alone for c in self.given]

    def confirm(self, k: int, have: list[str]) -> Iterator[tuple[float, int, int, list[str]]]:
        """Share of the template's words, first word and end of each match, from left to right, and wording differences."""
        known = set(have)
        if any(key not in known for key in self.templates[k].keys):
            return
        starts = [i for i, w in enumerate(have) if w in self.words[k][:3]] or [0]
        q = 0
        while q < len(starts):
            best = self._at(k, have, starts[q])
            q += 1
            if best is None:
                continue
            end = best[3]
            while q < len(starts) and starts[q] < end:  # a later start within the match may fit it better
                other = self._at(k, have, starts[q])
                if other is not None and other[2] < end and other[0] > best[0]:
                    best = other
                q += 1
            yield best[1:]
            q = bisect.bisect_left(starts, best[3])

    def _at(self, k: int, have: list[str], i: int) -> tuple[float, float, int, int, list[str]] | None:
        """Likeness, cover, first word, end and differences of the match in the words from i on; None if it isn't there."""
        want, places = self.words[k], self.places[k]
        n = len(want)
        part = have[i : i + n + 3 + n // 4]
        mask = (1 << n) - 1
        v, common = mask, []
        for w in part:
            u = v & places.get(w, 0)
            v = ((v + u) | (v - u)) & mask
            common.append(n - v.bit_count())
        if not common or common[-1] / n < self.least_cover:  # no alignment has more words in order
            return None
        likeness = [2 * c / (n + j) for j, c in enumerate(common, 1)]
        # The words behind a notice may belong to the next one: the end that fits best is tried first.
        for upto in dict.fromkeys((likeness.index(max(likeness)) + 1, common.index(common[-1]) + 1, len(part))):
            ops = difflib.SequenceMatcher(None, want, part[:upto], autojunk=False).get_opcodes()
            same = [op for op in ops if op[0] == "equal"]
            if not same:
                continue
            total = sum(op[2] - op[1] for op in same)
            a, b = same[0][3], same[-1][4]
            if total / n >= self.least_cover and all(key in part[a:b] for key in self.templates[k].keys):
                diff = []
                for op, i1, i2, j1, j2 in ops:
                    if op != "equal" and (j1 >= a and j2 <= b or op == "delete"):
                        diff.append(f"-{' '.join(want[i1:i2])} +{' '.join(part[j1:j2])}" if op != "delete" else f"-{' '.join(want[i1:i2])}")
                return 2 * total / (n + b - a), total / n, i + a, i + b, diff
        return None

    def scan(self, text: bytes, cues: list[int]) -> list[tuple]:
        """license, template, start, end (bytes), saving, cover and differences of each confirmed notice."""
        out = []
        for lo, hi in self.blocks(text, cues):
            block = text[lo:hi]
            decoded = block.decode("utf-8", "replace")
            have, at = words(decoded)
            if not have:
                continue
            # The saving only ranks: a short notice within prose saves little, so wording alone decides.
            ranked: dict[int, float] = {}
            for part in self._lines(block, [c - lo for c in cues if lo <= c < hi]):
                for k, s in enumerate(self.saving(part)):
                    ranked[k] = max(s, ranked.get(k, -1.0))
            hits = []
            for k, s in ranked.items():
                for cover, i, j, diff in self.confirm(k, have):
                    start = lo + len(decoded[: at[i][0]].encode())
                    end = lo + len(decoded[: at[j - 1][1]].encode())
                    hits.append((self.templates[k].license, self.templates[k].name, start, end, round(s, 6), round(cover, 6), diff))
            # Of overlapping notices of one license the best stands.
            taken: dict[str, list[tuple[int, int]]] = {}
            for row in sorted(hits, key=lambda r: (-r[5] * (r[3] - r[2]), -r[4], r[2])):
                spans = taken.setdefault(row[0], [])
                p = bisect.bisect_left(spans, (row[3], 0))
                if p == 0 or spans[p - 1][1] <= row[2]:
                    spans.insert(p, (row[2], row[3]))
                    out.append(row)
        return sorted(out, key=lambda r: (r[2], r[0]))

    def _lines(self, block: bytes, cues: list[int]) -> list[bytes]:
        """The whole block, and each line with a cue, cut to a template's reach."""
        parts = {block} if len(block) <= 2 * self.longest else set()
        for c in cues:
            a, b = block.rfind(b"\n", 0, c) + 1, block.find(b"\n", c)
            b = len(block) if b < 0 else b
            parts.add(block[max(a, c - 120) : min(b, c + 200)])
            parts.add(block[max(0, c - self.longest) : c + self.longest])
        return sorted(parts)


def cue_positions(data: np.ndarray) -> np.ndarray:
    """Sorted byte positions of the cues, in any case."""
    low = data.tobytes().lower()
    out = []
    for cue in CUES:
        at = low.find(cue)
        while at >= 0:
            out.append(at)
            at = low.find(cue, at + 1)
    return np.array(sorted(set(out)), np.int64)


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row for each notice: key (as key_name says), license, template, start, end (bytes of the text), saving, cover, differences."""
    kind = docs.schema.fields[position(docs, key)].dataType.simpleString()
    results = ("license", "template", "start", "end", "saving", "cover", "differences")
    name = key_name(key, results)
    chosen = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in it:
            ids: list[int] = []
            rows: list[tuple] = []
            for s in textscan.slices(batch.column("t")):
                at = cue_positions(s.data)
                firsts = np.searchsorted(at, s.offs)
                for d in np.flatnonzero(np.diff(firsts)):
                    cues = (at[firsts[d] : firsts[d + 1]] - s.offs[d]).tolist()
                    found = scanner.scan(s.data[s.offs[d] : s.offs[d + 1]].tobytes(), cues)
                    ids += [s.lo + int(d)] * len(found)
                    rows += found
            if rows:
                cols = list(zip(*rows, strict=True))
                types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k").take(pa.array(ids)), *[pa.array(list(c), t) for c, t in zip(cols, types, strict=True)]],
                    names=[name, *results],
                )

    return map_arrow(chosen, run, f"`{name}` {kind}, license string, template string, start long, end long, saving double, cover double, differences array<string>")


def op5_license_scan(spark, sf_dir: str) -> DataFrame:
    """All license notices of all documents."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
