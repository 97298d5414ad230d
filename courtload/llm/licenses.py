"""License scans by conditional compression.

Cue words make candidate blocks with the words on both sides, as many as the longest stretch without a cue in any
template plus the differences allowed (cues that near join), whatever the line ends.  Each block is
compressed with zstandard alone and with each template as a raw-content dictionary; templates are ranked
by how much smaller the block becomes.  Going down the ranking, a template is confirmed by the exact
wording: block and template are aligned word by word, and the differences must stay within TOLERANCE of the
template's words, none of them a number or a word that tells licenses apart; list markers at a line's start
(1., 2), (a)) are no differences.  A number joined to the template's last one by a dot is a longer version.  A
refused place doesn't end the search of its block.  Confirmed spans don't overlap, so a block can hold several licenses.  Blocks much longer than the longest template are taken in overlapping
windows.

Defined cases: null, empty and blank texts and texts without a cue have no findings; repeated rows are rows of
their own; ties in the ranking go to the template with more words, then the first name; an empty table
gives an empty result; other columns are not read, so none can clash.
"""

from __future__ import annotations

import difflib
import functools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtload.llm.common import field_type, ship

LEVEL = 19
#: Least bytes saved by a template to be considered, as a share of its compressed size.
LEAST_GAIN = 0.15
#: Share of a template's words that may differ.
TOLERANCE = 0.1

# Cue words, words that tell licenses apart, and template wordings (public license notices).
CUES = ("licens", "licenc", "copyright", "permission", "warrant", "redistribut", "public domain", "creative commons", "spdx")
TELLING = frozenset("no non not nc nd sa by lesser affero library mit bsd isc apache gnu mozilla gpl lgpl agpl mpl cc "
                    "noncommercial noderivatives sharealike attribution zlib unlicense later only".split())
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version."),
    "LGPL-2.1": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version."),
    "LGPL-3.0": (
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version."),
    "AGPL-3.0": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0."),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."),
    "BSD-2-Clause": (
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "CC0-1.0": ("Licensed under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related "
                "or neighboring rights to this work."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
}

_ASCII_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}
_CUE = re.compile("|".join(re.escape(c).replace(r"\ ", r"\W{1,20}") for c in CUES))
_BREAK = re.compile(r"[.!?](?=\s)|\n")
_WORD = re.compile(r"\w+")
#: A list marker, after comment signs or bullets at most.
_MARKER = re.compile(r"^[^\w\n]*(\d{1,2}|[a-zA-Z]|[ivxIVX]{2,4})[.)\]](?=\s|$)", re.MULTILINE)


def words_at(text: str) -> list[tuple[str, int, int]]:
    return [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


class Templates:
    def __init__(self, templates: dict[str, tuple[str, ...]]) -> None:
        self.known = [(name, text, [w for w, _, _ in words_at(text)]) for name, texts in sorted(templates.items()) for text in texts]
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False)
        self.given = [zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False, dict_data=(
            zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))) for _, text, _ in self.known]
        self.size = [len(self.plain.compress(text.encode())) for _, text, _ in self.known]
        self.longest = max(len(words) for _, _, words in self.known)
        self.reach = max(self._stretch(text) + int(TOLERANCE * len(words)) for _, text, words in self.known)

    @staticmethod
    def _stretch(text: str) -> int:
        """Most words of a template without a cue, before, after or between its cues."""
        return max(len(words_at(part)) for part in _CUE.split(text.lower()))

    def blocks(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(start, end) of the candidate blocks, and of their part from the first to the last cue."""
        low = text.lower() if len(text.lower()) == len(text) else text.translate(_ASCII_LOWER)
        if not any(c.split()[0] in low for c in CUES):
            return
        cues = np.array([m.span() for m in _CUE.finditer(low)], np.int64).reshape(-1, 2)
        if not len(cues):
            return
        span = np.fromiter((x for m in _WORD.finditer(text) for x in m.span()), np.int64).reshape(-1, 2)
        span = span[~np.isin(span[:, 0], [m.start(1) for m in _MARKER.finditer(text)])]
        first = np.searchsorted(span[:, 1], cues[:, 0], "right")
        end = np.searchsorted(span[:, 0], cues[:, 1], "left")
        cut = np.flatnonzero(first[1:] - end[:-1] > self.reach) + 1
        for x, y in zip([0, *cut.tolist()], [*cut.tolist(), len(cues)]):
            a, b = max(int(first[x]) - self.reach, 0), min(int(end[y - 1]) + self.reach, len(span))
            # the core is whole sentences or lines
            before = [m.end() for m in _BREAK.finditer(text, int(span[a, 0]), int(cues[x, 0]))]
            after = _BREAK.search(text, int(cues[y - 1, 1]), int(span[b - 1, 1]))
            yield from self._windows(span[a:b], before[-1] if before else int(span[a, 0]), after.end() if after else int(span[b - 1, 1]))

    def _windows(self, span: np.ndarray, core: int, core_end: int) -> Iterator[tuple[int, int, int, int]]:
        """Long blocks in overlapping windows of words, each template whole in one."""
        step = 2 * self.longest
        if len(span) <= 2 * step:
            yield int(span[0, 0]), int(span[-1, 1]), core, core_end
            return
        for k in range(0, len(span) - step, step):
            a, b = int(span[k, 0]), int(span[min(k + 2 * step, len(span)) - 1, 1])
            yield a, b, a, b

    def ranked(self, block: str) -> list[tuple[float, int]]:
        """(size reduction, template): the bytes a template saves as a share of its own compressed size.

        That share doesn't fall when other text stands in the block.
        """
        data = block.encode()
        alone = len(self.plain.compress(data))
        saved = [alone - len(c.compress(data)) for c in self.given]
        order = sorted(range(len(saved)), key=lambda k: (-saved[k], -len(self.known[k][2]), k))
        return [(share, k) for k in order if (share := saved[k] / self.size[k]) >= LEAST_GAIN]

    def confirm(self, found: list[tuple[str, int, int]], template: int, text: str,
                markers: frozenset[int] | set[int] = frozenset()) -> tuple[int, int, list[str] | None] | None:
        """(first word, end word, differences) of a template in a block's words.

        Differences are None if that place is refused, the result if no other place can hold the template.
        """
        wanted = self.known[template][2]
        have = [w for w, _, _ in found]
        matched = self._matched(wanted, have)
        if not matched:
            return None
        core = max(matched, key=lambda m: m.size)
        allowed = int(TOLERANCE * len(wanted))
        inside = sum(start in markers for _, start, _ in found)
        if core.size * (allowed + 1 + inside) < len(wanted) - allowed:
            return None   # any copy has a longer run of its words
        if (hit := self._differences(wanted, have, matched, found, text, markers)) is not None:
            return hit
        # other copies nearby may have drawn the alignment away: once more, close to the longest run
        low = max(core.b - core.a - allowed - inside, 0)
        high = core.b + len(wanted) - core.a + allowed + inside
        if (low or high < len(have)) and (near := self._matched(wanted, have[low:high])) and (
                hit := self._differences(wanted, have[low:high], near, found[low:high], text, markers, found[high:high + 1])) is not None:
            return low + hit[0], low + hit[1], hit[2]
        return core.b, core.b + core.size, None

    @staticmethod
    def _matched(wanted: list[str], have: list[str]) -> list[difflib.Match]:
        return [m for m in difflib.SequenceMatcher(None, wanted, have, autojunk=False).get_matching_blocks() if m.size]

    @staticmethod
    def _differences(wanted: list[str], have: list[str], matched: list[difflib.Match], found: list[tuple[str, int, int]], text: str,
                     markers: frozenset[int] | set[int], after: Iterable[tuple[str, int, int]] = ()) -> tuple[int, int, list[str]] | None:
        """(first word, end word, differences) of an alignment, None if they are too many or tell licenses apart."""
        # the densest run of matches: start from the longest and take what adds more words than it skips
        core = max(range(len(matched)), key=lambda i: matched[i].size)
        low = high = core
        while low and matched[low - 1].size > matched[low].b - (matched[low - 1].b + matched[low - 1].size):
            low -= 1
        while high + 1 < len(matched) and matched[high + 1].size > matched[high + 1].b - (matched[high].b + matched[high].size):
            high += 1
        first, end = matched[low].b, matched[high].b + matched[high].size
        gone = list(wanted[:matched[low].a]) + list(wanted[matched[high].a + matched[high].size:])
        extra = []
        for x, y in zip(matched[low:high], matched[low + 1:high + 1]):
            gone += wanted[x.a + x.size:y.a]
            extra += [w for w, start, _ in found[x.b + x.size:y.b] if start not in markers]
        if len(gone) + len(extra) > TOLERANCE * len(wanted) or any(w in TELLING or w.isdigit() for w in gone + extra):
            return None
        if wanted[-1].isdigit() and have[end - 1] == wanted[-1] and (follows := [*found, *after][end:end + 1]) and (
                follows[0][0].isdigit() and text[found[end - 1][2]:follows[0][1]] == "."):
            return None   # a longer version number
        return first, end, [f"-{w}" for w in gone] + [f"+{w}" for w in extra]

    def scan(self, text: str) -> list[dict]:
        out = {}
        for a, b, core, core_end in self.blocks(text):
            found, taken = words_at(text[a:b]), []
            markers = {m.start(1) for m in _MARKER.finditer(text[a:b])}
            ranks = self.ranked(text[core:core_end])   # neighbours without a cue may hide what a short template saves
            if (core, core_end) != (a, b):
                ranks += [(g, k) for g, k in self.ranked(text[a:b]) if k not in {j for _, j in ranks}]
            for gain, k in ranks:
                # the same wording may come several times in a block
                free = [found]
                while free:
                    part = free.pop()
                    if not part or (hit := self.confirm(part, k, text[a:b], markers)) is None:
                        continue
                    first, end, differences = hit
                    start, stop = a + part[first][1], a + part[end - 1][2]
                    free += [part[:first], part[end:]]
                    if differences is None or any(start < y and x < stop for x, y in taken):
                        continue
                    taken.append((start, stop))
                    out.setdefault((start, stop), {"license": self.known[k][0], "start": start, "length": stop - start,
                                                   "reduction": gain, "differences": differences, "wording": text[start:stop]})
        return [out[k] for k in sorted(out)]


@functools.lru_cache(1)
def default_templates() -> Templates:
    return Templates(TEMPLATES)


def _scan_batches(batches: Iterable[pa.RecordBatch], templates: dict[str, tuple[str, ...]] | None, schema: pa.Schema,
                  id_name: str) -> Iterator[pa.RecordBatch]:
    known = default_templates() if templates is None else Templates(templates)
    for batch in batches:
        rows = [{id_name: doc, **hit} for doc, text in zip(*(c.to_pylist() for c in batch.columns)) if text for hit in known.scan(text)]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """A row per license found: id, license, start, length (characters), reduction, differences, wording; one narrow pass."""
    from pyspark.sql.pandas.types import to_arrow_schema
    ship(docs.sparkSession)
    schema = T.StructType([T.StructField(id_col, field_type(docs, id_col)), T.StructField("license", T.StringType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("reduction", T.DoubleType()), T.StructField("differences", T.ArrayType(T.StringType())),
                           T.StructField("wording", T.StringType())])
    arrow = to_arrow_schema(schema)
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        lambda it: _scan_batches(it, templates, arrow, id_col), schema)
