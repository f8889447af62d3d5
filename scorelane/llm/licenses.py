"""License scans by conditional compression.

Windows of text around a licence word are compressed with zstandard alone and with each template as a raw
dictionary. The templates are ranked by the bytes they save, as a share of their own compressed size; all that save
any are confirmed by their exact differences in wording from the window, word by word.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Public licence notices and short licence texts, one wording a line, by SPDX identifier; BSD is the head that
#: its licences share, for texts in which neither set of clauses is found.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software',
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "BSD-2-Clause": (
        "Released under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    "BSD": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",),
    "Unlicense": ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so',
    ),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0",),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "CC-BY-NC-SA-4.0": ("Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    "CC-BY-NC-ND-4.0": ("Licensed under CC BY-NC-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    "CC0-1.0": ("Licensed under CC0 1.0.", "This work is licensed under a Creative Commons CC0 1.0 Universal License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
}
HINT = r"(?i)licen[cs]e|redistribut|permission (?:is|to) |\bspdx|public domain"
#: Share of a template's words that may differ.
TOLERANCE = 0.08
#: Words around a hint that a window takes at least; long templates widen it.
BEFORE, AFTER = 12, 90

_WORD = re.compile(r"[^\W_]+(?:[.'-][^\W_]+)*")
#: Words that tell licences apart: they must agree exactly.
_TELLING = re.compile(r"^(?:\d[\d.]*|v|nc|sa|nd|by|by-.*|affero|lesser|apache|mit|gnu|bsd|mozilla|creative|commons|.*commercial|.*sharealike|.*noderivatives|\d-clause)$")
#: Of these, words that a stretch may not add to a template.
_FOREIGN = re.compile(r"^(?:nc|sa|nd|by-.*|affero|lesser|apache|mit|bsd|mozilla|eclipse|boost|.*noncommercial|.*sharealike|.*noderivatives|\d-clause)$")


class Matcher:
    def __init__(self, templates=None):
        self.items = []
        plain = zstandard.ZstdCompressor(level=3)
        self.plain = lambda b: len(plain.compress(b))
        for name, wordings in (templates or TEMPLATES).items():
            for wording in wordings:
                data = zstandard.ZstdCompressionDict(wording.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                packer = zstandard.ZstdCompressor(level=3, dict_data=data)
                words = [w.lower() for w in _WORD.findall(wording)]
                self.items.append((name, words, packer, self.plain(wording.lower().encode()), Counter(words)))
        self.hint = re.compile(HINT)
        self.before, self.after = BEFORE, AFTER
        for wordings in (templates or TEMPLATES).values():
            for wording in wordings:
                ends = [m.end() for m in _WORD.finditer(wording)]
                spare = math.ceil(TOLERANCE * len(ends))
                hint = self.hint.search(wording)
                ahead = sum(end <= hint.start() for end in ends) if hint else 0
                self.before = max(self.before, ahead + spare)
                self.after = max(self.after, len(ends) - ahead + spare)

    def windows(self, text: str):
        """Lists of (word, start, end) that cover the surroundings of all hints, each template's length twice at most.

        Surroundings that overlap are one region; windows of it overlap by the longest template, so that each notice lies
        within one of them, and their number depends on the length of the text, not on its hints.
        """
        hints = [m.start() for m in self.hint.finditer(text)]
        if not hints:
            return
        words = [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]
        ends = [w[2] for w in words]
        regions = []
        for at in hints:
            k = bisect_right(ends, at)
            lo, hi = max(0, k - self.before), min(len(words), k + self.after)
            if regions and lo <= regions[-1][1]:
                regions[-1][1] = max(hi, regions[-1][1])
            elif lo < hi:
                regions.append([lo, hi])
        span = self.before + self.after
        for lo, hi in regions:
            for at in range(lo, max(hi - span, lo) + 1, span):
                yield words[at : min(at + 2 * span, hi)]
            if hi - span > lo and (hi - span - lo) % span:
                yield words[max(lo, hi - 2 * span) : hi]

    def closest(self, words: list[str], template: list[str]):
        """(first word, last word, differing words) of the stretch of words that is closest to the template, or None.

        It lies around the longest run that both share; shared words at its ends go if more words between them do not.
        """
        run = SequenceMatcher(None, words, template, autojunk=False).find_longest_match()
        if not run.size:
            return None
        spare = math.ceil(TOLERANCE * len(template)) + 1
        lo, hi = max(0, run.a - run.b - spare), run.a - run.b + len(template) + spare
        blocks = [(m.a + lo, m.size) for m in SequenceMatcher(None, words[lo:hi], template, autojunk=False).get_matching_blocks() if m.size]
        while len(blocks) > 1 and blocks[1][0] - sum(blocks[0]) > blocks[0][1]:
            del blocks[0]
        while len(blocks) > 1 and blocks[-1][0] - sum(blocks[-2]) > blocks[-1][1]:
            del blocks[-1]
        first, last, matched = blocks[0][0], sum(blocks[-1]), sum(size for _, size in blocks)
        return first, last, (len(template) - matched) + (last - first - matched)

    def confirmed(self, words: list[str], template: list[str], many: Counter, at: int = 0):
        """(first word, last word, differing words) of all stretches within the tolerance of the template's wording."""
        most = TOLERANCE * len(template)
        if len(template) - (Counter(words) & many).total() > most:  # even in the best order too many would differ
            return
        found = self.closest(words, template)
        if found is None or found[2] > most:
            return
        first, last, differing = found
        present = set(words[first:last])
        told = all(w in present for w in template if _TELLING.match(w)) and not any(_FOREIGN.match(w) for w in present.difference(template))
        if told:
            yield at + first, at + last, differing
        yield from self.confirmed(words[:first], template, many, at)
        yield from self.confirmed(words[last:], template, many, at + last)

    def find(self, text: str) -> list[tuple[str, int, int, int, int]]:
        """(licence, start, end, differing words, bytes saved) without overlaps, in order of place."""
        found = {}
        for window in self.windows(text):
            block = text[window[0][1] : window[-1][2]].lower().encode("utf-8", "replace")
            alone, words = self.plain(block), [w for w, _, _ in window]
            sizes = [(alone - len(packer.compress(block)), own, name, template, many) for name, template, packer, own, many in self.items]
            for saved, _, name, template, many in sorted(sizes, key=lambda x: (-x[0] / x[1], x[2], len(x[3]))):
                if saved <= 0:
                    break
                for first, last, differing in self.confirmed(words, template, many):
                    key = window[first][1], window[last - 1][2], name, len(template)
                    found[key] = min(found.get(key, (differing, saved)), (differing, saved))
        best = sorted((differing - length, start, name, end, differing, saved) for (start, end, name, length), (differing, saved) in found.items())
        taken: list[tuple] = []  # most words agreed upon first
        for _, start, name, end, differing, saved in best:
            k = bisect_right(taken, (start,))
            if (k == len(taken) or end <= taken[k][0]) and (not k or taken[k - 1][1] <= start):
                taken.insert(k, (start, end, name, differing, saved))
        return [(name, start, end, differing, saved) for start, end, name, differing, saved in taken]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col, n_licenses, licenses (identifiers in order, comma-joined), blocks.

    ``blocks`` is array<struct<license, start, end, differing, saved>>: code points of the wording, end exclusive,
    the words that differ from the template, and the bytes the template saves. Null and empty texts have none.
    Whole texts are scanned; only texts with a licence word leave the JVM. Rows with null or repeated ids are
    scanned like others, columns besides id_col and text_col are not read, and an empty table gives no rows. Of
    overlapping wordings the one with most words agreed stays; ties go to the earlier place, then to the identifier.
    """

    def run(batches):
        matcher = Matcher()
        for batch in batches:
            found = [matcher.find(t) if t else [] for t in batch.column(1).to_pylist()]
            kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("differing", pa.int32()), ("saved", pa.int32())]))
            blocks = [[dict(zip(("license", "start", "end", "differing", "saved"), f, strict=True)) for f in fs] for fs in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, found), pa.int64()), pa.array([",".join(f[0] for f in fs) for fs in found], pa.string()), pa.array(blocks, kind)],
                names=["doc_id", "n_licenses", "licenses", "blocks"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.when(F.col(text_col).rlike(HINT), F.col(text_col)).alias("text"))
    schema = f"doc_id {kind}, n_licenses long, licenses string, blocks array<struct<license:string,start:int,end:int,differing:int,saved:int>>"
    return rows.mapInArrow(run, schema).withColumnRenamed("doc_id", id_col)
