"""Licence scans: Dice coefficients over word bigrams, with size bounds.

Texts and templates are normalised to lower-case words of letters and digits. Any run of a text's words, over lines and
paragraphs, is a unit; its set of word bigrams matches a template's at ``2 * shared / (size of unit + size of
template) >= threshold``. The best unit of each template is found without looking at every run:

* a match needs ``shared >= threshold / (2 - threshold) * size of template``, so a template is a candidate only if the
  text has so many of its bigrams, by an inverted index of bigrams; a unit is at most ``(2 - threshold) / threshold``
  times its template's size;
* a best unit begins and ends with a bigram of the template, and its first bigram doesn't come again in it: anything
  else may be cut off without loss. So each place of a template's bigram is tried as a beginning, up to the size bound
  or the bigram's next place.

Of matches that overlap in a text only the best stays (ties: the longer template, then the licence's name): a licence
that contains another's words isn't reported as both. A row's ``license`` is that of its best match, ``licenses`` lists
all, and ``spans`` says where they are, in code points.

Defined cases: a null or empty text matches nothing; a null id passes through; repeated rows each get their own
result; without templates nothing matches; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import picked, rowwise

THRESHOLD = 0.8
_WORD = re.compile(r"[^\W_]+")

#: Notices by which texts state a licence, and short licences in full, as their authors publish them.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."),
    ("WTFPL", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed. DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION 0. You just DO WHAT THE FUCK YOU WANT TO."),
)


def normal(text: str) -> str:
    """Lower case, each character at its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


def words_of(text: str) -> list[str]:
    return _WORD.findall(normal(text))


def bigrams(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:]))


class Templates:
    """Templates as an inverted index from bigrams."""

    def __init__(self, templates=TEMPLATES, threshold: float = THRESHOLD):
        self.threshold, self.ratio = threshold, threshold / (2 - threshold)
        sets = [(name, s) for name, text in templates if (s := bigrams(words_of(text)))]
        self.names, self.sizes = [n for n, _ in sets], np.array([len(s) for _, s in sets], np.int64)
        self.words = {w: k for k, w in enumerate(sorted({w for _, s in sets for pair in s for w in pair}), 1)}
        pairs = sorted({p for _, s in sets for p in s})
        number = {p: k for k, p in enumerate(pairs)}
        self.width = len(self.words) + 1
        self.codes = np.array([self.words[a] * self.width + self.words[b] for a, b in pairs], np.int64)
        order = np.argsort(self.codes)
        self.codes, place = self.codes[order], np.empty(len(pairs), np.int64)
        place[order] = np.arange(len(pairs))
        self.holds = np.zeros((len(pairs), len(sets)), np.int64)
        for t, (_, s) in enumerate(sets):
            self.holds[place[[number[p] for p in s]], t] = 1
        # with fewer shared bigrams no unit matches
        self.need = np.array([math.ceil(self.ratio * n - 1e-9) for n in self.sizes], np.int64)

    def matches(self, words: list[str]) -> list[tuple[float, int, int, int]]:
        """(coefficient, template, first word, end) of the matches, none overlapping a better one."""
        if len(words) < 2 or not len(self.codes):
            return []
        get = self.words.get
        w = np.fromiter((get(x, 0) for x in words), np.int64, len(words))
        code = w[:-1] * self.width + w[1:]
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        hits = np.flatnonzero(self.codes[at] == code)
        if len(hits) < self.need.min():
            return []
        kind = at[hits]
        candidates = np.flatnonzero(self.holds[np.unique(kind)].sum(0) >= self.need)
        if not len(candidates):
            return []
        numbers: dict[tuple[str, str], int] = {}
        all_pairs = [numbers.setdefault(p, len(numbers)) for p in zip(words, words[1:])]
        found = [m for t in candidates.tolist() for m in self._of(t, hits[self.holds[kind, t] == 1].tolist(), all_pairs)]
        return self._apart(found)

    def _of(self, t: int, hits: list[int], pairs: list[int]) -> list[tuple[float, int, int, int]]:
        """For each beginning the best unit of a template, if it matches."""
        size, out = int(self.sizes[t]), []
        most = math.floor(size / self.ratio + 1e-9)
        own = set(hits)
        for start in hits:
            seen: set[int] = set()
            shared, best, end = 0, 0.0, 0
            first = pairs[start]
            for k in range(start, len(pairs)):
                p = pairs[k]
                if k > start and p == first:
                    break
                if p in seen:
                    continue
                seen.add(p)
                if len(seen) > most:
                    break
                if k in own:
                    shared += 1
                    dice = 2 * shared / (len(seen) + size)
                    if dice > best:
                        best, end = dice, k + 2
            if best >= self.threshold:
                out.append((best, t, start, end))
        return out

    def _apart(self, found: list[tuple[float, int, int, int]]) -> list[tuple[float, int, int, int]]:
        out: list[tuple[float, int, int, int]] = []
        taken = np.zeros(max((m[3] for m in found), default=0), bool)
        for m in sorted(found, key=lambda m: (-m[0], -int(self.sizes[m[1]]), self.names[m[1]], m[2])):
            if not taken[m[2] : m[3]].any():
                taken[m[2] : m[3]] = True
                out.append(m)
        return out

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(licence, coefficient, start, end) of a text's matches, the best first."""
        found = self.matches(words_of(text))
        if not found:
            return []
        places = [m.span() for m in _WORD.finditer(normal(text))]
        return [(self.names[t], dice, places[s][0], places[e - 1][1]) for dice, t, s, e in found]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each row of ``docs``: id, ``license``, ``dice`` (6 decimals), ``licenses`` and ``spans``."""
    rows = picked(docs, id=id_col, text=text_col)
    schema = T.StructType(
        [
            T.StructField(id_col, rows.schema["id"].dataType),
            T.StructField("license", T.StringType()),
            T.StructField("dice", T.DoubleType()),
            T.StructField("licenses", T.StringType()),
            T.StructField("spans", T.StringType()),
        ]
    )

    def build():
        table = Templates(templates, threshold)

        def step(b):
            found = [table.scan(t or "") for t in b.column(1).to_pylist()]
            return {
                id_col: b.column(0),
                "license": [f[0][0] if f else None for f in found],
                "dice": [round(f[0][1], 6) if f else None for f in found],
                "licenses": [",".join(sorted({x[0] for x in f})) for f in found],
                "spans": [",".join(f"{n}:{s}:{e}" for n, _, s, e in sorted(f, key=lambda x: x[2])) for f in found],
            }

        return step

    return rowwise(rows, schema, build)
