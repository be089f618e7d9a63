"""License texts found by patience alignment.

A template is aligned with a stretch of text: words that occur once in both are anchors, the
longest increasing run of anchors stands, and the gaps between them are aligned the same
way until nothing is left to anchor; gaps also match from both their ends. The share of
template words aligned is the template's coverage.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow import extended, fresh, slices, text_bytes, without
from millrace.llm.words import PLAIN, Taken, numbers_by_text, text_numbers

_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
    "DAMAGE."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_ADVERTISING = (
    "3. All advertising materials mentioning features or use of this software must display the following "
    "acknowledgement: This product includes software developed by the copyright holder. "
)


def _gnu(license: str, version: str, last: str) -> str:
    """The notice that the GNU licenses ask to be put into each file."""
    what = "library" if version == "2.1" else "program"
    return (
        f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU "
        f"{license} as published by the Free Software Foundation, either version {version} of the License, or (at "
        f"your option) any later version. This {what} is distributed in the hope that it will be useful, but WITHOUT "
        "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        f"See the GNU {license} for more details. You should have received a copy of the GNU {license} along with "
        f"this {what}. {last}"
    )


_WRITE = "If not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA"
_SEE = "If not, see https://www.gnu.org/licenses/"

#: Whole notices and texts of public licenses.
TEMPLATES = {
    "AGPL-3.0-notice": _gnu("Affero General Public License", "3", _SEE),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License."
    ),
    "BSD-2-Clause": _BSD_2 + _AS_IS,
    "BSD-3-Clause": f"{_BSD_2}3. {_NAMES}{_AS_IS}",
    "BSD-4-Clause": f"{_BSD_2}{_ADVERTISING}4. {_NAMES}{_AS_IS}",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "GPL-2.0-notice": _gnu("General Public License", "2", _WRITE),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-notice": _gnu("General Public License", "3", _SEE),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        'notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL '
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
        "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."
    ),
    "LGPL-2.1-notice": _gnu("Lesser General Public License", "2.1", _WRITE),
    "LGPL-3.0-notice": _gnu("Lesser General Public License", "3", _SEE),
    "MIT": "Released under the MIT License",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        'and associated documentation files (the "Software"), to deal in the Software without '
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
        "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"
    ),
}

#: Runs of words without which a text of more than ``SHORT`` words is another license.
REQUIRED = {
    "AGPL-3.0-notice": ("the GNU Affero General Public License", "version 3 of the License"),
    "Apache-2.0-notice": ("the Apache License, Version 2.0",),
    "BSD-3-Clause": ("endorse or promote",),
    "BSD-4-Clause": ("endorse or promote", "advertising materials"),
    "GPL-2.0-notice": ("the GNU General Public License", "version 2 of the License"),
    "GPL-3.0-notice": ("the GNU General Public License", "version 3 of the License"),
    "ISC": ("with or without fee",),
    "LGPL-2.1-notice": ("the GNU Lesser General Public License", "version 2.1 of the License"),
    "LGPL-3.0-notice": ("the GNU Lesser General Public License", "version 3 of the License"),
    "MIT-text": ("free of charge", "sublicense"),
    "MPL-2.0": ("the Mozilla Public License, v. 2.0",),
}
#: Words of conditions that the license does not have and a longer one does.
FOREIGN = {
    "BSD-2-Clause": ("endorse", "advertising"),
    "BSD-3-Clause": ("advertising",),
    "GPL-2.0-notice": ("affero", "lesser"),
    "GPL-3.0-notice": ("affero", "lesser"),
}
#: A notice of so many words names its license by each of them and has to stand word for word.
SHORT = 12


def aligned(left: list, right: list) -> list[tuple[int, int]]:
    """Pairs of equal places of two sequences, ascending in both, by patience alignment."""
    out: list[tuple[int, int]] = []
    work = [(0, len(left), 0, len(right))]
    while work:
        a, b, c, d = work.pop()
        while a < b and c < d and left[a] == right[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and left[b - 1] == right[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        anchors = _longest_rising(_unique_pairs(left, a, b, right, c, d))
        for x, y in anchors:
            out.append((x, y))
            work.append((a, x, c, y))
            a, c = x + 1, y + 1
        if anchors:
            work.append((a, b, c, d))
    return sorted(out)


def _unique_pairs(left, a: int, b: int, right, c: int, d: int) -> list[tuple[int, int]]:
    """Places of words that occur once in both stretches, in order of the left one."""
    in_left, in_right = Counter(left[a:b]), Counter(right[c:d])
    at = {right[k]: k for k in range(c, d) if in_right[right[k]] == 1}
    return [(k, at[left[k]]) for k in range(a, b) if in_left[left[k]] == 1 and left[k] in at]


def _longest_rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest subsequence with rising right places, by piles of patience sorting."""
    tops: list[int] = []
    last: list[int] = []
    back: list[int] = []
    for k, (_, y) in enumerate(pairs):
        pile = bisect_left(tops, y)
        back.append(last[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(y)
            last.append(k)
        else:
            tops[pile], last[pile] = y, k
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[int, ...]
    counts: Counter
    required: tuple[tuple[int, ...], ...] = ()
    foreign: tuple[tuple[int, ...], ...] = ()


def _numbered(text: str) -> tuple[int, ...]:
    return tuple(text_numbers([text.encode().translate(PLAIN)])[0].tolist())


def templates_of(texts: dict[str, str]) -> list[Template]:
    """Templates as numbers of their words; a template without words is left out.

    ``REQUIRED`` and ``FOREIGN`` are those of the fixed templates; another text has none.
    """
    out = []
    for name, text in texts.items():
        if words := _numbered(text):
            known = TEMPLATES.get(name) == text
            runs = [tuple(map(_numbered, k.get(name, ()) if known else ())) for k in (REQUIRED, FOREIGN)]
            out.append(Template(name, words, Counter(words), *runs))
    return out


def _has_run(words: list[int], run: tuple[int, ...]) -> bool:
    return any(tuple(words[k : k + len(run)]) == run for k in range(len(words) - len(run) + 1))


def _aligned_from(words: list[int], begin: int, template: Template) -> list[tuple[int, int]]:
    """Pairs of a stretch from ``begin`` on, which grows as long as that aligns more words."""
    size = len(template.words)
    reach = size + size // 2 + 4
    pairs = aligned(words[begin : begin + reach], template.words)
    while len(pairs) < size and begin + reach < len(words):
        reach += size
        more = aligned(words[begin : begin + reach], template.words)
        if len(more) <= len(pairs):
            break
        pairs = more
    return pairs


def _matches(words: list[int], places: list[int], template: Template, least: float) -> list[tuple]:
    """(score, coverage, begin, end, template) of alignments with at least the coverage.

    Any alignment begins with one of the template's first words, so a stretch from each such
    word on is tried if it has enough of the template's words in any order: half of those
    needed, as the others may lie behind a gap. ``places`` are all template words' places in the text.
    """
    size = len(template.words)
    if size <= SHORT:
        first, found = template.words[0], []
        for k in places:
            if words[k] == first and tuple(words[k : k + size]) == template.words:
                found.append((1.0, 1.0, k, k + size, template))
        return found
    need, reach = int(np.ceil(least * size - 1e-9)), size + size // 2 + 4
    early = set(template.words[: size - need + 1])
    own = [k for k in places if words[k] in template.counts]
    found, done = [], -1
    high = 0
    for at, begin in enumerate(own):
        if begin < done or words[begin] not in early:
            continue
        high = max(high, at)
        while high < len(own) and own[high] < begin + reach:
            high += 1
        if 2 * (high - at) < need:
            continue
        have = Counter(words[k] for k in own[at:high])
        if 2 * sum(min(n, template.counts[w]) for w, n in have.items()) < need:
            continue
        pairs = _aligned_from(words, begin, template)
        if len(pairs) >= need and pairs[0][0] == 0:
            end = begin + pairs[-1][0] + 1
            stretch = words[begin:end]
            if not all(_has_run(stretch, run) for run in template.required):
                continue
            if any(_has_run(stretch, run) for run in template.foreign):
                continue
            score = 2 * len(pairs) / (size + end - begin)
            found.append((score, len(pairs) / size, begin, end, template))
            done = begin + 1 if len(pairs) < size else end
    return found


def find_licenses(
    df: DataFrame, templates: dict[str, str] = TEMPLATES, text: str = "text", least: float = 0.8
) -> DataFrame:
    """Add ``licenses``, an array of (license, begin, end, coverage, score) in order of begin.

    Words are compared with A to Z lowered and ASCII punctuation as space; begin and end count words.
    Coverage is the share of template words aligned, at least ``least``; a notice of up to ``SHORT``
    words stands word for word, a longer text has its ``REQUIRED`` runs and no ``FOREIGN`` ones. Score, which also counts words
    of the text in between, decides between matches that overlap (then the longer template, the
    earlier one, the name). Null and empty texts have none, repeated rows get the same answers, and a
    text of any length is searched whole. An existing column ``licenses`` is replaced, others stay.
    The templates are a fixed list and travel with the task.
    """
    kept = without(df, "licenses")
    bytes_column = fresh(kept, "_source_bytes")
    found = "struct<license: string, begin: bigint, end: bigint, coverage: double, score: double>"
    schema = extended(kept, f"licenses array<{found}>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = templates_of(templates)
        vocabulary = np.array(sorted({w for t in known for w in t.words}), np.uint64)
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        names = ("license", "begin", "end", "coverage", "score")
        kind = pa.list_(pa.struct(list(zip(names, kinds, strict=True))))
        for batch in slices(batches, bytes_column):
            texts = [t.translate(PLAIN) for t in batch.column(bytes_column).to_pylist()]
            out = []
            for numbers in numbers_by_text(texts):
                places = np.flatnonzero(np.isin(numbers, vocabulary))
                present = set(numbers[places].tolist())
                words, matches = None, []
                for template in known:
                    there = sum(n for w, n in template.counts.items() if w in present)
                    if there >= least * len(template.words) - 1e-9:
                        words = numbers.tolist() if words is None else words
                        matches += _matches(words, places.tolist(), template, least)
                out.append([dict(zip(names, m, strict=True)) for m in _best(matches)])
            batch = batch.drop_columns([bytes_column])
            yield batch.append_column("licenses", pa.array(out, kind))

    return kept.withColumn(bytes_column, text_bytes(f"`{text}`")).mapInArrow(run, schema)


def _best(matches: list[tuple]) -> list[tuple]:
    """Matches that do not overlap, best first taken, in order of begin."""
    ranked = sorted(matches, key=lambda m: (-m[0], -len(m[4].words), m[2], m[4].name))
    taken = Taken()
    chosen = [m for m in ranked if taken.take(m[2], m[3])]
    return sorted(((t.name, begin, end, cover, score) for score, cover, begin, end, t in chosen), key=lambda m: m[1])
