"""License scans: marked-up templates compiled to token automata, and places of base phrases.

Method: a template is the wording of a license with marks: `<<beginOptional>> ... <<endOptional>>` around what may
be missing (nested if need be) and `<<var;words=2-5>>` where so many words of any kind may stand. It becomes an
automaton over words; a text is accepted where all mandatory wording stands word for word, in order, with only
marked parts missing or replaced. Automata start only at places whose first two words can begin the template,
which numpy finds for all words of a piece at once; the longest match from a start counts, and the next match
of the template starts behind it.

Base phrases are counted at all places where their words stand consecutively.

Defined results: null and wordless texts have 0 words, no places, empty labels and score 0; repeated rows give
repeated results; empty tables give empty results; other columns don't matter. Texts are looked at whole; words
of different texts never meet. Words count as equal if their 64-bit digests are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reviewloom.llm.shipping import ship, small_batches
from reviewloom.llm.words import Words, digest_of, pieces

#: Base phrases and their labels
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

#: the common parts of the BSD licenses
_BSD = """Redistribution and use <<beginOptional>>of <<var;words=1-8>><<endOptional>> in source and binary forms, with or
without modification, are permitted provided that the following conditions are met: <<beginOptional>>1.<<endOptional>>
Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. """
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY <<var;words=1-20>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
<<var;words=1-20>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"""


def _notices(label: str, name: str, version: str) -> list[tuple[str, str]]:
    """The standard notice of a GNU license with the version behind or before the publisher."""
    rest = f"""<<var;words=1-8>> is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} Public License for more details. You
should have received a copy of the GNU {name} Public License along with <<var;words=1-8>> if not"""
    start = f"is free software you can redistribute it and/or modify it under the terms of the GNU {name} Public License"
    return [
        (label, f"""{start} as published by the Free Software Foundation; <<beginOptional>>either<<endOptional>> version {version}
<<beginOptional>>of the License<<endOptional>><<beginOptional>>, or (at your option) any later version<<endOptional>>. {rest}"""),
        (label, f"{start} version {version} as published by the Free Software Foundation. {rest}"),
    ]


def _creative_commons() -> list[tuple[str, str]]:
    """Notices of all kinds and of the versions 3.0 and 4.0, by short and by full name."""
    out = []
    for kind in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd"):
        for version, nd, scope in (("3.0", "NoDerivs", "Unported"), ("4.0", "NoDerivatives", "International")):
            full = {"by": "Attribution", "sa": "ShareAlike", "nc": "NonCommercial", "nd": nd}
            names = " ".join(full[k] for k in kind.split("-"))
            start = "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>>"
            out += [(f"cc-{kind}-{version}", f"{start} {n}") for n in (
                f"CC {kind} {version}", f"Creative Commons {names} {version} <<beginOptional>>{scope}<<endOptional>> <<beginOptional>>License<<endOptional>>")]
    return out


#: Wording of published licenses and of the usual notices, with marks
TEMPLATES = [
    ("mit", "<<beginOptional>>this <<var;words=1-4>> is<<endOptional>> released under the <<beginOptional>>terms of the<<endOptional>> MIT license"),
    ("mit", "licensed under the <<beginOptional>>terms of the<<endOptional>> MIT license"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;words=1-8>> and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all
copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY
KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;words=1-20>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN
AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE"""),
    ("isc", """Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose
with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in
all copies. THE SOFTWARE IS PROVIDED "AS IS" AND <<var;words=1-20>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;words=1-20>> BE LIABLE FOR ANY
SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE"""),
    ("bsd-2-clause", _BSD + _BSD_DISCLAIMER),
    ("bsd-3-clause", _BSD + """<<beginOptional>>3.<<endOptional>> Neither the name of <<var;words=1-20>> nor the names of
<<var;words=1-8>> contributors may be used to endorse or promote products derived from this software without specific prior
written permission. """ + _BSD_DISCLAIMER),
    ("apache-2.0", """licensed under the Apache license version 2 0 <<beginOptional>>(the "License") you may not use
this file except in compliance with the License <<beginOptional>>You may obtain a copy of the License at
<<var;words=1-1>>://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express
or implied. See the License for the specific language governing permissions and limitations under the
License<<endOptional>><<endOptional>>"""),
    ("gpl-3.0", """this <<var;words=1-8>> is licensed under the <<beginOptional>>terms of the<<endOptional>> GNU general public license
<<beginOptional>>as published by the Free Software Foundation either<<endOptional>> version 3"""),
    *[t for n in [
        ("gpl-2.0", "General", "2"), ("gpl-3.0", "General", "3"), ("lgpl-2.0", "Library General", "2"),
        ("lgpl-2.1", "Lesser General", "2.1"), ("lgpl-3.0", "Lesser General", "3"), ("agpl-3.0", "Affero General", "3"),
    ] for t in _notices(*n)],
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at <<var;words=1-1>>://<<beginOptional>>www.<<endOptional>>mozilla.org/MPL/2.0"""),
    *_creative_commons(),
]

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MARK = re.compile(r"<<(.*?)>>")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.translate({c: c + 32 for c in range(65, 91)}))


class Automaton:
    """States are bits of an int; state i reads word i of the wording (None: any word) and goes to i + 1."""

    def __init__(self, template: str):
        self.reads: list[str | None] = []
        skips: list[tuple[int, int]] = []  # from one state to a later one without a word
        opened: list[int] = []
        at = 0
        for mark in [*_MARK.finditer(template), None]:
            self.reads += words_of(template[at:mark.start() if mark else len(template)])
            if mark is None:
                break
            at, name = mark.end(), mark.group(1)
            if name == "beginOptional":
                opened.append(len(self.reads))
            elif name == "endOptional":
                skips.append((opened.pop(), len(self.reads)))
            elif m := re.fullmatch(r"var;.*?words=(\d+)-(\d+)", name):
                least, most = int(m.group(1)), int(m.group(2))
                end = len(self.reads) + most
                skips += [(i, end) for i in range(len(self.reads) + least, end)]
                self.reads += [None] * most
            else:
                raise ValueError(f"unknown mark {name!r}")
        if opened:
            raise ValueError("an optional region is not closed")
        self.closed = [1 << i for i in range(len(self.reads) + 1)]
        for i in range(len(self.reads), -1, -1):
            for a, b in skips:
                if a == i:
                    self.closed[i] |= self.closed[b]
        self.end = 1 << len(self.reads)
        if self.closed[0] & self.end:
            raise ValueError("a template needs mandatory wording")

    def number(self, vocabulary: dict[str, int]) -> None:
        """Tables by word number; 0 stands for words of no template."""
        self.any = sum(1 << i for i, w in enumerate(self.reads) if w is None)
        self.by_word: dict[int, int] = {}
        for i, word in enumerate(self.reads):
            if word is not None:
                self.by_word[vocabulary[word]] = self.by_word.get(vocabulary[word], 0) | 1 << i

    def step(self, states: int, word: int) -> int:
        went = states & (self.by_word.get(word, 0) | self.any)
        out = 0
        while went:
            low = went & -went
            out |= self.closed[low.bit_length()]
            went ^= low
        return out

    def starts(self, words: int) -> list[tuple[int, int]]:
        """Pairs of first words that can begin a match; 0 as the second stands for all."""
        pairs = []
        for first in range(words + 1):
            after = self.step(self.closed[0], first)
            if after & (self.any | self.end):
                pairs.append((first, -1))
            elif after:
                pairs += [(first, second) for second in range(1, words + 1) if self.step(after, second)]
        return pairs

    def longest(self, numbers: list[int], at: int) -> int:
        """The end of the longest match that begins at `at`, or -1; a 0 word ends a text only if it is -1."""
        states, found = self.closed[0], -1
        while at < len(numbers) and numbers[at] >= 0:
            states = self.step(states, numbers[at])
            if not states:
                break
            at += 1
            if states & self.end:
                found = at
        return found


class Scanner:
    def __init__(self, templates: Sequence[tuple[str, str]], base: Sequence[tuple[str, str]]):
        self.automata = [(label, Automaton(text)) for label, text in templates]
        self.phrases = [(label, words_of(phrase)) for phrase, label in base]
        known = {w for _, a in self.automata for w in a.reads if w} | {w for _, p in self.phrases for w in p}
        names = sorted(known)
        digests = digest_of(names)
        order = np.argsort(digests)
        self.digests = digests[order]
        numbers = {names[i]: n for n, i in enumerate(order.tolist(), 1)}
        self.phrases = [(label, [numbers[w] for w in p]) for label, p in self.phrases]
        self.size = len(names) + 1
        self.pairs = []
        for _, automaton in self.automata:
            automaton.number(numbers)
            self.pairs.append(automaton.starts(len(names)))

    def numbers(self, digests: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.digests, digests)
        at[at == len(self.digests)] = 0
        return np.where(self.digests[at] == digests, at + 1, 0)

    def scan(self, texts: pa.Array):
        """Words, base places (text, word, phrase) and accepted spans (text, first, end, template)."""
        words = Words(texts, "alnum")
        owner = np.repeat(np.arange(len(texts)), words.counts())
        # -1 behind every text keeps words of different texts apart
        ids = np.full(len(words) + len(texts) + 1, -1, np.int64)
        ids[np.arange(len(words)) + owner] = self.numbers(words.digests())
        begins = words.first + np.arange(len(texts) + 1)
        places = []
        for number, (_, phrase) in enumerate(self.phrases):
            at = np.flatnonzero(ids == phrase[0])
            for j, word in enumerate(phrase[1:], 1):
                at = at[ids[at + j] == word]
            doc = np.searchsorted(begins, at, "right") - 1
            places += zip(doc.tolist(), (at - begins[doc]).tolist(), [number] * len(at))
        spans = []
        known = np.flatnonzero(ids > 0)
        code = ids[known] * self.size + np.maximum(ids[known + 1], 0)
        for number, ((_, automaton), pairs) in enumerate(zip(self.automata, self.pairs)):
            alone = np.array([a for a, b in pairs if b < 0], np.int64)
            both = np.array([a * self.size + b for a, b in pairs if b >= 0], np.int64)
            at = known[np.isin(code, both) | np.isin(ids[known], alone)]
            if 0 in alone:
                at = np.flatnonzero(ids >= 0)
            end = -1
            for place in at.tolist():
                if place < end:
                    continue
                doc = int(np.searchsorted(begins, place, "right")) - 1
                found = automaton.longest(ids[place:begins[doc + 1]].tolist() if begins[doc + 1] - place < 400 else _Lazy(ids, place), 0)
                if found > 0:
                    end = place + found
                    spans.append((doc, place - int(begins[doc]), end - int(begins[doc]), number))
        return words, places, spans


class _Lazy:
    """A view of word numbers from a place on; automata read only as far as they live."""

    def __init__(self, ids: np.ndarray, at: int):
        self.ids, self.at = ids, at

    def __len__(self) -> int:
        return len(self.ids) - self.at

    def __getitem__(self, i: int) -> int:
        return int(self.ids[self.at + i])


def license_labels(
    docs: DataFrame, text: str = "text", id: str = "doc_id", templates: Sequence[tuple[str, str]] = TEMPLATES,
    base: Sequence[tuple[str, str]] = BASE,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (share of the words inside base
    places and accepted texts) and spans (label, first word, end) of the accepted texts."""
    small_batches(docs.sparkSession)
    scanner = ship(docs.sparkSession, Scanner(templates, base))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scanner()
        for piece in pieces(batches, "text"):
            words, places, spans = own.scan(piece.column("text"))
            n = len(piece)
            starts: dict[int, list[int]] = {}
            names: list[set[str]] = [set() for _ in range(n)]
            covered: dict[int, list[tuple[int, int]]] = {}
            for doc, at, phrase in places:
                starts.setdefault(doc, []).append(at)
                names[doc].add(own.phrases[phrase][0])
                covered.setdefault(doc, []).append((at, at + len(own.phrases[phrase][1])))
            base_names = [",".join(sorted(s)) for s in names]
            listed: list[list[dict]] = [[] for _ in range(n)]
            for doc, first, end, template in spans:
                names[doc].add(own.automata[template][0])
                covered.setdefault(doc, []).append((first, end))
                listed[doc].append({"label": own.automata[template][0], "first": first, "end": end})
            counts, score = words.counts(), np.zeros(n)
            for doc, parts in covered.items():
                inside, reach = 0, 0
                for a, b in sorted(parts):
                    inside += max(0, b - max(a, reach))
                    reach = max(reach, b)
                score[doc] = inside / counts[doc]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("id"), pa.array(counts, pa.int64()),
                    pa.array([len(starts.get(i, ())) for i in range(n)], pa.int64()),
                    pa.array([min(starts[i]) if i in starts else None for i in range(n)], pa.int64()),
                    pa.array([max(starts[i]) if i in starts else None for i in range(n)], pa.int64()),
                    pa.array(base_names), pa.array([",".join(sorted(s)) for s in names]), pa.array(score),
                    pa.array(listed, pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())]))),
                ],
                ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
            )

    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    schema = (
        f"id {dict(rows.dtypes)['id']}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, spans array<struct<label:string,first:bigint,end:bigint>>"
    )
    return rows.mapInArrow(label, schema).withColumnRenamed("id", id)
