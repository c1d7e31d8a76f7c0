"""Licence scans: matching statistics of texts against licence templates, chained into covered spans."""

from __future__ import annotations

from collections import defaultdict
from itertools import chain, product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gleaner.llm.common import per_text
from gleaner.llm.leaks import WORD_BYTES

LEAST_MATCH = 4  # words of a match that may be part of a chain
MOST_GAP = 20  # words of a text between two matches of a chain
MAX_TEMPLATE_WORDS = 200_000  # the automaton travels to every task


class Template(NamedTuple):
    """A licence's text or notice, and the share of its words a chain must cover: all of a notice, most of a text."""

    label: str
    text: str
    share: float = 1.0


#: Fixed phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS
IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""

_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""

_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY,
OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is
not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software. 3. This notice may not be removed or altered from any source distribution."""

_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means."""

_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""

_GNU = """{it} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the
Free Software Foundation, either version {version} of the License, or (at your option) any later version."""

_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at"""

_CC_NAMES = {
    "by": "Attribution",
    "by-sa": "Attribution-ShareAlike",
    "by-nc": "Attribution-NonCommercial",
    "by-nd": "Attribution-NoDerivatives",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
    "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}
_GNU_NAMES = {
    "gpl": ("General Public License", ("2", "3")),
    "lgpl": ("Lesser General Public License", ("2.1", "3")),
    "agpl": ("Affero General Public License", ("3",)),
}


def default_templates() -> list[Template]:
    """Texts and notices of common licences; families of notices are made by rule."""
    found = [
        Template("mit", _MIT, 0.8),
        Template("mit", "released under the MIT License"),
        Template("mit", "licensed under the MIT License"),
        Template("bsd-2-clause", f"{_BSD_HEAD} {_BSD_TAIL}", 0.8),
        Template("bsd-3-clause", f"{_BSD_HEAD} {_BSD_NAMES} {_BSD_TAIL}", 0.8),
        Template("isc", _ISC, 0.8),
        Template("zlib", _ZLIB, 0.8),
        Template("unlicense", _UNLICENSE, 0.8),
        Template("apache-2.0", _APACHE, 0.8),
        Template("apache-2.0", "licensed under the Apache License, Version 2.0"),
        Template("mpl-2.0", _MPL, 0.8),
        Template("mpl-2.0", "under the Mozilla Public License, version 2.0"),
        Template("cc0-1.0", "dedicated to the public domain under CC0 1.0"),
    ]
    for short, name, version in ((short, name, v) for short, (name, versions) in _GNU_NAMES.items() for v in versions):
        label = f"{short}-{version if '.' in version else version + '.0'}"
        found.append(Template(label, f"licensed under the GNU {name}, version {version}"))
        found.append(Template(label, _GNU.format(it="This program", name=name, version=version), 0.8))
    for (short, name), version in product(_CC_NAMES.items(), ("1.0", "2.0", "2.5", "3.0", "4.0")):
        label = f"cc-{short}-{version}"
        found.append(Template(label, f"licensed under CC {short} {version}"))
        found.append(Template(label, f"licensed under a Creative Commons {name} {version}"))
    return found


def _words(text: str) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split()


class Automaton:
    """Generalised suffix automaton of token sequences: its states are the sets of places where a sequence ends.

    ``places[s]`` lists (sequence, end) of all ends of state ``s``; ``whole[s]`` lists the sequences that are a suffix of
    whatever reaches ``s``, with their lengths (those longer than the match so far do not count yet).
    """

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        own: list[list[tuple[int, int]]] = [[]]
        ends = []
        for k, sequence in enumerate(sequences):
            last = 0
            for i, token in enumerate(sequence):
                last = self._extend(last, token)
                own.extend([] for _ in range(len(self.size) - len(own)))
                own[last].append((k, i + 1))
            ends.append(last)
        order = sorted(range(1, len(self.size)), key=self.size.__getitem__)
        self.places = [list(x) for x in own]
        for s in reversed(order):
            if self.link[s] > 0:
                self.places[self.link[s]] += self.places[s]
        self.whole: list[list[tuple[int, int]]] = [[] for _ in self.size]
        for k, s in enumerate(ends):
            if s:
                self.whole[s].append((k, len(sequences[k])))
        for s in order:
            self.whole[s] = self.whole[self.link[s]] + self.whole[s]

    def _state(self, size: int, link: int, follow: dict[int, int]) -> int:
        self.size.append(size)
        self.link.append(link)
        self.next.append(follow)
        return len(self.size) - 1

    def _split(self, p: int, q: int, token: int) -> int:
        """State of the sequences of ``q`` up to one token longer than ``p``."""
        if self.size[q] == self.size[p] + 1:
            return q
        copy = self._state(self.size[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:  # another sequence went this way
            return self._split(last, self.next[last][token], token)
        new, p = self._state(self.size[last] + 1, 0, {}), last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][token], token)
        return new

    def matches(self, tokens: list[int]):
        """Per token the state and length of the longest match that ends with it."""
        follow, link, size = self.next, self.link, self.size
        state = length = 0
        for token in tokens:
            while state and token not in follow[state]:
                state = link[state]
                length = size[state]
            if token in follow[state]:
                state = follow[state][token]
                length += 1
            yield state, length


class Match(NamedTuple):
    start: int  # first word in the text
    end: int
    at: int  # first word in the template
    to: int


def chains(matches: list[Match], most_gap: int = MOST_GAP) -> list[tuple[int, int, int]]:
    """Chains of matches in order in text and template: ``first word, end, words covered``; every match is in one chain.

    A chain takes the match before that covers most, at most ``most_gap`` words back; words in both count once.
    """
    matches = sorted(set(matches), key=lambda m: (m.end, m.to))
    best, before = [], []
    for i, m in enumerate(matches):
        own, most, back = m.end - m.start, 0, -1
        for j in range(i - 1, -1, -1):
            o = matches[j]
            if o.end < m.start - most_gap:
                break
            if o.start < m.start and o.at < m.at and o.to < m.to and o.end < m.end:
                gain = best[j] - max(0, o.end - m.start, o.to - m.at)
                if gain > most:
                    most, back = gain, j
        best.append(own + most)
        before.append(back)
    found, used = [], [False] * len(matches)
    for i in sorted(range(len(matches)), key=lambda i: (-best[i], i)):
        if used[i]:
            continue
        at, first = i, i
        while at >= 0 and not used[at]:
            used[at], first = True, at
            at = before[at]
        found.append((matches[first].start, matches[i].end, best[i] - (best[at] if at >= 0 else 0)))
    return found


def _scan(templates: list[Template], phrases: dict[str, str]):
    """Function of a slice's texts."""
    sequences = [_words(p) for p in phrases] + [_words(t.text) for t in templates]
    ids: dict[bytes, int] = {}
    automaton = Automaton([[ids.setdefault(w, len(ids)) for w in x] for x in sequences])
    sizes, labels, base = [len(x) for x in sequences], [*phrases.values(), *(t.label for t in templates)], len(phrases)
    shares = [1.0] * base + [t.share for t in templates]
    shortest = min([LEAST_MATCH, *(n for n in sizes[:base] if n)])

    def one(stretches: list[tuple[int, list[int]]]) -> tuple[list, list, float]:
        places, by = [], defaultdict(list)
        for first, tokens in stretches:
            held = [*automaton.matches(tokens), (0, 0)]
            for i, (state, length) in enumerate(held[:-1]):
                end = first + i + 1
                for k, size in automaton.whole[state]:
                    if k < base and size <= length:
                        places.append({"label": labels[k], "start": end - size})
                if length >= LEAST_MATCH and held[i + 1][1] <= length:
                    for k, to in automaton.places[state]:
                        if k >= base:
                            by[k].append(Match(end - length, end, to - length, to))
        covered = [(words, words / sizes[k], k, start, end) for k, found in by.items() for start, end, words in chains(found)]
        score = max([share for _, share, *_ in covered], default=0.0)
        taken: set[int] = set()
        spans = []
        for words, share, k, start, end in sorted(covered, key=lambda c: (-c[0], -c[1], labels[c[2]], c[3])):
            if share >= shares[k] and taken.isdisjoint(range(start, end)):
                taken.update(range(start, end))
                spans.append({"label": labels[k], "start": start, "end": end, "share": share})
        order = lambda x: (x["start"], x["label"])
        return sorted(places, key=order), sorted(spans, key=order), 1.0 if places else score

    def run(texts: list[bytes]) -> list:
        listed = [t.translate(WORD_BYTES).split() for t in texts]
        n_words = np.array([len(w) for w in listed], np.int64)
        tokens = np.fromiter((ids.get(w, -1) for w in chain.from_iterable(listed)), np.int64, int(n_words.sum()))
        doc = np.repeat(np.arange(len(texts)), n_words)
        first_word = np.cumsum(n_words) - n_words
        known = np.flatnonzero(tokens >= 0)  # any other word sends the automaton back to its start
        cut = np.flatnonzero(np.concatenate(([True], (np.diff(known) != 1) | (np.diff(doc[known]) != 0)))) if len(known) else known
        spread = np.diff(np.append(cut, len(known)))
        work: dict[int, list] = defaultdict(list)
        for c, size in zip(cut[spread >= shortest].tolist(), spread[spread >= shortest].tolist(), strict=True):
            at = int(known[c])
            k = int(doc[at])
            work[k].append((at - int(first_word[k]), tokens[at : at + size].tolist()))
        places, spans, scores = [[] for _ in texts], [[] for _ in texts], [0.0] * len(texts)
        for k, stretches in work.items():
            places[k], spans[k], scores[k] = one(stretches)
        return [n_words, places, spans, scores]

    return run


_PLACE = [T.StructField("label", T.StringType()), T.StructField("start", T.LongType())]
_SPAN = [*_PLACE, T.StructField("end", T.LongType()), T.StructField("share", T.DoubleType())]
_PA_PLACE = [("label", pa.string()), ("start", pa.int64())]
FIELDS = [
    ("n_words", T.LongType(), pa.int64()),
    ("places", T.ArrayType(T.StructType(_PLACE)), pa.list_(pa.struct(_PA_PLACE))),
    ("spans", T.ArrayType(T.StructType(_SPAN)), pa.list_(pa.struct([*_PA_PLACE, ("end", pa.int64()), ("share", pa.float64())]))),
    ("score", T.DoubleType(), pa.float64()),
]


def find_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: list[Template] | None = None,
    phrases: dict[str, str] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Per row of ``docs``: the id (or the ``keep`` columns), ``n_words``, ``places``, ``spans`` and ``score``.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. One automaton holds the words of all
    phrases and templates; a text streams through it, which gives for each word the longest match that ends there.
    ``places``: label and first word of every occurrence of a phrase. ``spans``: label, first word, end and covered share
    of the templates that chains of matches of ``LEAST_MATCH`` words or more cover to their ``share``; where two of them
    meet, the one with more words stays (then the greater share, then the first label). ``score``: 1 with a phrase, else the
    greatest share of a template that a chain covers, enough or not; 0 without any.

    Null and empty texts have no words and score 0; repeated rows and ids each get their row, an empty table gives no rows,
    and only the named columns are read. Time and memory are linear in a text of any length. Nothing is shuffled; the automaton is built
    in each task from the templates, at most ``MAX_TEMPLATE_WORDS`` words.
    """
    templates = default_templates() if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    if sum(len(_words(t.text)) for t in templates) + sum(len(_words(p)) for p in phrases) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of over {MAX_TEMPLATE_WORDS} words")
    return per_text(docs, text_col, keep or [id_col], FIELDS, lambda: _scan(templates, phrases))
