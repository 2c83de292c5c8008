"""License scans: templates with optional and replaceable regions, compiled into token automata.

A template is wording with markup: ``<<beginOptional>>...<<endOptional>>`` (may be nested) may be
left out, ``<<var;max=N>>`` stands for up to N words of any kind, ``<<var;match=a|b>>`` for one of
the words given. All other words are mandatory. Each template becomes an automaton over words;
a document carries its label where the automaton accepts a run of the document's words, that is
where the mandatory wording matches exactly, word by word, whatever the case and punctuation. A run ends
at no word that a point joins to the digits after it: version 2 isn't found in version 2.1. Licenses stand
as their whole wordings, from the grant to the end of the disclaimer; of those named by a notice
(GNU, Apache, Mozilla, Creative Commons) the notice is the template.

Words of all documents of a batch are hashed at once; an automaton is only run where two words
follow one another that it can begin with. Documents are mapped and nothing is shuffled.

Defined cases: a null or empty text has no words, no places and score 0; repeated rows get equal
results; of overlapping places each counts; labels without any place are the empty string; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetscape.llm import tokens as T

#: Fixed phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

_MIT_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;max=12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"
_BSD_CONDITIONS = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: <<beginOptional>>1. <<endOptional>>Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. <<beginOptional>>2. <<endOptional>>Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
_BSD_NAMES = "<<beginOptional>>3. <<endOptional>>Neither the name of <<var;max=12>> nor the names of <<var;max=4>> contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_WARRANTY = "THIS SOFTWARE IS PROVIDED BY <<var;max=12>> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;max=12>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"
_ISC_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\" AND <<var;max=12>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;max=12>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE"
_LICENSED = "licensed under <<beginOptional>>a <<endOptional>><<beginOptional>>the <<endOptional>>"
_GNU = "licensed under the <<beginOptional>>terms of the <<endOptional>>GNU {kind} Public License<<beginOptional>> as published by the Free Software Foundation<<endOptional>><<beginOptional>> either<<endOptional>> "
_GNU_HEADER = "you can redistribute it and/or modify it under the terms of the GNU {kind} Public License as published by the Free Software Foundation, either version <<var;match={versions}>><<beginOptional>> <<var;match=0|1>><<endOptional>> of the License, or (at your option) any later version"


def _creative_commons() -> tuple[tuple[str, str], ...]:
    """Notices of the Creative Commons licenses: by their short and their long names."""
    names = {"by": "Attribution", "nc": "NonCommercial", "sa": "ShareAlike", "nd": "NoDerivatives"}
    out = []
    for code in ("by", "by-nc", "by-sa", "by-nd", "by-nc-sa", "by-nc-nd"):
        parts = code.split("-")
        for brand in ("CC", "Creative Commons"):
            out.append((f"cc-{code}-4.0", f"{_LICENSED}{brand} {' '.join(parts)} 4.0"))
            out.append((f"cc-{code}-4.0", f"{_LICENSED}{brand} {' '.join(names[p] for p in parts)} 4.0<<beginOptional>> International<<endOptional>>"))
    return tuple(out)


def _gnu() -> tuple[tuple[str, str], ...]:
    """Notices of the GNU licenses, by version ("version 2", "version 2.0", "v2") and as in the usual file header."""
    out = []
    for name, kind, versions in (("gpl", "General", ("2.0", "3.0")), ("lgpl", "Lesser General", ("2.1", "3.0")), ("agpl", "Affero General", ("3.0",))):
        for v in versions:
            number = f"{v[0]}<<beginOptional>>.0<<endOptional>>" if v.endswith("0") else v
            for word in ("version ", "v"):
                out.append((f"{name}-{v}", _GNU.format(kind=kind) + word + number))
        out.append((f"{name}-or-later", _GNU_HEADER.format(kind=kind, versions="1|2|3")))
    return tuple(out)


#: Fixed wordings of public licenses, whole, and of their notices, with markup.
TEMPLATES = (
    ("apache-2.0", "licensed under the Apache License<<beginOptional>>,<<endOptional>> Version 2.0<<beginOptional>> (the \"License\"); you may not use this <<var;max=3>> except in compliance with the License. You may obtain a copy of the License at <<var;max=12>> Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License<<endOptional>>"),
    ("bsd-2-clause", _BSD_CONDITIONS + _BSD_WARRANTY),
    ("bsd-3-clause", _BSD_CONDITIONS + _BSD_NAMES + _BSD_WARRANTY),
    ("cc0-1.0", "under <<beginOptional>>the <<endOptional>><<beginOptional>>Creative Commons <<endOptional>>CC0 1.0<<beginOptional>> Universal<<endOptional>>"),
    ("isc", "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. " + _ISC_WARRANTY),
    ("mit-notice", "<<var;match=released|licensed|distributed|available>> under the <<beginOptional>>terms of the <<endOptional>>MIT License"),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph) <<endOptional>>shall be included in all copies or substantial portions of the Software. " + _MIT_WARRANTY),
    ("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. <<beginOptional>>In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. <<endOptional>>" + _MIT_WARRANTY),
    *_creative_commons(),
    *_gnu(),
)

OUT = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, matches array<struct<label:string,first_word:bigint,n_words:bigint>>"
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MARKUP = re.compile(r"<<(.*?)>>", re.S)


def words(text: str) -> list[str]:
    return _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


@lru_cache(maxsize=100_000)
def word_hash(word: str) -> int:
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(T.hashes(raw, np.array([0]), np.array([len(raw)]))[0])


class Automaton:
    """States 0..n-1 with word edges and empty moves; ``None`` as a word stands for any."""

    def __init__(self, label: str, template: str) -> None:
        self.label = label
        self.edges: list[list[tuple[int | None, int]]] = [[]]
        self.empty: list[list[int]] = [[]]
        at, opened = 0, []
        parts = _MARKUP.split(template)
        for i, part in enumerate(parts):
            if i % 2 == 0:
                for w in words(part):
                    at = self._step(at, [word_hash(w)])
            elif part == "beginOptional":
                opened.append(at)
            elif part == "endOptional":
                self.empty[opened.pop()].append(at)
            elif part.startswith("var;match="):
                at = self._step(at, [word_hash(w) for w in words(part.removeprefix("var;match="))])
            elif part.startswith("var;max="):
                skips = []
                for _ in range(int(part.removeprefix("var;max="))):
                    skips.append(at)
                    at = self._step(at, [None])
                for s in skips:
                    self.empty[s].append(at)
            else:
                raise ValueError(f"unknown markup: {part}")
        if opened:
            raise ValueError("an optional region isn't closed")
        self.final = at
        self.closed = [self._closure(s) for s in range(len(self.edges))]
        self.starts = {(a, b) for s in self.closed[0] for a, t in self.edges[s] for u in self.closed[t] for b, _ in self.edges[u]}
        if any(x is None for pair in self.starts for x in pair):
            raise ValueError("a template begins with two words at least")

    def _step(self, at: int, labels: list) -> int:
        self.edges.append([])
        self.empty.append([])
        new = len(self.edges) - 1
        self.edges[at] += [(w, new) for w in labels]
        return new

    def _closure(self, s: int) -> tuple[int, ...]:
        seen, todo = {s}, [s]
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return tuple(sorted(seen))

    def match(self, h: list[int], joined: list[bool] | None = None) -> int:
        """Words of the longest accepted beginning of ``h``; 0 if there is none. It ends at no word that is ``joined``
        to the next."""
        states, longest = set(self.closed[0]), 0
        for n, w in enumerate(h, 1):
            states = {u for s in states for x, t in self.edges[s] if x is None or x == w for u in self.closed[t]}
            if not states:
                break
            if self.final in states and not (joined and joined[n - 1]):
                longest = n
        return longest


@lru_cache(maxsize=8)
def compiled(templates: tuple) -> tuple[list[Automaton], np.ndarray, dict]:
    """Automata, the sorted hashes they can begin with, and (first, second) -> automata."""
    automata = [Automaton(label, t) for label, t in templates]
    begin: dict[tuple[int, int], list[Automaton]] = {}
    for a in automata:
        for pair in a.starts:
            begin.setdefault(pair, []).append(a)
    return automata, np.array(sorted({a for a, _ in begin}), np.uint64), begin


def _joined(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a word and the next are parts of one number, as 2 and 1 in 2.1."""
    out = np.zeros(len(starts), bool)
    digit = lambda at: (buf[at] >= ord("0")) & (buf[at] <= ord("9"))
    out[:-1] = (starts[1:] == ends[:-1] + 1) & (doc[1:] == doc[:-1])
    x = np.flatnonzero(out)
    out[x] = (buf[ends[x]] == ord(".")) & digit(ends[x] - 1) & digit(starts[x + 1])
    return out


def _scan(templates: tuple, base: tuple):
    phrases = tuple((tuple(word_hash(w) for w in words(p)), label) for p, label in base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata, first_words, begin = compiled(templates)
        reach = max((len(a.edges) for a in automata), default=0)
        for b in batches:
            for i, j, buf, off in T.chunks(b.column("text")):
                n = j - i
                starts, ends = T.spans(buf, off, T.ALNUM_WORDS)
                h, doc = T.hashes(buf, starts, ends, fold=True), T.owners(starts, off)
                first = np.searchsorted(starts, off)
                places: dict[int, list[tuple[int, str]]] = {}
                for phrase, label in phrases:
                    m = len(phrase)
                    at = np.flatnonzero(h[: max(0, len(h) - m + 1)] == np.uint64(phrase[0]))
                    for k in range(1, m):
                        at = at[(h[at + k] == np.uint64(phrase[k])) & (doc[at + k] == doc[at])]
                    for x in at.tolist():
                        places.setdefault(int(doc[x]), []).append((x - int(first[doc[x]]), label))
                found: dict[int, list[tuple[str, int, int]]] = {}
                joined = _joined(buf, starts, ends, doc)
                for x in np.flatnonzero(np.isin(h[:-1], first_words)).tolist():
                    d = int(doc[x])
                    if x + 1 < first[d + 1]:
                        for a in begin.get((int(h[x]), int(h[x + 1])), ()):
                            stop = min(x + reach, int(first[d + 1]))
                            if m := a.match(h[x:stop].tolist(), joined[x:stop].tolist()):
                                found.setdefault(d, []).append((a.label, x - int(first[d]), m))
                at = [places.get(d, []) for d in range(n)]
                of_base = [sorted({label for _, label in p}) for p in at]
                own = [found.get(d, []) for d in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id").slice(i, n),
                        pa.array(np.diff(first)),
                        pa.array([len(p) for p in at], pa.int64()),
                        pa.array([min((x for x, _ in p), default=None) for p in at], pa.int64()),
                        pa.array([max((x for x, _ in p), default=None) for p in at], pa.int64()),
                        pa.array([",".join(x) for x in of_base], pa.string()),
                        pa.array([",".join(sorted({*x, *(label for label, _, _ in o)})) for x, o in zip(of_base, own)], pa.string()),
                        pa.array([1.0 if o else 0.5 if x else 0.0 for x, o in zip(of_base, own)], pa.float64()),
                        pa.array([[{"label": a, "first_word": x, "n_words": m} for a, x, m in o] for o in own], pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())]))),
                    ],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"],
                )

    return run


def scan(documents: DataFrame, templates: tuple = TEMPLATES, base: tuple = BASE) -> DataFrame:
    """One row per document: n_words, the places of the base phrases (n_base, first_word,
    last_word), base_labels, labels (with those of accepted templates), score (1 with an accepted
    template, 0.5 with base phrases alone, else 0) and every accepted place in ``matches``."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_scan(tuple(templates), tuple(base)), OUT)
