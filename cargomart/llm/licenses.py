"""License scans by template markup.

A template is wording with markup: ``[[ ... ]]`` is optional (and may hold
markup itself), ``{n}`` stands for any n words at most.  Each template is
compiled to an automaton over words; a text is accepted where all mandatory
wording follows word for word, with optional and replaceable regions in
between.  A text that ends within a license, at ``||`` or later, isn't accepted;
``partial`` names the license that it begins.  Case, punctuation and line breaks
don't matter, as only words count.

Texts are turned into numbers of the templates' words on arrays; automata run
only from places where a template's first words stand.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_slices, tune
from .vec import ALNUM, words

#: Phrases whose places are the base, and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

_AS_IS = (
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
    "merchantability fitness for a particular purpose and noninfringement in no event shall {8} be liable for any claim damages or other "
    "liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or "
    "other dealings in the software"
)
_NOTICE = (
    "[[{12} is free software you can redistribute it and or modify it under the terms of the]] {gpl} as published by the "
    "free software foundation either version {v} of the license or at your option any later version {12} distributed in the hope that it will "
    "be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the "
    "{gpl} for more details"
)
_GPL = _NOTICE.replace("{gpl}", "gnu general public license")
#: What follows a title in the GNU licenses themselves.
_VERBATIM = (
    "copyright {16} everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"
)

#: Wording of public licenses (whole short licenses, whole notices of long
#: ones) and, after it, short notices that name a license.
TEMPLATES = {
    "mit": (
        "[[[[the]] mit license [[mit]]]] [[copyright {12}]] permission is hereby granted free of charge to any person obtaining a copy of "
        "this software and associated documentation files the software to deal in the software without restriction || including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this "
        "permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the software " + _AS_IS,
        "[[is]] licensed under [[the terms of]] the mit license",
    ),
    "apache-2": (
        "licensed under the apache license version 2 0 [[the license]] you may not use {4} except in compliance with the license you may obtain "
        "a copy of the license at {8} unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific "
        "language governing permissions and limitations under the license",
        "licensed under [[the terms of]] the apache [[software]] license version 2 [[0]]",
        "apache license version 2 0 january 2004 [[http www apache org licenses]] terms and conditions for use reproduction and distribution",
    ),
    "zlib": (
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages "
        "arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial "
        "applications and to alter it and redistribute it freely subject to the following restrictions [[1]] the origin of this software must not "
        "be misrepresented you must not claim that you wrote the original software if you use this software in a product an [[acknowledgment]] "
        "[[acknowledgement]] in the product documentation would be appreciated but is not required [[2]] altered source versions must be plainly "
        "marked as such and must not be misrepresented as being the original software [[3]] this notice may not be removed or altered from any "
        "source distribution",
    ),
    "lgpl": (
        _NOTICE.replace("{gpl}", "gnu lesser general public license").replace("{v}", "{3}"),
        _NOTICE.replace("{gpl}", "gnu library general public license").replace("{v}", "{3}"),
        "gnu lesser general public license version [[2 1 february 1999]] [[3 29 june 2007]] " + _VERBATIM,
        "licensed under [[the terms of]] the [[gnu]] lesser general public license",
    ),
    "agpl-3": (
        _NOTICE.replace("{gpl}", "gnu affero general public license").replace("{v}", "3"),
        "gnu affero general public license version 3 19 november 2007 " + _VERBATIM,
        "licensed under [[the terms of]] the [[gnu]] affero general public license [[version 3]]",
    ),
    "cc0": (
        "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of [[his or her]] [[their]] "
        "rights to the work worldwide under copyright law including all related and neighboring rights to the extent allowed by law",
        "has waived all copyright and related or neighboring rights to",
        "licensed under [[the]] [[creative commons]] cc0 [[1 0]] [[universal]]",
    ),
    "cc-by-nc": (
        "licensed under [[a]] [[the]] creative commons attribution non commercial {3} license",
        "licensed under [[a]] [[the]] creative commons attribution noncommercial {3} license",
        "licensed under [[a]] [[the]] cc by nc [[4 0]]",
    ),
    "cc-by-sa": (
        "licensed under [[a]] [[the]] creative commons attribution share alike {3} license",
        "licensed under [[a]] [[the]] creative commons attribution sharealike {3} license",
        "licensed under [[a]] [[the]] cc by sa [[4 0]]",
    ),
    "cc-by": ("licensed under [[a]] [[the]] creative commons attribution [[{2} international]] license", "licensed under [[a]] [[the]] cc by 4 0"),
    "gpl-3": (
        _GPL.replace("{v}", "3"),
        "licensed under [[the terms of]] the [[gnu]] general public license [[as published by the free software foundation {1}]] version 3",
        "gnu general public license version 3 29 june 2007 " + _VERBATIM,
    ),
    "gpl-2": (
        _GPL.replace("{v}", "2"),
        "licensed under [[the terms of]] the [[gnu]] general public license [[as published by the free software foundation {1}]] version 2",
        "gnu general public license version 2 june 1991 " + _VERBATIM,
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
        "conditions are met {4} redistributions of source code must retain the above copyright notice || this list of conditions and the "
        "following disclaimer {1} redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution "
        "[[[[{1}]] all advertising materials mentioning features or use of this software must display the following acknowledgement {16}]] "
        "[[[[{1}]] neither the name of {16} may be used to endorse or promote products derived from this software without specific prior "
        "written permission]] "
        "this software is provided by {8} as is and any express or implied warranties including but not limited to the implied warranties of "
        "merchantability and fitness for a particular purpose are disclaimed in no event shall {8} be liable for any direct indirect incidental "
        "special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or "
        "profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including "
        "negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
        "[[is]] licensed under [[the terms of]] the [[{1}]] bsd {2} license",
    ),
    "isc": (
        "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies || the software is provided as is and {8} "
        "disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall "
        "{8} be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or "
        "profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or "
        "performance of this software",
    ),
    "mpl-2": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this "
        "file you can obtain one at {8}",
        "mozilla public license version 2 0 [[1 definitions]]",
    ),
    "unlicense": (
        "this is free and unencumbered software released into the public domain || anyone is free to copy modify publish use compile sell or "
        "distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any "
        "means in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in "
        "the software to the public domain we make this dedication for the benefit of the public at large and to the detriment of our heirs and "
        "successors we intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this "
        "software under copyright law " + _AS_IS,
    ),
}

_TOKEN = re.compile(r"\[\[|\]\]|\|\||\{[0-9]+\}|[^\s\[\]{}|]+")


@dataclass
class Automaton:
    """States 0 to ``accept``; ``step[state]`` maps a word to next states,
    ``any`` has the states that any word leaves as well, ``free`` those that
    are entered without a word.  A text that ends in a state from ``cut`` on
    is a partial match."""

    label: str
    mandatory: int = 0
    cut: int | None = None
    step: list[dict[str, int]] = field(default_factory=lambda: [{}])
    any: dict[int, int] = field(default_factory=dict)
    free: dict[int, list[int]] = field(default_factory=dict)

    @property
    def accept(self) -> int:
        return len(self.step) - 1

    def _new(self) -> int:
        self.step.append({})
        return self.accept

    def closure(self, states: set[int]) -> set[int]:
        out, todo = set(states), list(states)
        while todo:
            for s in self.free.get(todo.pop(), ()):
                if s not in out:
                    out.add(s)
                    todo.append(s)
        return out

    def starts(self) -> set[tuple[str, str | None]]:
        """Pairs of words that a match may begin with (any second word: None)."""
        out = set()
        for s in self.closure({0}):
            for w, t in self.step[s].items():
                after = self.closure({t})
                out |= {(w, v) for u in after for v in self.step[u]}
                if self.accept in after or after & self.any.keys():
                    out.add((w, None))
        return out

    def match(self, seen: list[int], number: dict[str, int]) -> int:
        """Words of the longest match at the start of ``seen``, or 0."""
        return self.run(seen, number)[0]

    def run(self, seen: list[int], number: dict[str, int]) -> tuple[int, bool]:
        """Words of the longest match, and whether there is none but ``seen``
        ends in a partial one; it ends with the text, unless it is longer than
        any match."""
        states, best = self.closure({0}), 0
        for k, w in enumerate(seen, 1):
            after = {t for s in states for v, t in self.step[s].items() if number[v] == w}
            after |= {self.any[s] for s in states if s in self.any}
            states = self.closure(after)
            if self.accept in states:
                best = k
            if not states:
                break
        return best, not best and self.cut is not None and any(s >= self.cut for s in states)


def compile_template(label: str, template: str) -> Automaton:
    """Wording and markup to an automaton."""
    a, opened, now = Automaton(label), [], 0
    for t in _TOKEN.findall(template):
        if t == "[[":
            opened.append(now)
        elif t == "]]":
            end = a._new()
            a.free.setdefault(now, []).append(end)
            a.free.setdefault(opened.pop(), []).append(end)
            now = end
        elif t == "||":
            a.cut = now
        elif t[0] == "{":
            states = [now]
            for _ in range(int(t[1:-1])):
                nxt = a._new()
                a.any[states[-1]] = nxt
                states.append(nxt)
            end = a._new()
            for s in states:
                a.free.setdefault(s, []).append(end)
            now = end
        else:
            nxt = a._new()
            a.step[now][t] = nxt
            now = nxt
            a.mandatory += not opened
    if opened:
        raise ValueError(f"{template!r}: an optional region isn't closed")
    return a


@cache
def _compiled():
    """Automata, the vocabulary (sorted hashes and their numbers), and the base."""
    automata = [compile_template(label, t) for label, ts in TEMPLATES.items() for t in ts]
    vocabulary = sorted({w for a in automata for s in a.step for w in s} | {w for p in BASE for w in p.split()})
    hashes = words([" ".join(vocabulary)], ALNUM).hash
    order = np.argsort(hashes)
    number = {w: i for i, w in enumerate(vocabulary)}
    base = [([number[w] for w in p.split()], label) for p, label in BASE.items()]
    starts: dict[tuple[int, int], list[Automaton]] = {}
    for a in automata:
        for v, u in a.starts():
            starts.setdefault((number[v], -1 if u is None else number[u]), []).append(a)
    return number, hashes[order], order, base, starts


def _scan(texts: list[str]) -> list[tuple]:
    """Of each text: words, base places, first, last, base labels, labels, score, partial labels."""
    number, hashes, order, base, starts = _compiled()
    w = words(texts, ALNUM)
    at = np.minimum(np.searchsorted(hashes, w.hash), len(hashes) - 1)
    seen = np.where(hashes[at] == w.hash, order[at], -1)
    text = np.repeat(np.arange(len(texts)), np.diff(w.bounds))
    # A place after each text's last word that no phrase or start goes beyond.
    joined = np.full(len(seen) + len(texts) + 4, -2)
    where = np.arange(len(seen)) + text
    joined[where] = seen
    places = [[] for _ in texts]
    for phrase, label in base:
        hit = np.ones(len(seen), bool)
        for k, v in enumerate(phrase):
            hit &= joined[where + k] == v
        for i in np.flatnonzero(hit):
            places[text[i]].append((int(i - w.bounds[text[i]]), label, len(phrase)))
    labels = [{label: n for _, label, n in p} for p in places]
    partial = [set() for _ in texts]
    # Pairs of a start's first words; -2 ends a text, -1 is any other word.
    size = len(number) + 2
    pair = seen * size + joined[where + 1] + 2
    loose = [v for v, u in starts if u == -1]
    for i in np.flatnonzero((seen >= 0) & (np.isin(pair, [v * size + u + 2 for v, u in starts if u >= 0]) | np.isin(seen, loose))):
        v, u, t = int(seen[i]), int(joined[where[i] + 1]), text[i]
        for a in {id(a): a for a in (*starts.get((v, u), ()), *starts.get((v, -1), ()))}.values():
            # No match is longer than its automaton has states.
            n, begun = a.run(seen[i : min(i + a.accept + 1, w.bounds[t + 1])].tolist(), number)
            if n:
                labels[t][a.label] = max(labels[t].get(a.label, 0), min(n, a.mandatory))
            elif begun:
                partial[t].add(a.label)
    out = []
    for i, p in enumerate(places):
        first, last = (min(p)[0], max(p)[0]) if p else (None, None)
        longest = max(labels[i].values(), default=0)
        out.append((
            int(w.bounds[i + 1] - w.bounds[i]), len(p), first, last, ",".join(sorted({x[1] for x in p})),
            ",".join(sorted(labels[i])), longest / (longest + 2) if longest else 0.0, ",".join(sorted(partial[i] - labels[i].keys())),
        ))
    return out


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, partial string"
)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) to the base phrases' places and labels, and
    all labels.  ``score`` is 0 without a label and nears 1 with the length of
    the longest mandatory wording that matched.  ``partial`` names licenses
    that a text begins and breaks off; they are no labels and don't score.  No
    label: an empty string; no place: null first and last word.  Rows are handled one by one, so repeated
    rows give repeated results; no shuffle."""
    tune(docs.sparkSession)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.string())
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for at, texts in text_slices(batch):
                cols = [ids[at : at + len(texts)], *zip(*_scan(texts))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)
