"""License scans by templates with markup, compiled into token automata.

A template is the wording of a license, or of a notice that names one, as lower-case words. ``[ ... ]`` marks an optional region
and ``{n-m}`` a replaceable one of n to m words of any kind; ``a|b`` accepts either word. All else is mandatory: a text is
accepted where it has these words, in this order, with nothing between them. Every template is compiled into an automaton over
words, and all automata run together: their sets of positions become the states of one machine as texts reach them, so
each word of a text costs one lookup. A text is read in pieces of bounded size, as the machine's state is all that is carried over.

Base phrases, the plain search, are templates without markup on the same machine.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import schema, sliced, utf8

#: Fixed phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

_MIT_REST = (
    "subject to the following conditions the above copyright notice and this permission notice [including the next paragraph] shall be included in all copies or substantial portions of the software "
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose "
    "and noninfringement in no event shall {1-12} be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software "
    "or the use or other dealings in the software"
)
_BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met [1] redistributions of source code must retain "
    "the above copyright notice this list of conditions and the following disclaimer [2] redistributions in binary form must reproduce the above copyright notice this list of conditions "
    "and the following disclaimer in the documentation and or other materials provided with the distribution "
)
_BSD_END = "this software is provided by {1-12} as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"
_UNDER = "licensed|released|distributed|available|published under [the terms of] the "
_GNU_END = "license|licence as published by the free software foundation "
#: Public wording of licenses and their usual notices, by label.
TEMPLATES = [
    ("mit", f"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files [the software] to deal in the software without restriction "
            f"including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so {_MIT_REST}"),
    ("mit", f"{_UNDER}[{{1-2}}] mit [x11] license|licence"),
    ("bsd-2", _BSD + _BSD_END),
    ("bsd-3", f"{_BSD}[3] neither the name of {{1-12}} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission {_BSD_END}"),
    ("bsd", f"{_UNDER}[{{1-3}}] bsd [2|3 clause] license|licence"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("apache-2", f"{_UNDER}apache license|licence version 2 [0]"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at {1-10} unless required by applicable law or agreed to in writing software distributed under the license "
                 "is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("gpl-2", "gnu general public license|licence [as published by the free software foundation] [either] version|v 2"),
    ("gpl-3", "gnu general public license|licence [as published by the free software foundation] [either] version|v 3"),
    ("lgpl", f"gnu lesser|library general public {_GNU_END}[either] version {{1-2}}"),
    ("agpl-3", "gnu affero general public license|licence [as published by the free software foundation] [either] version|v 3"),
    ("mpl-2", "subject to the terms of the mozilla public license v|version 2 0"),
    ("cc-by-nc", "licensed|released|available under [a|the] [creative commons] cc|attribution [by] nc|noncommercial [4|3 0]"),
    ("cc-by-nc", "creative commons attribution noncommercial|non [commercial] [4|3 0] [international|unported] license|licence"),
    ("cc-by-sa", "creative commons attribution sharealike|share [alike] [4|3 0] [international|unported] license|licence"),
    ("cc-by", "creative commons attribution [4|3 0] [international|unported] license|licence"),
    ("cc0", "cc0 1 0 universal"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

#: What is not part of a word, and A-Z in lower case.
_SPACED = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
PIECE, STATES = 1 << 20, 100_000
HITS = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, ends array<long>, found array<string>"


def compile_template(text: str) -> tuple[list[dict], list[list[int]]]:
    """Transitions (words to the next position, ``None`` for any word) and free moves of each position; the last one accepts."""
    edges, free, opened = [{}], [[]], []

    def step(words) -> None:
        edges[-1].update(dict.fromkeys(words, len(edges)))
        edges.append({})
        free.append([])

    for token in re.findall(r"\[|\]|\{\d+-\d+\}|[^\s\[\]{}]+", text):
        if token == "[":
            opened.append(len(edges) - 1)
        elif token == "]":
            free[opened.pop()].append(len(edges) - 1)
        elif token[0] == "{":
            low, high = map(int, token[1:-1].split("-"))
            skips = []
            for k in range(high):
                if k >= low:
                    skips.append(len(edges) - 1)
                step([None])
            for s in skips:
                free[s].append(len(edges) - 1)
        else:
            step(token.split("|"))
    return edges, free


class Machine:
    """All templates as one automaton over word classes, whose states are made when a text reaches them."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.labels = [label for label, _ in templates]
        parts = [compile_template(text) for _, text in templates]
        words = sorted({w for edges, _ in parts for e in edges for w in e if w is not None})
        self.classes = {w.encode(): k for k, w in enumerate(words, 1)}  # 0: any other word
        self.parts = [([{None if w is None else self.classes[w.encode()]: q for w, q in e.items()} for e in edges], free) for edges, free in parts]
        self.begin = self._closed((t, 0) for t in range(len(parts)))
        starters = {c for t, p in self.begin for c in self.parts[t][0][p]}
        self.starts = np.array([c in starters or None in starters for c in range(len(words) + 1)])
        self._reset()

    def _closed(self, positions) -> frozenset:
        todo, seen = list(positions), set()
        while todo:
            t, p = todo.pop()
            if (t, p) not in seen:
                seen.add((t, p))
                todo.extend((t, q) for q in self.parts[t][1][p])
        return frozenset(seen)

    def _reset(self) -> None:
        self.number, self.sets, self.next, self.accepts = {}, [], [], []
        self._state(self.begin)

    def _state(self, positions: frozenset) -> int:
        if positions not in self.number:
            self.number[positions] = len(self.sets)
            self.sets.append(positions)
            self.next.append({})
            self.accepts.append(tuple(sorted(t for t, p in positions if p == len(self.parts[t][0]) - 1)))
        return self.number[positions]

    def _move(self, state: int, c: int) -> int:
        moved = {(t, q) for t, p in self.sets[state] for k, q in self.parts[t][0][p].items() if k is None or k == c}
        to = self._state(self._closed(moved) | self.begin)
        self.next[state][c] = to
        return to

    def scan(self, body: bytes):
        """Number of words, and (template, number of its last word) of each place that is accepted.

        Only one answer is given for each template and last word, whichever optional regions it has.
        """
        body, at, seen, state, hits = body.translate(_SPACED), 0, 0, 0, []
        get = self.classes.get
        while at < len(body):
            end = body.find(b" ", at + PIECE)  # pieces end between words
            end = len(body) if end < 0 else end
            c = np.array([get(w, 0) for w in body[at:end].split()], np.int32)
            starters = np.flatnonzero(self.starts[c]).tolist()
            classes, i, nth = c.tolist(), 0, 0
            while True:
                if state == 0:  # nothing has begun: on to the next word that begins something
                    while nth < len(starters) and starters[nth] < i:
                        nth += 1
                    i = starters[nth] if nth < len(starters) else len(classes)
                if i == len(classes):
                    break
                to = self.next[state].get(classes[i])
                state = self._move(state, classes[i]) if to is None else to
                for t in self.accepts[state]:
                    hits.append((t, seen + i))
                i += 1
            if len(self.sets) > STATES:  # keep the state that the text is in, and forget the others
                kept = self.sets[state]
                self._reset()
                state = self._state(kept)
            seen, at = seen + len(classes), end
        return seen, hits


_machines: dict[tuple, Machine] = {}


def machine(templates: tuple) -> Machine:
    """The worker's machine for these templates, kept from one batch to the next."""
    if templates not in _machines:
        _machines[templates] = Machine(list(templates))
    return _machines[templates]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=None, base=None) -> DataFrame:
    """Licenses that each whole text names or holds.

    ``n_words``; ``n_base`` places where the words of a phrase of ``base`` stand consecutively, ``first_word`` and ``last_word`` their
    smallest and largest start (words count from 0; null without any); ``base_labels``, and ``labels``, which the accepted
    ``templates`` are added to, both distinct and sorted; ``ends`` and ``found`` the last word and label of each accepted template.
    A-Z count as lower case; words are runs of letters, digits and non-ASCII characters. Null and empty texts have no words.
    Ids may be null or repeat; rows are scanned where they lie. An empty table gives an empty result; other columns are ignored.
    """
    base = tuple((label, phrase) for phrase, label in (BASE if base is None else base).items())
    every = base + tuple(TEMPLATES if templates is None else templates)
    lengths = [len(phrase.split()) for _, phrase in base]
    of = schema(HITS)
    kinds = [pa.int64()] * 5 + [pa.list_(pa.string())] * 2 + [pa.list_(pa.int64()), pa.list_(pa.string())]

    def one(m: Machine, doc_id, body: bytes) -> tuple:
        n, hits = m.scan(body)
        starts = [end + 1 - lengths[t] for t, end in hits if t < len(base)]
        plain = sorted({m.labels[t] for t, _ in hits if t < len(base)})
        more = [(end, m.labels[t]) for t, end in hits if t >= len(base)]
        return (doc_id, n, len(starts), min(starts, default=None), max(starts, default=None), plain, sorted({*plain, *(x for _, x in more)}), [e for e, _ in more], [x for _, x in more])

    def run(batches):
        m = machine(every)
        for batch in sliced(batches, 500):
            rows = [one(m, i.as_py(), b.as_py()) for i, b in zip(*batch.columns, strict=True)]
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], of.names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("body")).mapInArrow(run, of)


def score():
    """1 where a template is accepted, a half where a license is only mentioned by a base phrase, else 0."""
    return F.when(F.size("found") > 0, 1.0).when(F.col("n_base") > 0, 0.5).otherwise(0.0)


def op12_licenses(spark, sf_dir: str) -> DataFrame:
    found = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    joined = (F.array_join(c, ",").alias(c) for c in ("base_labels", "labels"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", *joined, score().alias("score"))


def _pattern(template: str) -> str:
    """A template as a regular expression over words that each end with a space."""
    out = []
    for token in re.findall(r"\[|\]|\{\d+-\d+\}|[^\s\[\]{}]+", template):
        if token in "[]":
            out.append("(?:" if token == "[" else ")?")
        elif token[0] == "{":
            out.append("(?:[^ ]+ ){" + token[1:-1].replace("-", ",") + "}")
        else:
            out.append(f"(?:{token}) " if "|" in token else f"{token} ")
    return " " + "".join(out)


def _sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    said = lambda label, patterns: f"CASE WHEN {' OR '.join(f"regexp_matches(s, '{p}')" for p in patterns)} THEN '{label}' END"
    at = "list_filter(range(len(w)), lambda i: " + " OR ".join("(" + " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(p.split(), 1)) + ")" for p in BASE) + ")"
    by_label: dict[str, list[str]] = {}
    for label, t in TEMPLATES:
        by_label.setdefault(label, []).append(_pattern(t))
    base = [said(label, [f" {phrase} "]) for phrase, label in BASE.items()]
    more = [said(label, patterns) for label, patterns in by_label.items()]
    join = lambda parts: f"array_to_string(list_sort(list_distinct(list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL))), ',')"
    return f"""WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
      p AS (SELECT doc_id, w, {at} AS places, ' ' || array_to_string(w, ' ') || ' ' AS s FROM t)
      SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base, CAST(list_min(places) AS BIGINT) AS first_word, CAST(list_max(places) AS BIGINT) AS last_word,
        {join(base)} AS base_labels, {join([*base, *more])} AS labels,
        CAST(CASE WHEN {join(more)} <> '' THEN 1.0 WHEN len(places) > 0 THEN 0.5 ELSE 0.0 END AS DOUBLE) AS score FROM p"""


OP12_SQL = _sql()
