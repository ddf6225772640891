"""Licence scan with a generalised suffix automaton over the words of licence texts.

The automaton holds every run of words of every template. A document streams through it word by word: state and length
after a word are its matching statistic. Maximal matches of at least ``min_match`` words are chained per template where text and
template both go on; a chain that covers enough of a template gives that template's label and the covered span. Fixed
phrases are states of the same automaton: they occur wherever the suffix path of a state passes them.

NULL and empty text: no words, no labels, score 0. Equal or repeated rows are scanned on their own. Other columns are not
read. The automaton grows with the templates only and is built once in each Python worker.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame

from .common import per_document, texts, tune

# Phrases that label by themselves.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Opening words of public licences and the notices they ask for.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
            "files the software to deal in the software without restriction including without limitation the rights to use copy modify merge "
            "publish distribute sublicense and or sell copies of the software"),
    ("mit", "released under the mit license"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
                 "you may obtain a copy of the license at"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
              "published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
            "conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided "
            "that the above copyright notice and this permission notice appear in all copies"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced without permission"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
            "merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable"),
    ("apache-2", "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive "
                 "no charge royalty free irrevocable copyright license to reproduce prepare derivative works of"),
    ("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
              "published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2"),
    *((f"gpl-{n}", f"this program is free software you can redistribute it and or modify it under the terms of {name} as published by the free "
                   "software foundation")
      for n in (2, 3) for name in (f"version {n} of the gnu general public license", f"the gnu general public license version {n}")),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu library general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license version 2 0"),
    ("agpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license "
               "as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("epl-2", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    *((f"cc-{kind}", f"this work is licensed under a creative commons {name} {version} license")
      for kind, name in (("by", "attribution"), ("by-sa", "attribution sharealike"), ("by-nc", "attribution noncommercial"),
                         ("by-nd", "attribution noderivatives"), ("by-nc-sa", "attribution noncommercial sharealike"),
                         ("by-nc-nd", "attribution noncommercial noderivatives"))
      for version in ("2 0 generic", "2 5 generic", "3 0 unported", "4 0 international")),
)

#: Words that tell sibling licences apart: a template that has such a run counts only where one match holds it whole.
DISTINCT = tuple(
    x.split() for x in ("version 2", "version 3", "gnu general public", "gnu affero general public", "gnu lesser general public", "gnu library general public",
                                "mozilla public license version 2 0", "mozilla public license v 2 0",
                        "eclipse public license 2 0")
)


def distinct_places(template: str) -> list[tuple[int, int]]:
    """Word ranges of a template that tell it from its siblings."""
    own = template.split()
    out = [(i, i + len(d)) for d in DISTINCT for i in range(len(own)) if own[i : i + len(d)] == d]
    if "commons" in own:  # kind and version together
        at = own.index("commons")
        out.append((at, next(i for i in range(at, len(own)) if own[i].isdigit()) + 2))
    return out


#: A-Z lower-cased; every other byte that is no digit, letter or part of a longer character separates words.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str) -> list[bytes]:
    return text.encode().translate(_WORDS).split()


@dataclass(frozen=True)
class Span:
    label: str
    start: int  # first word in the text
    end: int  # after the last word
    coverage: float


class Automaton:
    """Suffix automaton of several word sequences, with the places of each state in the templates."""

    def __init__(self, templates: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]]):
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.places: list[set[tuple[int, int]]] = [set()]
        self.labels = [x for x, _ in templates]
        self.sizes = []
        for k, (_, text) in enumerate(templates):
            self.sizes.append(self._add(words(text), k))
        self.distinct = [distinct_places(text) for _, text in templates]
        for _, text in phrases:
            self._add(words(text), None)
        # A state's places are also those of the shorter suffixes it links to.
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.places[self.link[s]] |= self.places[s]
        self.shortest = min([len(words(p)) for _, p in phrases] + [3])
        own: dict[int, list[tuple[int, str]]] = {}
        for text_label in phrases:
            state = 0
            for w in words(text_label[0]):
                state = self.next[state][self.vocab[w]]
            own.setdefault(state, []).append((len(words(text_label[0])), text_label[1]))
        #: Phrases at each state, its suffixes' included.
        self.phrases: list[list[tuple[int, str]]] = [[] for _ in self.length]
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            self.phrases[s] = own.get(s, []) + self.phrases[self.link[s]]

    def _state(self, length: int, like: int | None = None) -> int:
        self.length.append(length)
        self.next.append({} if like is None else dict(self.next[like]))
        self.link.append(-1 if like is None else self.link[like])
        self.places.append(set())
        return len(self.length) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """A state for the strings of q up to one word longer than p, to which those arcs now lead."""
        short = self._state(self.length[p] + 1, q)
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = short
            p = self.link[p]
        self.link[q] = short
        return short

    def _add(self, sequence: list[bytes], template: int | None) -> int:
        last = 0
        for at, word in enumerate(sequence):
            w = self.vocab.setdefault(word, len(self.vocab) + 1)
            q = self.next[last].get(w)
            if q is not None:  # another sequence went here before
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
            else:
                new, p = self._state(self.length[last] + 1), last
                while p >= 0 and w not in self.next[p]:
                    self.next[p][w] = new
                    p = self.link[p]
                if p < 0:
                    self.link[new] = 0
                else:
                    q = self.next[p][w]
                    self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
                last = new
            if template is not None:
                self.places[last].add((template, at + 1))
        return len(sequence)

    def stream(self, ids: Sequence[int], at: int, found: list, matches: list, min_match: int) -> None:
        """Phrase occurrences and maximal matches of one run of known words that starts at word ``at``."""
        state = size = 0
        step, link, length, phrases = self.next, self.link, self.length, self.phrases
        for i, w in enumerate(ids):
            before, was = state, size
            while state and w not in step[state]:
                state = link[state]
                size = length[state]
            if w in step[state]:
                state, size = step[state][w], size + 1
            if size <= was and was >= min_match:
                matches.append((at + i - was, was, before))
            for n, label in phrases[state]:
                if n <= size:
                    found.append((at + i + 1 - n, label))
        if size >= min_match:
            matches.append((at + len(ids) - size, size, state))


class Scanner:
    def __init__(self, templates=TEMPLATES, phrases=PHRASES, min_match: int = 4, coverage: float = 0.6, gap: int = 8):
        self.automaton = Automaton(templates, phrases)
        self.min_match, self.coverage, self.gap = min_match, coverage, gap
        self.runs = re.compile(b"\x01{%d,}" % min(self.automaton.shortest, min_match))

    def scan(self, text: str) -> tuple[int, list[tuple[int, str]], list[Span]]:
        """Number of words, phrase places (start, label) in order, covered template spans."""
        own = words(text)
        vocab = self.automaton.vocab
        found: list[tuple[int, str]] = []
        matches: list[tuple[int, int, int]] = []
        for m in self.runs.finditer(bytes([w in vocab for w in own])):
            self.automaton.stream([vocab[w] for w in own[m.start() : m.end()]], m.start(), found, matches, self.min_match)
        return len(own), sorted(found), self.chain(matches)

    def chain(self, matches: list[tuple[int, int, int]]) -> list[Span]:
        """Per template, matches that follow each other in text and template, with at most ``gap`` words between."""
        by: dict[int, list[tuple[int, int, int]]] = {}
        for start, size, state in matches:
            for template, end in self.automaton.places[state]:
                by.setdefault(template, []).append((start, end - size, size))
        spans = []
        for template, parts in by.items():
            open_chains: list[list] = []  # text start, text end, template end, words, template ranges
            done = []
            for start, place, size in sorted(parts):
                done += [c for c in open_chains if c[1] + self.gap < start]
                open_chains = [c for c in open_chains if c[1] + self.gap >= start]
                fit = max((c for c in open_chains if c[1] <= start and c[2] <= place), key=lambda c: c[3], default=None)
                if fit:
                    fit[1:] = [start + size, place + size, fit[3] + size, [*fit[4], (place, place + size)]]
                else:
                    open_chains.append([start, start + size, place + size, size, [(place, place + size)]])
            for a, b, _, n, ranges in done + open_chains:
                held = all(any(x <= i and j <= y for x, y in ranges) for i, j in self.automaton.distinct[template])
                if held and n >= self.coverage * self.automaton.sizes[template]:
                    spans.append(Span(self.automaton.labels[template], a, b, n / self.automaton.sizes[template]))
        return sorted(spans, key=lambda s: (s.start, s.end, s.label))


@cache
def scanner() -> Scanner:
    return Scanner()


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<string>"
)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document; ``spans`` are covered template spans as ``label:first word:end word``.

    ``score`` is 1 with a fixed phrase, else the largest part of a template that a chain covers.
    """
    tune(docs.sparkSession)

    def run(batch: list[str]) -> dict[str, Sequence]:
        rows = []
        for text in batch:
            n, found, spans = scanner().scan(text)
            base = {label for _, label in found}
            starts = [at for at, _ in found]
            score = 1.0 if found else max((s.coverage for s in spans), default=0.0)
            rows.append((n, len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                         ",".join(sorted(base | {s.label for s in spans})), score, [f"{s.label}:{s.start}:{s.end}" for s in spans]))
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return {n: [r[i] for r in rows] for i, n in enumerate(names)}

    return per_document(texts(docs), run, SCHEMA)
