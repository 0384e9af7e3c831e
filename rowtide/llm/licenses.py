"""Licence scans: a suffix automaton over the words of licence templates."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.common import texts_of

# Phrases whose places are counted, and their labels.
PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)

# Passages of well-known licences and notices, with the labels of the method.
TEMPLATES = (
    (
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions",
    ),
    (
        "bsd-text",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    (
        "isc-text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies",
    ),
    (
        "apache-notice",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at",
    ),
    ("apache-short", "Licensed under the Apache License, Version 2.0"),
    (
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version",
    ),
    ("gpl-short", "licensed under the GNU General Public License, version 3"),
    (
        "mpl-notice",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at",
    ),
    ("mit-short", "Released under the MIT License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("all-rights-reserved", "All rights reserved"),
)

# Bytes that belong to words: digits, letters, and all of a character beyond ASCII.
_WORD_BYTES = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Words of a text, A to Z in lower case."""
    return text.lower().translate(_WORD_BYTES).split()


@dataclass
class SuffixAutomaton:
    """All substrings of several word sequences, with where they end.

    ``ends`` holds for each state the sequences and positions at which its words end.
    """

    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    ends: list[set[tuple[int, int]]] = field(default_factory=lambda: [set()])

    def _state(self, length: int, like: int | None = None) -> int:
        self.step.append({} if like is None else dict(self.step[like]))
        self.link.append(-1 if like is None else self.link[like])
        self.length.append(length)
        self.ends.append(set())
        return len(self.step) - 1

    def _split(self, state: int, symbol: int, reached: int) -> int:
        """The state for the words of ``state`` and ``symbol`` alone, apart from longer ones."""
        if self.length[state] + 1 == self.length[reached]:
            return reached
        copy = self._state(self.length[state] + 1, reached)
        self.link[reached] = copy
        while state >= 0 and self.step[state].get(symbol) == reached:
            self.step[state][symbol] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, symbol: int) -> int:
        if symbol in self.step[last]:
            return self._split(last, symbol, self.step[last][symbol])
        new = self._state(self.length[last] + 1)
        at = last
        while at >= 0 and symbol not in self.step[at]:
            self.step[at][symbol] = new
            at = self.link[at]
        self.link[new] = 0 if at < 0 else self._split(at, symbol, self.step[at][symbol])
        return new

    def add(self, sequence: int, symbols: Iterable[int]) -> int:
        """Takes a sequence in and returns the state of all its words."""
        last, marks = 0, []
        for position, symbol in enumerate(symbols):
            last = self._extend(last, symbol)
            marks.append((position, symbol))
        state = 0
        for position, symbol in marks:
            state = self.step[state][symbol]
            self.ends[state].add((sequence, position))
        return state

    def close(self) -> None:
        """Hands the ends of longer words down to their suffixes."""
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]


@dataclass(frozen=True)
class LicenseScanner:
    """Templates and phrases, and when a chain of matches counts as a template's span.

    ``shortest`` is the least number of words in a match that is chained, ``gap`` the most words
    between two matches, ``coverage`` the share of the template that a span's matches must have.
    """

    phrases: tuple[tuple[str, str], ...] = PHRASES
    templates: tuple[tuple[str, str], ...] = TEMPLATES
    shortest: int = 3
    gap: int = 8
    coverage: float = 0.6

    @cached_property
    def _index(self):
        numbers: dict[bytes, int] = {}
        automaton = SuffixAutomaton()
        lengths, phrase_states = [], []
        for number, (_, text) in enumerate((*self.phrases, *self.templates)):
            words = words_of(text.encode())
            lengths.append(len(words))
            state = automaton.add(number, [numbers.setdefault(w, len(numbers)) for w in words])
            if number < len(self.phrases):
                phrase_states.append(state)
        automaton.close()
        # The phrases that end wherever a state is reached with enough words.
        complete = []
        for state in range(len(automaton.link)):
            at, found = state, []
            while at > 0:
                found += [
                    (p, lengths[p]) for p, own in enumerate(phrase_states) if own == at and lengths[p]
                ]
                at = automaton.link[at]
            complete.append(tuple(found))
        # Only templates are chained. For each state and template, the state of the longest of its
        # words' endings that the template has, and where in the template that ends.
        first = len(self.phrases)
        inside: list[dict[int, tuple[int, tuple[int, ...]]]] = [{} for _ in automaton.link]
        for state in sorted(range(1, len(automaton.link)), key=lambda s: automaton.length[s]):
            inside[state].update(inside[automaton.link[state]])
            for template in {t for t, _ in automaton.ends[state] if t >= first}:
                places = sorted(e for t, e in automaton.ends[state] if t == template)
                inside[state][template] = state, tuple(places)
        return numbers, automaton, complete, inside, lengths

    def scan(self, text: bytes) -> dict:
        """Phrase places, and spans of templates as ``label, start, end, covered`` (a share)."""
        numbers, automaton, complete, inside, lengths = self._index
        words = words_of(text)
        known = np.fromiter(map(numbers.get, words, _Missing()), np.int32, len(words))
        places: list[tuple[int, int]] = []
        matches: list[tuple[int, int, int, tuple[int, ...]]] = []
        shortest = min([self.shortest, *(n for n in lengths if n)], default=self.shortest)
        for low, high in _runs(known >= 0, shortest):
            self._walk(known[low:high].tolist(), low, automaton, complete, inside, places, matches)
        spans = self._chain(matches, lengths)
        starts = [start for _, start in places]
        base = {self.phrases[p][0] for p, _ in places}
        labels = base | {s["label"] for s in spans}
        score = max([1.0 if places else 0.0, *(s["covered"] for s in spans)])
        return {
            "n_words": len(words),
            "n_base": len(places),
            "first_word": min(starts, default=None),
            "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(labels)),
            "score": float(min(score, 1.0)),
            "spans": spans,
        }

    def _walk(self, run, low, automaton, complete, inside, places, matches) -> None:
        """Matching statistics of a run of known words. For each template the matches that cannot
        be longer in it are kept, also within a longer match of another one."""
        step, link, length = automaton.step, automaton.link, automaton.length
        state = size = 0
        for offset, symbol in enumerate(run):
            while state > 0 and symbol not in step[state]:
                state = link[state]
                size = length[state]
            if symbol in step[state]:
                state = step[state][symbol]
                size += 1
            for phrase, words in complete[state]:
                if size >= words:
                    places.append((phrase, low + offset - words + 1))
            if size < self.shortest:
                continue
            after = run[offset + 1] if offset + 1 < len(run) else None
            for template, (own, ends) in inside[state].items():
                n = min(size, length[own])
                longer = step[own].get(after)
                if n >= self.shortest and not (longer and inside[longer].get(template, (0,))[0] == longer):
                    matches.append((template, low + offset + 1 - n, n, ends))

    def _chain(self, matches, lengths) -> list[dict]:
        """Matches in one order in text and template, close together, joined to spans.

        A match goes to the span of most words that it can follow, or opens another one.
        """
        open_spans: dict[int, list[dict]] = {}
        done = []
        first = len(self.phrases)
        for template, start, size, ends in matches:
            spans = open_spans.setdefault(template, [])
            done += [s for s in spans if start - s["end"] > self.gap]
            spans[:] = [s for s in spans if start - s["end"] <= self.gap]
            last = max(ends) - size + 1
            before = [s for s in spans if start >= s["end"] and last >= s["next"]]
            if before:
                span = max(before, key=lambda s: s["words"])
                span["words"] += size
                span["end"] = start + size
                span["next"] = min(e + 1 for e in ends if e - size + 1 >= span["next"])
            else:
                spans.append(
                    {
                        "template": template,
                        "start": start,
                        "end": start + size,
                        "next": min(ends) + 1,
                        "words": size,
                    }
                )
        done += [s for spans in open_spans.values() for s in spans]
        spans = [
            {
                "label": self.templates[s["template"] - first][0],
                "start": s["start"],
                "end": s["end"],
                "covered": min(s["words"] / lengths[s["template"]], 1.0),
            }
            for s in done
        ]
        kept = [s for s in spans if s["covered"] >= self.coverage]
        return sorted(kept, key=lambda s: (s["start"], s["end"], s["label"]))

    def column(self, text: Column) -> Column:
        """The scan of a text column, as a struct."""
        sent = SparkSession.getActiveSession().sparkContext.broadcast(self)

        @F.arrow_udf(_SCHEMA_TEXT)
        def licenses(texts: pa.Array) -> pa.Array:
            scanner = sent.value
            return pa.array([scanner.scan(t) for t in texts_of(texts)], _SCHEMA)

        return licenses(text.cast("binary"))


_SCHEMA_TEXT = (
    "struct<n_words: long, n_base: long, first_word: long, last_word: long, base_labels: string, "
    "labels: string, score: double, "
    "spans: array<struct<label: string, start: long, end: long, covered: double>>>"
)
_SCHEMA = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        (
            "spans",
            pa.list_(
                pa.struct(
                    [
                        ("label", pa.string()),
                        ("start", pa.int64()),
                        ("end", pa.int64()),
                        ("covered", pa.float64()),
                    ]
                )
            ),
        ),
    ]
)


class _Missing:
    """An endless supply of the number of a word that no template has."""

    def __iter__(self):
        return self

    def __next__(self):
        return -1


def _runs(known: np.ndarray, shortest: int) -> list[tuple[int, int]]:
    """First and last-but-one index of runs of known words that can hold a match."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
    low, high = edges[::2], edges[1::2]
    long = high - low >= shortest
    return list(zip(low[long].tolist(), high[long].tolist(), strict=True))


def scan_licenses(
    docs: DataFrame, scanner: LicenseScanner | None = None, *, text: str = "text", found: str = "licenses"
) -> DataFrame:
    """All rows of ``docs`` with a struct ``found``: counts and places of the phrases, labels,
    score and covered spans (words counted from 0, the end after the last).

    A text is read once, word by word, against all templates together. Null and empty texts have
    no words, no labels and score 0; repeated rows get equal results. The score is the largest
    share of a template that is covered, 1 for a whole phrase. A column of ``docs`` named like
    the result is replaced.
    """
    scanner = scanner or LicenseScanner()
    return docs.withColumn(found, scanner.column(F.col(text)))
