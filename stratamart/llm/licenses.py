"""Licence scans: matching statistics of whole texts against a suffix automaton of licence wordings.

The automaton holds every run of words of every template. A text is streamed through it
once, which gives the longest template run that ends at each word. Maximal runs are
chained per template into covered spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from .common import encoded, framed, small_batches

# Phrases whose consecutive words name a licence.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Wordings of public licences and licence notices.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
)

#: Shortest run that a chain takes, largest hole in a chain, least covered share of a template.
MIN_RUN, MAX_GAP, MIN_COVER = 2, 6, 0.75

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_FOLD = bytes(b if b in _KEEP else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of ``text`` with A-Z lower-cased: all but ASCII digits, letters and other code points separates."""
    return encoded(text).translate(_FOLD).split()


class Automaton:
    """Generalised suffix automaton of word sequences, with where each state's runs end."""

    def __init__(self, sequences: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.len = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        for s, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence):
                last = self._extend(last, word)
                while len(ends) < len(self.len):
                    ends.append(set())
                ends[last].add((s, place + 1))
        for state in sorted(range(1, len(self.len)), key=lambda v: -self.len[v]):
            ends[self.link[state]] |= ends[state] if self.link[state] else set()
        self.ends = [sorted(e) for e in ends]
        self.words = frozenset(w for sequence in sequences for w in sequence)

    def _state(self, length: int, following: dict[bytes, int], link: int) -> int:
        self.len.append(length)
        self.next.append(following)
        self.link.append(link)
        return len(self.len) - 1

    def _split(self, parent: int, word: bytes) -> int:
        """The state of ``parent``'s longest run and ``word``, cut off its longer runs if need be."""
        target = self.next[parent][word]
        if self.len[target] == self.len[parent] + 1:
            return target
        copy = self._state(self.len[parent] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while parent >= 0 and self.next[parent].get(word) == target:
            self.next[parent][word] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new = self._state(self.len[last] + 1, {}, 0)
        parent = last
        while parent >= 0 and word not in self.next[parent]:
            self.next[parent][word] = new
            parent = self.link[parent]
        if parent >= 0:
            self.link[new] = self._split(parent, word)
        return new

    def statistics(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(place, length, state) of the longest run that ends at each word that a template has."""
        known, following, link, length_of = self.words, self.next, self.link, self.len
        state = length = 0
        before = -1
        for place in [i for i, w in enumerate(words) if w in known]:
            if place != before + 1:
                state = length = 0
            before, word = place, words[place]
            while state and word not in following[state]:
                state = link[state]
                length = length_of[state]
            if word in following[state]:
                state, length = following[state][word], length + 1
            yield place, length, state


class Scanner:
    """Finds phrases and covered template spans in texts."""

    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        named = [*phrases, *((text, label) for label, text in templates)]
        self.labels = [label for _, label in named]
        self.sequences = [words_of(text) for text, _ in named]
        self.phrases = len(phrases)
        self.automaton = Automaton(self.sequences)
        # Per state: the phrases that end its runs, by way of its links from short to long.
        whole = {(p, len(self.sequences[p])) for p in range(self.phrases)}
        length_of, link = self.automaton.len, self.automaton.link
        self.closing: list[list[tuple[int, int]]] = [[] for _ in length_of]
        for state in sorted(range(1, len(length_of)), key=lambda v: length_of[v]):
            own = {e for e in self.automaton.ends[state] if e in whole and e[1] <= length_of[state]}
            self.closing[state] = sorted(own.union(self.closing[link[state]]))

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, str]], list[tuple[int, int, str, float]]]:
        """Word count, base places (start, label), spans (start, end, label, covered share)."""
        words = words_of(text)
        base, runs = [], []
        before = (-2, 0, 0)
        for place, length, state in self.automaton.statistics(words):
            if length >= MIN_RUN:
                base += [(place + 1 - at, self.labels[p]) for p, at in self.closing[state] if length >= at]
            if before[1] >= MIN_RUN and (place, length) != (before[0] + 1, before[1] + 1):
                runs.append(before)
            before = (place, length, state)
        if before[1] >= MIN_RUN:
            runs.append(before)
        return len(words), base, self._chained(runs)

    def _chained(self, runs: list[tuple[int, int, int]]) -> list[tuple[int, int, str, float]]:
        """Chains of runs in the order of their template, without overlap and with small holes."""
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for place, length, state in runs:
            for s, end in self.automaton.ends[state]:
                if s >= self.phrases and end >= length:
                    by_template.setdefault(s, []).append((place + 1, end, length))
        spans = []
        for s, found in by_template.items():
            size, open_chains, best = len(self.sequences[s]), [], []
            for end, at, length in found:
                start, first, covered = end - length, end - length, length
                open_chains = [c for c in open_chains if end - length - c[0] <= MAX_GAP]
                for c_end, c_at, c_first, c_covered in open_chains:
                    shared = max(0, c_end - start, c_at - (at - length))
                    if c_end < end and c_at < at and shared < length and at - length - c_at <= MAX_GAP and c_covered + length - shared > covered:
                        first, covered = c_first, c_covered + length - shared
                open_chains = [c for c in open_chains if not (c[1] == at and c[3] <= covered and c[0] <= end)]
                open_chains.append((end, at, first, covered))
                if covered >= MIN_COVER * size:
                    best.append((first, end, covered / size))
            for first, end, share in sorted(best, key=lambda x: (-x[2], x[0], x[1])):
                if all(end <= a or first >= b for a, b, label, _ in spans if label == self.labels[s]):
                    spans.append((first, end, self.labels[s], share))
        return sorted(spans)


def scan_licenses(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """One row per row of ``docs``: doc_id, words, phrase places and template spans.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score
    (largest covered share of a template; 1.0 with a base phrase) and ``spans``, a list
    of (start, end, label, share) in words. Null texts count as empty and have no words;
    ids may be null or repeat, each row is scanned for itself; other columns are not
    read. The scan is one narrow pass over whole texts: nothing is shuffled, and the
    automaton (a few hundred words) travels with the task.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(phrases, templates)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                n, base, spans = scanner.scan(text)
                starts = [start for start, _ in base]
                own = {label for _, label in base}
                rows.append((
                    None if pd.isna(doc_id) else int(doc_id), n, len(base),
                    min(starts, default=None), max(starts, default=None), ",".join(sorted(own)),
                    ",".join(sorted(own | {label for _, _, label, _ in spans})),
                    1.0 if base else min(1.0, max((x for *_, x in spans), default=0.0)),
                    [dict(zip(("start", "end", "label", "share"), x, strict=True)) for x in spans],
                ))
            yield framed(rows, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")

    kind = docs.schema["doc_id"].dataType.simpleString()
    return small_batches(docs.select("doc_id", "text")).mapInPandas(
        scan,
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, spans array<struct<start: long, end: long, label: string, share: double>>",
    )

