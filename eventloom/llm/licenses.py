"""Licence scan with a generalised suffix automaton over the words of licence templates.

The automaton holds every run of words of every template. Streaming a text through it gives, at each word, the longest
run ending there that some template contains (matching statistics). Maximal long matches are chained, in text and
template order, into spans; a span that covers enough of its template, and
has all the words that tell the licence from others, names it. Phrases are found by the same stream:
a phrase ends at a word when its state lies on the suffix path of the current one and the match is long enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import raw_texts, slices, text_first, words_of

# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}



def _creative_commons() -> dict[str, tuple[str, ...]]:
    """Short and long notices of the six licences in all versions, with their usual spellings."""
    parts = {
        "by": ("Attribution",), "by-sa": ("Attribution-ShareAlike", "Attribution-Share Alike"),
        "by-nd": ("Attribution-NoDerivatives", "Attribution-NoDerivs", "Attribution-No Derivative Works"),
        "by-nc": ("Attribution-NonCommercial", "Attribution-Non-Commercial", "Attribution-Noncommercial"),
        "by-nc-sa": ("Attribution-NonCommercial-ShareAlike", "Attribution-Non-Commercial-Share Alike", "Attribution-Noncommercial-Share Alike"),
        "by-nc-nd": ("Attribution-NonCommercial-NoDerivatives", "Attribution-NonCommercial-NoDerivs", "Attribution-Non-Commercial-No Derivative Works"),
    }
    out = {}
    for short, names in parts.items():
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            where = {"4.0": "International", "3.0": "Unported"}.get(version, "Generic")
            texts = [f"Licensed under CC {short} {version}.", f"creativecommons.org/licenses/{short}/{version}"]
            for name in names:
                for article in ("a", "the"):
                    texts += [f"licensed under {article} Creative Commons {name} {version} License", f"licensed under {article} Creative Commons {name} {version} {where} License"]
                texts.append(f"This work is licensed under a Creative Commons {name} {version} {where} License.")
            out[f"cc-{short}-{version}"] = tuple(dict.fromkeys(texts))
    return out


def _gnu() -> dict[str, tuple[str, ...]]:
    out = {}
    for label, name, title, versions in (
        ("gpl", "General", "GNU General Public License", ("1", "2", "3")), ("agpl", "Affero General", "GNU Affero General Public License", ("3",)),
        ("lgpl", "Lesser General", "GNU Lesser General Public License", ("2.1", "3")), ("lgpl", "Library General", "GNU Library General Public License", ("2",)),
    ):
        for version in versions:
            number = version if "." in version else f"{version}.0"
            thing = "library" if label == "lgpl" else "program"
            out[f"{label}-{number}"] = (
                f"licensed under the {title}, version {version}.", f"{title} version {version}", f"{title} v{version}", f"Licensed under {label.upper()} {number}", f"Licensed under {label.upper()}v{version}",
                f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} Public License as"
                f" published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.",
                f"This {thing} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} Public License"
                f" version {version} as published by the Free Software Foundation",
            )
    return out


# Sentences of public licences and of their usual notices, each sentence for itself.
TEMPLATES = {
    "mit": (
        "Released under the MIT License.", "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction",
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so",
    ),
    "isc": (
        "Licensed under the ISC License.", "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided"
        " that the above copyright notice and this permission notice appear in all copies.",
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.", "Released under the Apache License 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License.",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive,"
        " no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
        "Released under the BSD License.", "Licensed under the BSD License.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in"
        " the documentation and/or other materials provided with the distribution.",
        "may be used to endorse or promote products derived from this software without specific prior written permission",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at",
        "Licensed under the Mozilla Public License, version 2.0.",
        "Each Contributor hereby grants You a world-wide, royalty-free, non-exclusive license under intellectual property rights (other than"
        " patent or trademark) Licensable by such Contributor",
    ),
    "cc0-1.0": (
        "Licensed under CC0 1.0.", "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication", "creativecommons.org/publicdomain/zero/1.0",
        "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to"
        " the work worldwide under copyright law",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a"
        " compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    **_gnu(),
    **_creative_commons(),
}
#: Shortest match, in words, that may take part in a span (whole templates of fewer words always may).
SHORTEST = 3
#: Words that may lie between two matches of one span, in the text and in the template.
GAP = 4
#: Words that tell licences apart, with the one-digit numbers of versions: see ``Scanner.told``.
TELLING = frozenset(
    b"nc nd sa noncommercial commercial noderivatives noderivs derivatives derivative derivs sharealike alike lesser library affero mit"
    b" apache bsd isc mpl mozilla gpl lgpl agpl cc0 zero".split()
)
#: Share of a template's words that a span must cover.
COVERED = 0.75


class Automaton:
    """Suffix automaton of several word sequences, with the phrases that end on each state's suffix path."""

    def __init__(self, templates: list[list[bytes]], phrases: list[list[bytes]]) -> None:
        self.numbers: dict[bytes, int] = {}
        sequences = [[self.numbers.setdefault(w, len(self.numbers) + 1) for w in s] for s in [*templates, *phrases]]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for sequence in sequences:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        # Where a state's runs end in the templates, spread from longer states to the shorter ones on their suffix path.
        self.ends: list[set[tuple[int, int]]] = [set() for _ in self.next]
        for t, sequence in enumerate(sequences[: len(templates)]):
            state = 0
            for i, word in enumerate(sequence):
                state = self.next[state][word]
                self.ends[state].add((t, i + 1))
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]
        own: dict[int, list[tuple[int, int]]] = {}
        for p, sequence in enumerate(sequences[len(templates) :]):
            state = 0
            for word in sequence:
                state = self.next[state][word]
            own.setdefault(state, []).append((p, len(sequence)))
        self.phrases: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for state in sorted(range(1, len(self.next)), key=lambda s: self.length[s]):
            above = self.phrases[self.link[state]] if self.link[state] > 0 else []
            self.phrases[state] = own.get(state, []) + above

    def _new(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """A state for the runs of ``q`` up to the length that ``p`` gives it."""
        copy = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, word: int) -> int:
        q = self.next[last].get(word)
        if q is not None:  # the run is already there, from an earlier sequence
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, word)
        state, p = self._new(self.length[last] + 1, 0, {}), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
        return state

    def stream(self, numbers: list[int]) -> Iterator[tuple[int, int, int]]:
        """(place, state, matched length) at every word with a match; nothing is said for words of no template."""
        follow, link, lengths = self.next, self.link, self.length
        state = matched = 0
        for i, word in enumerate(numbers):
            if not word:
                state = matched = 0
                continue
            while state and word not in follow[state]:
                state = link[state]
                matched = lengths[state]
            if word in follow[state]:
                state = follow[state][word]
                matched += 1
                yield i, state, matched
            else:
                matched = 0


class Scanner:
    """Templates and phrases ready for scanning."""

    def __init__(self, templates: dict[str, tuple[str, ...]], phrases: dict[str, str], shortest: int, gap: int, covered: float) -> None:
        self.names = [name for name, texts in templates.items() for _ in texts]
        words = [words_of(t.encode()) for texts in templates.values() for t in texts]
        self.words, self.sizes = words, [len(w) for w in words]
        self.labels = list(phrases.values())
        self.automaton = Automaton(words, [words_of(p.encode()) for p in phrases])
        self.shortest, self.gap, self.covered = shortest, gap, covered

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[int, int, str]], list[tuple[int, int, str, float]]]:
        """Number of words, phrase places (start, end, label) and template spans (start, end, name, coverage)."""
        automaton = self.automaton
        get = automaton.numbers.get
        words = words_of(text)
        numbers = [get(w, 0) for w in words]
        places, matches = [], []
        before = None
        for i, state, matched in automaton.stream(numbers) if any(numbers) else ():
            for p, size in automaton.phrases[state]:
                if matched >= size:
                    places.append((i + 1 - size, i + 1, self.labels[p]))
            if before and not (before[0] == i - 1 and matched == before[2] + 1):
                matches.append(before)  # the match before could not be extended to here
            before = (i, state, matched)
        if before:
            matches.append(before)
        spans = self._chain([m for m in matches if m[2] >= self.shortest], words)
        return len(numbers), sorted(places), spans

    def told(self, t: int, first: int, end: int, words: list[bytes]) -> bool:
        """Whether the text between two places tells the same licence as the template.

        All telling words of the template must be there in order, each with its neighbours, and no other ones. Version
        numbers count in templates that have some. Neither may the text go on with a telling word that is not the template's.
        """
        own = self.words[t]
        digits = any(len(w) == 1 and w.isdigit() for w in own)

        def telling(w: bytes) -> bool:
            return w in TELLING or (digits and len(w) == 1 and w.isdigit())

        inside = words[first:end]
        at, here = [i for i, w in enumerate(own) if telling(w)], [i for i, w in enumerate(inside) if telling(w)]
        if [own[i] for i in at] != [inside[i] for i in here]:
            return False
        for i, j in zip(at, here, strict=True):
            if i and (not j or own[i - 1] != inside[j - 1]) or i + 1 < len(own) and own[i + 1] != (inside[j + 1] if j + 1 < len(inside) else None):
                return False
        after = words[end] if end < len(words) else b""
        return not (after in TELLING or (len(own[-1]) == 1 and own[-1].isdigit() and len(after) == 1 and after in b"123456789")) or not at

    def _chain(self, matches: list[tuple[int, int, int]], words: list[bytes]) -> list[tuple[int, int, str, float]]:
        """Chain matches of one template whose text and template places both go on with small gaps."""
        open_spans: dict[int, list[list[int]]] = {}
        done: list[tuple[int, int, int, int]] = []
        for i, state, matched in matches:
            start, end = i + 1 - matched, i + 1
            for t, t_end in self.automaton.ends[state]:
                t_start = t_end - matched
                kept = []
                joined = None
                for span in open_spans.get(t, []):
                    first, last, t_last, count = span
                    if start - last > self.gap:
                        done.append((t, first, last, count))
                        continue
                    kept.append(span)
                    skip = max(0, last - start, t_last - t_start)  # words that both already hold
                    if t_start + skip >= t_last and t_start - t_last <= self.gap and skip < matched and (joined is None or count > joined[3]):
                        joined = span
                if joined is not None:
                    skip = max(0, joined[1] - start, joined[2] - t_start)
                    joined[1], joined[2], joined[3] = end, t_end, joined[3] + matched - skip
                else:
                    kept.append([start, end, t_end, matched])
                open_spans[t] = kept
        for t, spans in open_spans.items():
            done += [(t, first, last, count) for first, last, _, count in spans]
        good = [(t, first, last, count) for t, first, last, count in done if count >= self.covered * self.sizes[t] and self.told(t, first, last, words)]
        # Of overlapping spans those stay that cover most words; equal ones all stay.
        best: dict[tuple[int, int, str], float] = {}
        kept: list[tuple[int, int, int]] = []
        for t, first, last, count in sorted(good, key=lambda g: -g[3]):
            if any(first < y and x < last and n > count for x, y, n in kept):
                continue
            kept.append((first, last, count))
            key = (first, last, self.names[t])
            best[key] = max(count / self.sizes[t], best.get(key, 0.0))
        return sorted((a, b, name, min(1.0, share)) for (a, b, name), share in best.items())


@lru_cache(maxsize=4)
def _scanner(*settings) -> Scanner:
    templates, phrases, shortest, gap, covered = settings
    return Scanner(dict(templates), dict(phrases), shortest, gap, covered)


_PLACES = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("label", pa.string())]))
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("template", pa.string()), ("covered", pa.float64())]))
SCAN_TYPE = (
    "n_words long, places array<struct<first:int,end:int,label:string>>,"
    " spans array<struct<first:int,end:int,template:string,covered:double>>"
)


def scan_licenses(
    docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, phrases: dict[str, str] = PHRASES,
    text: str = "text", keep: tuple[str, ...] = ("doc_id",), shortest: int = SHORTEST, gap: int = GAP, covered: float = COVERED,
) -> DataFrame:
    """``keep``, n_words, phrase ``places`` and template ``spans`` (words from 0, end exclusive) of every whole text.

    Null and empty texts have no words, places or spans. Of overlapping spans those that cover most words are
    reported; of equal spans of one template the better coverage stays. The templates are parameters of a few kilobytes.
    """
    settings = (tuple(templates.items()), tuple(phrases.items()), shortest, gap, covered)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(*settings)
        for whole in batches:
            for batch in slices(whole, 0):
                found = [scanner.scan(t) for t in raw_texts(batch.column(0))]
                places = [[{"first": a, "end": b, "label": c} for a, b, c in p] for _, p, _ in found]
                spans = [[{"first": a, "end": b, "template": c, "covered": s} for a, b, c, s in p] for _, _, p in found]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[1:], pa.array([n for n, _, _ in found], pa.int64()), pa.array(places, _PLACES), pa.array(spans, _SPANS)],
                    names=[*keep, "n_words", "places", "spans"],
                )

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + [SCAN_TYPE])
    return text_first(docs, text, keep).mapInArrow(run, schema)


def digests(scanned: DataFrame) -> DataFrame:
    """Counts, first and last phrase, labels and a score: the share of a template covered, 1 where a phrase stands."""
    base = F.array_sort(F.array_distinct("places.label"))
    every = F.array_sort(F.array_distinct(F.concat("places.label", "spans.template")))
    score = F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("spans.covered"), F.lit(0.0)))
    return scanned.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places.first").cast("long").alias("first_word"),
        F.array_max("places.first").cast("long").alias("last_word"), F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"), score.alias("score"),
    )
