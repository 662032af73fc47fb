"""Licence texts in documents by patience alignment.

Words that are unique in both a stretch of the text and the template anchor the alignment; the
longest increasing subsequence of the anchors is kept, and the gaps between its neighbours are
aligned in the same way, where more words are unique. A gap without anchors keeps what its two
sides have in common at its ends, and the rest its longest common subsequence. The share of the
template's words that are aligned is the coverage.

A text may hold a notice anywhere and more than once. The template's words that are rarest in the
text mark where copies may begin; each such place is aligned within stretches of up to three times
the template, so the work grows with the text and not with its square. Stretches end at copies
already found, so that copies side by side are all found.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpulse.llm.common import whole_text
from parcelpulse.llm.license_texts import BODIES, DISTINCT, LINES, NOTICES

#: Notices as licences ask for them, how documents name them in one line, whole texts.
TEMPLATES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "MIT line": "Released under the MIT License.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "GPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."
    ),
    "GPL line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
} | NOTICES | LINES | BODIES
WORD = regex.compile(r"[\p{L}\p{N}]+")
#: Up to so many words a template is a line: words between those aligned stand only in place of others.
LINE_WORDS = 16


@dataclass(frozen=True)
class Match:
    license: str
    start: int
    stop: int
    matched: int
    of: int

    @property
    def coverage(self) -> float:
        return self.matched / self.of


def increasing(values: list[int]) -> list[int]:
    """The places of a longest increasing subsequence, by patience sorting."""
    piles: list[int] = []
    tops: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        p = bisect_left(tops, v)
        back.append(piles[p - 1] if p else -1)
        if p == len(piles):
            piles.append(i)
            tops.append(v)
        else:
            piles[p], tops[p] = i, v
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def _common_subsequence(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of a longest common subsequence, a row of bits per word of ``a``."""
    whole = (1 << len(b)) - 1
    where: dict[str, int] = {}
    for j, w in enumerate(b):
        where[w] = where.get(w, 0) | 1 << j
    # bit j of a row is 0 where the length of the subsequence grows with b's word j
    rows, row = [whole], whole
    for w in a:
        hits = row & where.get(w, 0)
        row = ((row + hits) | (row - hits)) & whole
        rows.append(row)
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            out.append((i, j))
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of equal words, increasing on both sides."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        ours, theirs = Counter(text[a:b]), Counter(template[c:d])
        places = {w: i for i, w in enumerate(text[a:b], a) if ours[w] == 1}
        anchors = [(places[w], j) for j, w in enumerate(template[c:d], c) if theirs[w] == 1 and w in places]
        if not anchors:
            shared = [i for i in range(a, b) if text[i] in theirs]
            wanted = [j for j in range(c, d) if template[j] in ours]
            pairs = _common_subsequence([text[i] for i in shared], [template[j] for j in wanted])
            out += [(shared[i], wanted[j]) for i, j in pairs]
            continue
        kept = [anchors[i] for i in increasing([i for i, _ in anchors])]
        out += kept
        left = (a, c)
        for i, j in [*kept, (b, d)]:
            gaps.append((left[0], i, left[1], j))
            left = (i + 1, j + 1)
    return sorted(out)


class Scanner:
    def __init__(self, templates: tuple[tuple[str, str], ...], coverage: float):
        self.coverage = coverage
        self.templates = [(name, WORD.findall(body.lower())) for name, body in templates]
        self.templates = [(n, w, Counter(w)) for n, w in self.templates if w]
        self.common = set.union(set(), *(set(w) for _, w, _ in self.templates))

    def scan(self, text: str) -> list[Match]:
        """All stretches that cover a template, the best first to last by place; none overlap per template."""
        spots = [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text)]
        words = [w for w, _, _ in spots]
        places: dict[str, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.common:
                places.setdefault(w, []).append(i)
        found = []
        for name, template, counts in self.templates:
            if len(words) < self.coverage * len(template):
                continue
            present = sum(min(n, len(places.get(w, ()))) for w, n in counts.items())
            if present < self.coverage * len(template):
                continue
            missing = len(template) - int(-(-self.coverage * len(template) // 1))
            found += self._copies(name, template, counts, words, spots, places, missing)
        return sorted(found, key=lambda m: (m.start, -m.matched, m.license))

    def _copies(self, name, template, counts, words, spots, places, missing) -> list[Match]:
        # a covering copy lacks at most ``missing`` words, so it holds one of the rarest missing + 1 places
        order = sorted(counts, key=lambda w: (len(places.get(w, ())), w))
        marks: set[int] = set()
        lacked = 0
        for w in order:
            marks.update(places.get(w, ()))
            lacked += counts[w]
            if lacked > missing:
                break
        at: dict[str, list[int]] = {}
        for j, w in enumerate(template):
            at.setdefault(w, []).append(j)
        votes = Counter(mark - j for mark in marks for j in at[words[mark]])
        phrases = [p.split() for p in DISTINCT.get(name, ())]
        found = _spread(words, template, counts, votes, missing, phrases)
        return [Match(name, spots[a][1], spots[b][2], n, len(template)) for a, b, n in found]


def _spread(
    words: list[str], template: list[str], counts: Counter[str], votes: Counter[int], missing: int, phrases: list[list[str]]
) -> list[tuple[int, int, int]]:
    """(first word, last word, words aligned) of copies that do not overlap, in order of place.

    ``votes`` has the places where a copy may begin. What lies before, between and behind copies
    already found is searched again by itself, so copies that touch do not hide each other:
    copies word for word first, then stretches little longer than the template, those with the
    most votes first, then stretches three times as long.
    """
    size, found = len(template), []
    done = -1
    for start in sorted(votes):
        if done < start < len(words) and words[start] == template[0] and words[start : start + size] == template:
            done = start + size - 1
            found.append((start, done, size))
    # places where a long copy may begin are many once it lacks words: those close by share their stretches
    step = max(1, missing // 4)
    near: Counter[int] = Counter()
    for start, n in votes.items():
        near[start // step * step] += n
    order = sorted(near, key=lambda s: (-near[s], s))
    tried: dict[tuple[int, int], tuple[int, int, int] | None] = {}
    firsts, lasts = [f[0] for f in found], [f[1] for f in found]
    for slacks in ((0, missing), (size,)):
        again = True
        while again:
            again = False
            for start in order:
                lows, highs = _free(firsts, lasts, start - slacks[-1], start + step + size + slacks[-1], len(words))
                for low, high in zip(lows, highs):
                    if high - low < size - missing:
                        continue
                    best = None
                    for slack in slacks:
                        window = max(low, start - slack), min(high, start + step - 1 + size + slack)
                        if window[1] - window[0] < size - missing:
                            continue
                        if window not in tried:
                            tried[window] = _copy(words, template, counts, window, size - missing, phrases)
                        if (copy := tried[window]) and (best is None or _gain(copy) > _gain(best)):
                            best = copy
                    if best:
                        k = bisect_left(firsts, best[0])
                        firsts.insert(k, best[0])
                        lasts.insert(k, best[1])
                        found.append(best)
                        again = True
    return sorted(found)


def _free(firsts: list[int], lasts: list[int], low: int, high: int, end: int) -> tuple[list[int], list[int]]:
    """Begins and ends of the stretches between ``low`` and ``high`` that no copy covers."""
    k = max(0, bisect_left(lasts, low))
    lows, highs, begin = [], [], max(0, low)
    while k < len(firsts) and firsts[k] < high:
        lows.append(begin)
        highs.append(firsts[k])
        begin = lasts[k] + 1
        k += 1
    return [*lows, begin], [*highs, min(end, high)]


def _gain(copy: tuple[int, int, int]) -> int:
    """Words aligned less the words between them that are not."""
    first, last, n = copy
    return 2 * n - (last + 1 - first)


def _copy(
    words: list[str], template: list[str], counts: Counter[str], window: tuple[int, int], least: int, phrases: list[list[str]]
) -> tuple[int, int, int] | None:
    low, high = window
    here = Counter(words[low:high])
    if sum(min(n, here[w]) for w, n in counts.items()) < least:
        return None
    pairs = align(words[low:high], template)
    for run in (_tight(pairs), _dense(pairs, len(template))):
        if len(run) >= least and run[-1][0] - run[0][0] < 1.5 * len(template) and _told(run, template, phrases):
            return low + run[0][0], low + run[-1][0], len(run)
    return None


def _told(run: list[tuple[int, int]], template: list[str], phrases: list[list[str]]) -> bool:
    """Whether each phrase is aligned side by side somewhere, and a line has no words too many."""
    if len(template) <= LINE_WORDS and any(i - a > j - b for (a, b), (i, j) in zip(run, run[1:])):
        return False
    if not phrases:
        return True
    text_of = {j: i for i, j in run}
    return all(
        any(
            template[j : j + len(p)] == p and j in text_of and all(text_of.get(j + k) == text_of[j] + k for k in range(len(p)))
            for j in range(len(template) - len(p) + 1)
        )
        for p in phrases
    )


def _tight(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of all runs of pairs the one that gains most: a word aligned counts one, a word between less one."""
    best, begin, top = (0, 0, 0), 0, None
    for k, (i, _) in enumerate(pairs):
        if top is None or i - 2 * k > top:
            top, begin = i - 2 * k, k
        gain = 2 * k - i + top
        best = max(best, (gain + 1, -begin, k + 1))
    return pairs[-best[1] : best[2]]


def _dense(pairs: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """The pairs without stray ones: of all runs that span at most one and a half templates, the longest."""
    best, low = (0, 0), 0
    for high in range(len(pairs)):
        while pairs[high][0] - pairs[low][0] >= 1.5 * size:
            low += 1
        best = max(best, (high + 1 - low, -low))
    return pairs[-best[1] : best[0] - best[1]]


@lru_cache(maxsize=4)
def scanner(templates: tuple[tuple[str, str], ...], coverage: float) -> Scanner:
    return Scanner(templates, coverage)


FIELDS = "license string, start long, stop long, matched_words long, template_words long, coverage double"


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES, coverage: float = 0.8, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """(doc_id, matches): for each row an array of all notices found, in order of place.

    A null or empty text has none; ids may be null or repeat; other columns are left out. Start
    and stop count code points, the stop is exclusive. No shuffle, a batch of rows at a time.
    """
    listed, kind = tuple(templates.items()), dict(docs.dtypes)[id_column]
    fields = pa.struct(
        [("license", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("matched_words", pa.int64()),
         ("template_words", pa.int64()), ("coverage", pa.float64())]
    )

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = scanner(listed, coverage)
        for batch in batches:
            rows = [
                [dict(zip([f.name for f in fields], (m.license, m.start, m.stop, m.matched, m.of, m.coverage), strict=True)) for m in found.scan(t)]
                for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(fields))], ["doc_id", "matches"])

    rows = docs.select(F.col(id_column).alias("doc_id"), whole_text(text).alias("text"))
    return rows.mapInArrow(scanned, f"doc_id {kind}, matches array<struct<{FIELDS.replace(' ', ':').replace(',:', ',')}>>")
