"""License notices by conditional compression.

Lines of a paragraph are folded into one, without the comment marks around them, so that wrapped
notices are whole. In a sentence that speaks of licensing, windows of several widths around the
words that do so are compressed on their own and again with each template as a raw zstandard
dictionary. Text that repeats a template shrinks most with it. Templates are ranked by that
reduction, and a winner is confirmed by the differences in wording: which words were put in, left
out or changed, with numbers (versions) having to agree. A notice reaches from its first to its last
word common with the template, and over a full stop after it, however long the sentence is.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityframe.llm.words import free_name, small_batches

#: License -> sentences of its notices and of its text. Public license wording.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without restriction",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under "
        "the License is distributed on an AS IS BASIS",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0."],
    "proprietary": ["All rights reserved."],
}

#: A sentence with one of these may be a notice.
CUE = re.compile(
    r"licen[sc]e|copyright|permission is hereby|public domain|redistribut|all rights reserved"
    r"|warrant(?:y|ies)|creative commons|applicable law",
    re.I,
)
#: A word of every cue, for texts whose cues are wrapped.
_HINT = re.compile(
    r"licen[sc]e|copyright|permission|public|redistribut|reserved|warrant(?:y|ies)|creative|applicable", re.I
)
# "v. 2.0" does not end a sentence
_SENTENCE = re.compile(r"[^\n]+?(?:(?:[!?]|(?<!\b[vV])\.|(?<=\b[vV])\.(?!\s+\d))(?=\s|$)|(?=\n|$))")
_LINE = re.compile(r"^[^\n]*", re.M)
_MARK = re.compile(r"\s*(?:(?://+|/\*+|\*+(?!/)|#+|;+|--+|%+|>+|<!--+)(?=\s|$)\s*)?")
_END_MARKS = ("*/", "-->")
_WORD = re.compile(r"[0-9]+(?:\.[0-9]+)*|[^\W\d_]+")
#: Least reduction of the compressed size for a template to be looked at, and largest share of
#: its words that may differ.
LEAST_REDUCTION = 0.2
MOST_DIFFERENT = 0.25
#: Candidates are the windows of so many words to either side of a cue, within its line and its
#: sentence: a short sentence is its own window, and a notice amid many words has a narrow one.
WINDOWS = (6, 12, 24, 48)


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


@dataclass(frozen=True)
class Verdict:
    license: str
    template: int
    reduction: float
    added: int
    missing: int


class Scanner:
    """The templates' dictionaries, made once per worker."""

    def __init__(self):
        self.plain = self._codec(None)
        self.templates = [
            (name, k, words_of(text), self._codec(text))
            for name, texts in TEMPLATES.items()
            for k, text in enumerate(texts)
        ]
        self._words = {(name, k): words for name, k, words, _ in self.templates}
        self.judge = lru_cache(20_000)(self._judge)

    @staticmethod
    def _codec(template: str | None) -> zstandard.ZstdCompressor:
        params = zstandard.ZstdCompressionParameters.from_level(
            9, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_dict_id=False
        )
        if template is None:
            return zstandard.ZstdCompressor(compression_params=params)
        raw = zstandard.ZstdCompressionDict(
            template.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        return zstandard.ZstdCompressor(dict_data=raw, compression_params=params)

    def _judge(self, sentence: str) -> Verdict | None:
        raw = sentence.encode()
        alone = len(self.plain.compress(raw))
        ranked = []
        for name, k, words, codec in self.templates:
            reduction = 1 - len(codec.compress(raw)) / alone
            if reduction >= LEAST_REDUCTION:
                ranked.append((-reduction, name, k, words))
        own = words_of(sentence)
        best = None
        for reduction, name, k, words in sorted(ranked, key=lambda r: r[:3]):
            added, missing, numbers = differences(words, own)
            if numbers and missing <= MOST_DIFFERENT * len(words) and (
                best is None or added + missing < best.added + best.missing
            ):
                best = Verdict(name, k, -reduction, added, missing)
        return best

    def scan(self, text: str) -> list[tuple[int, int, Verdict]]:
        """Start, end (code points) and verdict of every confirmed notice."""
        if not _HINT.search(text):
            return []
        found = []
        for lines in _paragraphs(text):
            folded = " ".join(text[a:b] for a, b in lines)
            if not CUE.search(folded):
                continue
            begins = [0]
            for a, b in lines:
                begins.append(begins[-1] + b - a + 1)
            for sentence in _SENTENCE.finditer(folded):
                start = sentence.end() - len(sentence[0].lstrip())
                end = sentence.start() + len(sentence[0].rstrip())
                if start < end and CUE.search(folded, start, end):
                    for a, b, verdict in self._notices(folded, begins, start, end):
                        first, last = bisect_right(begins, a) - 1, bisect_right(begins, b - 1) - 1
                        found.append((lines[first][0] + a - begins[first], lines[last][0] + b - begins[last], verdict))
        return found

    def _notices(self, folded: str, begins: list[int], start: int, end: int) -> list[tuple[int, int, Verdict]]:
        """Notices of one sentence, in positions of the folded paragraph."""
        first, last = bisect_right(begins, start) - 1, bisect_right(begins, end - 1) - 1
        pieces = [(max(start, begins[k]), min(end, begins[k + 1] - 1)) for k in range(first, last + 1)]
        ranges = dict.fromkeys([*((a, b) for a, b in pieces if a < b), (start, end)])
        found = [notice for a, b in ranges for notice in self._windows(folded, a, b)]
        # of overlapping ones that with more of its template's words, then the shorter span
        kept: list[tuple[int, int, Verdict]] = []
        for a, b, verdict in sorted(found, key=lambda n: (-self._held(n[2]), n[1] - n[0], n[0])):
            if all(b <= x or y <= a for x, y, _ in kept):
                kept.append((a, b, verdict))
        return sorted(kept, key=lambda n: n[:2])

    def _windows(self, folded: str, start: int, end: int) -> list[tuple[int, int, Verdict]]:
        spans = [m.span() for m in _WORD.finditer(folded, start, end)]
        begins = [a for a, _ in spans]
        windows = {}
        for cue in CUE.finditer(folded, start, end):
            at = max(0, bisect_right(begins, cue.start()) - 1)
            for n in WINDOWS:
                a, b = spans[max(0, at - n)][0], spans[min(len(spans) - 1, at + n)][1]
                windows[a, b] = None
        judged = ((a, b, self.judge(folded[a:b])) for a, b in windows)
        return [(*self._common(folded, a, b, verdict), verdict) for a, b, verdict in judged if verdict]

    def _held(self, verdict: Verdict) -> int:
        return len(self._words[verdict.license, verdict.template]) - verdict.missing

    def _common(self, folded: str, start: int, end: int, verdict: Verdict) -> tuple[int, int]:
        """Where the first and the last word common with the template lie."""
        spans = [m.span() for m in _WORD.finditer(folded, start, end)]
        own = [folded[a:b].lower() for a, b in spans]
        words = self._words[verdict.license, verdict.template]
        blocks = [b for b in SequenceMatcher(None, words, own, autojunk=False).get_matching_blocks() if b.size]
        last = spans[blocks[-1].b + blocks[-1].size - 1][1]
        return spans[blocks[0].b][0], last + folded[last:].startswith((".", "!", "?"))


def _paragraphs(text: str) -> Iterator[list[tuple[int, int]]]:
    """Start and end of the lines of each paragraph, without indents and comment marks."""
    lines: list[tuple[int, int]] = []
    for line in _LINE.finditer(text):
        start = line.start() + _MARK.match(line[0]).end()
        body = line[0].rstrip()
        for mark in _END_MARKS:
            if body.endswith(mark):
                body = body[: -len(mark)].rstrip("*-").rstrip()
        end = line.start() + len(body)
        if start < end:
            lines.append((start, end))
        elif lines:
            yield lines
            lines = []
    if lines:
        yield lines


def differences(template: list[str], own: list[str]) -> tuple[int, int, bool]:
    """Words put in within the notice, words left out, and whether all numbers are there.

    Words before and after the notice do not count as put in. A changed word is one put in and
    one left out.
    """
    blocks = [b for b in SequenceMatcher(None, template, own, autojunk=False).get_matching_blocks() if b.size]
    if not blocks:
        return 0, len(template), False
    same = sum(b.size for b in blocks)
    first, last = blocks[0].b, blocks[-1].b + blocks[-1].size
    numbers = {w for w in template if w[0].isdigit()}
    return (last - first) - same, len(template) - same, numbers <= set(own[first:last])


_RESULT = {
    "n_notices": "bigint",
    "n_exact": "bigint",
    "licenses": "string",
    "notices": "string",
}


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the notices of every text.

    ``notices`` lists ``license:start:end:added:missing`` (code points, end exclusive) by start,
    ``licenses`` the distinct licenses by name, both comma-joined; ``n_exact`` counts notices that
    have all words of a template and no others between. A null or empty text has none. Rows and
    other columns are unchanged, repeated rows get the same result, and columns named like a
    result are replaced. One pass without a shuffle.
    """
    small_batches(docs.sparkSession)
    kept = docs.drop(*[c for c in docs.columns if c in _RESULT])
    columns = kept.columns
    body = free_name(kept, "_license_text")
    rows = kept.withColumn(body, F.coalesce(docs[text].cast("string"), F.lit("")))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields]
    schema = ", ".join(fields + [f"{n} {k}" for n, k in _RESULT.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            out = []
            for t in batch.column(body).to_pylist():
                found = scanner.scan(t)
                exact = sum(v.added + v.missing == 0 for _, _, v in found)
                listed = ",".join(f"{v.license}:{a}:{b}:{v.added}:{v.missing}" for a, b, v in found)
                names = ",".join(sorted({v.license for _, _, v in found}))
                out.append((len(found), exact, names, listed))
            values = list(zip(*out)) or [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            arrays = [batch.column(c) for c in columns]
            arrays += [pa.array(v, k) for v, k in zip(values, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, *_RESULT])

    return rows.mapInArrow(run, schema)
