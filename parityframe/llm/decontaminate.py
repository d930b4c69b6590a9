"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every run of words of every test item, in space linear in the items. A
document is streamed through it word by word; the automaton's state and depth are the longest run
ending here that occurs in some item. A run as long as the window, or one that covers a whole
item shorter than the window, marks its words.

Words and items are normalised by lower-casing A-Z and taking runs of letters, digits and
non-ASCII characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityframe.llm.words import (
    LOWER_ALNUM,
    free_name,
    small_batches,
    text_blocks,
    window_hashes,
    word_hashes,
)

WINDOW = 10
#: Words of test items in one automaton (some hundred bytes each in every Python worker).
#: More items are split into several automata, through which the documents run in one chain.
AUTOMATON_WORDS = 200_000

FOUND = {
    "n_words": "bigint",
    "n_hit": "bigint",
    "items": "array<string>",
    "word_spans": "array<bigint>",
    "byte_spans": "array<bigint>",
}


class Automaton:
    """Suffix automaton of several word sequences; words are integers."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.depth = [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.windows: dict[int, set[str]] = {}  # state of a window -> items that have it
        self.wholes: dict[int, set[str]] = {}  # state of a short item -> items that are it
        for name, words in items:
            state = 0
            for i, word in enumerate(words):
                state = self.next[state][word]
                if i + 1 >= window:
                    at = self.at_window(state)
                    self.windows.setdefault(at, set()).add(name)
            if 0 < len(words) < window:
                self.wholes.setdefault(state, set()).add(name)

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.depth[known] == self.depth[last] + 1:
                return known
            return self._split(last, known, word)
        state = self._new(self.depth[last] + 1, {})
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        if p < 0:
            self.link[state] = 0
        else:
            q = self.next[p][word]
            self.link[state] = q if self.depth[q] == self.depth[p] + 1 else self._split(p, q, word)
        return state

    def _new(self, depth: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(0)
        self.depth.append(depth)
        return len(self.depth) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """A copy of state ``q`` for the shorter runs that end in ``p`` and ``word``."""
        copy = self._new(self.depth[p] + 1, dict(self.next[q]))
        self.link[copy] = self.link[q]
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def at_window(self, state: int) -> int:
        """The state of the last ``window`` words, if at least so many end in ``state``."""
        while self.depth[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def stream(self, words: list[int], found: list[tuple[int, int]], items: set[str]) -> None:
        """Add the marked runs (first word, word after) and the items of their windows."""
        state = depth = 0
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                depth = self.depth[state]
            if word not in self.next[state]:
                continue
            state = self.next[state][word]
            depth += 1
            if depth >= self.window:
                found.append((i + 1 - depth, i + 1))
                items |= self.windows[self.at_window(state)]
            if self.wholes:
                at = state
                while at > 0:
                    if at in self.wholes and self.depth[at] <= depth:
                        found.append((i + 1 - self.depth[at], i + 1))
                        items |= self.wholes[at]
                    at = self.link[at]


class Matcher:
    """An automaton with the vocabulary of its items and a filter of their word pairs.

    A word pair in no item ends every run there, so a text falls apart into stretches of known
    pairs; only stretches as long as the shortest window need to be streamed, which gives the
    same result as streaming all of the text.
    """

    def __init__(self, items: list[tuple[str, str]], window: int):
        # Equal items give the same windows; one copy of each is enough for the automaton.
        column = pa.array([text for _, text in items], pa.large_string())
        spelled: dict[bytes, int] = {}
        sequences: list[tuple[str, list[int]]] = []
        hashes: dict[int, int] = {}
        pairs: list[np.ndarray] = [np.zeros(0, np.uint64)]
        for first, data, offsets in text_blocks(column):
            starts, ends, keys, cut = word_hashes(data, offsets, LOWER_ALNUM)
            raw = data.tobytes().lower()
            for i in range(len(offsets) - 1):
                ids = []
                for j in range(cut[i], cut[i + 1]):
                    word = raw[starts[j] : ends[j]]
                    ids.append(spelled.setdefault(word, len(spelled)))
                    hashes[int(keys[j])] = ids[-1]
                sequences.append((items[first + i][0], ids))
                pairs.append(window_hashes(keys[cut[i] : cut[i + 1]], 2))
        sequences = [(name, ids) for name, ids in sequences if ids]
        self.automaton = Automaton(sequences, window)
        self.shortest = min((min(len(ids), window) for _, ids in sequences), default=0)
        self.words = list(spelled)
        self.keys = np.array(sorted(hashes), np.uint64)
        self.ids = np.array([hashes[k] for k in sorted(hashes)], np.int64)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[self._place(np.concatenate(pairs))] = True

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys & np.uint64(len(self.bits) - 1)).astype(np.int64)

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Word numbers, -1 for words of no item."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ids[at], -1)

    def match(self, raw: bytes, starts, ends, keys) -> tuple[list[tuple[int, int]], set[str]]:
        """Marked runs of one text (merged, as word positions) and the items they come from."""
        found: list[tuple[int, int]] = []
        items: set[str] = set()
        if not self.shortest or len(keys) < self.shortest:
            return found, items
        for a, b in self._stretches(keys):
            spans: list[tuple[int, int]] = []
            ids = self.lookup(keys[a:b]).tolist()
            # a hash may in theory stand for another word: compare the spelling as well
            for k, word in enumerate(ids):
                if word >= 0 and raw[starts[a + k] : ends[a + k]] != self.words[word]:
                    ids[k] = -1
            self.automaton.stream(ids, spans, items)
            found += [(a + x, a + y) for x, y in spans]
        return merged(found), items

    def _stretches(self, keys: np.ndarray) -> list[tuple[int, int]]:
        if self.shortest == 1:
            known = self.lookup(keys) >= 0
            edge = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]])))
            return list(zip(edge[::2].tolist(), edge[1::2].tolist()))
        known = self.bits[self._place(window_hashes(keys, 2))]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]])))
        first, last = edge[::2], edge[1::2] + 1
        long = last - first >= self.shortest
        return list(zip(first[long].tolist(), last[long].tolist()))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans united, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _automata(benchmark: DataFrame, item_id: str, text: str, limit: int):
    """The items in groups of at most ``limit`` words (or one item), read group by group."""
    rows = benchmark.select(
        F.col(item_id).cast("string").alias("name"), F.col(text).cast("string").alias("text")
    ).filter("text IS NOT NULL")
    words = F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    groups = max(1, -(-(rows.agg(F.sum(words)).first()[0] or 0) // limit))
    for group in range(groups):
        part = rows.filter(F.expr(f"pmod(xxhash64(name, text), {groups}) = {group}"))
        yield [(row["name"] or "", row["text"]) for row in part.toLocalIterator()]


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    automaton_words: int = AUTOMATON_WORDS,
) -> DataFrame:
    """``docs`` with the columns of ``FOUND``, rows and other columns unchanged.

    ``n_hit`` counts the words inside any occurrence of a window (``window`` consecutive words of
    an item, or all words of a shorter item), ``items`` has the items with such windows, the span
    columns hold first and last-plus-one of each marked run, flattened, in words and in bytes.

    One pass over the documents without a shuffle. The items are sent to the workers in automata
    of bounded size; if they need several, the documents pass through all of them in a chain. A
    null or empty text has no words; items without words match nothing; repeated items or
    documents count each on their own. An existing column named like a result is replaced.
    """
    small_batches(docs.sparkSession)
    result = docs.drop(*[c for c in docs.columns if c in FOUND])
    for k, items in enumerate(_automata(benchmark, item_id, item_text, automaton_words)):
        result = _pass(result, text, Matcher(items, window), first=k == 0)
    return result


def _pass(docs: DataFrame, text: str, matcher: Matcher, first: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(matcher)
    own = [c for c in docs.columns if first or c not in FOUND]
    body = free_name(docs, "_decontaminate_text")
    source = docs.withColumn(body, F.col(text).cast("string"))
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(
        [f"`{c}` {kinds[c]}" for c in own] + [f"{name} {kind}" for name, kind in FOUND.items()]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = shared.value
        for batch in batches:
            rows = []
            for start, data, offsets in text_blocks(batch.column(body)):
                starts, ends, keys, cut = word_hashes(data, offsets, LOWER_ALNUM)
                for i in range(len(offsets) - 1):
                    a, b = cut[i], cut[i + 1]
                    low = offsets[i]
                    raw = data[low : offsets[i + 1]].tobytes().lower()
                    s, e = starts[a:b] - low, ends[a:b] - low
                    spans, items = matcher.match(raw, s, e, keys[a:b])
                    if not first:
                        earlier = batch.column("word_spans")[start + i].as_py()
                        spans = merged(spans + list(zip(earlier[::2], earlier[1::2])))
                        items |= set(batch.column("items")[start + i].as_py())
                    rows.append(
                        (
                            int(b - a),
                            sum(y - x for x, y in spans),
                            sorted(items),
                            [x for span in spans for x in span],
                            [int(x) for p, q in spans for x in (s[p], e[q - 1])],
                        )
                    )
            made = list(zip(*rows)) or [()] * len(FOUND)
            types = [pa.int64(), pa.int64(), pa.list_(pa.string())] + [pa.list_(pa.int64())] * 2
            arrays = [batch.column(c) for c in own] + [pa.array(v, t) for v, t in zip(made, types)]
            yield pa.RecordBatch.from_arrays(arrays, [*own, *FOUND])

    return source.mapInArrow(run, schema)


def remove(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    length: str | None = None,
    **options,
) -> DataFrame:
    """``docs`` with the marked runs cut out of ``text``; other columns unchanged.

    A column named by ``length`` gets the code points of each text that was cut.
    A document of which no word is left is dropped, one without marked words is left as it is
    (a null or empty text too). Options as for :func:`find`.
    """
    clash = {c: free_name(docs, f"_own_{c}") for c in docs.columns if c in FOUND}
    renamed = docs.withColumnsRenamed(clash)
    body = clash.get(text, text)
    found = find(renamed, benchmark, body, **options)
    found = found.filter("n_hit = 0 OR n_hit < n_words")
    # the kept pieces lie between the ends of one span and the start of the next
    pieces = F.expr(
        f"transform(sequence(0, CAST(size(byte_spans) / 2 AS INT)), i -> substring("
        f"CAST(`{body}` AS BINARY), CAST(IF(i = 0, 0, byte_spans[2 * i - 1]) AS INT) + 1, "
        f"CAST(IF(2 * i < size(byte_spans), get(byte_spans, 2 * i), octet_length(`{body}`)) "
        f"- IF(i = 0, 0, get(byte_spans, 2 * i - 1)) AS INT)))"
    )
    joined = F.aggregate(
        F.transform(pieces, lambda p: p.cast("string")), F.lit(""), lambda a, p: F.concat(a, p)
    )
    cut = F.when(F.col("n_hit") > 0, joined).otherwise(F.col(body))
    out = found.withColumn(body, cut)
    if length:
        kind = out.schema[clash.get(length, length)].dataType
        size = F.when(F.col("n_hit") > 0, F.length(body).cast(kind))
        out = out.withColumn(clash.get(length, length), F.coalesce(size, clash.get(length, length)))
    out = out.drop(*FOUND)
    return out.withColumnsRenamed({new: old for old, new in clash.items()}).select(*docs.columns)
