"""Line dedup by pairwise alignment of documents that share lines.

Lines are compared by the hash of their stripped content. Each line that several documents hold
names the first of them as the partner of all others, so a line is one pair per holder however
many hold it, rare or not. Partners are aligned with patience diff: lines that occur once in both
are anchors, the longest chain of anchors in equal order is kept, the gaps between are aligned
alike. Runs of aligned lines with enough words are deleted from the later document; the earliest
holder of a line always keeps it.

Alignment sees one partner per line, in one order. The blocks it misses are covered by short runs:
of consecutive lines the fewest from each line on, and up to each line, that have enough words. A
run that an earlier document holds too, anywhere, is deleted from the later one. Every block of
enough words is made of such runs, so no pairs of documents are needed for them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityframe.llm.words import (
    NOT_SPACE,
    free_name,
    mix,
    shield,
    small_batches,
    text_blocks,
    word_hashes,
)
from parityframe.workspace import stage

#: Words a line must have to point to a partner, and a run of aligned lines to be deleted.
LINE_WORDS = 5
BLOCK_WORDS = 8


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of two sequences (patience diff), ascending in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_a, once_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {x: i for i, x in enumerate(b[b0:b1], b0) if once_b[x] == 1}
        anchors = [(i, place[x]) for i, x in enumerate(a[a0:a1], a0) if once_a[x] == 1 and x in place]
        chain = _rising(anchors)
        if not chain:
            continue
        before = (a0, b0)
        for i, j in chain:
            todo.append((before[0], i, before[1], j))
            out.append((i, j))
            before = (i + 1, j + 1)
        todo.append((before[0], a1, before[1], b1))
    return sorted(out)


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs (already rising in the first part) that rises in the second."""
    ends: list[int] = []
    where: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(ends, j)
        back[k] = where[at - 1] if at else -1
        ends[at : at + 1] = [j]
        where[at : at + 1] = [k]
    chain = []
    k = where[-1] if where else -1
    while k >= 0:
        chain.append(pairs[k])
        k = back[k]
    return chain[::-1]


def common_blocks(
    earlier: list[int], later: list[int], words: list[int], block_words: int = BLOCK_WORDS
) -> list[int]:
    """Positions in ``later`` of aligned runs with at least ``block_words`` words."""
    gone: list[int] = []
    block: list[int] = []
    last = (-2, -2)
    for pair in [*align(earlier, later), (-9, -9)]:
        if pair != (last[0] + 1, last[1] + 1):
            if sum(words[j] for j in block) >= block_words:
                gone += block
            block = []
        block.append(pair[1])
        last = pair
    return gone


def _lines(rows: DataFrame) -> DataFrame:
    """``key``, ``hashes`` and ``words``: hash and number of words of every line with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, words = [], []
            for _, data, offsets in text_blocks(batch.column("text")):
                starts, _, keys, cut = word_hashes(data, offsets, NOT_SPACE)
                ends = np.flatnonzero(data == 10)
                line = np.searchsorted(ends, starts)
                made, n, row = _line_hashes(keys, line, cut)
                for i in range(len(offsets) - 1):
                    hashes.append(made[row[i] : row[i + 1]])
                    words.append(n[row[i] : row[i + 1]])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(hashes, pa.list_(pa.int64())),
                    pa.array(words, pa.list_(pa.int32())),
                ],
                ["key", "hashes", "words"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, hashes array<bigint>, words array<int>")


def _line_hashes(keys: np.ndarray, line: np.ndarray, cut: np.ndarray):
    """Hash and number of words of every line with a word, and where each row's lines begin."""
    if not len(keys):
        none = np.zeros(0, np.int64)
        return none, none.astype(np.int32), np.zeros(len(cut), np.int64)
    new = np.ones(len(keys), bool)
    new[1:] = line[1:] != line[:-1]
    new[cut[:-1][cut[:-1] < len(keys)]] = True  # a row's first word begins a line
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(keys)))
    place = np.arange(len(keys)) - np.repeat(first, n)
    hashes = mix(np.add.reduceat(mix(keys + mix(place.astype(np.uint64))), first))
    return hashes.view(np.int64), n.astype(np.int32), np.searchsorted(first, cut)


def run_hashes(hashes: np.ndarray, words: np.ndarray, block_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first line and number of lines of the shortest runs with ``block_words`` words."""
    total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    ends = np.searchsorted(total, total[:-1] + block_words)  # from each line on
    starts = np.searchsorted(total, total[1:] - block_words, side="right") - 1  # up to each line
    lines = np.arange(len(words))
    forward = np.stack([lines, ends], 1)[ends <= len(words)]
    backward = np.stack([starts, lines + 1], 1)[starts >= 0]
    spans = np.unique(np.concatenate([forward, backward]), axis=0)
    first, n = spans[:, 0], spans[:, 1] - spans[:, 0]
    plain = hashes.view(np.uint64)
    made = n.astype(np.uint64)
    for place in range(int(n.max(initial=0))):
        inside = n > place
        made[inside] = mix(made[inside] + mix(plain[first[inside] + place]))
    return made.view(np.int64), first, n


def _runs(lines: DataFrame, block_words: int) -> DataFrame:
    """``key``, ``run``, ``start`` and ``n``: a row per run of ``run_hashes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for k in range(batch.num_rows):
                hashes, words = (batch.column(c)[k].values.to_numpy() for c in ("hashes", "words"))
                made, first, n = run_hashes(hashes, words, block_words)
                found.append((np.full(len(made), k), made, first, n))
            if found:
                row, made, first, n = (np.concatenate(part) for part in zip(*found))
                keys = batch.column("key").take(pa.array(row))
                arrays = [keys, pa.array(made), pa.array(first, pa.int32()), pa.array(n, pa.int32())]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "run", "start", "n"])

    kind = lines.schema["key"].dataType.simpleString()
    return lines.select("key", "hashes", "words").mapInArrow(run, f"key {kind}, run bigint, start int, n int")


def _aligned(pairs: DataFrame, block_words: int) -> DataFrame:
    """``key`` and ``gone``: positions (among lines with a word) to delete from a later document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("first", "later", "words")]
            gone = [common_blocks(a, b, w, block_words) for a, b, w in zip(*columns)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(gone, pa.list_(pa.int32()))], ["key", "gone"]
            )

    kind = pairs.schema["key"].dataType.simpleString()
    return pairs.mapInArrow(run, f"key {kind}, gone array<int>")


def deduplicate(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    line_words: int = LINE_WORDS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with common blocks cut from later documents, and ``n_lines`` and ``n_deleted``.

    The order of documents is their id, then the hash of their text; rows equal in both are one
    document and get the same text. A null id comes first. Lines without a word are neither
    compared nor deleted; a null text stays null, with no lines. Lines repeated within a document
    stay unless an earlier document holds their block; then each copy of it goes. Other columns are unchanged, columns named like a result are replaced.

    The lines of every document are stored once as hashes. Pairs, alignments and runs work on these;
    the texts are shuffled once, to meet the positions to delete.
    """
    safe, names, back = shield(docs)
    made = _deduplicate(safe, names.get(doc_id, doc_id), names.get(text, text), line_words, block_words)
    return made.withColumnsRenamed(back)


def _deduplicate(docs: DataFrame, doc_id: str, text: str, line_words: int, block_words: int) -> DataFrame:
    spark = docs.sparkSession
    small_batches(spark)
    key = F.struct(F.col(doc_id).alias("id"), F.xxhash64(F.col(text).cast("string")).alias("hash"))
    rows = docs.select(key.alias("key"), F.col(text).cast("string").alias("text"))
    lines = stage(_lines(rows).dropDuplicates(["key"]), "lines")
    told = lines.selectExpr(
        "key", f"explode(array_distinct(transform(filter(arrays_zip(hashes, words), x -> x.words >= {line_words}), x -> x.hashes))) AS line"
    )
    shared = told.groupBy("line").agg(F.min("key").alias("first"), F.count("*").alias("n"))
    shared = stage(shared.filter("n > 1").drop("n"), "shared-lines")
    pairs = told.join(shared, "line").filter("NOT key <=> first").select("key", "first").distinct()
    runs = _runs(lines, block_words)
    first = runs.groupBy("run").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    first = stage(first.filter("NOT first <=> last").drop("last"), "shared-runs")
    held = runs.join(first, "run").filter("NOT key <=> first")
    held = held.selectExpr("key", "sequence(start, start + n - 1) AS gone")
    aligned = _aligned(_with_lines(pairs, lines), block_words).filter("size(gone) > 0")
    gone = aligned.unionByName(held).groupBy("key").agg(
        F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone")
    )
    gone = stage(gone.selectExpr("key.id AS _id", "key.hash AS _hash", "gone AS _gone"), "deleted-lines")
    return _cut(docs, gone, doc_id, text)


def _with_lines(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """The lines of both documents beside each pair: ``later`` with ``words``, and ``first``."""
    own = lines.selectExpr("key AS _own", "hashes AS later", "words")
    other = lines.selectExpr("key AS _other", "hashes AS first_lines")
    out = pairs.join(own, F.expr("key.hash = _own.hash AND key.id <=> _own.id"))
    out = out.join(other, F.expr("first.hash = _other.hash AND first.id <=> _other.id"))
    return out.selectExpr("key", "first_lines AS first", "later", "words")


def _cut(docs: DataFrame, gone: DataFrame, doc_id: str, text: str) -> DataFrame:
    made = ["n_lines", "n_deleted"]
    body, mark = free_name(docs, "_line_text"), free_name(docs, "_line_hash")
    lost = free_name(docs, "_line_gone")
    rows = docs.drop(*[c for c in docs.columns if c in made])
    columns = rows.columns
    rows = rows.withColumns({body: F.col(text).cast("string"), mark: F.xxhash64(F.col(text).cast("string"))})
    gone = gone.withColumnRenamed("_gone", lost)
    joined = rows.join(gone, F.expr(f"`{mark}` = _hash AND `{doc_id}` <=> _id"), "left")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    kinds[text] = "string"
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in columns] + [f"{c} bigint" for c in made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, total, deleted = [], [], []
            for t, positions in zip(batch.column(body).to_pylist(), batch.column(lost).to_pylist()):
                all_lines = (t or "").split("\n")
                # white space is what separates words: space and tab to carriage return
                full = [k for k, x in enumerate(all_lines) if x.strip(" \t\n\x0b\x0c\r")]
                out = {full[k] for k in positions or ()}
                if out:
                    t = "\n".join(x for k, x in enumerate(all_lines) if k not in out)
                texts.append(t)
                total.append(len(full))
                deleted.append(len(out))
            arrays = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in columns]
            arrays += [pa.array(total, pa.int64()), pa.array(deleted, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, *made])

    return joined.select(*columns, body, lost).mapInArrow(run, schema)
