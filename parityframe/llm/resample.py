"""Importance resampling: draw the documents that look most like a target corpus.

Features are runs of 1 to ``runs`` words, hashed into ``buckets``. A bucket's gain is the log of
the ratio of its shares in the target and in the documents, a document's weight the mean gain of
its features, its score the weight plus Gumbel noise from the hash of its id: the highest scores
are a sample without replacement in proportion to ``exp(weight / 1000)``.

Three tables are kept: the buckets of every document, its score, the drawn rows. Gains are an array
of ``buckets`` numbers, the only thing that passes through the driver besides counts. Nothing is
sorted to find the cut: exact count jobs over the stored scores halve the interval of scores, then,
among the rows that tie there, the interval of ids. Only drawn rows are sorted, in ranges; a row's
rank is its place in its range plus the rows of the ranges before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from parityframe.llm.words import (
    LOWER_ALNUM,
    batches_of,
    crc32_after,
    free_name,
    lower_ascii,
    text_blocks,
    word_hashes,
)
from parityframe.workspace import quoted, stage

BUCKETS = 10_000
RUNS = 1
SEED = "2024"
MIN_WORDS = 20
#: Halvings of an interval that one count job answers: it counts at ``2 ** STEPS - 1`` places.
STEPS = 4
#: Bits in which a partition's rows are numbered by ``monotonically_increasing_id``.
_PLACE_BITS = 33


@dataclass(frozen=True)
class Names:
    """The columns of a table of scores, named so that none is one of the documents' own."""

    row: str
    key: str
    words: str
    buckets: str


def _bucket_lists(texts: pa.Array, buckets: int, runs: int) -> tuple[pa.Array, pa.Array]:
    """Number of words of every text, and the buckets of its features."""
    counts, lists = [], []
    for _, data, offsets in text_blocks(texts):
        starts, ends, _, cut = word_hashes(data, offsets, LOWER_ALNUM)
        lower = lower_ascii(data)
        n = np.diff(cut)
        counts.append(n)
        rows = np.repeat(np.arange(len(n)), n)
        left = np.repeat(cut[1:], n) - np.arange(len(starts))  # words from here to the text's end
        first = np.arange(len(starts))
        crc = crc32_after(np.zeros(len(starts), np.uint32), lower, starts, ends)
        found, owners = [crc], [rows]
        for size in range(2, runs + 1):
            more = left[first] >= size
            first, crc = first[more], crc[more]
            space, one = np.frombuffer(b" ", np.uint8), np.ones(len(first), np.int64)
            crc = crc32_after(crc, space, one - 1, one)
            crc = crc32_after(crc, lower, starts[first + size - 1], ends[first + size - 1])
            found.append(crc)
            owners.append(rows[first])
        owner = np.concatenate(owners)
        values = (np.concatenate(found) % np.uint32(buckets)).astype(np.int32)
        if runs > 1:
            values = values[np.argsort(owner, kind="stable")]
        ends_at = np.cumsum(np.bincount(owner, minlength=len(n)))
        lists.append(
            pa.ListArray.from_arrays(pa.array(np.r_[0, ends_at], pa.int32()), pa.array(values, pa.int32()))
        )
    words = np.concatenate([np.zeros(0, np.int64), *counts])
    return pa.array(words, pa.int64()), pa.concat_arrays([pa.array([], pa.list_(pa.int32())), *lists])


def _hashed(rows: DataFrame, text: str, names: Names, buckets: int, runs: int) -> DataFrame:
    """``rows`` without the text, with the columns ``words`` and ``buckets`` of ``names``."""
    others = [c for c in rows.columns if c != text]
    plain = rows.select(*map(quoted, others), F.col(quoted(text)).cast("string").alias(names.words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = _bucket_lists(batch.column(names.words), buckets, runs)
            arrays = [*batch.columns[:-1], *made]
            yield pa.RecordBatch.from_arrays(arrays, [*others, names.words, names.buckets])

    schema = StructType(plain.schema.fields[:-1])
    schema = schema.add(names.words, LongType()).add(names.buckets, ArrayType(IntegerType()))
    return plain.mapInArrow(run, schema)


def _counts(hashed: DataFrame, buckets: str, name: str) -> DataFrame:
    each = hashed.select(F.explode(buckets).alias("bucket"))
    return each.groupBy("bucket").agg(F.count("*").alias(name))


def gains(docs: DataFrame, target: DataFrame, bucket: str, buckets: int) -> list[int]:
    """``floor(1000 * ln(...))`` of the smoothed share in the target over that in the documents.

    Both frames hold arrays of buckets in the column ``bucket``. ``buckets`` numbers are returned.
    """
    spark = docs.sparkSession
    every = spark.range(buckets).withColumnRenamed("id", "bucket")
    both = every.join(_counts(docs, bucket, "s"), "bucket", "left").join(
        _counts(target, bucket, "t"), "bucket", "left"
    )
    rows = both.select("bucket", *(F.coalesce(c, F.lit(0)).alias(c) for c in "st")).collect()
    total_s, total_t = sum(r["s"] for r in rows), sum(r["t"] for r in rows)
    counted = spark.createDataFrame(rows, "bucket bigint, s bigint, t bigint")
    ratio = (
        f"((CAST(t AS DOUBLE) + 1) * ({total_s}D + {buckets})) "
        f"/ ((CAST(s AS DOUBLE) + 1) * ({total_t}D + {buckets}))"
    )
    made = counted.selectExpr("bucket", f"CAST(floor(1000D * ln({ratio})) AS BIGINT) AS gain")
    found = {r["bucket"]: r["gain"] for r in made.collect()}
    return [found[b] for b in range(buckets)]


def weigh(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    runs: int = RUNS,
    seed: str = SEED,
) -> tuple[DataFrame, Names]:
    """``docs`` with ``n_features``, ``weight`` and ``score``, as a stored table, and its own names.

    The text and own columns of ``docs`` with one of these three names are not kept. A null text has no words:
    no features, weight 0. A null id is hashed as an empty one. Repeated rows are rows of their
    own. An empty target or table has counts of 0.
    """
    results = ("n_features", "weight", "score")
    rows = docs.drop(*(c for c in docs.columns if c.lower() in results))
    names = Names(*(free_name(rows, n) for n in ("_row", "_key", "_words", "_buckets")))
    others = [c for c in rows.columns if c != text]
    name = f"coalesce(CAST({quoted(doc_id)} AS STRING), '')"
    h = f"CAST(conv(substr(sha2(concat('{seed}:', {name}), 256), 1, 8), 16, 10) AS DOUBLE)"
    noise = f"CAST(floor(-1000D * ln(-ln(({h} + 0.5D) / 4294967296D))) AS BIGINT)"
    hashed = _hashed(rows, text, names, buckets, runs)
    hashed = hashed.withColumns(
        {names.key: F.expr(noise), names.row: F.monotonically_increasing_id()}
    )
    with batches_of(docs.sparkSession):
        kept = stage(hashed, "resample-buckets")
        wanted = _hashed(target.select(target_text), target_text, names, buckets, runs)
        wanted = stage(wanted, "resample-target")
    array = ",".join(map(str, gains(kept, wanted, names.buckets, buckets)))
    total = (
        f"aggregate({quoted(names.buckets)}, 0L, "
        f"(sum, b) -> sum + CAST(split('{array}', ',') AS ARRAY<BIGINT>)[b])"
    )
    # floor of the mean in integers: SQL's div rounds toward 0
    scored = kept.withColumn("n_features", F.size(names.buckets).cast("bigint"))
    scored = scored.withColumn(names.buckets, F.expr(total))
    mean = f"({quoted(names.buckets)} - pmod({quoted(names.buckets)}, n_features)) div n_features"
    scored = scored.withColumn("weight", F.expr(f"IF(n_features = 0, 0L, {mean})"))
    scored = scored.withColumn("score", F.col("weight") + F.col(names.key))
    scored = scored.select(*others, *results, names.row, names.words)
    return stage(scored, "resample-scores"), names


def largest_true(low: int, high: int, counts: Callable[[list[int]], list[int]], least: int) -> int:
    """The largest ``x`` in ``[low, high)`` with ``counts([x])[0] >= least``; it holds at ``low``.

    ``counts`` falls as its argument rises. Each call narrows the interval ``2 ** STEPS`` times.
    """
    while high - low > 1:
        parts = min(1 << STEPS, high - low)
        places = [low + (high - low) * k // parts for k in range(1, parts)]
        answers = counts(places)
        for place, n in zip(places, answers):
            if n >= least:
                low = place
            else:
                high = place
                break
    return low


def _counter(rows: DataFrame, condition: Callable[[int], Column]) -> Callable[[list[int]], list[int]]:
    return lambda places: list(rows.agg(*(F.count_if(condition(p)) for p in places)).first())


def cutoff(rows: DataFrame, doc_id: str, draws: int) -> tuple[int, int | None]:
    """Score and id of the last of the ``draws`` best rows (highest scores, then smallest ids).

    ``rows`` is a stored table with an integer ``score``; there are at least ``draws`` rows, and
    one at least is drawn. A null id comes after all others, and is None here.
    """
    low, high = rows.agg(F.min("score"), F.max("score")).first()
    score = largest_true(low, high + 1, _counter(rows, lambda p: F.col("score") >= p), draws)
    missing = draws - rows.filter(F.col("score") > score).count()
    tied = rows.filter(F.col("score") == score)
    key = F.col(doc_id)
    ids = tied.agg(F.count(key), F.min(key), F.max(key)).first()
    if ids[0] < missing:
        return score, None
    # over negated ids the count of ids that are as good or better falls as well
    last = largest_true(-ids[2], -ids[1] + 1, _counter(tied, lambda p: key <= -p), missing)
    return score, -last


def ranked(rows: DataFrame, doc_id: str, row: str) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, 3... by falling score, then id (nulls last), then ``row``."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("score"), F.asc_nulls_last(doc_id), F.asc(row)]
    place, part, before = (free_name(rows, n) for n in ("_place", "_part", "_before"))
    sorted_rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = stage(sorted_rows.withColumn(place, F.monotonically_increasing_id()), "resample-drawn")
    in_part = F.shiftright(place, _PLACE_BITS)
    sizes = placed.groupBy(in_part.alias(part)).agg(F.count("*").alias(before))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = sizes.select(part, F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before))
    joined = placed.withColumn(part, in_part).join(stage(starts, "resample-ranges"), part)
    inside = F.col(place).bitwiseAND((1 << _PLACE_BITS) - 1)
    return joined.withColumn("rank", F.col(before) + inside + 1).drop(place, part, before)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    min_words: int = MIN_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_text: bool = True,
    **options,
) -> DataFrame:
    """``docs`` with ``n_features``, ``weight``, ``score`` and ``rank`` (null where not drawn).

    Of the N documents with ``min_words`` words or more, ``floor(percent * N / 100)`` are drawn:
    those of the highest scores, ties to the smaller ``doc_id`` (an integer, null last). Rows
    equal in both differ in nothing the draw looks at; if only some of them fit, any of them are
    drawn. Own columns of ``docs`` with a result's name are not kept; ``keep_text`` says whether
    the text is. Other ``options`` are those of :func:`weigh`. A table in which nothing is drawn
    (empty, or all documents short) has null ranks only.
    """
    body = docs.drop(*(c for c in docs.columns if c.lower() == "rank"))
    copy = free_name(body, "_text")
    body = body.withColumn(copy, F.col(text))
    if not keep_text:
        body = body.drop(text)
    scores, names = weigh(body, target, doc_id, copy, **options)
    eligible = scores.filter(F.col(names.words) >= min_words)
    draws = percent * eligible.count() // 100
    out = [*(c for c in scores.columns if c not in (names.row, names.words)), "rank"]
    if not draws:
        return scores.withColumn("rank", F.lit(None).cast("bigint")).select(*out)
    score, last = cutoff(eligible, doc_id, draws)
    fits = F.lit(True) if last is None else F.coalesce(F.col(doc_id) <= last, F.lit(False))
    chosen = (F.col(names.words) >= min_words) & (
        (F.col("score") > score) | ((F.col("score") == score) & fits)
    )
    drawn = ranked(scores.filter(chosen), doc_id, names.row)
    within = F.when(F.col("rank") <= draws, F.col("rank")).cast("bigint")
    rest = scores.filter(~chosen).withColumn("rank", F.lit(None).cast("bigint"))
    return drawn.withColumn("rank", within).select(*out).unionByName(rest.select(*out))
