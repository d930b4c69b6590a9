"""Importance resampling against a plain computation."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from parityframe.llm import resample
from parityframe.llm.words import batches_of, crc32_after, lower_ascii
from parityframe.workspace import stage

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, runs):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), [" ".join(w[i : i + n]) for n in range(1, runs + 1) for i in range(len(w) - n + 1)]


def plain(rows, target, percent, least, buckets, runs):
    def counts(texts):
        return collections.Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t, runs)[1])

    s, t = counts([x for _, x in rows]), counts(target)
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log(((t[b] + 1) * float(all_s + buckets)) / ((s[b] + 1) * float(all_t + buckets))))
        for b in range(buckets)
    ]
    out, eligible = [], []
    for k, (doc_id, text) in enumerate(rows):
        words, own = features(text, runs)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in own) // len(own) if own else 0
        name = "" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"2024:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(own), weight, score, None])
        if words >= least:
            eligible.append(k)
    eligible.sort(key=lambda k: (-out[k][3], out[k][0] is None, out[k][0]))
    for rank, k in enumerate(eligible[: percent * len(eligible) // 100], 1):
        out[k][4] = rank
    return collections.Counter(map(tuple, out))


def corpus():
    rng = random.Random(4)
    words = "Ärger über THE la of naïve x1 日本 don't e-mail and to rows".split() + ["w" * 100]
    rows = [(k, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for k in range(150)]
    rows += [(None, None), (900, ""), (901, " \n "), (None, "the of and " * 10), (5, rows[5][1])]
    rows += [(77, "la la " * 20)] * 30 + [(None, "to to " * 20)] * 10
    return rows, [" ".join(rng.choices(words[2:8], k=30)) for _ in range(20)] + [None, ""]


@pytest.fixture(scope="module")
def tables(spark):
    rows, target = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return docs, spark.createDataFrame([(t,) for t in target], "text string")


@pytest.mark.parametrize(
    "percent, least, buckets, runs", [(10, 20, 10_000, 1), (50, 1, 7, 3), (100, 0, 100, 2), (97, 20, 1000, 1), (1, 20, 50, 1)]
)
def test_equal_to_the_plain_computation(tables, percent, least, buckets, runs):
    docs, target = tables
    made = resample.resample(docs, target, percent, least, buckets=buckets, runs=runs, keep_text=False)
    got = collections.Counter(tuple(r) for r in made.collect())
    assert got == plain(*corpus(), percent, least, buckets, runs)


def test_large_and_tied_ids_find_the_cut(spark):
    rows = [(k * 10**15 - 3 * 10**17, 5) for k in range(601)] + [(1, 4)] * 50
    table = stage(spark.createDataFrame(rows, "doc_id long, score long").coalesce(2))
    ordered = sorted(rows, key=lambda r: (-r[1], r[0]))
    for draws in (1, 300, 602):
        assert resample.cutoff(table, "doc_id", draws) == ordered[draws - 1][::-1]
    calls = []

    def counts(places):
        calls.append(len(places))
        return [1000 - p for p in places]

    assert resample.largest_true(0, 1 << 40, counts, 3) == 997 and len(calls) <= 11


def test_columns_empty_tables_and_reruns(spark, tables):
    docs, target = tables
    odd = docs.withColumns({c: F.lit("own") for c in ("score", "rank", "_row", "_text", "_place", "_words", "_key")})
    made = resample.resample(odd, target)
    assert made.columns == [
        "doc_id", "_row", "_text", "_place", "_words", "_key", "text", "n_features", "weight", "score", "rank"
    ] or set(made.columns) == {*odd.columns, "n_features", "weight", "score", "rank"}
    rows = made.collect()
    assert {r["_row"] for r in rows} == {r["_place"] for r in rows} == {"own"}
    assert collections.Counter((r["doc_id"], r["text"]) for r in rows) == collections.Counter(corpus()[0])
    again = resample.resample(docs, target).select("doc_id", "rank").collect()
    assert collections.Counter(map(tuple, again)) == collections.Counter((r["doc_id"], r["rank"]) for r in rows)
    empty = docs.limit(0)
    assert resample.resample(empty, target).count() == 0
    assert resample.resample(docs, empty).filter("rank IS NOT NULL").count() == plain_draws(corpus()[0])


def plain_draws(rows):
    return 10 * sum(features(t, 1)[0] >= 20 for _, t in rows) // 100


def test_crc_and_batches(spark):
    rng = random.Random(1)
    data = np.frombuffer(bytes(rng.randrange(256) for _ in range(5000)), np.uint8)
    starts = np.array([rng.randrange(4000) for _ in range(200)] + [7, 9])
    ends = starts + np.array([rng.choice([0, 1, 5, 63, 64, 65, 900]) for _ in range(200)] + [0, 64])
    crc = crc32_after(np.zeros(202, np.uint32), data, starts, ends)
    assert crc.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]
    more = crc32_after(crc, data, starts[::-1], ends[::-1])
    joined = zip(starts, ends, starts[::-1], ends[::-1])
    assert more.tolist() == [zlib.crc32(data[a:b].tobytes() + data[c:d].tobytes()) for a, b, c, d in joined]
    assert lower_ascii(np.frombuffer(b"AZ@[az\xc3\x84", np.uint8)).tobytes() == b"az@[az\xc3\x84"
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    with batches_of(spark, 10):
        assert spark.conf.get(key) == "10"
    assert spark.conf.get(key) == before
