"""Spelling variants against all pairs of words."""

from __future__ import annotations

import collections
import random
import re
import zlib

import numpy as np
import pytest

from parityframe.llm import spelling
from parityframe.llm.spelling import _differ_once, _one_edit, _pairs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute(rows, slip=None):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 6
    words = {w: n for w, n in counts.items() if n >= 5}
    form, near = {}, {}
    for w, n in words.items():
        others = [x for x in words if one_edit(w, x)]
        near[w] = len(others)
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, near[w], words.get(form[w])))
    return out


def corpus():
    rng = random.Random(5)
    letters = "aeinrstéÿ×q"
    base = ["".join(rng.choices(letters, k=rng.randint(6, 9))) for _ in range(40)]
    base += ["z" * 60, "ab" * 40]
    words = []
    for w in base:
        words += [w] * rng.choice([5, 30, 200])
        for _ in range(6):
            k, c = rng.randrange(len(w)), rng.choice(letters)
            changed = rng.choice([w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]])
            words += [changed] * rng.choice([1, 5, 6, 40])
    words += ["STRASSE", "straße", "Straße"] * 6
    words += ["chained"] * 900 + ["chainer"] * 90 + ["chaimer"] * 9
    rng.shuffle(words)
    sep = [" ", ". ", "\n", "-", "3"]
    texts = ["".join(w + rng.choice(sep) for w in words[at : at + 300]) for at in range(0, len(words), 300)]
    rows = [(k, t) for k, t in enumerate(texts)]
    return rows + [(None, None), (7, ""), (8, "!!"), (None, texts[0]), (0, texts[0]), (0, texts[0])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), "doc_id long, text string").repartition(4).cache()


@pytest.mark.parametrize("node_words, query_words", [(2048, 8192), (6, 15)])
def test_variants_equal_brute_force(docs, node_words, query_words):
    """With small nodes the upper trie is deep and its leaves are dealt in several blocks."""
    found = spelling.variants(docs, node_words=node_words, query_words=query_words, slip=11)
    rows = found.select("word", "form", "root", "n", "n_near", "form_n").collect()
    want = brute(corpus(), slip=11)
    assert {tuple(r) for r in rows} == want and len(rows) == len(want) > 100
    assert any(form and root != form for _, form, root, *_ in want)


def test_anagrams_are_compared_in_blocks(spark):
    rng = random.Random(9)
    words = {"".join(rng.sample("abcdefg", 7)) for _ in range(40)} | {"abcdefgg", "bcdefg", "abbdefg"}
    docs = spark.createDataFrame([(1, " ".join(sorted(words) * 5))], "doc_id long, text string")
    rows = spelling.variants(docs, node_words=10, query_words=25).collect()
    got = {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert got == brute([(1, " ".join(sorted(words) * 5))])


def test_empty_tables_and_clashing_names(spark, docs):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(empty).count() == 0
    odd = docs.selectExpr("doc_id", "text", "1 AS word", "2 AS n", "3 AS doc", "4 AS h", "5 AS counts")
    assert spelling.variants(odd).count() == spelling.variants(docs).count() > 0


def test_search_and_verification():
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("abcd", k=rng.randint(6, 8))) for _ in range(300)} | {"a" * 60, "a" * 61})
    raw = [w.encode() for w in words]
    counts = np.array([[sum(ord(c) % 16 == g for c in w) for g in range(16)] for w in words])
    order = np.lexsort(counts.T[::-1])
    found = set()
    for query, word in _pairs(counts[order], counts):
        found |= {(int(q), int(order[w])) for q, w in zip(query, word)}
    step = counts[None, :, :] - counts[:, None, :]
    fits = (np.maximum(step, 0).sum(2) <= 1) & (np.maximum(-step, 0).sum(2) <= 1)
    assert found == set(zip(*map(np.ndarray.tolist, np.nonzero(fits))))
    pairs = np.array(sorted(found))
    got = _one_edit(raw, pairs[:, 0], pairs[:, 1])
    assert got.tolist() == [one_edit(words[a], words[b]) for a, b in pairs]
    assert _differ_once(b"a" * 60, b"a" * 61) and not _differ_once(b"ab" * 30, b"ab" * 30)
