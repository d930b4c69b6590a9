"""Own columns with the names that operators use inside stay as they are."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parityframe.llm import line_dedup, near_copies, secrets, urls
from parityframe.llm.words import shield

INTERNAL = {
    "op1": "_near_class _near_keep _near_copy _near_id _near_text class_id copy_id fp elements n_links".split(),
    "op3": "_a0 _a1 _a2 _a3 _base _tokens _secret _limits".split(),
    "op5": "_id _hash _gone _line_text _line_hash _line_gone _own _other key id line run first last".split(),
    "op8": "_host _path _key _shard _words0 _words1 key shard listed seen own_host".split(),
}
BLOCK = "one line of six words here\nand another line of six words there"


def with_names(df, names):
    return df.withColumns({name: F.concat(F.lit(f"{name}:"), F.col("k")) for name in names})


def check(made, names, n):
    rows = made.collect()
    assert len(rows) == n
    for r in rows:
        for name in names:
            assert r[name] == f"{name}:{r['k']}", name


@pytest.fixture(scope="module")
def docs(spark):
    texts = [BLOCK, "x\n" + BLOCK, BLOCK, None, "password = hunter2hunter2", "token AKIA" + "Z" * 20]
    rows = [(k % 4, t, str(k)) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, k string")


def test_near_copies(docs):
    names = INTERNAL["op1"]
    check(near_copies.keep_one(with_names(docs, names)), names, near_copies.keep_one(docs).count())
    single = docs.filter("k < 4")
    check(near_copies.keep_one(with_names(single, names)), names, near_copies.keep_one(single).count())


def test_secrets(docs):
    names = INTERNAL["op3"]
    plain = {r["k"]: r["spans"] for r in secrets.scan(docs).collect()}
    made = secrets.scan(with_names(docs, names).withColumnRenamed("text", "_text"), "_text")
    check(made, names, 6)
    assert {r["k"]: r["spans"] for r in made.collect()} == plain and any(plain.values())


def test_line_dedup(docs):
    names = INTERNAL["op5"]
    plain = {r["k"]: r["text"] for r in line_dedup.deduplicate(docs).collect()}
    made = line_dedup.deduplicate(with_names(docs, names).withColumnRenamed("doc_id", "_doc"), "_doc")
    check(made, names, 6)
    assert {r["k"]: r["text"] for r in made.collect()} == plain


def test_urls(spark):
    names = INTERNAL["op8"]
    pages = spark.createDataFrame([(f"http://a.net/{k % 3}", str(k)) for k in range(7)], "url string, k string")
    listed = spark.createDataFrame([("a.net/1",)], "key string")
    check(urls.judge(with_names(pages, names), listed), names, 7)
    made = urls.judge(with_names(pages, names).withColumnRenamed("url", "_url"), listed, "_url")
    assert sum(r["verdict"] == "block" for r in made.collect()) == 2
    assert {r["host"] for r in made.collect()} == {"a.net"}


def test_shield(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "_a int, own_a int, Own_b int, _b int")
    safe, new, back = shield(df)
    assert len({c.lower() for c in safe.columns}) == 4 and set(new) == {"_a", "_b"}
    assert not any(c.startswith("_") for c in safe.columns)
    assert safe.withColumnsRenamed(back).columns == df.columns
