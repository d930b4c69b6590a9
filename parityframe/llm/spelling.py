"""Groups of spelling variants: frequent words one edit apart, found in a trie of letter counts.

A word is described by how often letters of each of ``GROUPS`` letter groups occur in it. Inserting
a letter raises one count by one, deleting lowers one, replacing does both or neither. So words
one edit apart have counts that differ by a surplus of at most one and a deficit of at most one.

The words are arranged in a trie by one count after the other. Its upper part is a table: a node
over which more than ``NODE_WORDS`` words lie is an inner node, and a chain of joins takes every
word down to its leaf, and every word in the role of a query to all leaves its budget reaches. Below
such a leaf the trie is searched depth first in a task, each node with all queries that reach it,
until few words are left, which are verified letter by letter. Leaves are dealt in blocks of words
and blocks of queries, so that no task holds more than a block of each; a task returns per query the
number of near words and the best of them, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityframe.workspace import quoted, stage

MIN_LENGTH = 6
MIN_COUNT = 5
#: A word's form has this many times its occurrences, at least.
FORM_RATIO = 5
#: Letter groups: a letter's group is its code point modulo this number.
GROUPS = 16
#: Words below one leaf of the upper part, and queries dealt to it at a time.
NODE_WORDS = 2_048
QUERY_WORDS = 8_192
#: Words below a node at which the search in a task stops descending and verifies.
LEAF_WORDS = 24
#: Longest word compared in arrays; longer ones are compared one pair at a time.
ARRAY_LETTERS = 48

RUN = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALPHABET = _LOWER + "".join(map(chr, range(0xC0, 0x100)))


def word_counts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    slip: int | None = None,
) -> DataFrame:
    """Words of at least ``min_length`` letters with ``min_count`` occurrences: ``word``, ``n``.

    Words are maximal runs of a-z and U+00C0 to U+00FF, A-Z lower-cased. With ``slip``, one letter
    is deleted from each run whose hash with the document's id (null: an empty one) is divisible
    by it. A null text has no words. Counts are combined before the shuffle, so a word that makes
    a third of the text costs a row per task.
    """
    lower = f"translate(CAST({quoted(text)} AS STRING), '{_UPPER}', '{_LOWER}')"
    name = f"coalesce(CAST({quoted(doc_id)} AS STRING), '')"
    runs = docs.select(
        F.expr(name).alias("doc"),
        F.explode(F.expr(f"regexp_extract_all({lower}, '{RUN}', 0)")).alias("word"),
    ).filter(F.length("word") >= min_length)
    if slip:
        h = F.crc32(F.concat("doc", F.lit(":"), "word"))
        at = F.expr("CAST(h % length(word) AS INT)")
        cut = F.concat(F.expr("substr(word, 1, at)"), F.expr("substr(word, at + 2)"))
        runs = runs.withColumn("h", h).withColumn("at", at)
        runs = runs.withColumn("word", F.when(F.col("h") % slip == 0, cut).otherwise(F.col("word")))
        runs = runs.filter(F.length("word") >= min_length)
    return runs.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def _letters(group: int) -> str:
    return "".join(c for c in _ALPHABET if ord(c) % GROUPS == group)


def _described(words: DataFrame) -> DataFrame:
    """``words`` with ``counts``, an array of the letter counts, richest groups first.

    The order of the groups is that of their sums over all words: the first levels of the trie
    then part the words most. It has no influence on the result.
    """
    count = [F.expr(f"length(word) - length(translate(word, '{_letters(g)}', ''))") for g in range(GROUPS)]
    sums = words.agg(*(F.sum(c) for c in count)).first()
    order = sorted(range(GROUPS), key=lambda g: (-(sums[g] or 0), g))
    return words.withColumn("counts", F.array(*(count[g].cast("int") for g in order)))


def _node(depth: str) -> str:
    return f"array_join(slice(counts, 1, {depth}), ',')"


def _inner(words: DataFrame, node_words: int) -> DataFrame:
    """Nodes of the trie over more than ``node_words`` words: ``inner`` (their counts), ``depth``."""
    alike = words.groupBy("counts").agg(F.count("*").alias("words"))
    depths = alike.withColumn("depth", F.explode(F.sequence(F.lit(1), F.lit(GROUPS))))
    nodes = depths.groupBy(F.expr(_node("depth")).alias("inner"), "depth").agg(F.sum("words").alias("words"))
    return nodes.filter(F.col("words") > node_words).drop("words")


def _placed(words: DataFrame, node_words: int) -> DataFrame:
    """Every word at its leaf (``query`` false) and, as a query, at all leaves it reaches.

    Columns ``word``, ``n``, ``query``, ``node``. All rows go down together, one level a join;
    rows at a leaf stay as they are.
    """
    inner = stage(_inner(words, node_words), "spelling-inner")
    deepest = inner.agg(F.max("depth")).first()[0] or 0
    # the root counts as an inner node; a path goes one level below the deepest inner node
    rows = words.select("word", "n", "counts", F.explode(F.array(F.lit(False), F.lit(True))).alias("query"))
    rows = rows.selectExpr(
        "*", "'' AS node", "IF(query, 1, 0) AS surplus", "IF(query, 1, 0) AS deficit", "true AS open"
    )
    for depth in range(min(deepest + 1, GROUPS)):
        count = f"counts[{depth}]"
        child = "named_struct('node', {}, 'surplus', {}, 'deficit', {})".format
        name = "concat(node, IF(node = '', '', ','), CAST({} AS STRING))".format
        same = child(name(count), "surplus", "deficit")
        more = child(name(f"{count} + 1"), "surplus - 1", "deficit")
        less = child(name(f"{count} - 1"), "surplus", "deficit - 1")
        children = (
            f"concat(array({same}), IF(surplus > 0, array({more}), array()), "
            f"IF(deficit > 0 AND {count} > 0, array({less}), array()))"
        )
        stay = f"array({child('node', 'surplus', 'deficit')})"
        step = rows.withColumn("to", F.explode(F.expr(f"IF(open, {children}, {stay})")))
        rows = step.select("word", "n", "counts", "query", "to.*").join(
            inner.select("inner"), F.col("node") == F.col("inner"), "left"
        )
        rows = rows.withColumn("open", F.col("inner").isNotNull()).drop("inner")
    return rows.select("word", "n", "counts", "query", "node")


_FOUND = "word string, near bigint, form string, form_n bigint"


def near_words(words: DataFrame, node_words: int = NODE_WORDS, query_words: int = QUERY_WORDS) -> DataFrame:
    """Per word (``word``, ``n``; unique) with near words: ``near``, their number, and its form.

    ``form`` is the near word of largest ``n`` (ties: the smallest by code points) if that is
    ``FORM_RATIO`` times the word's, with ``form_n``; else both are null.
    """
    placed = stage(_placed(_described(words), node_words), "spelling-placed")
    leaves = placed.groupBy("node").agg(
        F.count_if(~F.col("query")).alias("words"), F.count_if("query").alias("queries")
    )
    leaves = leaves.filter("words > 0").selectExpr(
        "node",
        f"CAST(ceil(words / {node_words}) AS INT) AS word_blocks",
        f"CAST(ceil(queries / {query_words}) AS INT) AS query_blocks",
    )
    at = placed.join(stage(leaves, "spelling-leaves"), "node")
    # a word goes to one block of words, beside every block of queries; a query the other way round
    own = "pmod(xxhash64(word), {0})".format
    every = "explode(sequence(0, {0} - 1))".format
    as_word = at.filter("NOT query").selectExpr(
        "*", f"{own('word_blocks')} AS w", f"{every('query_blocks')} AS q"
    )
    as_query = at.filter("query").selectExpr(
        "*", f"{own('query_blocks')} AS q", f"{every('word_blocks')} AS w"
    )
    fields = "word", "n", "counts", "query", "node"
    dealt = as_word.select(*fields, "w", F.col("q").cast("bigint")).unionByName(
        as_query.select(*fields, F.col("w").cast("bigint"), "q")
    )
    found = dealt.groupBy("node", "w", "q").applyInArrow(_search, _FOUND)
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("down"), "form")))
    merged = found.groupBy("word").agg(F.sum("near").alias("near"), best.alias("best"))
    return merged.selectExpr("word", "near", "best.form", "-best.down AS form_n")


def _search(block: pa.Table) -> pa.Table:
    """Near words of the queries of a block among its words."""
    block = block.combine_chunks()
    query = block["query"].to_numpy(zero_copy_only=False)
    counts = pc.list_flatten(block["counts"]).to_numpy().reshape(len(query), GROUPS)
    text = block["word"].to_pylist()
    words = [w.encode("latin-1") for w in text]
    n = block["n"].to_numpy()
    order = np.lexsort(counts[~query].T[::-1])
    held, mine = np.flatnonzero(~query)[order], np.flatnonzero(query)
    pairs = list(_pairs(counts[held], counts[mine])) if len(held) and len(mine) else []
    left = mine[np.concatenate([p[0] for p in pairs] or [np.zeros(0, np.int64)])]
    right = held[np.concatenate([p[1] for p in pairs] or [np.zeros(0, np.int64)])]
    near = _one_edit(words, left, right)
    left, right = left[near], right[near]
    # queries in runs, the best form first in each: largest n, then smallest word
    by_word = np.empty(len(words), np.int64)
    by_word[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    rank = np.lexsort((by_word[right], -n[right], left))
    left, right = left[rank], right[rank]
    first = np.flatnonzero(np.diff(left, prepend=-1))
    mine, best = left[first], right[first]
    rare = n[best] < FORM_RATIO * n[mine]
    return pa.table(
        {
            "word": pa.array([text[k] for k in mine], pa.string()),
            "near": pa.array(np.diff(np.r_[first, len(left)]), pa.int64()),
            "form": pa.array([None if r else text[k] for r, k in zip(rare, best)], pa.string()),
            "form_n": pa.array(n[best], pa.int64(), mask=rare),
        }
    )


def _pairs(words: np.ndarray, queries: np.ndarray):
    """Pairs (query, word) whose counts differ within the budgets, from a depth-first search.

    ``words`` is sorted, so that a node is a run of its rows. A node is visited once, with the
    queries that reach it and what each has left of its surplus and its deficit.
    """
    everyone = np.arange(len(queries))
    one = np.ones(len(queries), np.int8)
    open_nodes = [(0, len(words), 0, everyone, one, one)]
    while open_nodes:
        low, high, depth, who, surplus, deficit = open_nodes.pop()
        if high - low <= LEAF_WORDS or depth == GROUPS:
            yield from _within(words, queries, low, high, depth, who, surplus, deficit)
            continue
        column = words[low:high, depth]
        starts = low + np.flatnonzero(np.r_[True, column[1:] != column[:-1]])
        own = queries[who, depth]
        for begin, end in zip(starts, [*starts[1:], high]):
            step = words[begin, depth] - own
            left_surplus, left_deficit = surplus - (step == 1), deficit - (step == -1)
            alive = (np.abs(step) <= 1) & (left_surplus >= 0) & (left_deficit >= 0)
            if alive.any():
                open_nodes.append(
                    (begin, end, depth + 1, who[alive], left_surplus[alive], left_deficit[alive])
                )


def _within(words, queries, low, high, depth, who, surplus, deficit):
    """Pairs below one node that keep to the budgets in all counts still to come."""
    rest = words[low:high, depth:]
    rows = max(1, (1 << 20) // max(1, rest.size))
    for at in range(0, len(who), rows):
        some = who[at : at + rows]
        step = rest[None, :, :] - queries[some][:, None, depth:]
        more = np.maximum(step, 0).sum(axis=2)
        less = more - step.sum(axis=2)
        fits = (more <= surplus[at : at + rows, None]) & (less <= deficit[at : at + rows, None])
        query, word = np.nonzero(fits)
        if len(query):
            yield some[query], low + word


def _one_edit(words: list[bytes], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether the words of each pair differ by exactly one edit; lengths differ by one at most."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    shorter = np.where(lengths[left] <= lengths[right], left, right)
    longer = left + right - shorter
    out = np.zeros(len(left), bool)
    small = lengths[longer] <= ARRAY_LETTERS
    for k in np.flatnonzero(~small):
        out[k] = _differ_once(words[shorter[k]], words[longer[k]])
    width = int(lengths[lengths <= ARRAY_LETTERS].max(initial=0)) + 1
    letters = np.zeros((len(words), width), np.uint8)
    for k in np.flatnonzero(lengths <= ARRAY_LETTERS):
        letters[k, : lengths[k]] = np.frombuffer(words[k], np.uint8)
    chosen = np.flatnonzero(small)
    for at in range(0, len(chosen), 1 << 17):
        some = chosen[at : at + (1 << 17)]
        a, b = letters[shorter[some]], letters[longer[some]]
        other = a != b
        same_length = lengths[shorter[some]] == lengths[longer[some]]
        replaced = same_length & (other.sum(axis=1) == 1)
        # one letter more: from the first difference on, the longer word is one letter ahead
        ahead = (a[:, :-1] != b[:, 1:]) & np.logical_or.accumulate(other, axis=1)[:, :-1]
        out[some] = replaced | (~same_length & ~ahead.any(axis=1))
    return out


def _differ_once(a: bytes, b: bytes) -> bool:
    at = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    if len(a) == len(b):
        return a != b and a[at + 1 :] == b[at + 1 :]
    return a[at:] == b[at + 1 :]


def _roots(forms: DataFrame) -> DataFrame:
    """Per word with a form the end of its chain of forms: ``word``, ``root``.

    The pointers are doubled until none moves. Each form occurs ``FORM_RATIO`` times as often as
    its word, so there are no cycles, and chains are as short as a logarithm of the counts.
    """
    roots = stage(forms.filter("form IS NOT NULL").selectExpr("word", "form AS root"), "spelling-roots")
    while True:
        further = roots.selectExpr("word AS at", "root AS next")
        moved = roots.join(further, F.col("root") == F.col("at"), "left")
        moved = stage(
            moved.selectExpr("word", "coalesce(next, root) AS root", "next IS NOT NULL AS moved"),
            "spelling-roots",
        )
        roots = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return roots


def variants(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    node_words: int = NODE_WORDS,
    query_words: int = QUERY_WORDS,
    **options,
) -> DataFrame:
    """Per frequent word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    ``n_near`` counts the frequent words exactly one inserted, deleted or replaced letter away,
    ``form`` is the most frequent of them (ties: smallest by code points) if it occurs at least
    ``FORM_RATIO`` times as often, ``root`` the last of the chain of forms (the word itself
    without one). Words and ``options`` are those of :func:`word_counts`. Other columns of
    ``docs`` play no part; repeated rows count as often as they are there; without frequent words
    the result is empty. Words whose letter counts are all equal cannot be parted by the trie:
    their blocks are compared with each other.
    """
    words = stage(word_counts(docs, doc_id, text, **options), "spelling-words")
    near = near_words(words, node_words, query_words)
    forms = words.join(near, "word", "left").selectExpr(
        "word", "n", "coalesce(near, 0L) AS n_near", "form", "form_n"
    )
    forms = stage(forms, "spelling-forms")
    joined = forms.join(_roots(forms), "word", "left")
    return joined.selectExpr("word", "form", "coalesce(root, word) AS root", "n", "n_near", "form_n")
