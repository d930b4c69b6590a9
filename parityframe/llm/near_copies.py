"""Near copies: Jaccard join on word shingles through a MinHash LSH forest, verified exactly.

Each document is the set of its runs of five words. Documents with equal sets are one *class*;
all further work is on one row per class.

*Forest.* A class gets ``TREES`` labels of ``DEPTH`` MinHash values. A tree is the trie of one of
the labels: classes that share a prefix are a subtree. Matching starts with whole labels and
shortens the prefix value by value, so that every class first meets those most like it, down to
the prefix length at which a pair at the threshold shares a prefix in some tree with the target
probability (:func:`shortest_prefix`). Classes in one such subtree are candidates.

*Families.* Pairs within a subtree are not listed, since a subtree may hold a third of all rows.
Each class follows the class it meets most often to the root of a family, and is written as the
difference of its set from the root's, which is short for near copies. Counting in a family:

    common(a, b) = |root| - |a-| - |b-| + |a- and b-| + |a+ and b+|

so with ``weight(a) = (p + q) |a-| + p |a|`` for the threshold p / q, a and b surely are linked if
``weight(a) + weight(b) <= (p + q) |root|``. Links of this kind are counted from the histogram of
weights. Only the remaining pairs, among the heavy classes, look at the differences themselves,
block by block, where a block is a bounded number of classes.

*Between families.* Where a subtree holds several families, signatures are compared block by
block; pairs that can reach the threshold (by six standard deviations) are verified on their sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityframe.llm.words import (
    LOWER_ALNUM,
    free_name,
    mix,
    small_batches,
    text_blocks,
    window_hashes,
    word_hashes,
)
from parityframe.workspace import Scope, stage

SHINGLE = 5
THRESHOLD = (4, 5)  # p / q
TREES = 16
DEPTH = 6
TARGET_RECALL = 0.999
BLOCK = 400
#: Bytes of an intermediate table that one task writes.
FILE_BYTES = 32 << 20

_VALUES = TREES * DEPTH
_FACTORS = mix(np.arange(1, _VALUES + 1, dtype=np.uint64)) | np.uint64(1)
_SHIFTS = mix(np.arange(1001, _VALUES + 1001, dtype=np.uint64))


def shortest_prefix(threshold: float, target: float) -> int:
    """The longest prefix at which a pair at the threshold meets with the target probability."""
    for length in range(DEPTH, 0, -1):
        if 1 - (1 - threshold**length) ** TREES >= target:
            return length
    return 1


def shingles(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of five-word runs; a shorter text is one run, an empty one none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(words, min(SHINGLE, len(words))))


def signature(elements: np.ndarray) -> bytes:
    """The labels of all trees, 32 bits a value."""
    low = np.full(_VALUES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(elements), 2048):
        part = elements[at : at + 2048, None] * _FACTORS[None, :] + _SHIFTS[None, :]
        low = np.minimum(low, part.min(axis=0))
    return (low >> np.uint64(32)).astype(">u4").tobytes()


def fingerprint(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    for _, data, offsets in text_blocks(column):
        _, _, hashes, cut = word_hashes(data, offsets, LOWER_ALNUM)
        for i in range(len(offsets) - 1):
            yield shingles(hashes[cut[i] : cut[i + 1]])


def _per_text(docs: DataFrame, text: str, made: dict[str, str], of) -> DataFrame:
    """``docs`` with columns ``made`` that ``of`` takes from each text's set, ``text`` dropped."""
    small_batches(docs.sparkSession)
    body = free_name(docs, "_near_text")
    source = docs.withColumn(body, F.col(text).cast("string"))
    kept = [c for c in docs.columns if c != text]
    source = source.select(*kept, body)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in kept] + [f"{n} {k}" for n, k in made.items()])
    types = [_ARROW[k] for k in made.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [of(elements) for elements in _sets(batch.column(body))]
            values = list(zip(*rows)) or [()] * len(types)
            arrays = [batch.column(c) for c in kept]
            arrays += [pa.array(v, t) for v, t in zip(values, types)]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, *made])

    return source.mapInArrow(run, schema)


_ARROW = {"binary": pa.binary(), "int": pa.int32()}


def _sketch(elements: np.ndarray) -> tuple:
    if not len(elements):
        return None, 0, None
    return fingerprint(elements), len(elements), signature(elements)


def _whole(elements: np.ndarray) -> tuple:
    return (fingerprint(elements) if len(elements) else None), elements.tobytes()


def _keep(df: DataFrame, name: str, size: int) -> DataFrame:
    """:func:`stage` in files of about ``FILE_BYTES`` for a table of about ``size`` bytes.

    ``size`` follows from the rows and shingles of the documents. A table with more bytes gets
    larger files, which tasks write row by row.

    Most tables here are short rows per class. Without this each would be written by as many
    tasks as the shuffle before it has partitions, which are set for whole texts.
    """
    least = df.sparkSession.sparkContext.defaultParallelism
    return stage(df.coalesce(max(least, -(-size // FILE_BYTES))), name)


# --- connected components ----------------------------------------------------------------


def components(edges: DataFrame, size: int) -> DataFrame:
    """``node`` and the smallest node it is connected with as ``label``; ``edges`` has a and b.

    In each round, a written table, a node takes the smallest label of its neighbours and of the
    node its own label names, until none changes. ``size``: see :func:`_keep`.
    """
    both = edges.unionByName(edges.selectExpr("b AS a", "a AS b")).distinct()
    both = _keep(both, "edges", size)
    labels = both.groupBy("a").agg(F.min("b").alias("b"))
    labels = _keep(labels.selectExpr("a AS node", "least(a, b) AS label"), "labels", size)
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a")
        near = seen.agg(F.min("label").alias("near")).withColumnRenamed("a", "node")
        up = labels.selectExpr("node AS label", "label AS above")
        new = labels.join(near, "node").join(up, "label", "left").selectExpr(
            "node", "label AS old", "least(label, near, above) AS label"
        )
        labels = _keep(new, "labels", size)
        if labels.filter("label < old").isEmpty():
            return labels.drop("old")
        labels = labels.drop("old")


# --- the forest --------------------------------------------------------------------------


def _subtrees(classes: DataFrame, shortest: int, size: int) -> DataFrame:
    """``fp``, ``run`` (a subtree with company) and ``leader``, the class to follow there.

    The leader is the smallest fingerprint among those sharing the longest matched prefix.
    """
    def key(length: int) -> str:
        return f"xxhash64(tree, substring(sig, tree * {4 * DEPTH} + 1, {4 * length}))"

    trees = classes.selectExpr("fp", f"explode(sequence(0, {TREES - 1})) AS tree", "sig")
    rows = trees.selectExpr("fp", *[f"{key(d)} AS run{d}" for d in range(shortest, DEPTH + 1)])
    shared = f"run{shortest}"
    met = rows.groupBy(shared).agg(F.count("*").alias("n"), F.min("fp").alias(f"lead{shortest}"))
    rows = rows.join(met.filter("n > 1").drop("n"), shared)
    rows = _keep(rows, "forest", TREES * size)
    for d in range(shortest + 1, DEPTH + 1):
        met = rows.groupBy(f"run{d}").agg(F.count("*").alias("n"), F.min("fp").alias(f"lead{d}"))
        rows = rows.join(met.filter("n > 1").drop("n"), f"run{d}", "left")
    leads = ", ".join(f"lead{d}" for d in range(DEPTH, shortest - 1, -1))
    rows = rows.selectExpr("fp", f"{shared} AS run", f"coalesce({leads}) AS leader")
    return _keep(rows, "subtrees", TREES * size)


def _families(met: DataFrame, size: int) -> DataFrame:
    """``fp`` and ``root``: the end of the chain of most often met leaders."""
    votes = met.groupBy("fp", "leader").agg(F.count("*").alias("n"))
    best = votes.groupBy("fp").agg(F.max_by("leader", F.struct("n", "leader")).alias("root"))
    return _ends(_keep(best, "roots", size), size)


def _ends(roots: DataFrame, size: int) -> DataFrame:
    """``fp`` and ``root`` with every root replaced by the last one that following it leads to."""
    while True:
        up = roots.selectExpr("fp AS root", "root AS above")
        jumped = roots.join(up, "root", "left").selectExpr(
            "fp", "coalesce(above, root) AS root", "coalesce(above < root, false) AS moved"
        )
        roots = _keep(jumped, "roots", size)
        if roots.filter("moved").isEmpty():
            return roots.drop("moved")
        roots = roots.drop("moved")


def _united(met: DataFrame, families: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """``families`` with those joined that meet in a subtree and whose roots are alike.

    Each root looks at the smallest root of every subtree its family is in, and follows the one
    whose signature agrees most, if that is half of the values or more. This keeps large groups
    of near copies in few families; families that stay apart lose nothing.
    """
    half = _VALUES // 2
    value = "substring({}, 4 * k + 1, 4)"
    agree = F.expr(
        f"size(filter(sequence(0, {_VALUES - 1}), k -> {value.format('sig')} = {value.format('sig2')}))"
    )
    signatures = classes.select("fp", "sig")
    seen = met.select("fp", "run").join(families, "fp").select("run", "root").distinct()
    first = seen.groupBy("run").agg(F.min("root").alias("lead"), F.max("root").alias("hi"))
    asked = seen.join(first.filter("lead < hi"), "run").filter("lead < root")
    asked = asked.select("root", "lead").distinct()
    asked = asked.join(signatures.withColumnsRenamed({"fp": "root"}), "root")
    asked = asked.join(signatures.withColumnsRenamed({"fp": "lead", "sig": "sig2"}), "lead")
    votes = asked.select("root", "lead", agree.alias("n")).filter(f"n >= {half}")
    moves = votes.groupBy("root").agg(F.max_by("lead", F.struct("n", "lead")).alias("lead"))
    moves = moves.withColumnsRenamed({"root": "fp", "lead": "root"})
    ends = _ends(_keep(moves, "moves", size), size)
    moved = families.join(ends.selectExpr("fp AS root", "root AS end"), "root", "left")
    return _keep(moved.selectExpr("fp", "coalesce(end, root) AS root"), "families", size)


def _differences(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``members`` (fp, root, copies) with ``n``, ``root_n``, ``minus`` and ``plus`` (sorted hashes)."""
    own = members.join(sets, "fp").withColumnRenamed("elements", "own")
    rows = own.join(sets.selectExpr("fp AS root", "elements AS base"), "root")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for own, base in zip(*(batch.column(c).to_pylist() for c in ("own", "base"))):
                a, b = np.frombuffer(own, np.uint64), np.frombuffer(base, np.uint64)
                common = np.isin(a, b, assume_unique=True)
                minus = b[~np.isin(b, a, assume_unique=True)]
                out.append((len(a), len(b), minus.tobytes(), a[~common].tobytes(), len(minus)))
            values = list(zip(*out)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
            arrays = [batch.column(c) for c in ("fp", "root", "copies")]
            arrays += [pa.array(v, t) for v, t in zip(values, kinds)]
            names = ["fp", "root", "copies", "n", "root_n", "minus", "plus", "n_minus"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return rows.select("fp", "root", "copies", "own", "base").mapInArrow(
        run,
        "fp binary, root binary, copies bigint, n bigint, root_n bigint, minus binary, "
        "plus binary, n_minus bigint",
    )


# --- counting ----------------------------------------------------------------------------


def _sure_links(family: DataFrame) -> DataFrame:
    """``fp`` and ``links``: documents surely linked with each class, itself included if so."""
    sums = family.groupBy("root", "weight").agg(
        F.sum("copies").alias("c"), F.max("bound").alias("bound")
    )
    values = sums.selectExpr("root", "weight AS v", "c", "false AS asks", "weight")
    limits = sums.selectExpr("root", "bound - weight AS v", "0L AS c", "true AS asks", "weight")
    running = values.unionByName(limits).selectExpr(
        "*",
        "sum(c) OVER (PARTITION BY root ORDER BY v, asks "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS links",
    )
    answers = running.filter("asks").select("root", "weight", "links")
    return family.join(answers, ["root", "weight"]).select("fp", "links")


def _blocks(rows: DataFrame, group: str) -> DataFrame:
    """Rows copied to every pair of blocks of their group: ``pair``, ``low``, ``high``, ``block``.

    Blocks are dealt by hash and hold about ``BLOCK`` rows, and each pair of blocks is dealt to
    tasks on its own, so a group of any size is spread.
    """
    sizes = rows.groupBy(group).agg(F.count("*").alias("size"))
    sized = rows.join(sizes, group).selectExpr("*", f"CAST(ceil(size / {BLOCK}) AS INT) AS blocks")
    dealt = sized.selectExpr("*", "CAST(pmod(xxhash64(fp), blocks) AS INT) AS block")
    paired = dealt.selectExpr("*", "explode(sequence(0, blocks - 1)) AS other")
    ends = paired.selectExpr("*", "least(block, other) AS low", "greatest(block, other) AS high")
    # rows lie where their group's key put them: without an exchange by the pair of blocks all
    # pairs of a group would stay in one task
    return ends.withColumn("pair", F.xxhash64(group, "low", "high")).repartition("pair")


def _arrays(table: pa.Table, name: str) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in table.column(name).to_pylist()]


def _overlap(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set."""
    out = np.zeros((len(left), len(right)), np.float32)
    mine, theirs = (np.concatenate([*x, np.zeros(0, np.uint64)]) for x in (left, right))
    shared = np.intersect1d(mine, theirs)
    for at in range(0, len(shared), 8192):
        part = shared[at : at + 8192]
        out += _incidence(left, mine, part) @ _incidence(right, theirs, part).T
    return out


def _incidence(sets: list[np.ndarray], flat: np.ndarray, part: np.ndarray) -> np.ndarray:
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    column = np.minimum(np.searchsorted(part, flat), len(part) - 1)
    hit = part[column] == flat
    made = np.zeros((len(sets), len(part)), np.float32)
    made[owner[hit], column[hit]] = 1
    return made


def _close_links(family: DataFrame, both: int) -> DataFrame:
    """``fp``, ``links``, ``a``: links that need the differences, and a class of each linked group."""
    heaviest = family.groupBy("root").agg(F.max("weight").alias("heaviest"))
    heavy = family.join(heaviest, "root").filter("weight + heaviest > bound").drop("heaviest")
    dealt = _blocks(heavy.select("fp", "root", "copies", "weight", "bound", "minus", "plus"), "root")

    def run(table: pa.Table) -> pa.Table:
        same = table.column("low")[0].as_py() == table.column("high")[0].as_py()
        block = np.array(table.column("block").to_pylist())
        left = np.flatnonzero(block == table.column("low")[0].as_py())
        right = left if same else np.flatnonzero(block != table.column("low")[0].as_py())
        weight = np.array(table.column("weight").to_pylist(), np.int64)
        copies = np.array(table.column("copies").to_pylist(), np.int64)
        bound = table.column("bound")[0].as_py()
        total = weight[left][:, None] + weight[right][None, :]
        linked = np.zeros(total.shape, bool)
        if (total > bound).any():
            overlap = np.zeros(total.shape, np.float32)
            for name in ("minus", "plus"):
                sets = _arrays(table, name)
                overlap += _overlap([sets[i] for i in left], [sets[i] for i in right])
            linked = (total > bound) & (total <= bound + both * overlap.astype(np.int64))
            if same:
                np.fill_diagonal(linked, False)
        fp = table.column("fp").to_pylist()
        links = np.zeros(len(fp), np.int64)
        links[left] += linked @ copies[right]
        if not same:
            links[right] += linked.T @ copies[left]
        label = np.arange(len(fp))
        while True:  # the smallest position of each linked group
            new = label.copy()
            for i, k in enumerate(left):
                others = right[linked[i]]
                if len(others):
                    low = min(new[k], new[others].min())
                    new[k] = low
                    new[others] = low
            if (new == label).all():
                break
            label = new
        some = np.flatnonzero(links)
        return pa.table(
            {
                "fp": pa.array([fp[i] for i in some], pa.binary()),
                "links": pa.array(links[some], pa.int64()),
                "a": pa.array([fp[label[i]] for i in some], pa.binary()),
            }
        )

    grouped = dealt.groupBy("pair", "root", "low", "high")
    return grouped.applyInArrow(run, "fp binary, links bigint, a binary")


def _foreign_pairs(met: DataFrame, families: DataFrame, classes: DataFrame, threshold: float):
    """Pairs (a < b) of different families in one subtree whose signatures agree well enough."""
    spread = math.sqrt(threshold * (1 - threshold) / _VALUES)
    least = math.floor((threshold - 6 * spread) * _VALUES)
    rows = met.select("fp", "run").join(families, "fp")
    mixed = rows.groupBy("run").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    rows = rows.join(mixed.filter("lo < hi").select("run"), "run")
    rows = rows.join(classes.select("fp", "sig"), "fp")
    dealt = _blocks(rows.select("fp", "root", "run", "sig"), "run")

    def run(table: pa.Table) -> pa.Table:
        low, high = (table.column(c)[0].as_py() for c in ("low", "high"))
        block = np.array(table.column("block").to_pylist())
        left = np.flatnonzero(block == low)
        right = left if low == high else np.flatnonzero(block == high)
        fp = np.array(table.column("fp").to_pylist(), dtype=object)
        root = np.unique(np.array(table.column("root").to_pylist(), "S16"), return_inverse=True)[1]
        raw = b"".join(table.column("sig").to_pylist())
        sig = np.frombuffer(raw, np.uint32).reshape(len(fp), _VALUES)
        agree = np.zeros((len(left), len(right)), np.int16)
        for k in range(_VALUES):
            agree += sig[left, k][:, None] == sig[right, k][None, :]
        ok = (agree >= least) & (root[left][:, None] != root[right][None, :])
        i, j = np.nonzero(ok)
        pairs = {tuple(sorted(p)) for p in zip(fp[left[i]], fp[right[j]])}
        return pa.table(
            {
                "a": pa.array([p[0] for p in pairs], pa.binary()),
                "b": pa.array([p[1] for p in pairs], pa.binary()),
            }
        )

    return dealt.groupBy("pair", "run", "low", "high").applyInArrow(run, "a binary, b binary").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, p: int, q: int) -> DataFrame:
    """The pairs whose sets reach the threshold."""
    rows = pairs.join(sets.selectExpr("fp AS a", "elements AS x"), "a")
    rows = rows.join(sets.selectExpr("fp AS b", "elements AS y"), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(*(batch.column(c).to_pylist() for c in ("x", "y"))):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = int(np.isin(x, y, assume_unique=True).sum())
                good.append((p + q) * common >= p * (len(x) + len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return rows.mapInArrow(run, "a binary, b binary")


# --- the operator ------------------------------------------------------------------------


def find(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: tuple[int, int] = THRESHOLD,
    target_recall: float = TARGET_RECALL,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``copy_id``, ``class_id``, ``n_links``, ``fp``.

    ``n_links`` is the number of other rows whose shingle sets have a Jaccard similarity of at
    least ``threshold`` = p / q, ``copy_id`` the smallest id with an equal set, ``class_id`` the
    smallest id connected by links. Words are runs of letters, digits and non-ASCII characters,
    A-Z lower-cased; a text of one to four words is a single shingle. A null or empty text has no
    shingles, no links, and is a class of its own with a null ``fp``. Repeated rows are copies of
    each other. A null id counts as the largest; other columns are not looked at.

    Any link between two families is found with ``target_recall`` or more for a pair at the
    threshold; within a family every link is counted. The result is a stored table; those it
    was made from are deleted.
    """
    with Scope(docs.sparkSession) as scope:
        found = _find(docs, doc_id, text, threshold, target_recall)
        return scope.hand_over(found, "near-copies")


def _find(
    docs: DataFrame, doc_id: str, text: str, threshold: tuple[int, int], target_recall: float
) -> DataFrame:
    p, q = threshold
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    made = {"fp": "binary", "n": "int", "sig": "binary"}
    sketches = stage(_per_text(rows, "text", made, _sketch), "sketches")
    classes = sketches.filter("n > 0").groupBy("fp").agg(
        F.first("sig").alias("sig"), F.count("*").alias("copies"), F.min("doc_id").alias("copy_id")
    )
    total = sketches.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    size, whole = 64 * total[0], 8 * total[1]  # bytes of short rows per class and of all sets
    classes = _keep(classes, "classes", size + 4 * _VALUES * total[0])
    met = _subtrees(classes, shortest_prefix(p / q, target_recall), size)
    families = _united(met, _families(met, size), classes, size)

    # whole sets only of classes with company: one document each is read again
    wanted = families.join(classes.select("fp", "copies", "copy_id"), "fp")
    wanted = _keep(wanted, "wanted", size)
    ids = wanted.select(F.col("copy_id").alias("_id")).distinct()
    again = rows.join(ids, F.expr("doc_id <=> _id"), "left_semi").select("text")
    sets = _per_text(again, "text", {"fp": "binary", "elements": "binary"}, _whole)
    sets = sets.join(wanted.select("fp"), "fp", "left_semi").dropDuplicates(["fp"])
    sets = _keep(sets, "sets", size + whole)

    family = _differences(wanted.select("fp", "root", "copies"), sets).selectExpr(
        "*", f"{p + q} * n_minus + {p} * n AS weight", f"{p + q} * root_n AS bound"
    )
    family = _keep(family, "differences", size + 2 * whole)
    sure = _sure_links(family)
    close = stage(_close_links(family, p + q), "close")
    foreign = stage(
        _verified(_foreign_pairs(met, families, classes, p / q), sets, p, q), "foreign"
    )
    own = family.selectExpr("fp", "-CAST(IF(2 * weight <= bound, copies, 0) AS BIGINT) AS links")
    copies = classes.select("fp", "copies")
    ends = foreign.selectExpr("a AS fp", "b AS other").unionByName(
        foreign.selectExpr("b AS fp", "a AS other")
    )
    across = ends.join(copies.selectExpr("fp AS other", "copies AS links"), "other")
    parts = sure.unionByName(own).unionByName(close.select("fp", "links"))
    links = parts.unionByName(across.select("fp", "links")).groupBy("fp").agg(
        F.sum("links").alias("links")
    )

    lightest = family.groupBy("root").agg(
        F.min(F.struct("weight", "fp")).alias("light")
    )
    # classes linked with the lightest of their family count as that one from here on
    centre = family.join(lightest, "root").filter("weight + light.weight <= bound")
    centre = _keep(centre.selectExpr("fp", "light.fp AS node"), "centre", size)
    edges = close.selectExpr("a", "fp AS b").unionByName(foreign)
    for end in ("a", "b"):
        edges = edges.join(centre.withColumnRenamed("fp", end), end, "left").withColumn(
            end, F.coalesce("node", end)
        ).drop("node")
    linked = components(edges.filter("a <> b"), size)

    known = classes.select("fp", "copies", "copy_id").join(centre, "fp", "left")
    known = known.withColumn("node", F.coalesce("node", "fp")).join(linked, "node", "left")
    known = known.withColumn("label", F.coalesce("label", "node")).drop("node")
    known = _keep(known.join(links, "fp", "left"), "known", size)
    smallest = known.groupBy("label").agg(F.min("copy_id").alias("class_id"))
    result = known.join(smallest, "label").selectExpr(
        "fp", "copy_id", "class_id", "copies - 1 + coalesce(links, 0) AS n_links"
    )
    out = sketches.select("doc_id", "fp").join(_keep(result, "found", size), "fp", "left")
    return out.selectExpr(
        "doc_id",
        "IF(fp IS NULL, doc_id, copy_id) AS copy_id",
        "IF(fp IS NULL, doc_id, class_id) AS class_id",
        "coalesce(n_links, 0L) AS n_links",
        "fp",
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without near copies: of each class the row with the smallest id stays.

    Rows and columns are as they were. A text without words always stays. Where ids repeat, rows
    are told apart by their sets, and one of equal rows stays.
    """
    found = find(docs, doc_id, text, **options)
    ids = free_name(docs, "_near_id")
    if found.groupBy("doc_id").count().filter("count > 1").isEmpty():
        gone = found.filter("NOT doc_id <=> class_id").select(F.col("doc_id").alias(ids))
        return docs.join(gone, F.expr(f"`{doc_id}` <=> `{ids}`"), "left_anti")
    group, keep = free_name(docs, "_near_class"), free_name(docs, "_near_keep")
    stay = found.filter("fp IS NOT NULL AND doc_id <=> class_id").groupBy(
        F.col("class_id").alias(group)
    ).agg(F.min("fp").alias(keep))
    marks = {"fp": "binary", "elements": "binary"}
    copy = free_name(docs, "_near_copy")
    clash = {c: free_name(docs, f"_own_{c}") for c in docs.columns if c in marks}
    rows = docs.withColumnsRenamed(clash)
    body, key = clash.get(text, text), clash.get(doc_id, doc_id)
    rows = _per_text(rows.withColumn(copy, F.col(body)), copy, marks, _whole).drop("elements")
    same = rows.join(stay, F.expr(f"`{key}` <=> `{group}` AND fp = `{keep}`"), "left_semi")
    kept = same.dropDuplicates([key, "fp"]).unionByName(rows.filter("fp IS NULL"))
    return kept.drop("fp").withColumnsRenamed({v: k for k, v in clash.items()}).select(*docs.columns)
