"""URL filters: host and path rules, and an exact block list as a cascade of Bloom filters.

*Cascade.* The first filter encodes the listed keys. Keys of the corpus that are not listed but
pass it are encoded by the second, listed keys that pass the second by the third, and so on until
a level lets no wrong key pass. As the levels were built over every key of the corpus, the first
level that a key fails gives its exact answer; no key is looked up in a table.

Filters are arrays of 64-bit words, each of a bounded size. One filter per level serves
``SHARD_KEYS`` listed keys; a longer list is cut by key hash into shards, whose filters are
joined to the pages by shard number.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityframe.llm.words import shield
from parityframe.workspace import stage

SHARD_KEYS = 500_000
#: Bits per encoded key and number of bits set, on the first level and on the others.
FIRST = (8, 4)
LATER = (4, 2)
MAX_LEVELS = 64

#: (verdict, host, path). Fixed values.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_sql(url: str) -> str:
    """SQL for the host of a URL, A-Z lower-cased; empty if null or without ``://``."""
    found = f"regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1)"
    return f"translate(coalesce({found}, ''), '{_UPPER}', '{_LOWER}')"


def path_sql(url: str) -> str:
    """SQL for what follows the host up to ``?``, ``#`` or the end; empty like the host."""
    return f"coalesce(regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"


def rule_sql(host: str, path: str, rules=RULES) -> tuple[str, str]:
    """SQL for the rule that fits (null if none) and its verdict; the longest rule wins."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [
        (
            f"({host} = '{h}' OR endswith({host}, '.{h}')) AND startswith({path}, '{p}')",
            h + p,
            verdict,
        )
        for verdict, h, p in ordered
    ]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{name}'" for c, name, _ in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits) + " END"
    return rule, verdict


class Cascade:
    """Levels over keys that all have a shard number; see :func:`build`."""

    def __init__(self, shards: int):
        self.shards = shards
        self.levels: list[tuple[DataFrame, int]] = []  # (shard, words, bits), bits set per key

    def passes(self, rows: DataFrame, key: str, level: int) -> tuple[DataFrame, str]:
        """``rows`` with the level's filter attached, and SQL for whether ``key`` passes it."""
        table, hashes = self.levels[level]
        words, bits = f"_words{level}", f"_bits{level}"
        if self.shards == 1:
            rows = rows.withColumns(
                {words: table.select("words").scalar(), bits: table.select("bits").scalar()}
            )
        else:
            named = table.withColumnsRenamed({"words": words, "bits": bits, "shard": "_shard"})
            rows = rows.join(named, "_shard", "left")
        tests = [
            f"getbit({words}[CAST({place} div 64 AS INT)], CAST({place} % 64 AS INT)) = 1"
            for place in (_place(level, k, key, bits) for k in range(hashes))
        ]
        return rows, f"({words} IS NOT NULL AND " + " AND ".join(tests) + ")"

    def listed(self, rows: DataFrame, key: str) -> tuple[DataFrame, str]:
        """``rows`` with all filters attached, and SQL for whether ``key`` is listed."""
        if self.shards > 1:
            rows = rows.withColumn("_shard", F.expr(_shard(key, self.shards)))
        cases = []
        for level in range(len(self.levels)):
            rows, test = self.passes(rows, key, level)
            cases.append(f"WHEN NOT {test} THEN {'false' if level % 2 == 0 else 'true'}")
        last = "true" if len(self.levels) % 2 else "false"
        return rows, f"(CASE {' '.join(cases)} ELSE {last} END)"


def _place(level: int, k: int, key: str, bits: str) -> str:
    return f"pmod(xxhash64({level}, {k}, {key}), {bits})"


def _shard(key: str, shards: int) -> str:
    return f"CAST(pmod(xxhash64('shard', {key}), {shards}) AS INT)"


def _filters(keys: DataFrame, level: int, per_key: int, hashes: int) -> DataFrame:
    """The filter of every shard: ``shard``, ``words``, ``bits``."""
    sizes = keys.groupBy("shard").agg(F.count("*").alias("n"))
    sizes = sizes.selectExpr("shard", f"CAST(ceil(n * {per_key} / 64) * 64 AS BIGINT) AS bits")
    sizes = stage(sizes, "filter-sizes")
    places = ", ".join(_place(level, k, "key", "bits") for k in range(hashes))
    set_bits = keys.join(sizes, "shard").selectExpr("shard", "bits", f"explode(array({places})) AS at")
    words = set_bits.groupBy("shard", "bits", F.expr("CAST(at div 64 AS INT) AS word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(at % 64 AS INT))) AS value")
    )
    maps = words.groupBy("shard", "bits").agg(
        F.expr("map_from_entries(collect_list(struct(word, value))) AS m")
    )
    full = "transform(sequence(0, CAST(bits / 64 AS INT) - 1), i -> coalesce(try_element_at(m, i), 0L))"
    return stage(maps.selectExpr("shard", "bits", f"{full} AS words"), "filters")


def build(universe: DataFrame, shard_keys: int = SHARD_KEYS) -> Cascade:
    """The cascade for ``universe``: ``key`` (distinct, not null) and ``listed``."""
    n = universe.filter("listed").count()
    shards = max(1, -(-n // shard_keys))
    keys = universe.selectExpr("key", "listed", f"{_shard('key', shards)} AS shard")
    keys = stage(keys, "filter-keys")
    cascade = Cascade(shards)
    inside, outside = keys.filter("listed"), keys.filter("NOT listed")
    while not inside.isEmpty():
        level = len(cascade.levels)
        if level == MAX_LEVELS:
            raise RuntimeError("two keys agree in all hashes")
        per_key, hashes = LATER if level else FIRST
        cascade.levels.append((_filters(inside, level, per_key, hashes), hashes))
        rows = outside.withColumn("_shard", F.col("shard"))
        rows, test = cascade.passes(rows, "key", level)
        wrong = stage(rows.filter(test).select("key", "shard"), "filter-wrong")
        inside, outside = wrong, inside.select("key", "shard")
    return cascade


def judge(
    pages: DataFrame, listed: DataFrame, url: str = "url", rules=RULES, shard_keys: int = SHARD_KEYS
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    The rule's verdict holds; without a rule a page is blocked if its key (host and path) is in
    ``listed`` (a column ``key``; repeated and null keys are fine, keys of no page do no harm).
    Null, empty and odd URLs have an empty host and path and the empty key. Repeated pages get
    the same verdict; columns named like a result are replaced.
    """
    safe, names, back = shield(pages)
    return _judge(safe, listed, names.get(url, url), rules, shard_keys).withColumnsRenamed(back)


def _judge(pages: DataFrame, listed: DataFrame, url: str, rules, shard_keys: int) -> DataFrame:
    result = ["host", "path", "rule", "verdict"]
    address = f"CAST(`{url}` AS STRING)"
    out = pages.withColumns({"_host": F.expr(host_sql(address)), "_path": F.expr(path_sql(address))})
    keys = out.selectExpr("concat(_host, _path) AS key", "false AS listed")
    known = listed.selectExpr("CAST(key AS STRING) AS key", "true AS listed").filter("key IS NOT NULL")
    # a listed key of no page is left out: the corpus is the universe
    seen = keys.selectExpr("key", "listed", "true AS seen").unionByName(
        known.selectExpr("key", "listed", "false AS seen")
    )
    universe = seen.groupBy("key").agg(
        F.expr("bool_or(listed) AS listed"), F.expr("bool_or(seen) AS seen")
    )
    cascade = build(stage(universe.filter("seen").drop("seen"), "universe"), shard_keys)
    out = out.withColumn("_key", F.concat("_host", "_path"))
    if cascade.levels:
        out, on_list = cascade.listed(out, "_key")
    else:
        on_list = "false"
    rule, verdict = rule_sql("_host", "_path", rules)
    kept = [f"`{c}`" for c in pages.columns if c not in result]
    return out.selectExpr(
        *kept,
        "_host AS host",
        "_path AS path",
        f"{rule} AS rule",
        f"coalesce({verdict}, IF({on_list}, 'block', 'allow')) AS verdict",
    )
