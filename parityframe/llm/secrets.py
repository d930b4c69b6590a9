"""Secrets in texts: known forms by pattern, unknown ones by a battery of randomness tests.

*Known forms* are assignments to telling names, access key ids and long hexadecimal strings.

*Battery.* Long runs of letters, digits and ``+ / _ -``, padded by ``=`` or not, are inferred to be of an encoding
(hexadecimal, base 32, 36, 62 or 64). Three tests ask whether such a token could be drawn evenly
from its alphabet: chi-squared uniformity, runs above and below the middle of the alphabet, serial
correlation of neighbours. Their p-values are combined by the Cauchy rule.

*False discoveries.* Tokens of an encoding and of a band of lengths are judged together, as short
ones pass the tests more easily. Random tokens have evenly spread p-values, so of those above any
threshold the upper half of the range must hold its share. A threshold is given up, and all below
it, if that half holds significantly less: more than ``MAX_FALSE`` of the tokens above are ordinary
text then. The lowest one left is used, but not below a floor on p unless the counts prove that the tokens there
are random too. Few tokens prove nothing, so in a small cell the floor alone decides, and a random
token is lost with about the floor's chance. The counts cover all texts.

DataFrame functions only. Positions are code points, the end is exclusive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityframe.llm.words import shield
from parityframe.workspace import stage

#: Forms to be found. Fixed values, letters of the names in either case.
ASSIGN = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
    "|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"[\"\x27]?\x20*[:=]\x20*[\"\x27]?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_VALUE = 6
# Runs of the class are maximal, so asking for the length in the pattern gives the same matches.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
# "=" only pads the end, so that the value of name=value is a token of its own.
TOKEN = "[A-Za-z0-9+/_-]{20,}={0,2}"

KINDS = ["assign", "access", "hex", "random"]
#: Encoding -> alphabet, in the order in which they are tried.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
BANDS = [20, 24, 32, 48, 64, 128]
BINS = 40
MAX_FALSE = 0.1
#: Standard deviations that make a deviation significant, and the floor in steps of p for tokens
#: shorter than ``SHORT`` and for the others.
SIGNIFICANT = 2.326
SHORT, FLOOR_SHORT, FLOOR = 32, 2, 1

_CHUNK = 128
_RESULT = ["n_assign", "n_access", "n_hex", "base", "spans"]


def _matches(text: str, pattern: str, value: int = 0) -> str:
    """SQL for array<struct<start, end, value>> of all matches of ``pattern``, left to right.

    The text between matches comes from ``split``; starts are running sums, taken in chunks so
    that the work is not quadratic in the number of matches.
    """
    p = pattern.replace("\\", "\\\\").replace("'", "\\'")
    found = f"regexp_extract_all({text}, '{p}', 0)"
    shown = f"regexp_extract_all({text}, '{p}', {value})" if value else found
    base = (
        f"transform(sequence(0, size(found) - 1), i -> length(gaps[i]) + length(found[i]))"
    )
    chunks = (
        f"aggregate(sequence(0, (size(found) - 1) div {_CHUNK}), array(0), (a, c) -> concat(a, "
        f"array(element_at(a, -1) + aggregate(slice(steps, c * {_CHUNK} + 1, {_CHUNK}), 0, (s, x) -> s + x))))"
    )
    start = (
        f"bases[i div {_CHUNK}] + length(gaps[i]) + aggregate(slice(steps, CAST(i div {_CHUNK} AS INT) "
        f"* {_CHUNK} + 1, i % {_CHUNK}), 0, (s, x) -> s + x)"
    )
    empty = "CAST(array() AS array<struct<start: int, end: int, value: string>>)"
    body = f"""transform(
        transform(sequence(0, size(found) - 1), i -> struct(i, {start} AS start)),
        r -> struct(r.start AS start, r.start + length(found[r.i]) AS end, shown[r.i] AS value))"""
    # names for the parts, by arrays of one element
    named = f"""flatten(transform(array(struct({found} AS found, {shown} AS shown, split({text}, '{p}', -1) AS gaps)), x ->
        {_let(base, chunks, body)}))"""
    return f"CASE WHEN {text} RLIKE '{p}' THEN {named} ELSE {empty} END"


def _let(base: str, chunks: str, body: str) -> str:
    def inner(sql: str) -> str:
        for name in ("found", "shown", "gaps"):
            sql = sql.replace(f"{name}[", f"x.{name}[").replace(f"({name})", f"(x.{name})")
        return sql

    return (
        f"flatten(transform(array({inner(base)}), steps -> flatten(transform(array({inner(chunks)}), "
        f"bases -> {inner(body)}))))"
    )


def _tail(z: str) -> str:
    """SQL for the upper tail of the normal distribution, to about 0.0002."""
    x = f"least(greatest({z}, -9D), 9D)"
    return f"(1D / (1D + exp(1.5976D * {x} + 0.070565D * pow({x}, 3))))"


def _encoding(token: str) -> str:
    """SQL for the encoding of a token without padding, null for words and numbers."""
    two = f"{token} RLIKE '[0-9]' AND {token} RLIKE '[A-Za-z]'"
    mixed = f"({two} OR ({token} RLIKE '[a-z]' AND {token} RLIKE '[A-Z]'))"
    three = f"{two} AND {token} RLIKE '[a-z]' AND {token} RLIKE '[A-Z]'"
    return (
        f"CASE WHEN {token} RLIKE '^([0-9a-f]+|[0-9A-F]+)$' AND {two} THEN 'hex' "
        f"WHEN {token} RLIKE '^[A-Z2-7]+$' AND {two} THEN 'base32' "
        f"WHEN {token} RLIKE '^[a-z0-9]+$' AND {two} THEN 'base36' "
        f"WHEN {token} RLIKE '^[A-Za-z0-9]+$' AND {mixed} THEN 'base62' "
        f"WHEN {token} RLIKE '^[A-Za-z0-9+/_-]+$' AND {three} THEN 'base64' END"
    )


def _battery(spans: str) -> str:
    """SQL for the judged tokens of an array of matches: start, end, encoding, band, p."""
    band = "CASE " + " ".join(f"WHEN n >= {b} THEN {b}" for b in reversed(BANDS)) + " ELSE 0 END"
    alphabet = "CASE enc " + " ".join(f"WHEN '{e}' THEN '{a}'" for e, a in ALPHABETS.items()) + " END"
    folded = "translate(IF(t.enc = 'hex', lower(t.token), t.token), '-_', '+/')"
    steps = [
        f"filter(transform({spans}, s -> struct(s.start, s.end, rtrim('=', s.value) AS token)), s -> length(s.token) >= {BANDS[0]})",
        f"filter(transform(_, s -> struct(s.start, s.end, s.token, {_encoding('s.token')} AS enc)), s -> s.enc IS NOT NULL)",
        f"transform(_, t -> struct(t.start, t.end, t.enc, length(t.token) AS n, "
        f"transform(filter(split({folded}, ''), c -> c <> ''), c -> CAST(instr({alphabet.replace('CASE enc', 'CASE t.enc')}, c) - 1 AS DOUBLE)) AS x, "
        f"CAST(length({alphabet.replace('CASE enc', 'CASE t.enc')}) AS DOUBLE) AS k))",
        "transform(_, t -> struct(t.start, t.end, t.enc, t.n, t.k, t.x, "
        "aggregate(array_distinct(t.x), 0D, (a, y) -> a + pow(size(filter(t.x, v -> v = y)), 2)) AS squares, "
        "aggregate(t.x, 0D, (a, v) -> a + v) / t.n AS mean, "
        "CAST(size(filter(t.x, v -> v >= t.k / 2)) AS DOUBLE) AS high, "
        "CAST(1 + size(filter(sequence(1, t.n - 1), i -> (t.x[i] >= t.k / 2) <> (t.x[i - 1] >= t.k / 2))) AS DOUBLE) AS runs))",
        "transform(_, t -> struct(t.start, t.end, t.enc, t.n, "
        "(t.k * t.squares / t.n - t.n - (t.k - 1)) / sqrt(2 * (t.k - 1) * (t.n - 1) / t.n) AS z_even, "
        "2 * t.high * (t.n - t.high) / t.n + 1 AS expected, t.runs, "
        "aggregate(sequence(1, t.n - 1), 0D, (a, i) -> a + (t.x[i] - t.mean) * (t.x[i - 1] - t.mean)) AS both, "
        "aggregate(t.x, 0D, (a, v) -> a + pow(v - t.mean, 2)) AS var))",
        "transform(_, t -> struct(t.start, t.end, t.enc, t.n, t.z_even, "
        "abs(t.runs - t.expected) / sqrt(greatest((t.expected - 1) * (t.expected - 2) / (t.n - 1), 1e-9D)) AS z_runs, "
        "IF(t.var > 0, abs(t.both / t.var) * sqrt(t.n), 9D) AS z_serial))",
        f"transform(_, t -> struct(t.start, t.end, t.enc, t.n, array({_tail('t.z_even')}, 2 * {_tail('t.z_runs')}, 2 * {_tail('t.z_serial')}) AS p))",
        "transform(_, t -> struct(t.start, t.end, t.enc, t.n, aggregate(t.p, 0D, "
        "(a, p) -> a + tan((0.5D - least(greatest(p, 1e-9D), 1 - 1e-9D)) * pi())) / 3 AS q))",
        f"transform(_, t -> struct(t.start, t.end, t.enc AS encoding, {band.replace('n >=', 't.n >=')} AS band, 0.5D - atan(t.q) / pi() AS p))",
    ]
    sql = steps[0]
    for step in steps[1:]:
        sql = step.replace("transform(_,", f"transform({sql},", 1)
    return sql


def _thresholds(judged: DataFrame) -> DataFrame:
    """One row with a map from encoding and band to the lowest p-value that counts as random."""
    tokens = judged.selectExpr("explode(_tokens) AS t").selectExpr(
        "concat(t.encoding, ':', t.band) AS kind", f"least(CAST(floor(t.p * {BINS}) AS INT), {BINS - 1}) AS bin"
    )
    bins = tokens.groupBy("kind", "bin").agg(F.count("*").alias("n"))
    cells = bins.groupBy("kind").agg(F.collect_list(F.struct("bin", "n")).alias("c"))  # BINS at most
    middle = f"ceil((b + {BINS}) / 2)"
    count = "aggregate(c, 0D, (a, x) -> a + IF(x.bin >= {0}, x.n, 0))"
    steps = cells.selectExpr(
        "kind",
        f"IF(CAST(split(kind, ':')[1] AS INT) < {SHORT}, {FLOOR_SHORT}, {FLOOR}) AS floor",
        f"transform(sequence(0, {BINS - 1}), b -> struct(b, {count.format('b')} AS n, {count.format(middle)} AS high, "
        f"{1 - MAX_FALSE}D * ({BINS} - {middle}) / ({BINS} - b) AS q)) AS s",
    )
    noise = f"{SIGNIFICANT}D * sqrt(r.n * r.q * (1 - r.q))"
    ruled_out = steps.selectExpr(
        "kind", "floor", "s", f"coalesce(array_max(filter(s, r -> r.high < r.n * r.q - {noise}).b), -1) AS bad"
    )
    fits = f"r.n > 0 AND r.b > bad AND (r.b >= floor OR r.high >= r.n * r.q + {noise})"
    lowest = ruled_out.selectExpr("kind", f"array_min(filter(s, r -> {fits}).b) / {BINS}D AS least")
    return lowest.agg(F.map_from_entries(F.collect_list(F.struct("kind", "least"))).alias("m"))


def _listed(spans: str) -> str:
    ranked = (
        f"transform(array_sort({spans}), s -> concat(element_at(array("
        + ", ".join(f"'{k}'" for k in KINDS)
        + "), s.kind + 1), ':', s.start, ':', s.end))"
    )
    return f"array_join({ranked}, ',')"


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_assign``, ``n_access``, ``n_hex``, ``base`` and ``spans``.

    ``base`` lists the known forms and ``spans`` these and the random tokens that overlap none of
    them, as ``kind:start:end``, comma-joined by start, then kind as in ``KINDS``. A null or empty
    text has none. Rows and other columns stay as they are; repeated rows count each in the
    corpus counts; columns named like a result are replaced.

    One pass over the texts, whose judged tokens are written with the other columns; then a count
    per encoding, band and step of p. No text is shuffled.
    """
    safe, names, back = shield(docs)
    return _scan(safe, names.get(text, text)).withColumnsRenamed(back)


def _scan(docs: DataFrame, text: str) -> DataFrame:
    kept = docs.drop(*[c for c in docs.columns if c in _RESULT])
    rows = kept.withColumn("_secret", F.coalesce(docs[text].cast("string"), F.lit("")))
    found = rows.selectExpr(
        *[f"`{c}`" for c in kept.columns],
        f"filter({_matches('_secret', ASSIGN, 2)}, s -> length(s.value) >= {ASSIGN_VALUE}) AS _a0",
        f"{_matches('_secret', ACCESS)} AS _a1",
        f"{_matches('_secret', HEX)} AS _a2",
        f"{_matches('_secret', TOKEN)} AS _a3",
    )
    base = ", ".join(f"transform(_a{k}, s -> struct(s.start, {k} AS kind, s.end))" for k in range(3))
    judged = found.selectExpr(
        *[f"`{c}`" for c in kept.columns],
        "CAST(size(_a0) AS BIGINT) AS n_assign",
        "CAST(size(_a1) AS BIGINT) AS n_access",
        "CAST(size(_a2) AS BIGINT) AS n_hex",
        f"concat({base}) AS _base",
        f"{_battery('_a3')} AS _tokens",
    )
    judged = stage(judged, "secrets")
    limits = _thresholds(judged).scalar()
    random = (
        "transform(filter(_tokens, t -> t.p >= coalesce(try_element_at(_limits, concat(t.encoding, ':', t.band)), 2D) "
        "AND NOT exists(_base, b -> b.start < t.end AND t.start < b.end)), t -> struct(t.start, 3 AS kind, t.end))"
    )
    out = judged.withColumn("_limits", limits)
    return out.selectExpr(
        *[f"`{c}`" for c in kept.columns],
        "n_assign", "n_access", "n_hex",
        f"{_listed('_base')} AS base",
        f"{_listed(f'concat(_base, {random})')} AS spans",
    )
