"""Approximate quantiles and distinct counts from stored, mergeable sketches.

A sketch table holds one row per group: built by one pass with map-side combining, a few kilobytes
a group whatever its size, stored once, and merged to coarser groups without touching the rows.
The exact counterparts are ``operators.quantiles`` and :func:`key_counts`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityframe.workspace import attach_groups, quoted

#: Size parameter of the quantile sketches. Twice the error stated for it is kept with 99 %.
QUANTILE_SIZE = 800
#: Rank error of a quantile sketch of that size, as a share of the group's rows.
RANK_ERROR = 2.296 / QUANTILE_SIZE**0.9021
#: Logarithm of the registers of a distinct-count sketch.
DISTINCT_BITS = 14
#: Relative standard error of such a sketch.
DISTINCT_ERROR = 1.04 / 2 ** (DISTINCT_BITS / 2)


def quantile_sketches(df: DataFrame, value: str, by: list[str] = ()) -> DataFrame:
    """``by``, ``n`` (values that are no NULL or NaN) and ``sketch``, in one hash aggregate."""
    y = f"CAST({quoted(value)} AS DOUBLE)"
    usable = df.select(*by, F.expr(f"nanvl({y}, NULL)").alias("_value")).filter("_value IS NOT NULL")
    return usable.groupBy(*by).agg(
        F.expr("count(*) AS n"),
        F.expr(f"kll_sketch_agg_double(_value, {QUANTILE_SIZE}) AS sketch"),
    )


def merge_quantiles(sketches: DataFrame, by: list[str] = ()) -> DataFrame:
    """Sketches of coarser groups; ``by`` is a part of the keys ``sketches`` has."""
    return sketches.groupBy(*by).agg(
        F.expr("sum(n) AS n"), F.expr(f"kll_merge_agg_double(sketch, {QUANTILE_SIZE}) AS sketch")
    )


def approximate_quantiles(sketches: DataFrame, probs: dict[str, float]) -> DataFrame:
    """Quantiles read off sketches; ``probs`` maps output names to probabilities.

    The rank of an answer differs from the one asked for by ``RANK_ERROR`` of the group's rows
    or less in nearly all cases, and hardly ever by twice that.
    """
    keys = [c for c in sketches.columns if c not in ("n", "sketch")]
    found = [
        F.expr(f"kll_sketch_get_quantile_double(sketch, {float(p)!r}D)").alias(name)
        for name, p in probs.items()
    ]
    return sketches.select(*keys, "n", *found)


def rank_errors(df: DataFrame, value: str, answers: DataFrame, probs: dict[str, float]) -> DataFrame:
    """How far each approximate quantile of ``answers`` lies from its rank, from the rows of ``df``.

    Long form: the keys of ``answers``, ``quantile`` and ``rank_error``, the distance of the
    probability to the interval of shares that the answer covers (0: an exact quantile).
    """
    keys = [c for c in answers.columns if c != "n" and c not in probs]
    limits = answers.select(*keys, *[F.col(name).alias(f"_at_{name}") for name in probs])
    y = f"CAST({quoted(value)} AS DOUBLE)"
    usable = df.select(*keys, F.expr(f"nanvl({y}, NULL)").alias("_value")).filter("_value IS NOT NULL")
    met = attach_groups(usable, limits, keys)
    shares = {}
    for name in probs:
        shares[f"_below_{name}"] = F.avg((F.col("_value") < F.col(f"_at_{name}")).cast("double"))
        shares[f"_upto_{name}"] = F.avg((F.col("_value") <= F.col(f"_at_{name}")).cast("double"))
    wide = met.groupBy(*keys).agg(*[c.alias(name) for name, c in shares.items()])
    rows = ", ".join(
        f"named_struct('quantile', '{name}', 'rank_error', "
        f"greatest(_below_{name} - {float(p)!r}D, {float(p)!r}D - _upto_{name}, 0D))"
        for name, p in probs.items()
    )
    return wide.select(*keys, F.expr(f"inline(array({rows}))"))


def distinct_sketches(df: DataFrame, keys: list[str], by: list[str] = ()) -> DataFrame:
    """``by``, ``n_rows`` and ``sketch``, from which distinct combinations of ``keys`` are told."""
    one = F.xxhash64(*[F.struct(F.col(k)) for k in keys])
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"), F.hll_sketch_agg(one, F.lit(DISTINCT_BITS)).alias("sketch")
    )


def merge_distinct(sketches: DataFrame, by: list[str] = ()) -> DataFrame:
    """Sketches of coarser groups, keys that several groups share counted once."""
    return sketches.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), F.hll_union_agg("sketch").alias("sketch")
    )


def estimated_counts(sketches: DataFrame) -> DataFrame:
    """Rows and about how many distinct keys there are, within ``DISTINCT_ERROR`` mostly."""
    keys = [c for c in sketches.columns if c not in ("n_rows", "sketch")]
    return sketches.select(*keys, "n_rows", F.hll_sketch_estimate("sketch").alias("n_keys"))


def key_counts(df: DataFrame, keys: list[str], by: list[str] = ()) -> DataFrame:
    """Exact rows and distinct combinations of ``keys`` per group.

    In two steps: rows per group and key, then keys per group. So no task holds the keys of a
    group, of which there may be as many as rows. A NULL key is a key.
    """
    each = df.groupBy(*by, *[k for k in keys if k not in by]).agg(F.count("*").alias("_rows"))
    return each.groupBy(*by).agg(F.sum("_rows").alias("n_rows"), F.count("*").alias("n_keys"))
