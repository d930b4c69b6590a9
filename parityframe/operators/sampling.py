"""Opt-in samples. No measure uses them: all results cover all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityframe.workspace import join_groups, quoted


def bernoulli(df: DataFrame, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    return df.sample(fraction=fraction, seed=seed)


def stratified(df: DataFrame, column: str, fractions: dict, seed: int = 42) -> DataFrame:
    """A fraction of each listed stratum; strata not listed are left out."""
    return df.sampleBy(column, fractions, seed)


def profile(df: DataFrame, sample: DataFrame, column: str, fractions: dict) -> DataFrame:
    """Per stratum of ``df``: its rows, and whether ``sample`` can be a sample of it.

    ``n_foreign`` counts sampled rows the table lacks or has fewer times; ``size_fits`` tells
    that the size lies within five standard deviations. Strata not listed must be empty.
    """
    drawn = sample.groupBy(column).agg(F.count(F.lit(1)).alias("_drawn"))
    foreign = sample.exceptAll(df).groupBy(column).agg(F.count(F.lit(1)).alias("_foreign"))
    rate = F.lit(0.0)
    for stratum, fraction in fractions.items():
        rate = F.when(F.col(column) == stratum, F.lit(float(fraction))).otherwise(rate)
    whole = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("_rate", rate)
    whole = join_groups(whole, drawn, [column], "left")
    gap = "abs(coalesce(_drawn, 0) - n_rows * _rate)"
    return join_groups(whole, foreign, [column], "left").selectExpr(
        quoted(column),
        "n_rows",
        "coalesce(_foreign, 0L) AS n_foreign",
        f"{gap} <= 5 * sqrt(n_rows * _rate * (1 - _rate)) AS size_fits",
    )


def keyed(
    df: DataFrame, household: str, person: str, fractions: dict, column: str, base: int = 1000
) -> DataFrame:
    """Stratified sample decided by the identifiers alone.

    The same persons are drawn whatever the partitioning and however often a task is retried.
    """
    draw = F.pmod(
        F.pmod(F.col(household), F.lit(100003)) * 7919 + F.col(person) * 104729 + 12345,
        F.lit(base),
    )
    rate = F
    for stratum, fraction in fractions.items():
        rate = rate.when(F.col(column) == stratum, F.lit(round(fraction * base)))
    return df.filter(draw < rate.otherwise(0))
