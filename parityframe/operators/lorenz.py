"""Lorenz curves."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parityframe.operators.prefix import weighted_cdf, weighted_rows

_GUARD = 1e-9  # a grid point met up to rounding counts as met


def lorenz_curve(
    df: DataFrame, value: str, weight: str | None = None, by: list[str] = ()
) -> DataFrame:
    """The origin and one point per distinct value.

    Rows sharing a value lie on one straight segment, so nothing of the curve is lost.
    """
    by = list(by)
    cdf = weighted_cdf(weighted_rows(df, value, weight, by), by)
    points = cdf.select(
        *by,
        F.try_divide(F.col("weight_before") + F.col("weight"), "weight_total").alias(
            "cum_population"
        ),
        F.try_divide(F.col("income_before") + F.col("income"), "income_total").alias("cum_income"),
    )
    origin = cdf.groupBy(*by).agg(
        F.lit(0.0).alias("cum_population"), F.lit(0.0).alias("cum_income")
    )
    return origin.unionByName(points)


def lorenz_points(
    df: DataFrame,
    value: str,
    weight: str | None = None,
    by: list[str] = (),
    n_points: int = 100,
) -> DataFrame:
    """The curve at ``n_points`` + 1 equally spaced population shares.

    Each distinct value emits the grid points on its own segment, so no range join is needed.
    """
    by = list(by)
    cdf = weighted_cdf(weighted_rows(df, value, weight, by), by)
    c0, total = F.col("weight_before"), F.col("weight_total")

    def passed(cum):
        return F.floor(F.try_divide(cum * n_points, total) + _GUARD).cast("int")

    spans = cdf.withColumns({"_from": passed(c0) + 1, "_to": passed(c0 + F.col("weight"))})
    spans = spans.filter("_from <= _to").withColumn("point", F.explode(F.sequence("_from", "_to")))
    share = F.col("point") / F.lit(n_points)
    income = F.col("income_before") + F.col("value") * (share * total - c0)
    points = spans.select(
        *by,
        "point",
        share.alias("cum_population"),
        F.try_divide(income, "income_total").alias("cum_income"),
    )
    origin = cdf.groupBy(*by).agg(
        F.lit(0).alias("point"), F.lit(0.0).alias("cum_population"), F.lit(0.0).alias("cum_income")
    )
    return origin.unionByName(points)


def lorenz_from_quantiles(shares: DataFrame, by: list[str], n: int = 5) -> DataFrame:
    """The coarse curve of a quantile table; a group has ``n`` rows at most there."""
    along = Window.partitionBy(*by).orderBy("quantile")
    points = shares.select(
        *by,
        (F.col("quantile") / F.lit(n)).alias("cum_population"),
        F.sum("income_share").over(along).alias("cum_income"),
    )
    origin = shares.groupBy(*by).agg(
        F.lit(0.0).alias("cum_population"), F.lit(0.0).alias("cum_income")
    )
    return origin.unionByName(points)
