"""Inequality measures per group, all taken from one table of cumulative weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parityframe import constants as C
from parityframe.functions.labels import country_label
from parityframe.functions.metrics import mld_col, theil_col, weighted_mean_col
from parityframe.operators.bands import weight_bands
from parityframe.operators.prefix import weighted_cdf, weighted_rows
from parityframe.workspace import join_groups, quoted, stage

GINI_METHODS = ("cumulative", "lorenz_left", "trapezoid", "rank")


def _group(df: DataFrame, by: list[str], *aggregates: Column) -> DataFrame:
    return df.groupBy(*by).agg(*aggregates)


def gini_col(method: str = "cumulative") -> Column:
    """Gini as an aggregate over the rows of a weighted cdf.

    Each method needs a sum over persons of value, weight and the totals before the person.
    Persons sharing a value have equal terms up to their order, and the order cancels out, so the
    sum over them has a closed form in their count, total weight and sum of squared weights.

    ``cumulative``  parity definition; exact only for unit weights, clipped to [0, 1].
    ``lorenz_left`` area under the Lorenz curve by left-hand rectangles.
    ``trapezoid``   area by trapezoids; the unbiased weighted definition.
    ``rank``        by rank; use it on an unweighted cdf.
    """
    heads, incomes = "max(weight_total)", "max(income_total)"
    area = f"({heads} * {incomes})"
    if method == "cumulative":
        moment = "sum(value * (weight_before * weight + (weight * weight + weight_sq) / 2))"
        raw = f"try_divide(2 * {moment}, {area}) - try_divide({heads} + 1, {heads})"
        return F.expr(
            f"CASE WHEN {incomes} = 0 THEN 0D "
            f"WHEN {raw} IS NOT NULL THEN least(greatest({raw}, 0D), 1D) END"
        )
    if method == "lorenz_left":
        left = "sum(income_before * weight + value * (weight * weight - weight_sq) / 2)"
        return F.expr(f"if({incomes} = 0, 0D, 1 - try_divide(2 * {left}, {area}))")
    if method == "trapezoid":
        under = "sum(income_before * weight + value * weight * weight / 2)"
        return F.expr(f"1 - try_divide(2 * {under}, {area})")
    if method == "rank":
        ranks = "sum(value * weight * (2 * weight_before + weight))"
        return F.expr(f"try_divide({ranks}, {area}) - 1")
    raise ValueError(f"unknown Gini method {method!r}; choose from {GINI_METHODS}")


def gini(
    df: DataFrame,
    value: str,
    weight: str | None = None,
    by: list[str] = (),
    method: str = "cumulative",
) -> DataFrame:
    by = list(by)
    signed = method in ("lorenz_left", "trapezoid")
    if method == "rank":
        weight = None
    cdf = weighted_cdf(weighted_rows(df, value, weight, by, keep_negative=signed), by)
    return _group(cdf, by, gini_col(method).alias("gini"))


def theil(df: DataFrame, value: str, weight: str | None = None, by: list[str] = ()) -> DataFrame:
    w = quoted(weight) if weight else None
    return _group(df, list(by), theil_col(quoted(value), w).alias("theil"))


def mean_log_deviation(
    df: DataFrame, value: str, weight: str | None = None, by: list[str] = ()
) -> DataFrame:
    w = quoted(weight) if weight else None
    return _group(df, list(by), mld_col(quoted(value), w).alias("mld"))


def _rows_and_cdf(df: DataFrame, value: str, weight: str | None, by: list[str]):
    rows = weighted_rows(df, value, weight, by)
    return rows, weighted_cdf(rows, by)


def bottom_and_top_shares(
    pieces: DataFrame, by: list[str], bottom: int = 0, top: int = 2
) -> DataFrame:
    """Totals of each group up to band ``bottom`` and from band ``top`` on."""
    return pieces.groupBy(*by).agg(
        F.expr(f"coalesce(sum(if(band <= {bottom}, income, NULL)), 0D) AS bottom_income"),
        F.expr(f"coalesce(sum(if(band <= {bottom}, weight, NULL)), 0D) AS bottom_weight"),
        F.expr(f"coalesce(sum(if(band >= {top}, income, NULL)), 0D) AS top_income"),
    )


def _bottom_and_top(rows, cdf, by: list[str], top_inclusive: bool = False) -> DataFrame:
    cuts = [C.BOTTOM_SHARE, C.TOP_SHARE]
    return bottom_and_top_shares(weight_bands(rows, cdf, by, cuts, [False, top_inclusive]), by)


def palma(
    df: DataFrame,
    value: str,
    weight: str | None = None,
    by: list[str] = (),
    top_inclusive: bool = False,
) -> DataFrame:
    """Income of the top 10 % over income of the bottom 40 %; NULL when the latter is zero."""
    by = list(by)
    rows, cdf = _rows_and_cdf(df, value, weight, by)
    shares = _bottom_and_top(rows, cdf, by, top_inclusive)
    return shares.select(*by, F.try_divide("top_income", "bottom_income").alias("palma"))


def weighted_median_col() -> Column:
    """Lower weighted median: the first value whose cumulative weight reaches one half."""
    return F.expr("min(CASE WHEN weight_before + weight >= 0.5D * weight_total THEN value END)")


def weighted_median(
    df: DataFrame, value: str, weight: str | None = None, by: list[str] = ()
) -> DataFrame:
    by = list(by)
    cdf = weighted_cdf(weighted_rows(df, value, weight, by), by)
    return _group(cdf, by, weighted_median_col().alias("median"))


def _below_half_median(cdf: DataFrame, medians: DataFrame, by: list[str]) -> DataFrame:
    """Share of weight strictly below half the median; 0 for a zero median.

    ``medians`` is a stored table of one row per group.
    """
    matched = _with_groups(cdf, medians.select(*by, "median"), by)
    poor = "sum(if(value < 0.5D * median, weight, 0D))"
    share = f"if(max(median) = 0, 0D, try_divide({poor}, max(weight_total)))"
    return _group(matched, by, F.expr(f"{share} AS sdg_10_2_1"))


def poverty_half_median(
    df: DataFrame, value: str, weight: str | None = None, by: list[str] = ()
) -> DataFrame:
    """Relative poverty: share of the population with less than half the weighted median."""
    by = list(by)
    _, cdf = _rows_and_cdf(df, value, weight, by)
    medians = _group(cdf, by, weighted_median_col().alias("median"))
    return _below_half_median(cdf, stage(medians, "medians"), by)


def _with_prosperity(df: DataFrame) -> DataFrame:
    """Bottom mean, its premium and the flag, beside ``mean_income``."""
    low = "coalesce(try_divide(bottom_income, bottom_weight), 0D)"
    flag = f"if({low} < 0.5D * mean_income, '{C.LAGGING_FLAG}', '{C.NORMAL_FLAG}')"
    return df.selectExpr(
        "*",
        f"{low} AS mean_b40",
        f"(try_divide({low}, mean_income) - 1) * 100 AS premium_pct",
        f"{flag} AS anomali_b40",
    )


def _with_groups(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Join two one-row-per-group tables; without keys both are single rows."""
    if by:
        return join_groups(left, right, by)
    row = right.first()
    return left.withColumns(
        {f.name: F.lit(row[f.name]).cast(f.dataType) for f in right.schema.fields}
    )


def shared_prosperity(
    df: DataFrame, value: str, weight: str | None = None, by: list[str] = ()
) -> DataFrame:
    """Mean of the bottom 40 %, its premium over the overall mean in percent, and the flag."""
    by = list(by)
    rows, cdf = _rows_and_cdf(df, value, weight, by)
    means = _group(cdf, by, weighted_mean_col("value", "weight").alias("mean_income"))
    shares = _bottom_and_top(rows, cdf, by)
    joined = _with_prosperity(_with_groups(means, shares, by))
    return joined.select(*by, "mean_income", "mean_b40", "premium_pct", "anomali_b40")


def inequality_summary(
    df: DataFrame,
    value: str = "income_analysis",
    weight: str | None = "PERWT",
    by: list[str] = ("COUNTRY", "YEAR"),
) -> DataFrame:
    """Every headline measure per group, from one cdf.

    ``df`` is scanned a second time only for the values that straddle a cut.
    """
    by = list(by)
    rows, cdf = _rows_and_cdf(df, value, weight, by)
    return summary_from(cdf, _bottom_and_top(rows, cdf, by), by)


def summary_from(cdf: DataFrame, shares: DataFrame, by: list[str]) -> DataFrame:
    """The summary from a cdf and the bottom and top shares taken from it."""
    base = _group(
        cdf,
        by,
        gini_col("cumulative").alias("gini"),
        theil_col("value", "weight").alias("theil"),
        weighted_mean_col("value", "weight").alias("mean_income"),
        weighted_median_col().alias("median"),
        F.sum("n").alias("n_obs"),
    )
    base = stage(base, "base")
    poverty = _below_half_median(cdf, base, by)
    # the stored table comes last, so that it is broadcast to what the other two are joined to
    joined = _with_groups(_with_groups(poverty, shares, by), base, by)
    return _with_prosperity(joined).select(
        *by,
        "gini",
        "theil",
        F.try_divide("top_income", "bottom_income").alias("palma"),
        "sdg_10_2_1",
        "mean_income",
        "mean_b40",
        "anomali_b40",
        "n_obs",
    )


def inequality_table(silver: DataFrame) -> DataFrame:
    """The published aggregate table, one sorted row per country and year."""
    return published_summary(inequality_summary(silver))


def published_summary(summary: DataFrame) -> DataFrame:
    return summary.select(
        F.col("COUNTRY").alias("country"),
        country_label("COUNTRY").alias("country_name"),
        F.col("YEAR").alias("year"),
        *[c for c in summary.columns if c not in ("COUNTRY", "YEAR")],
    ).orderBy("country", "year")
