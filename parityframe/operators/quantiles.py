"""Order statistics: exact quantiles, quantile bins, shares by quantile, and the ratios of them.

``percentile`` keeps every distinct value of a group in one buffer and the approximate
sketches are not exact, so quantiles are read off the distributed cumulative counts instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parityframe import constants as C
from parityframe.functions.labels import cut
from parityframe.operators.bands import weight_bands
from parityframe.operators.prefix import weighted_cdf, weighted_rows
from parityframe.workspace import attach_groups, quoted


def count_cdf(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Cumulative row counts per distinct value; negative values are kept."""
    return weighted_cdf(weighted_rows(df, value, None, by, keep_negative=True), by)


def quantile_col(p: float, kind: str = "linear", of: str = "weight") -> Column:
    """Quantile as an aggregate over a cdf whose weights ``of`` are row counts.

    ``linear`` interpolates between the two nearest ranks, ``discrete`` is the first value that
    reaches the share ``p`` of the rows.
    """
    before, total = f"{of}_before", f"{of}_total"
    if kind == "discrete":
        return F.expr(f"min(CASE WHEN {before} + {of} >= {p!r}D * {total} THEN value END)")
    position = f"(({total} - 1) * {p!r}D)"
    low = f"max(CASE WHEN {before} <= floor({position}) THEN value END)"
    high = f"max(CASE WHEN {before} <= ceil({position}) THEN value END)"
    part = f"max({position} - floor({position}))"
    return F.expr(f"{low} + ({high} - {low}) * {part}")


def quantiles(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    by: list[str] = (),
    kind: str = "linear",
    frequency: str | None = None,
) -> DataFrame:
    """Exact quantiles per group; ``probs`` maps output names to probabilities.

    With ``frequency`` each row counts as many times as its whole part says, at least once,
    without being replicated.
    """
    by = list(by)
    if frequency is None:
        cdf = count_cdf(df, value, by)
    else:
        times = F.greatest(F.col(frequency).cast("long"), F.lit(1))
        counted = df.withColumn("_times", times)
        rows = weighted_rows(counted, value, "_times", by, keep_negative=True)
        cdf = weighted_cdf(rows, by)
    return cdf.groupBy(*by).agg(*[quantile_col(p, kind).alias(n) for n, p in probs.items()])


def quantile_shares(
    df: DataFrame, value: str, weight: str | None = None, by: list[str] = (), n: int = 5
) -> DataFrame:
    """Bounds, mean and income share of each of ``n`` equal parts of the population.

    Rows belong to a part as a whole; parts no row falls in are absent. Rows with nothing
    accumulated yet (leading zero weights) belong to no part.
    """
    by = list(by)
    rows = weighted_rows(df, value, weight, by)
    cdf = weighted_cdf(rows, by)
    return shares_from(weight_bands(rows, cdf, by, [i / n for i in range(1, n)]), by)


def shares_from(pieces: DataFrame, by: list[str], quantile: str = "band + 1") -> DataFrame:
    """Quantile shares from bands; ``quantile`` tells in SQL which part a band belongs to."""
    pieces = pieces.filter("weight_reached > 0").selectExpr("*", f"{quantile} AS quantile")
    return pieces.groupBy(*by, "quantile").agg(
        F.expr("min(value) AS lower_bound"),
        F.expr("max(value) AS upper_bound"),
        F.expr("try_divide(sum(income), sum(weight)) AS mean_income"),
        F.expr(
            "if(max(income_total) > 0, sum(income) / max(income_total), 0D) AS income_share"
        ),
    )


def quintile_table(silver: DataFrame, n: int = 5) -> DataFrame:
    """The published quintile table, sorted by country, year and quintile."""
    shares = quantile_shares(silver, "income_analysis", "PERWT", ["COUNTRY", "YEAR"], n)
    return published_quintiles(shares)


def published_quintiles(shares: DataFrame) -> DataFrame:
    return shares.select(
        "quantile",
        "lower_bound",
        "upper_bound",
        "mean_income",
        "income_share",
        F.col("COUNTRY").alias("country"),
        F.col("YEAR").alias("year"),
    ).orderBy("country", "year", "quantile")


def _edges(cdf: DataFrame, q: int, by: list[str]) -> DataFrame:
    """The ``q`` + 1 bin edges of each group of a count cdf."""
    names = [f"_edge_{i}" for i in range(q + 1)]
    edges = cdf.groupBy(*by).agg(*[quantile_col(i / q).alias(n) for i, n in enumerate(names)])
    distinct = " AND ".join(f"{low} < {high}" for low, high in zip(names, names[1:]))
    fail = "CAST(raise_error('quantile edges are not distinct') AS DOUBLE)"
    return edges.withColumn("_edge_0", F.expr(f"if({distinct}, _edge_0, {fail})"))


def _binned(
    df: DataFrame, edges: DataFrame, value: str, q: int, by: list[str], name: str, labels: list
) -> DataFrame:
    marked = attach_groups(df, edges, by)
    names = [f"_edge_{i}" for i in range(q + 1)]
    bins = cut(quoted(value), names, labels, include_lowest=True)
    return marked.withColumn(name, bins).drop(*names)


def qcut(
    df: DataFrame,
    value: str,
    q: int,
    by: list[str] = (),
    name: str = "bin",
    labels: list | None = None,
) -> DataFrame:
    """Label the rows by quantile intervals, closed on the right, lowest included.

    The edges are interpolated quantiles, so equal values never part; duplicate edges are an
    error. Labels are 1..q unless given.
    """
    by = list(by)
    labels = list(range(1, q + 1)) if labels is None else labels
    return _binned(df, _edges(count_cdf(df, value, by), q, by), value, q, by, name, labels)


def qcut_summary(df: DataFrame, value: str, q: int = 5, by: list[str] = ()) -> DataFrame:
    """Count, mean, median, minimum and maximum of each quantile bin.

    Bins are given to distinct values rather than rows, so the rows are scanned once.
    """
    by = list(by)
    cdf = count_cdf(df, value, by)
    values = cdf.select(*by, "value", F.col("n").alias("heads"))
    binned = _binned(values, _edges(cdf, q, by), "value", q, by, "bin", list(range(1, q + 1)))
    rows = weighted_rows(binned, "value", "heads", [*by, "bin"], keep_negative=True)
    return weighted_cdf(rows, [*by, "bin"]).groupBy(*by, "bin").agg(
        F.expr("CAST(sum(weight) AS BIGINT) AS n_obs"),
        F.expr("try_divide(sum(income), sum(weight)) AS mean"),
        quantile_col(0.5).alias("median"),
        F.expr("min(value) AS min"),
        F.expr("max(value) AS max"),
    )


def iqr_outliers(df: DataFrame, value: str, by: list[str] = (), factor: float = 1.5) -> DataFrame:
    """Rows outside the quartiles widened by ``factor`` times their distance."""
    by = list(by)
    marked = attach_groups(df, quantiles(df, value, {"_q1": 0.25, "_q3": 0.75}, by), by)
    margin = f"{float(factor)!r}D * (_q3 - _q1)"
    outside = f"{quoted(value)} < _q1 - {margin} OR {quoted(value)} > _q3 + {margin}"
    return marked.filter(outside).drop("_q1", "_q3")


def quintile_contrast(shares: DataFrame, by: list[str]) -> DataFrame:
    """Bottom-40 and top-20 shares of a quintile table in percent, one row per group.

    Absent quintiles count as zero; a group without the first two is left out.
    """
    low, top = F.col("quantile").isin(1, 2), F.col("quantile") == 5
    percent = F.col("income_share") * 100
    return (
        shares.groupBy(*by)
        .agg(
            F.sum(F.when(low, percent)).alias("bottom_40"),
            F.coalesce(F.sum(F.when(top, percent)), F.lit(0.0)).alias("top_20"),
        )
        .filter(F.col("bottom_40").isNotNull())
    )


def share_b40_vs_top20(shares: DataFrame, by: list[str]) -> DataFrame:
    """The contrast in long form: one row per group and population part."""
    long = quintile_contrast(shares, by).unpivot(
        by, ["bottom_40", "top_20"], "part", "income_share_pct"
    )
    label = F.when(F.col("part") == "bottom_40", C.BOTTOM_40_LABEL).otherwise(C.TOP_20_LABEL)
    return long.withColumn("part", label)


def quintile_ratio(shares: DataFrame, by: list[str]) -> DataFrame:
    """Top over bottom quintile by share and by mean; NULL unless the bottom is positive."""

    def of(q: int, column: str) -> Column:
        return F.max(F.when(F.col("quantile") == q, F.col(column)))

    wide = shares.groupBy(*by).agg(
        of(1, "income_share").alias("q1_share"),
        of(5, "income_share").alias("q5_share"),
        of(1, "mean_income").alias("_q1_mean"),
        of(5, "mean_income").alias("_q5_mean"),
    )

    def ratio(top: str, bottom: str) -> Column:
        return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom))

    return wide.select(
        *by,
        "q1_share",
        "q5_share",
        ratio("q5_share", "q1_share").alias("share_ratio"),
        ratio("_q5_mean", "_q1_mean").alias("mean_ratio"),
    )
