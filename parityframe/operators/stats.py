"""Descriptive statistics, profiles and histograms.

Statistics that need order are read from the cumulative counts per distinct value, which one
scan with map-side combining produces; the plain ones are ordinary hash aggregates.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from parityframe import constants as C
from parityframe.functions.labels import country_label, ppp_income
from parityframe.functions.metrics import theil_col
from parityframe.operators.bands import weight_bands
from parityframe.operators.inequality import bottom_and_top_shares, gini_col
from parityframe.operators.prefix import collapse, weighted_cdf, weighted_rows
from parityframe.operators.quantiles import count_cdf, quantile_col, quantiles
from parityframe.workspace import join_groups, quoted, stage


def _mean(of: str = "weight", amount: str = "income") -> Column:
    return F.expr(f"try_divide(max({amount}_total), max({of}_total))")


def _stddev(of: str = "weight", amount: str = "income") -> Column:
    """Sample deviation, taken around the group mean each cdf row carries."""
    gap = f"(value - try_divide({amount}_total, {of}_total))"
    return F.expr(f"sqrt(try_divide(sum({of} * {gap} * {gap}), max({of}_total) - 1))")


def income_stats(
    df: DataFrame, value: str = "income_analysis", by: list[str] = ("COUNTRY", "YEAR")
) -> DataFrame:
    """Unweighted mean, median, deviation, range and count per group; the median is exact."""
    return stats_from(count_cdf(df, value, list(by)), list(by))


def stats_from(
    cdf: DataFrame, by: list[str], of: str = "weight", amount: str = "income"
) -> DataFrame:
    """The statistics from a cdf with row counts ``of`` and their income ``amount``."""
    return cdf.groupBy(*by).agg(
        _mean(of, amount).alias("mean_income"),
        quantile_col(0.5, "discrete", of).alias("median_income"),
        _stddev(of, amount).alias("std_income"),
        F.expr("min(value) AS min_income"),
        F.expr("max(value) AS max_income"),
        F.expr("sum(n) AS n_obs"),
    )


def eda_summary(df: DataFrame, value: str = "INCTOT", by: list[str] = ("COUNTRY",)) -> DataFrame:
    by = list(by)
    return count_cdf(df, value, by).groupBy(*by).agg(
        _mean().alias("mean_income"),
        quantile_col(0.5, "discrete").alias("median_income"),
        F.max("value").alias("max_income"),
        F.sum("n").alias("population"),
    )


def median_by(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    return count_cdf(df, value, by).groupBy(*by).agg(
        quantile_col(0.5, "discrete").alias("median_income"), F.sum("n").alias("n_obs")
    )


def share_thresholds(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Value at the 40th and the 90th percentile and the total income."""
    return count_cdf(df, value, by).groupBy(*by).agg(
        quantile_col(C.BOTTOM_SHARE, "discrete").alias("bottom40_limit"),
        quantile_col(C.TOP_SHARE, "discrete").alias("top10_limit"),
        F.max("income_total").alias("total_income"),
    )


def describe(df: DataFrame, value: str, by: list[str] = ()) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum in long form."""
    by = list(by)
    wide = count_cdf(df, value, by).groupBy(*by).agg(
        F.sum("n").cast("double").alias("count"),
        _mean().alias("mean"),
        _stddev().alias("std"),
        F.min("value").alias("min"),
        quantile_col(0.25).alias("25%"),
        quantile_col(0.5).alias("50%"),
        quantile_col(0.75).alias("75%"),
        F.max("value").alias("max"),
    )
    names = [c for c in wide.columns if c not in by]
    return wide.unpivot(by, names, "statistic", "amount")


def describe_columns(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """:func:`describe` of several numeric columns at once, with ``column_name`` as a further key.

    A row gives one value per column, and all columns share one collapse and one set of running
    totals. A column without values has no rows.
    """
    pairs = ", ".join(
        f"named_struct('column_name', '{c}', 'value', CAST({quoted(c)} AS DOUBLE))" for c in columns
    )
    long = df.select(*by, F.expr(f"inline(array({pairs}))"))
    return describe(long.withColumnRenamed("value", "_amount"), "_amount", [*by, "column_name"])


def five_numbers(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Box-plot numbers per group."""
    probs = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}
    return quantiles(df, value, probs, by)


def zero_share(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    zero = F.count_if(F.col(value) == 0)
    total = F.count(value)
    return df.groupBy(*by).agg(
        total.alias("population"),
        zero.alias("n_zero"),
        (F.try_divide(zero, total) * 100).alias("zero_pct"),
    )


def _missing(df: DataFrame, column: str) -> Column:
    missing = F.col(column).isNull()
    if df.schema[column].dataType.typeName() in ("double", "float"):
        missing = missing | F.isnan(column)
    return missing


def missing_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the number of NULL or NaN entries of each column."""
    return df.agg(*[F.count_if(_missing(df, c)).alias(c) for c in columns])


def missing_counts_long(df: DataFrame, columns: list[str]) -> DataFrame:
    return missing_counts(df, columns).unpivot([], columns, "column_name", "n_missing")


def null_percent(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Share of missing entries per column in percent, largest first."""
    columns = columns or df.columns
    total = F.count(F.lit(1))
    shares = df.agg(
        *[
            F.round(F.try_divide(F.count_if(_missing(df, c)), total) * 100, 2).alias(c)
            for c in columns
        ]
    )
    long = shares.unpivot([], columns, "column_name", "null_pct")
    return long.orderBy(F.desc("null_pct"), "column_name")


def _fields(kind: DataType, path: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], DataType]]:
    """All columns of a schema and, after each struct, its fields at any depth."""
    found = []
    for field in kind.fields:
        here = (*path, field.name)
        found.append((here, field.dataType))
        if isinstance(field.dataType, StructType):
            found += _fields(field.dataType, here)
    return found


def null_profile(df: DataFrame) -> DataFrame:
    """Type, rows, missing entries and their share in percent of every column, nested ones too.

    One row per column in the order of the schema; a field of a struct is called ``a.b`` and is
    missing where the struct is. NaN counts as missing. All columns come from one aggregate over
    one scan, an array with an entry per column that is then unfolded.
    """
    entries = []
    for place, (path, kind) in enumerate(_fields(df.schema)):
        column = ".".join(map(quoted, path))
        missing = f"{column} IS NULL"
        if kind.typeName() in ("double", "float"):
            missing += f" OR isnan({column})"
        name = ".".join(path).replace("\\", "\\\\").replace("'", "\\'")
        entries.append(
            f"named_struct('position', {place}, 'column_name', '{name}', "
            f"'type', '{kind.simpleString()}', 'n_rows', count(*), 'n_missing', count_if({missing}))"
        )
    profile = df.agg(F.expr(f"array({', '.join(entries)}) AS columns"))
    return profile.selectExpr("inline(columns)").selectExpr(
        "*", "round(try_divide(n_missing, n_rows) * 100, 2) AS missing_pct"
    )


def _values(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Stored counts per group and distinct value, from one scan of the rows."""
    rows = weighted_rows(df, value, None, by, keep_negative=True)
    return stage(collapse(rows, by).select(*by, "value", "n"), "values")


def histogram(
    df: DataFrame, value: str, bins: int = 50, by: list[str] = ()
) -> DataFrame:
    """Counts in equal-width bins over the common range, per group, empty bins included."""
    by = list(by)
    return _histogram(_values(df, value, by), bins, by)


def trimmed_histogram(
    df: DataFrame, value: str, by: list[str], keep: float = 0.95, bins: int = 50
) -> DataFrame:
    """Histogram of the values below the overall quantile ``keep``."""
    values = _values(df, value, by)
    overall = weighted_cdf(weighted_rows(values, "value", "n", [], keep_negative=True), [])
    limit = overall.agg(quantile_col(keep).alias("limit")).first()["limit"]
    return _histogram(values.filter(F.col("value") < F.lit(limit)), bins, by)


def _histogram(values: DataFrame, bins: int, by: list[str]) -> DataFrame:
    limits = values.selectExpr("min(value) AS low", "max(value) AS high").first()
    low, high = limits["low"], limits["high"]
    if low is not None and not math.isfinite(high - low):
        raise ValueError("a histogram needs finite values; filter the infinite ones first")
    if low is None:
        low, high = 0.0, 1.0
    elif low == high:
        low, high = low - 0.5, high + 0.5
    place = f"floor((value - {low!r}D) / ({high!r}D - {low!r}D) * {bins})"
    index = F.expr(f"CAST(least({place}, {bins - 1}) AS INT) AS bin")
    counts = values.groupBy(*by, index).agg(F.sum("n").alias("n"))
    if by:
        steps = F.expr(f"explode(sequence(0, {bins - 1}))")
        grid = counts.select(*by).distinct().withColumn("bin", steps)
    else:
        grid = values.sparkSession.range(bins).selectExpr("CAST(id AS INT) AS bin")
    width = (high - low) / bins
    return join_groups(grid, counts, [*by, "bin"], "left").selectExpr(
        *map(quoted, by),
        "bin",
        f"{low!r}D + bin * {width!r}D AS lower",
        f"{low!r}D + (bin + 1) * {width!r}D AS upper",
        "coalesce(n, 0L) AS n",
    )


def attrition(layers: dict[str, DataFrame], by: str = "COUNTRY") -> DataFrame:
    """Rows per layer and group, and the share kept of the first layer.

    A group that a layer empties has 0 rows there; a group the first layer lacks has no share.
    """
    flagged = [df.select(by, F.lit(name).alias("_layer")) for name, df in layers.items()]
    per_layer = {f"_n{i}": F.count_if(F.col("_layer") == name) for i, name in enumerate(layers)}
    counts = reduce(DataFrame.unionAll, flagged).groupBy(by).agg(
        *[n.alias(column) for column, n in per_layer.items()]
    )
    return _retained(counts, list(layers), by)


def _retained(counts: DataFrame, layers: list[str], by: str) -> DataFrame:
    """Long form of row counts ``_n0``, ``_n1``... of the layers, with the shares kept."""
    steps = [F.struct(F.lit(m).alias("layer"), F.col(f"_n{i}").alias("n_rows"))
             for i, m in enumerate(layers)]
    long = counts.select(by, "_n0", F.inline(F.array(*steps)))
    kept = F.try_divide("n_rows", "_n0") * 100
    return long.select(
        by,
        "layer",
        "n_rows",
        kept.alias("retained_pct"),
        (100 - kept).alias("excluded_pct"),
    )


def attrition_in_one_pass(
    df: DataFrame,
    keys: list[str],
    order_by: list[str],
    layers: dict[str, Column],
    first: str = "bronze",
    by: str = "COUNTRY",
) -> DataFrame:
    """:func:`attrition` of layers that keep one row per key, from one scan of the first layer.

    ``layers`` gives for each later layer the condition under which the row that is kept of a key
    (the first by ``order_by``, NULLs first) belongs to it. Rows are first counted per key and
    group, with the first of them carried along; that is combined before the shuffle, so copies of
    a key cost a row per task. Only then are the groups a key occurs in ranked. ``order_by`` must
    tell the copies of a key apart.
    """
    order = [F.col(c) for c in order_by]
    member = [c.alias(f"in_{i}") for i, c in enumerate(layers.values())]
    narrow = df.select(
        *keys, F.col(by).alias("_by"), F.struct(*order).alias("_order"), F.struct(*member).alias("_in")
    )
    counted = narrow.groupBy(*keys, "_by").agg(
        F.count("*").alias("_n"), F.min(F.struct("_order", "_in")).alias("_first")
    )
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_first._order"))
    ranked = counted.withColumn("_rank", place)
    kept = [
        F.count_if((F.col("_rank") == 1) & F.col(f"_first._in.in_{i}")).alias(f"_n{i + 1}")
        for i in range(len(layers))
    ]
    counts = ranked.groupBy(F.col("_by").alias(by)).agg(F.sum("_n").alias("_n0"), *kept)
    return _retained(counts, [first, *layers], by)


def dimension_values(df: DataFrame, country: str = "country", year: str = "year") -> DataFrame:
    """Distinct countries and years of a small table, as two sorted lists."""
    return df.agg(
        F.sort_array(F.collect_set(country)).alias("countries"),
        F.sort_array(F.collect_set(year)).alias("years"),
    )


def baseline_metrics(df: DataFrame, income: str, weight: str = "PERWT") -> DataFrame:
    """Per country, on price-adjusted income: counts, centre, inequality and quintile limits."""
    by = ["country_name"]
    named = df.withColumns({"_ppp": ppp_income(income), "country_name": country_label("COUNTRY")})
    weights = {
        "head": F.lit(1.0),
        "copies": F.greatest(F.col(weight).cast("long"), F.lit(1)),
    }
    rows = weighted_rows(named, "_ppp", weight, by, extra=weights)
    cdf = weighted_cdf(rows, by, extra=list(weights))
    cuts = [C.BOTTOM_SHARE, C.TOP_SHARE]
    shares = bottom_and_top_shares(weight_bands(rows, cdf, by, cuts, [False, True]), by)
    base = cdf.groupBy(*by).agg(
        F.sum("n").alias("n_individuals"),
        F.floor(F.max("weight_total")).alias("n_weighted"),
        F.round(quantile_col(0.5, of="head"), 2).alias("median_ppp"),
        F.round(_mean(), 2).alias("mean_ppp"),
        F.round(gini_col("lorenz_left"), 4).alias("gini"),
        F.round(theil_col("value", "weight"), 4).alias("theil"),
        F.round(quantile_col(0.2, of="copies"), 2).alias("q1_limit"),
        F.round(quantile_col(0.6, of="copies"), 2).alias("q3_limit"),
        F.round(quantile_col(1.0, of="copies"), 2).alias("q5_limit"),
    )
    palma = F.round(F.try_divide("top_income", "bottom_income"), 4).alias("palma")
    return join_groups(base, stage(shares, "shares"), by).select(*base.columns, palma)
