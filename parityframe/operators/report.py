"""Reshaping of the small aggregate tables for display."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parityframe import constants as C
from parityframe.functions.labels import gauge_band, gini_status
from parityframe.workspace import join_groups

METRICS = ["gini", "theil", "palma", "sdg_10_2_1"]
KEYS = ["country", "country_name", "year"]


def with_status(table: DataFrame) -> DataFrame:
    return table.withColumns({"status": gini_status(), "gauge_band": gauge_band()})


def target_gap(table: DataFrame, target: float = C.GINI_TARGET) -> DataFrame:
    gap = F.round(F.col("gini") - F.lit(target), 4)
    return table.select(*KEYS, "gini", F.lit(target).alias("target"), gap.alias("gap"))


def actual_vs_target(table: DataFrame, target: float = C.GINI_TARGET) -> DataFrame:
    """Two rows per group: the measured Gini and the target; the gap on the former."""
    both = table.select(
        *KEYS, F.col("gini").alias(C.ACTUAL_LABEL), F.lit(target).alias(C.TARGET_LABEL)
    )
    long = both.unpivot(KEYS, [C.ACTUAL_LABEL, C.TARGET_LABEL], "kind", "amount")
    gap = F.when(F.col("kind") == C.ACTUAL_LABEL, F.round(F.col("amount") - F.lit(target), 4))
    return long.withColumn("gap", gap)


def metric_comparison(table: DataFrame) -> DataFrame:
    return table.unpivot(KEYS, METRICS, "metric", "amount")


def metric_trend(table: DataFrame, metrics: list[str] = ("gini", "theil", "palma")) -> DataFrame:
    """Each metric scaled to its range over the years of a country, in long form."""
    per_country = Window.partitionBy("country")

    def scaled(name: str) -> Column:
        low, high = F.min(name).over(per_country), F.max(name).over(per_country)
        return (F.col(name) - low) / (high - low + F.lit(1e-10))

    wide = table.select("country", "year", *[scaled(m).alias(m) for m in metrics])
    return wide.unpivot(["country", "year"], list(metrics), "metric", "scaled")


def display_format(table: DataFrame) -> DataFrame:
    """The inequality table as text: four decimals, ratios, percentages, grouped digits."""
    return table.select(
        "country_name",
        "year",
        F.format_number("gini", 4).alias("gini"),
        F.format_number("theil", 4).alias("theil"),
        F.concat(F.format_number("palma", 2), F.lit("×")).alias("palma"),
        F.concat(F.format_number(F.col("sdg_10_2_1") * 100, 1), F.lit("%")).alias("sdg_10_2_1"),
        F.format_number("mean_income", 0).alias("mean_income"),
        F.format_number("mean_b40", 0).alias("mean_b40"),
        F.format_number("n_obs", 0).alias("n_obs"),
    )


def quintile_format(shares: DataFrame) -> DataFrame:
    """The quintile table as text."""
    label = F
    for q, name in C.QUINTILE_LABELS.items():
        label = label.when(F.col("quantile") == q, name)
    return shares.select(
        "country",
        "year",
        label.otherwise(F.lit(None).cast("string")).alias("quintile"),
        F.format_number("lower_bound", 0).alias("lower_bound"),
        F.format_number("upper_bound", 0).alias("upper_bound"),
        F.format_number("mean_income", 2).alias("mean_income"),
        F.concat(F.format_number(F.col("income_share") * 100, 2), F.lit("%")).alias(
            "income_share"
        ),
    )


def kpi_summary(table: DataFrame, stats: DataFrame) -> DataFrame:
    """Headline numbers per country and year, with the median looked up in the statistics.

    ``stats`` has one row per country and year, as ``table`` has.
    """
    medians = stats.select(
        F.col("COUNTRY").alias("country"), F.col("YEAR").alias("year"), "median_income"
    )
    joined = join_groups(table, medians, ["country", "year"], "left")
    return joined.select(
        *KEYS,
        "gini",
        "palma",
        F.coalesce("median_income", F.lit(0.0)).alias("median_income"),
        "n_obs",
        stats.agg(F.sum("n_obs")).scalar().alias("n_obs_total"),
    )
