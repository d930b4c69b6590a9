"""Weighted and raw head counts by sex, employment, education and age group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parityframe import constants as C
from parityframe.functions.labels import (
    age_decade,
    education_label,
    employment_label,
    ordinal,
    sex_label,
)

DIMENSIONS = {
    "sex": "sex_label",
    "emp": "empstat_label",
    "edu": "education_label",
    "age": "age_group",
}
EDUCATION_ORDER = [*C.EDUCATION_NAMES.values(), C.OTHER_LABEL]
AGE_ORDER = [f"{low}-{high}" for low, high in C.AGE_DECADES] + [C.OLDEST_LABEL]


def _labels() -> dict[str, Column]:
    return {
        "sex_label": sex_label(),
        "empstat_label": employment_label(),
        "education_label": education_label(),
        "age_group": age_decade(),
    }


def demographic(df: DataFrame, dimension: str, weight: str = "PERWT") -> DataFrame:
    """Head counts per country, year and label of one dimension."""
    label = DIMENSIONS[dimension]
    labelled = df.select("COUNTRY", "YEAR", weight, _labels()[label].alias(label))
    return labelled.groupBy("COUNTRY", "YEAR", label).agg(
        F.sum(weight).alias("weighted_count"), F.count(F.lit(1)).alias("raw_count")
    )


def demographic_base(df: DataFrame, weight: str = "PERWT") -> DataFrame:
    """Head counts by all four labels at once, a few hundred rows per country and year.

    One scan feeds all four tables; see :func:`roll_up`.
    """
    names = list(DIMENSIONS.values())
    labelled = df.select("COUNTRY", "YEAR", weight, *[c.alias(n) for n, c in _labels().items()])
    return labelled.groupBy("COUNTRY", "YEAR", *names).agg(
        F.sum(weight).alias("weighted_count"), F.count(F.lit(1)).alias("raw_count")
    )


def roll_up(base: DataFrame, dimension: str) -> DataFrame:
    return base.groupBy("COUNTRY", "YEAR", DIMENSIONS[dimension]).agg(
        F.sum("weighted_count").alias("weighted_count"), F.sum("raw_count").alias("raw_count")
    )


def share_of_total(df: DataFrame, amount: str, by: list[str], name: str = "share") -> DataFrame:
    """Share of each row in the total of its group, for tables of labels."""
    total = F.sum(amount).over(Window.partitionBy(*by))
    return df.withColumn(name, F.try_divide(F.col(amount), total))


def ordered(df: DataFrame, label: str, order: list[str], then: list[str] = ()) -> DataFrame:
    """Sort a table of labels by a fixed display order, which is added as ``position``."""
    ranked = df.withColumn("position", ordinal(label, order))
    return ranked.orderBy("position", *then)
