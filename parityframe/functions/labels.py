"""Label, bin and status expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parityframe import constants as C


def case(branches: list[tuple[str, object]], otherwise: object = None) -> Column:
    """CASE over (condition, constant) branches; conditions are SQL text."""
    steps = " ".join(f"WHEN {condition} THEN {literal(v)}" for condition, v in branches)
    return F.expr(f"CASE {steps} ELSE {literal(otherwise)} END")


def literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def code_label(code: str, names: dict[int, str], otherwise: object = None) -> Column:
    """Label of an integer code; ``otherwise`` for codes not listed and for NULL."""
    return case([(f"({code}) = {key}", name) for key, name in names.items()], otherwise)


def country_label(code: str = "COUNTRY") -> Column:
    return F.coalesce(code_label(code, C.COUNTRY_NAMES), F.expr(f"CAST(({code}) AS STRING)"))


def sex_label(code: str = "SEX", strict: bool = False) -> Column:
    """Everything but code 1 counts as female; ``strict`` leaves unknown codes NULL."""
    return code_label(code, C.SEX_NAMES, None if strict else C.SEX_NAMES[2])


def employment_label(code: str = "EMPSTAT", strict: bool = False) -> Column:
    if strict:
        return code_label(code, C.EMPLOYMENT_NAMES_EN)
    return code_label(code, C.EMPLOYMENT_NAMES, C.OTHER_LABEL)


def education_label(code: str = "EDATTAIN") -> Column:
    return code_label(code, C.EDUCATION_NAMES, C.OTHER_LABEL)


def age_decade(age: str = "AGE", strict: bool = False) -> Column:
    """Ten-year group. Ages below 10 or missing fall in the oldest group unless ``strict``."""
    groups = [(f"({age}) BETWEEN {lo} AND {hi}", f"{lo}-{hi}") for lo, hi in C.AGE_DECADES]
    if strict:
        return case([*groups, (f"({age}) >= 80", C.OLDEST_LABEL)])
    return case(groups, C.OLDEST_LABEL)


def cut(
    value: str, edges: list[float], labels: list, include_lowest: bool = False
) -> Column:
    """Right-closed intervals between consecutive edges; NULL outside of them.

    Edges are numbers or SQL text.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per interval is needed")
    bins = []
    for i, label in enumerate(labels):
        above = ">=" if include_lowest and i == 0 else ">"
        bins.append((f"({value}) {above} {edges[i]} AND ({value}) <= {edges[i + 1]}", label))
    return case(bins)


def income_category(income: str = "income_analysis") -> Column:
    steps = [(f"{income} < {limit}", name) for limit, name in C.INCOME_CATEGORIES]
    return case([(f"{income} = 0", C.ZERO_CATEGORY), *steps], C.TOP_CATEGORY)


def ppp_income(
    income: str,
    country: str = "COUNTRY",
    factors: dict[int, float] | None = None,
    default: float = 1.0,
) -> Column:
    """Income times the price-level factor of the country."""
    factors = C.PPP_FACTORS if factors is None else factors
    rate = code_label(country, factors, default) if factors else F.lit(default)
    return F.col(income) * rate


def gini_status(gini: str = "gini") -> Column:
    steps = [(f"{gini} > {limit}", name) for limit, name in C.GINI_STATUS]
    return case([*steps, (f"{gini} IS NOT NULL", C.GINI_STATUS_REST)])


def gauge_band(gini: str = "gini") -> Column:
    """Index of the gauge segment a value lies in: 0 up to the number of inner edges."""
    return F.expr(" + ".join(f"CAST({gini} >= {edge}D AS INT)" for edge in C.GAUGE_EDGES))


def ordinal(label: str, order: list[str]) -> Column:
    """Position of a label in a fixed display order, after all others if not listed."""
    positions = [(f"{label} = {literal(name)}", i) for i, name in enumerate(order)]
    return case(positions, len(order))


def dictionary(spark: SparkSession, names: dict[int, str], key: str, label: str) -> DataFrame:
    """A code dictionary as a dimension table."""
    return spark.createDataFrame(list(names.items()), f"{key} int, {label} string")


def with_sector_labels(df: DataFrame) -> DataFrame:
    """Occupation and industry names beside their codes; NULL for unknown codes.

    Both dictionaries are fixed lists of about a dozen entries, hence the broadcast.
    """
    spark = df.sparkSession
    occupation = dictionary(spark, C.OCCUPATION_NAMES, "OCCISCO", "occupation_label")
    industry = dictionary(spark, C.INDUSTRY_NAMES, "INDGEN", "industry_label")
    df = df.join(F.broadcast(occupation), "OCCISCO", "left")
    return df.join(F.broadcast(industry), "INDGEN", "left")
