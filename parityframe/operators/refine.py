"""Row-level steps from raw to refined person records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parityframe import constants as C
from parityframe.functions.labels import (
    code_label,
    country_label,
    cut,
    employment_label,
    income_category,
    ppp_income,
    sex_label,
)


def add_lineage(df: DataFrame, source: str, layer: str = "bronze") -> DataFrame:
    return df.withColumns(
        {
            "_source_file": F.lit(source),
            "_ingested_at": F.current_timestamp(),
            "_layer": F.lit(layer),
        }
    )


def select_available(df: DataFrame, wanted: list[str] = C.REFINED_COLUMNS) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    present = set(df.columns)
    return df.select([name for name in wanted if name in present])


def cast_numeric(df: DataFrame, columns: list[str] = C.NUMERIC_COLUMNS) -> DataFrame:
    """Cast to double; text that is no number becomes NULL."""
    present = [name for name in columns if name in df.columns]
    return df.withColumns({name: F.col(name).try_cast("double") for name in present})


def deduplicate(
    df: DataFrame, keys: list[str] = ("SERIAL", "PERNUM"), order_by: list[str] = ()
) -> DataFrame:
    """One row per key: the first by ``order_by`` (NULLs first).

    ``order_by`` should be a total order of the copies of a key. Without it all other columns
    are used, so that the result is the same in every run, at the price of reading them all.

    Spark turns the rank filter into a limit per key that is applied before the shuffle as well
    as after it, so of a key with very many copies one row per map task is moved.
    """
    keys = list(keys)
    order = list(order_by) or [name for name in df.columns if name not in keys]
    ranked = Window.partitionBy(*keys).orderBy(*order)
    kept = df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1")
    return kept.drop("_rank")


def filter_age(df: DataFrame, low: int = C.MIN_AGE, high: int = C.MAX_AGE) -> DataFrame:
    if "AGE" not in df.columns:
        return df
    return df.filter(F.col("AGE").between(low, high))


def harmonized_income(columns: list[str], sentinel_min: float = C.SENTINEL_MIN) -> Column:
    """Total income, else earned income, else zero; sentinels NULL, negatives zero.

    A sentinel in the total does not fall back to earned income, since it is a value.
    """
    sources = [F.col(c).try_cast("double") for c in ("INCTOT", "INCEARN") if c in columns]
    if len(sources) == 1:
        income = sources[0]
    else:
        income = F.coalesce(*sources, F.lit(0.0))
    return F.when(income < 0, 0.0).when(income < sentinel_min, income)


def harmonize_income(df: DataFrame, sentinel_min: float = C.SENTINEL_MIN) -> DataFrame:
    income = harmonized_income(df.columns, sentinel_min)
    return df.withColumn("income_analysis", income).filter("income_analysis IS NOT NULL")


def drop_null_keys(df: DataFrame, columns: list[str] = ("YEAR", "PERWT")) -> DataFrame:
    present = [name for name in columns if name in df.columns]
    return df.dropna(subset=present) if present else df


def add_derived(df: DataFrame) -> DataFrame:
    derived = {"_layer": F.lit("silver")}
    if "income_analysis" in df.columns:
        derived["income_category"] = income_category()
    if "SEX" in df.columns:
        derived["sex_label"] = sex_label()
    if "COUNTRY" in df.columns:
        derived["country_name"] = country_label()
    return df.withColumns(derived)


def refine(
    bronze: DataFrame,
    dedup_keys: list[str] = ("SERIAL", "PERNUM"),
    order_by: list[str] = (),
) -> DataFrame:
    """Raw to refined. Copies are dropped before the age filter, which must stay so: the kept
    copy decides whether the person passes."""
    extra = [c for c in (*dedup_keys, *order_by) if c not in C.REFINED_COLUMNS]
    df = select_available(bronze, [*C.REFINED_COLUMNS, *extra])
    df = deduplicate(cast_numeric(df), dedup_keys, order_by).drop(*extra)
    df = harmonize_income(filter_age(df))
    return add_derived(drop_null_keys(df))


def survives(columns: list[str]) -> Column:
    """Whether :func:`refine` keeps a raw row that has been kept as the only one of its key."""
    tests = [harmonized_income(columns).isNotNull()]
    if "AGE" in columns:
        tests.append(F.col("AGE").try_cast("double").between(C.MIN_AGE, C.MAX_AGE))
    for name in ("YEAR", "PERWT"):
        if name in columns:
            kind = "double" if name in C.NUMERIC_COLUMNS else "string"
            tests.append(F.col(name).try_cast(kind).isNotNull())
    return F.coalesce(reduce(Column.__and__, tests), F.lit(False))


def valid_income(
    df: DataFrame,
    column: str = "INCTOT",
    sentinels: list[int] | None = None,
    low: float | None = 0,
    below: float | None = None,
    strict_low: bool = False,
) -> DataFrame:
    """Rows whose income is no sentinel code and lies in the range; NULL and NaN are dropped."""
    y = F.col(column)
    keep = y.isNotNull() & ~F.isnan(y.cast("double"))
    if sentinels:
        keep = keep & ~y.isin(sentinels)
    if low is not None:
        keep = keep & (y > low if strict_low else y >= low)
    if below is not None:
        keep = keep & (y < below)
    return df.filter(keep)


def refine_baseline(
    raw: DataFrame, order_by: list[str] = (), ages: tuple[int, int] = (15, 65)
) -> DataFrame:
    """The alternative refinement: filters first, then copies per sample, prices adjusted.

    Total income must be present, not negative and no sentinel; earned income may be missing.
    Labels of unknown codes stay NULL.
    """
    known = valid_income(raw, "INCTOT", C.SENTINEL_CODES)
    earned = F.col("INCEARN").isNull() | ~F.col("INCEARN").isin(C.SENTINEL_CODES)
    kept = filter_age(known.filter(earned), *ages)
    return deduplicate(kept, ["SAMPLE", "SERIAL", "PERNUM"], order_by).withColumns(
        {
            "income_ppp": ppp_income("INCTOT"),
            "country_name": code_label("COUNTRY", C.COUNTRY_NAMES),
            "sex_label": sex_label(strict=True),
            "empstat_label": employment_label(strict=True),
            "age_group": cut("AGE", C.AGE_CUT_EDGES, C.AGE_CUT_LABELS),
        }
    )


def filter_countries(df: DataFrame, selected: list[int], column: str = "COUNTRY") -> DataFrame:
    """Rows of the selected countries; an empty selection means all."""
    return df.filter(F.col(column).isin(list(selected))) if selected else df
