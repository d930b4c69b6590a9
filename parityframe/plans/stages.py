"""Raw CSV to refined records to aggregate tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parityframe import constants as C
from parityframe.operators.bands import weight_bands
from parityframe.operators.demographics import DIMENSIONS, demographic_base, roll_up
from parityframe.operators.inequality import (
    bottom_and_top_shares,
    published_summary,
    summary_from,
)
from parityframe.operators.prefix import weighted_cdf, weighted_rows
from parityframe.operators.quantiles import published_quintiles, shares_from
from parityframe.operators.refine import add_lineage, refine, select_available
from parityframe.operators.sampling import stratified
from parityframe.operators.stats import stats_from
from parityframe.sources import bundle
from parityframe.sources.ingest import (
    ensure_bronze,
    is_written,
    load_gold,
    path_exists,
    read_persons_csv,
    write_counted,
    write_csv,
)
from parityframe.workspace import stage


@dataclass(frozen=True)
class LayerRows:
    """Rows a layer was made from and rows it holds; ``None`` where a stored layer was reused."""

    layer: str
    rows_in: int | None
    rows_out: int | None


def build_bronze(spark: SparkSession, source: str, path: str) -> LayerRows | None:
    """Ingest the raw table unless it is stored, counting its rows as they are written."""
    if is_written(spark, path):
        return LayerRows("bronze", None, None)
    if not path_exists(spark, source):
        ensure_bronze(spark, source, path)  # says so in the log
        return None
    read = Observation()
    raw = read_persons_csv(spark, source).observe(read, F.count(F.lit(1)).alias("rows"))
    written = write_counted(add_lineage(raw, source), path)
    return LayerRows("bronze", read.get["rows"], written)


def build_silver(bronze: DataFrame, path: str, **refine_options) -> LayerRows:
    """Write the refined table by country, counting the rows that come and go on the way.

    The count of the rows that come is taken over the columns the refinement reads.
    """
    extra = [*refine_options.get("dedup_keys", ()), *refine_options.get("order_by", ())]
    wanted = dict.fromkeys([*C.REFINED_COLUMNS, *extra])
    read = Observation()
    used = select_available(bronze, [*wanted]).observe(read, F.count(F.lit(1)).alias("rows"))
    written = write_counted(refine(used, **refine_options), path, ["COUNTRY"])
    return LayerRows("silver", read.get["rows"], written)


def gold_tables(silver: DataFrame) -> dict[str, DataFrame]:
    """The aggregate tables over all rows of a stored refined table.

    All income tables come from one cumulative table, weighted and unweighted totals side by
    side; all head counts from one table by all labels. So the rows are scanned twice, and once
    more for the few values that straddle one of the cuts, which quintiles and top and bottom
    shares have in common.
    """
    by, income = ["COUNTRY", "YEAR"], "income_analysis"
    with ThreadPoolExecutor(1) as aside:  # beside the income tables, which do not need it
        people = aside.submit(stage, demographic_base(silver), "demographics")
        tables = _income_tables(silver, by, income)
        for name in DIMENSIONS:
            tables[f"gold_demog_{name}"] = roll_up(people.result(), name)
    return tables


def _income_tables(silver: DataFrame, by: list[str], income: str) -> dict[str, DataFrame]:
    plain = {"head": F.lit(1.0), "head_income": F.col(income)}
    rows = weighted_rows(silver, income, "PERWT", by, extra=plain)
    cdf = weighted_cdf(rows, by, extra=list(plain))
    stats = stats_from(cdf, by, "head", "head_income")
    cuts = [0.2, 0.4, 0.6, 0.8, 0.9]  # bands 0-1 are the bottom 40 %, bands 4-5 the top quintile
    pieces = weight_bands(rows, cdf, by, cuts, reuse=True)
    shares = bottom_and_top_shares(pieces, by, bottom=1, top=5)
    quintiles = shares_from(pieces, by, "least(band, 4) + 1")
    return {
        "gold_gini_by_year": published_summary(summary_from(cdf, shares, by)),
        "gold_quintile_by_year": published_quintiles(quintiles),
        "gold_theil_by_year": stats.orderBy(*by),
    }


def build_gold(silver: DataFrame, root: str) -> bundle.Version:
    """Publish the aggregate tables below ``root``, all of them or, if one fails, none."""
    return bundle.publish(gold_tables(silver), root)


@dataclass(frozen=True)
class Run:
    """What a run of all stages has made: the aggregate tables by name, rows in and out."""

    tables: dict[str, DataFrame]
    rows: list[LayerRows]


def run(spark: SparkSession, source: str, root: str, **refine_options) -> Run | None:
    """All stages; each hands over a stored table, and a stored raw table is reused.

    Without stored table and source there is nothing to do: logged, and ``None`` is returned.
    """
    first = build_bronze(spark, source, f"{root}/bronze")
    if first is None:
        return None
    second = build_silver(spark.read.parquet(f"{root}/bronze"), f"{root}/silver", **refine_options)
    build_gold(spark.read.parquet(f"{root}/silver"), f"{root}/gold")
    return Run(load_gold(spark, f"{root}/gold"), [first, second])


def extract_sample(
    spark: SparkSession, source: str, target: str, fractions: dict[int, float], seed: int = 42
) -> None:
    """A stratified sample of a raw CSV as one CSV file, for tools that need a small one."""
    people = read_persons_csv(spark, source)
    write_csv(stratified(people, "COUNTRY", fractions, seed), target, single_file=True)
