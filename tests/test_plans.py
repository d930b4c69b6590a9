"""What the optimizer makes of the queries."""

from __future__ import annotations

import pytest

from parityframe.operators import inequality, refine
from parityframe.operators.prefix import collapse, inside_cells, weighted_rows, with_cells
from parityframe.plans.catalog import BY, ID, INCOME, QUERIES, WEIGHT, incomes, silver
from parityframe.plans.persons import TIE_BREAK, persons
from tests.conftest import SF


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    return incomes(spark, SF)


@pytest.mark.parametrize(
    "key", ["gini", "inequality_summary", "quantile_shares", "income_stats", "iqr_outliers"]
)
def test_no_python_and_no_cross_join(spark, key):
    text = plan(QUERIES[key](spark, SF))
    for node in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


@pytest.mark.parametrize("by", [BY, ["COUNTRY"], []])
def test_rows_are_collapsed_before_the_only_shuffle_of_rows(stored, by):
    lines = plan(collapse(weighted_rows(stored, INCOME, WEIGHT, by), by)).splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange" in line]
    assert len(exchanges) == 1
    below = lines[exchanges[0] + 1]
    assert "HashAggregate" in below and "partial_sum" in below
    assert "hashpartitioning" in lines[exchanges[0]] and "value" in lines[exchanges[0]]


@pytest.mark.parametrize("by", [BY, ["COUNTRY"], []])
def test_values_are_moved_once_more_for_the_running_totals(spark, stored, by):
    """Of ``leaves``: one exchange of rows and one of distinct values, at any size of the joins."""
    blocks = collapse(with_cells(weighted_rows(stored, INCOME, WEIGHT, by), "value"), [*by, "_cell"])
    leaves = inside_cells(blocks, by, "value", ["weight", "income"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit in (before, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        lines = plan(leaves).splitlines()
        moved = [line for line in lines if "Exchange" in line and "Broadcast" not in line]
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        rows = [line for line in moved if "value" in line]
        values = [line for line in moved if "_cell" in line and "value" not in line]
        assert len(rows) == len(values) == 1 and len(moved) == 2, "\n".join(lines)
        assert "rangepartitioning" not in "".join(lines)
        below = lines[lines.index(rows[0]) + 1]
        assert "HashAggregate" in below and "partial_sum" in below
        assert "Join" not in "".join(lines)


def test_only_needed_columns_and_rows_are_read(stored):
    by = ["COUNTRY"]
    text = plan(collapse(weighted_rows(stored, INCOME, WEIGHT, by), by))
    assert "YEAR" not in text
    assert "PushedFilters: [IsNotNull(income_analysis), IsNotNull(PERWT)" in text
    assert "GreaterThanOrEqual(income_analysis,0.0)" in text


@pytest.mark.parametrize("by", [BY, []])
def test_measures_read_the_rows_once(stored, by):
    """What follows the collapse is planned on the stored table of distinct values."""
    (source,) = stored.inputFiles()[:1]
    folder = source.rsplit("/", 1)[0].split(":", 1)[-1].lstrip("/")
    assert folder not in plan(inequality.gini(stored, INCOME, WEIGHT, by))


def test_only_partial_aggregates_meet_in_one_task(stored):
    """Without groups the stored parts are summed on the map side before they meet."""
    lines = plan(inequality.gini(stored, INCOME, WEIGHT)).splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert single
    for i in single:
        assert "HashAggregate" in lines[i + 1]


@pytest.mark.parametrize("key", ["gini", "poverty_half_median", "inequality_summary"])
def test_stored_values_are_not_shuffled_again(spark, key):
    """Every table is joined to the distinct values by broadcast, on its stored size."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100kb")
    try:
        text = plan(QUERIES[key](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            assert "HashAggregate" in lines[i + 1], text


def test_dedup_limits_copies_before_the_shuffle(spark):
    text = plan(refine.deduplicate(persons(spark, SF), ID, TIE_BREAK))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Exchange hashpartitioning") < text.rindex("WindowGroupLimit")


def test_refinement_prunes_columns(spark):
    text = plan(silver(spark, SF).groupBy("COUNTRY").count())
    scan = text[text.rindex("ReadSchema") :]
    assert "l_tax" not in scan and "l_linestatus" not in scan


def test_age_filter_is_pushed_to_a_stored_table(spark, tmp_path):
    path = str(tmp_path / "raw")
    persons(spark, SF).write.parquet(path)
    df = refine.filter_age(spark.read.parquet(path)).select("SERIAL")
    assert "GreaterThanOrEqual(AGE,18)" in plan(df)
