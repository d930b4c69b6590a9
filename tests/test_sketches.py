"""Sketches against exact order statistics and counts."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from parityframe.operators import sketches
from parityframe.workspace import stage

PROBS = {"low": 0.01, "p25": 0.25, "mid": 0.5, "p90": 0.9, "top": 1.0}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(6)
    n = 40_000
    values = np.where(rng.random(n) < 0.3, 0.0, np.round(rng.lognormal(6, 1.2, n), 2))
    groups = np.where(rng.random(n) < 0.9, "big", "small")
    data = [(str(g), int(k % 3), float(v)) for k, (g, v) in enumerate(zip(groups, values))]
    data += [("small", 1, None), ("small", 1, float("nan")), (None, 2, 5.0)]
    return stage(spark.createDataFrame(data, "g string, year int, y double").repartition(6))


def test_merged_quantiles_keep_the_stated_error(rows):
    fine = stage(sketches.quantile_sketches(rows, "y", ["g", "year"]))
    usable = rows.filter("y IS NOT NULL AND NOT isnan(y)")
    for by in (["g", "year"], ["g"], []):
        answers = sketches.approximate_quantiles(sketches.merge_quantiles(fine, by), PROBS)
        counts = {tuple(r[c] for c in by): r["n"] for r in answers.collect()}
        want = usable.groupBy(*by).agg(F.count("*").alias("n")).collect()
        assert counts == {tuple(r[c] for c in by): r["n"] for r in want}
        errors = sketches.rank_errors(rows, "y", answers, PROBS).collect()
        assert len(errors) == len(counts) * len(PROBS)
        assert max(r["rank_error"] for r in errors) <= 2 * sketches.RANK_ERROR
        assert {r["rank_error"] for r in errors if r["quantile"] == "top"} == {0}


def test_rank_errors_see_wrong_answers(spark):
    df = spark.range(100).selectExpr("CAST(id AS DOUBLE) AS y")
    answers = spark.createDataFrame([(100, 49.0, 80.0)], "n long, mid double, off double")
    found = sketches.rank_errors(df, "y", answers, {"mid": 0.5, "off": 0.5}).collect()
    assert {r["quantile"]: round(r["rank_error"], 6) for r in found} == {"mid": 0.0, "off": 0.3}


def test_one_aggregate_builds_the_sketches(rows):
    text = sketches.quantile_sketches(rows, "y", ["g"])._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and text.count("HashAggregate") == 2 and "Window" not in text


def test_distinct_keys(rows):
    table = rows.withColumn("k", F.when(F.col("y") > 0, F.floor("y")))
    fine = stage(sketches.distinct_sketches(table, ["k", "year"], ["g", "year"]))
    for by in (["g", "year"], ["g"], []):
        exact = {tuple(r[c] for c in by): (r["n_rows"], r["n_keys"])
                 for r in sketches.key_counts(table, ["k", "year"], by).collect()}
        plain = table.fillna(-1, ["k"]).groupBy(*by).agg(F.count("*"), F.countDistinct("k", "year")).collect()
        assert exact == {tuple(r[: len(by)]): tuple(r[len(by) :]) for r in plain}
        for r in sketches.estimated_counts(sketches.merge_distinct(fine, by)).collect():
            n_rows, n_keys = exact[tuple(r[c] for c in by)]
            assert r["n_rows"] == n_rows
            assert abs(r["n_keys"] - n_keys) <= 5 * sketches.DISTINCT_ERROR * n_keys + 1
