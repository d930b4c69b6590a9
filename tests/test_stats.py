from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parityframe.operators import demographics, quantiles, refine, report, stats
from parityframe.plans.persons import TIE_BREAK, persons
from tests.conftest import SF

RNG = np.random.default_rng(21)
DATA = pd.DataFrame(
    {
        "g": np.where(RNG.random(900) < 0.4, "a", "b"),
        "y": np.round(RNG.normal(200, 300, 900), 1),
        "w": RNG.integers(0, 6, 900) + RNG.random(900).round(2),
    }
)


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(DATA)


def test_linear_and_discrete_quantiles(df):
    probs = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    linear = {r["g"]: r for r in quantiles.quantiles(df, "y", probs, ["g"]).collect()}
    steps = quantiles.quantiles(df, "y", probs, ["g"], kind="discrete")
    steps = {r["g"]: r for r in steps.collect()}
    for g, part in DATA.groupby("g"):
        for name, p in probs.items():
            assert linear[g][name] == pytest.approx(np.quantile(part.y, p))
            assert steps[g][name] == np.quantile(part.y, p, method="inverted_cdf")


def test_frequency_quantiles_replicate_rows(df):
    got = quantiles.quantiles(df, "y", {"q": 0.4}, ["g"], frequency="w").collect()
    for row in got:
        part = DATA[DATA.g == row["g"]]
        copies = np.repeat(part.y, part.w.astype(int).clip(lower=1))
        assert row["q"] == pytest.approx(np.quantile(copies, 0.4))


def test_qcut_matches_pandas(df):
    got = quantiles.qcut(df, "y", 5).toPandas().sort_values(["y", "g", "w"])
    want = pd.qcut(DATA.sort_values(["y", "g", "w"]).y, 5, labels=[1, 2, 3, 4, 5]).astype(int)
    assert got["bin"].tolist() == want.tolist()


def test_qcut_by_group_and_summary(df):
    got = quantiles.qcut_summary(df, "y", 4, ["g"]).toPandas().set_index(["g", "bin"])
    for g, part in DATA.groupby("g"):
        bins = pd.qcut(part.y, 4, labels=[1, 2, 3, 4]).astype(int)
        want = part.groupby(bins).y.agg(["count", "mean", "median", "min", "max"])
        for b, row in want.iterrows():
            np.testing.assert_allclose(got.loc[(g, b)], row)


def test_qcut_refuses_duplicate_edges(spark):
    same = spark.createDataFrame([(1.0,)] * 9 + [(2.0,)], "y double")
    with pytest.raises(Exception, match="not distinct"):
        quantiles.qcut(same, "y", 5).count()


def test_describe_matches_pandas(df):
    got = {r["statistic"]: r["amount"] for r in stats.describe(df, "y").collect()}
    want = DATA.y.describe()
    assert got.keys() == set(want.index)
    for name, amount in want.items():
        assert got[name] == pytest.approx(amount)


def test_income_stats(df):
    got = {r["g"]: r for r in stats.income_stats(df, "y", ["g"]).collect()}
    for g, part in DATA.groupby("g"):
        assert got[g]["mean_income"] == pytest.approx(part.y.mean())
        assert got[g]["std_income"] == pytest.approx(part.y.std())
        assert (got[g]["min_income"], got[g]["max_income"]) == (part.y.min(), part.y.max())
        assert got[g]["n_obs"] == len(part)


def test_single_row_has_no_deviation(spark):
    row = stats.income_stats(spark.createDataFrame([("a", 3.0)], "g string, y double"), "y", ["g"])
    assert row.first()["std_income"] is None


def test_iqr_outliers(df):
    got = quantiles.iqr_outliers(df, "y", factor=0.5).count()
    q1, q3 = DATA.y.quantile(0.25), DATA.y.quantile(0.75)
    low, high = q1 - 0.5 * (q3 - q1), q3 + 0.5 * (q3 - q1)
    assert got == ((DATA.y < low) | (DATA.y > high)).sum()


def test_histograms(df):
    got = stats.histogram(df, "y", 20).orderBy("bin").toPandas()
    counts, edges = np.histogram(DATA.y, 20)
    assert got.n.tolist() == counts.tolist()
    np.testing.assert_allclose(got.lower, edges[:-1], atol=1e-9)
    grouped = stats.trimmed_histogram(df, "y", ["g"], bins=20).toPandas()
    kept = DATA[DATA.y < DATA.y.quantile(0.95)]
    assert len(grouped) == 40 and grouped.n.sum() == len(kept)


def test_histogram_of_one_value_and_of_nothing(spark):
    same = spark.createDataFrame([(5.0,)] * 3, "y double")
    assert stats.histogram(same, "y", 2).orderBy("bin").toPandas().n.tolist() == [0, 3]
    assert stats.histogram(same.limit(0), "y", 2).toPandas().n.tolist() == [0, 0]


def test_missing_counts_see_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (None, float("nan")), (3, None)], "a int, b double")
    assert stats.missing_counts(df, ["a", "b"]).first().asDict() == {"a": 1, "b": 2}
    rows = stats.null_percent(df).collect()
    assert [(r["column_name"], r["null_pct"]) for r in rows] == [("b", 66.67), ("a", 33.33)]


def test_attrition(df):
    layers = {"all": df, "kept": df.filter("y > 0")}
    rows = {(r["g"], r["layer"]): r for r in stats.attrition(layers, "g").collect()}
    for g, part in DATA.groupby("g"):
        kept = rows[(g, "kept")]
        assert kept["retained_pct"] == pytest.approx((part.y > 0).mean() * 100)
        assert kept["retained_pct"] + kept["excluded_pct"] == pytest.approx(100)
        assert rows[(g, "all")]["retained_pct"] == 100


def test_attrition_of_an_emptied_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "g string, y int")
    layers = {"all": df, "some": df.filter("g = 'a' AND y = 1"), "none": df.filter("false")}
    rows = {(r["g"], r["layer"]): r for r in stats.attrition(layers, "g").collect()}
    assert len(rows) == 9
    assert rows["a", "some"]["retained_pct"] == 50 and rows["a", "none"]["n_rows"] == 0
    assert rows["b", "some"]["n_rows"] == 0 and rows["b", "some"]["excluded_pct"] == 100
    assert rows[None, "all"]["n_rows"] == 1 and rows[None, "some"]["n_rows"] == 0


def test_attrition_in_one_pass(spark):
    rng = np.random.default_rng(8)
    rows = [(int(k), int(t), rng.choice(["a", "b", "c", None]), int(y))
            for t, (k, y) in enumerate(zip(rng.integers(0, 60, 400), rng.integers(0, 9, 400)))]
    rows += [(7, 1000 + t, "a", 3) for t in range(300)] + [(None, 2000, "b", 1), (None, 2001, "b", 8)]
    df = spark.createDataFrame(rows, "k int, t int, g string, y int").repartition(7)
    kept = {}
    for k, t, g, y in sorted(rows, key=lambda r: r[1]):
        kept.setdefault(k, (g, y))
    found = stats.attrition_in_one_pass(
        df, ["k"], ["t"], {"single": F.lit(True), "low": F.col("y") < 4}, "all", "g"
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1
    got = {(r["g"], r["layer"]): r["n_rows"] for r in found.collect()}
    for g in ("a", "b", "c", None):
        assert got[g, "all"] == sum(r[2] == g for r in rows)
        assert got[g, "single"] == sum(x == g for x, _ in kept.values())
        assert got[g, "low"] == sum(x == g and y < 4 for x, y in kept.values())
    assert len(got) == 12


def test_one_pass_attrition_equals_the_layers(spark):
    raw = persons(spark, SF)
    layers = {"bronze": raw, "deduplicated": refine.deduplicate(raw, ["SERIAL", "PERNUM"], TIE_BREAK),
              "silver": refine.refine(raw, order_by=TIE_BREAK)}
    want = stats.attrition(layers)
    got = stats.attrition_in_one_pass(
        raw, ["SERIAL", "PERNUM"], TIE_BREAK,
        {"deduplicated": F.lit(True), "silver": refine.survives(raw.columns)},
    )
    assert sorted(got.collect()) == sorted(want.collect())


def test_describe_columns(spark, df):
    made = stats.describe_columns(df, ["y", "w"], ["g"]).collect()
    got = {(r["g"], r["column_name"], r["statistic"]): r["amount"] for r in made}
    for (g, part) in DATA.groupby("g"):
        for column in ("y", "w"):
            for name, want in part[column].describe().items():
                assert got[g, column, name] == pytest.approx(want)
    one_none = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    assert {r["column_name"] for r in stats.describe_columns(one_none, ["a", "b"]).collect()} == {"a"}


def test_null_profile_of_nested_columns(spark):
    rows = [(1, (None, (float("nan"),)), [None]), (None, None, None), (3, ("x", None), [])]
    df = spark.createDataFrame(rows, "`it's` int, s struct<`a.b`:string,t:struct<d:double>>, l array<int>")
    profile = stats.null_profile(df)
    assert profile._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    got = [(r["column_name"], r["type"], r["n_rows"], r["n_missing"]) for r in profile.collect()]
    assert got == [
        ("it's", "int", 3, 1),
        ("s", "struct<a.b:string,t:struct<d:double>>", 3, 1),
        ("s.a.b", "string", 3, 2),
        ("s.t", "struct<d:double>", 3, 2),
        ("s.t.d", "double", 3, 3),
        ("l", "array<int>", 3, 1),
    ]
    empty = stats.null_profile(df.limit(0)).collect()
    assert [(r["n_rows"], r["n_missing"], r["missing_pct"]) for r in empty] == [(0, 0, None)] * 6


def test_rolled_up_demographics_equal_direct_ones(spark):
    people = spark.range(500).selectExpr(
        "CAST(id % 3 AS INT) AS COUNTRY", "2010 AS YEAR", "CAST(id % 7 AS DOUBLE) AS PERWT",
        "CAST(id % 90 AS INT) AS AGE", "CAST(id % 4 AS INT) AS SEX",
        "CAST(id % 6 AS INT) AS EDATTAIN", "CAST(id % 5 AS INT) AS EMPSTAT",
    )
    base = demographics.demographic_base(people)
    for name in demographics.DIMENSIONS:
        direct = demographics.demographic(people, name)
        assert sorted(demographics.roll_up(base, name).collect()) == sorted(direct.collect())
    shares = demographics.share_of_total(direct, "weighted_count", ["COUNTRY", "YEAR"])
    total = shares.groupBy("COUNTRY").agg(F.sum("share").alias("s")).collect()
    assert [r["s"] for r in total] == pytest.approx([1, 1, 1])


@pytest.fixture()
def table(spark):
    return spark.createDataFrame(
        [(76, "Brazil", y, 0.5 + y / 1e4, 0.4, 3.0, 0.25, 1234.5, 10.0, 4321) for y in (1, 2, 3)],
        "country int, country_name string, year int, gini double, theil double, palma double, "
        "sdg_10_2_1 double, mean_income double, mean_b40 double, n_obs long",
    )


def test_report_shapes(table):
    assert report.metric_comparison(table).count() == 12
    pairs = report.actual_vs_target(table).collect()
    assert len(pairs) == 6
    assert {r["gap"] for r in pairs if r["kind"] == "Target SDG"} == {None}
    assert report.target_gap(table).orderBy("year").first()["gap"] == pytest.approx(0.2001)
    trend = report.metric_trend(table).filter("metric = 'gini'").orderBy("year").collect()
    assert [r["scaled"] for r in trend] == pytest.approx([0, 0.5, 1], abs=1e-5)
    text = report.display_format(table).orderBy("year").first()
    assert text["palma"] == "3.00×" and text["sdg_10_2_1"] == "25.0%" and text["n_obs"] == "4,321"


def test_kpi_defaults_missing_median_to_zero(spark, table):
    found = spark.createDataFrame([(76, 1, 9.0, 10), (76, 2, 8.0, 5)],
                                  "COUNTRY int, YEAR int, median_income double, n_obs long")
    rows = {r["year"]: r for r in report.kpi_summary(table, found).collect()}
    assert [rows[y]["median_income"] for y in (1, 2, 3)] == [9.0, 8.0, 0.0]
    assert {r["n_obs_total"] for r in rows.values()} == {15}


def test_quintile_contrasts(spark):
    shares = spark.createDataFrame(
        [("a", 1, 10.0, 0.0), ("a", 5, 90.0, 0.9), ("b", 1, 5.0, 0.1), ("b", 2, 5.0, 0.2)],
        "g string, quantile int, mean_income double, income_share double",
    )
    long = {(r["g"], r["part"]): r["income_share_pct"]
            for r in quantiles.share_b40_vs_top20(shares, ["g"]).collect()}
    assert long[("b", "Bottom 40% (Q1+Q2)")] == pytest.approx(30)
    assert long[("b", "Top 20% (Q5)")] == 0 and long[("a", "Top 20% (Q5)")] == pytest.approx(90)
    ratio = {r["g"]: r for r in quantiles.quintile_ratio(shares, ["g"]).collect()}
    assert ratio["a"]["share_ratio"] is None and ratio["a"]["mean_ratio"] == 9
    assert ratio["b"]["mean_ratio"] is None


def test_results_do_not_depend_on_broadcasts(spark, df):
    """Large per-group tables are joined by shuffling; the outcome is the same."""

    def run():
        bins = quantiles.qcut(df, "y", 4, ["g"]).groupBy("g", "bin").count()
        far = quantiles.iqr_outliers(df, "y", ["g"], 0.5).groupBy("g").count()
        return sorted(bins.collect()), sorted(far.collect())

    before = run()
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for name in ("spark.sql.autoBroadcastJoinThreshold",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(name, "-1")
    try:
        assert run() == before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
