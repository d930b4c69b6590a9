from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from parityframe.functions.metrics import mld_col, theil_col, weighted_mean_col
from parityframe.operators import inequality, lorenz, prefix, quantiles
from parityframe.workspace import stage
from tests import brute


def sample_groups():
    """Group name -> (values, weights), from closed forms to awkward random data."""
    rng = np.random.default_rng(11)
    n = 300
    groups = {
        "equal": (np.full(80, 37.5), np.ones(80)),
        "owner": (np.r_[np.zeros(49), 7.0], np.ones(50)),
        "steps": (3.0 * np.arange(1, 641), np.ones(640)),
        "single": (np.array([12.25]), np.ones(1)),
        "negative": (np.array([-9.0, 4.0, 10.0, 10.0]), np.ones(4)),
        "heavy": (np.full(10, 7.0), np.full(10, 3.0)),
        "zeros": (np.zeros(20), np.ones(20)),
        "gaps": (np.array([1.0, 2.0, 3.0]), np.array([1.0, 8.0, 1.0])),
        "lognormal": (np.round(rng.lognormal(3, 0.8, n), 2), np.ones(n)),
        "ties": (rng.integers(0, 6, n) * 100.0, rng.integers(1, 9, n).astype(float)),
        "one_value": (np.full(n, 40.0), rng.integers(1, 1000, n).astype(float)),
        "half_hot": (
            np.where(rng.random(n) < 0.5, 1000.0, rng.integers(1, 5000, n)),
            rng.integers(1, 400, n).astype(float),
        ),
        "tiny": (rng.random(n) * 1e-6, rng.integers(1, 5, n).astype(float)),
        "zero_weights": (
            rng.integers(0, 5, n) * 10.0,
            np.where(rng.random(n) < 0.3, 0.0, rng.integers(1, 5, n)).astype(float),
        ),
        "fractions": (np.round(rng.gamma(2, 900, n), 1), rng.uniform(0.3, 1.7, n)),
    }
    return groups


GROUPS = sample_groups()


@pytest.fixture(scope="module")
def people(spark):
    rows = [
        (name, float(y), float(w))
        for name, (values, weights) in GROUPS.items()
        for y, w in zip(values, weights)
    ]
    np.random.default_rng(3).shuffle(rows)
    rows = [(str(g), float(y), float(w)) for g, y, w in rows]
    return stage(spark.createDataFrame(rows, "g string, y double, w double"), "people")


def by_group(df, column):
    return {row["g"]: row[column] for row in df.collect()}


def check(got, expected, names=GROUPS, tolerance=1e-9):
    for name in names:
        want = expected(*GROUPS[name])
        if want is None:
            assert got[name] is None, name
        else:
            assert got[name] == pytest.approx(want, rel=tolerance, abs=tolerance), name


@pytest.mark.parametrize("method", ["cumulative", "lorenz_left", "trapezoid"])
def test_gini_matches_person_by_person(people, method):
    data = people.filter("g <> 'negative'")
    got = by_group(inequality.gini(data, "y", "w", ["g"], method), "gini")
    check(got, lambda y, w: brute.gini(y, w, method), [g for g in GROUPS if g != "negative"])


def test_gini_closed_forms(people):
    got = by_group(inequality.gini(people, "y", "w", ["g"]), "gini")
    assert got["equal"] == pytest.approx(0, abs=1e-6)
    assert got["owner"] == pytest.approx(0.98)
    assert got["steps"] == pytest.approx(639 / 1920)
    assert got["single"] == 0
    assert got["negative"] == pytest.approx(1 / 6)
    assert got["heavy"] == pytest.approx(2 / 30)  # the weight bias of this definition
    assert got["zeros"] == 0
    even = by_group(inequality.gini(people, "y", "w", ["g"], "trapezoid"), "gini")
    assert even["heavy"] == pytest.approx(0, abs=1e-12)
    left = by_group(inequality.gini(people, "y", "w", ["g"], "lorenz_left"), "gini")
    assert left["equal"] == pytest.approx(1 / 80)


def test_trapezoid_is_the_mean_difference(people):
    got = by_group(inequality.gini(people, "y", "w", ["g"], "trapezoid"), "gini")
    names = ["ties", "half_hot", "fractions", "lognormal"]
    check(got, lambda y, w: brute.gini(y, w, "pairs"), names)


def test_rank_gini_ignores_weights(people):
    got = by_group(inequality.gini(people, "y", "w", ["g"], "rank"), "gini")
    check(got, lambda y, w: brute.gini(y, np.ones(len(y)), "pairs"), ["ties", "steps", "half_hot"])
    assert got["zeros"] is None


def test_gini_rejects_unknown_method(people):
    with pytest.raises(ValueError):
        inequality.gini(people, "y", method="other")


@pytest.mark.parametrize("inclusive", [False, True])
def test_palma(people, inclusive):
    got = by_group(inequality.palma(people, "y", "w", ["g"], inclusive), "palma")
    check(got, lambda y, w: brute.palma(y, w, inclusive))


def test_palma_of_equal_incomes(spark):
    df = spark.range(250).select(F.lit(6.5).alias("y"))
    assert inequality.palma(df, "y").first()["palma"] == pytest.approx(0.25)


def test_median_and_poverty(people):
    medians = by_group(inequality.weighted_median(people, "y", "w", ["g"]), "median")
    check(medians, brute.median)
    poor = by_group(inequality.poverty_half_median(people, "y", "w", ["g"]), "sdg_10_2_1")
    check(poor, brute.poverty)
    assert poor["zeros"] == 0


def test_theil_and_mld(people):
    check(by_group(inequality.theil(people, "y", "w", ["g"]), "theil"), brute.theil)
    check(by_group(inequality.mean_log_deviation(people, "y", "w", ["g"]), "mld"), brute.mld)


def test_algebraic_measures_work_in_a_rollup(people):
    df = people.filter("g in ('ties', 'steps')").rollup("g").agg(
        theil_col("y", "w").alias("t"),
        mld_col("y").alias("m"),
        weighted_mean_col("y", "w").alias("mean"),
    )
    rows = {row["g"]: row for row in df.collect()}
    y, w = (np.concatenate([GROUPS[g][i] for g in ("ties", "steps")]) for i in (0, 1))
    assert rows[None]["t"] == pytest.approx(brute.theil(y, w))
    assert rows[None]["m"] == pytest.approx(brute.mld(y, np.ones(len(y))))
    assert rows[None]["mean"] == pytest.approx(np.average(y, weights=w))


def shares_by_group(df):
    found = {}
    for row in df.orderBy("g", "quantile").collect():
        found.setdefault(row["g"], []).append(tuple(row)[1:])
    return found


@pytest.mark.parametrize("n", [2, 5, 10])
def test_quantile_shares(people, n):
    got = shares_by_group(quantiles.quantile_shares(people, "y", "w", ["g"], n))
    for name, (y, w) in GROUPS.items():
        want = brute.quantile_shares(y, w, n)
        assert [row[0] for row in got[name]] == [row[0] for row in want], name
        np.testing.assert_allclose(np.array(got[name]), np.array(want), rtol=1e-9, atol=1e-12)


def test_empty_quintiles_are_absent(people):
    got = shares_by_group(quantiles.quantile_shares(people, "y", "w", ["g"]))["gaps"]
    assert [(row[0], round(row[4], 6)) for row in got] == [(1, 0.05), (5, 0.95)]


@pytest.fixture
def many_parts(spark):
    """Keep even tiny tables in several partitions, and join by shuffles only."""
    off = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name) for name in off}
    for name, value in off.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_bands_the_same_however_planned(people, request):
    """Without broadcasts, and with totals over several parts, inside one value too."""
    expected = shares_by_group(quantiles.quantile_shares(people, "y", "w", ["g"]))
    request.getfixturevalue("many_parts")
    got = shares_by_group(quantiles.quantile_shares(people, "y", "w", ["g"]))
    assert got.keys() == expected.keys()
    for name in got:
        np.testing.assert_allclose(np.array(got[name]), np.array(expected[name]), rtol=1e-12)


def test_shared_prosperity(people):
    rows = inequality.shared_prosperity(people, "y", "w", ["g"]).collect()
    got = {row["g"]: row["mean_b40"] for row in rows}
    check(got, brute.bottom_mean)
    for row in rows:
        flag = "Kritis" if row["mean_b40"] < 0.5 * row["mean_income"] else "Normal"
        assert row["anomali_b40"] == flag


def test_summary_agrees_with_single_measures(people, many_parts):
    got = {r["g"]: r for r in inequality.inequality_summary(people, "y", "w", ["g"]).collect()}
    for name, (y, w) in GROUPS.items():
        row = got[name]
        assert row["gini"] == pytest.approx(brute.gini(y, w, "cumulative"), abs=1e-9)
        assert row["sdg_10_2_1"] == pytest.approx(brute.poverty(y, w))
        palma = brute.palma(y, w)
        assert row["palma"] == (pytest.approx(palma) if palma is not None else None)
        assert row["n_obs"] == sum(y >= 0)


def test_without_groups(people, many_parts):
    y, w = (np.concatenate([g[i] for g in GROUPS.values()]) for i in (0, 1))
    row = inequality.inequality_summary(people, "y", "w", []).first()
    assert row["gini"] == pytest.approx(brute.gini(y, w, "cumulative"))
    assert row["palma"] == pytest.approx(brute.palma(y, w))
    assert row["sdg_10_2_1"] == pytest.approx(brute.poverty(y, w))
    assert row["mean_b40"] == pytest.approx(brute.bottom_mean(y, w))


def test_null_is_a_group_and_unusable_rows_are_dropped(spark):
    rows = [(None, 1.0, 1.0), (None, 3.0, 1.0), ("a", 2.0, 1.0)]
    dirt = [("a", None, 1.0), ("a", 5.0, None), ("a", float("nan"), 1.0), ("a", -1.0, 1.0)]
    df = spark.createDataFrame(rows + dirt, "g string, y double, w double")
    got = {r["g"]: r for r in inequality.inequality_summary(df, "y", "w", ["g"]).collect()}
    assert got[None]["gini"] == pytest.approx(0.25) and got[None]["n_obs"] == 2
    assert got["a"]["mean_income"] == 2 and got["a"]["n_obs"] == 1


def test_awkward_column_names(spark):
    df = spark.createDataFrame(
        [("x", 1.0, 1.0), ("x", 3.0, 1.0)], "`my group` string, `the income` double, `w t` double"
    )
    args = ("the income", "w t", ["my group"])
    assert inequality.inequality_summary(df, *args).first()["gini"] == pytest.approx(0.25)
    assert inequality.theil(df, *args).first()["theil"] > 0
    assert inequality.mean_log_deviation(df, *args).first()["mld"] > 0
    assert quantiles.quantile_shares(df, *args).count() == 2
    assert quantiles.qcut(df, "the income", 2, ["my group"]).filter("bin = 1").count() == 1
    assert lorenz.lorenz_points(df, *args, n_points=4).count() == 5


def test_empty_input_gives_no_groups(spark):
    df = spark.createDataFrame([], "g string, y double, w double")
    assert inequality.inequality_summary(df, "y", "w", ["g"]).count() == 0
    assert quantiles.quantile_shares(df, "y", "w", ["g"]).count() == 0


def test_scale_and_order_do_not_matter(people):
    scaled = people.withColumn("y", F.col("y") * 4).repartition(5).orderBy(F.rand(1))
    for measure in (inequality.gini, inequality.theil, inequality.palma):
        name = measure.__name__
        a = by_group(measure(people, "y", "w", ["g"]), name)
        b = by_group(measure(scaled, "y", "w", ["g"]), name)
        for group in a:
            assert b[group] == (pytest.approx(a[group], abs=1e-9) if a[group] is not None else None)


# --- the kernel --------------------------------------------------------------------------


def test_running_totals_equal_a_single_window(people, many_parts):
    rows = prefix.weighted_rows(people, "y", "w", ["g"], keep_negative=True)
    got = prefix.weighted_cdf(rows, ["g"]).select(
        "g", "value", "weight_before", "income_before", "weight_total"
    )
    whole = Window.partitionBy("g")
    earlier = whole.orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("g", "value").agg(F.sum("w").alias("weight"))
    blocks = blocks.withColumn("income", F.col("value") * F.col("weight"))
    want = blocks.select(
        "g",
        "value",
        F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)),
        F.coalesce(F.sum("income").over(earlier), F.lit(0.0)),
        F.sum("weight").over(whole),
    )
    a = sorted(map(tuple, got.collect()))
    b = sorted(map(tuple, want.collect()))
    assert [x[:2] for x in a] == [x[:2] for x in b]
    np.testing.assert_allclose([x[2:] for x in a], [x[2:] for x in b], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("by", [["g"], []])
def test_cells_are_even_whatever_the_values(spark, by):
    rng = np.random.default_rng(12)
    n = 60_000
    spread = np.where(rng.random(n) < 0.4, 0.0, np.exp(rng.normal(0, 8, n)))
    spread[:20_000] = 1000 + np.arange(20_000) * 2.0**-43
    data = [(str(g), float(v)) for g, v in zip(np.where(rng.random(n) < 0.8, "hot", "b"), spread)]
    df = stage(spark.createDataFrame(data, "g string, value double").distinct())
    cells = prefix.with_cells(df, "value").groupBy(*by, "_cell")
    found = cells.agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    rows = sorted(found.collect(), key=lambda r: (*[r[c] for c in by], r["_cell"]))
    total = sum(r["n"] for r in rows)
    # of a hot group, and of values in a sliver, only a small part meets in one window
    assert max(r["n"] for r in rows) < total / 100 and len(rows) > 500
    for a, b in zip(rows, rows[1:]):
        assert any(a[c] != b[c] for c in by) or a["hi"] < b["lo"]


def test_values_crowded_into_a_sliver(spark, many_parts):
    """Parts are even for neighbouring doubles too."""
    values = np.r_[1.0, 1000 + np.arange(400) * 2.0**-43, 1000.1 + np.arange(200) * 2.0**-43]
    df = spark.createDataFrame([(float(v), 1.0) for v in values], "value double, weight double")
    got = prefix.running_totals(df, [], "value", ["weight"]).orderBy("value").collect()
    assert [r["weight_before"] for r in got] == list(range(len(values)))
    assert {r["weight_total"] for r in got} == {float(len(values))}


def test_reserved_grouping_names_are_refused(people):
    with pytest.raises(ValueError):
        inequality.gini(people.withColumnRenamed("g", "weight"), "y", "w", ["weight"])


# --- Lorenz curves -----------------------------------------------------------------------


def test_lorenz_curve(people):
    df = lorenz.lorenz_curve(people, "y", "w", ["g"]).orderBy("g", "cum_population", "cum_income")
    curves = {}
    for row in df.collect():
        curves.setdefault(row["g"], []).append((row["cum_population"], row["cum_income"]))
    for name in set(GROUPS) - {"zeros"}:
        curve = np.array(curves[name])
        assert tuple(curve[0]) == (0, 0)
        np.testing.assert_allclose(curve[-1], (1, 1), atol=1e-9)
        assert (np.diff(curve[:, 1]) >= -1e-9).all()
        assert (curve[:, 1] <= curve[:, 0] + 1e-9).all()
        y, w = brute.ranked(*GROUPS[name])
        at = np.cumsum(w) / w.sum()
        np.testing.assert_allclose(
            np.interp(at, curve[:, 0], curve[:, 1]), np.cumsum(w * y) / (w * y).sum(), atol=0.25
        )


@pytest.mark.parametrize("n", [7, 100])
def test_lorenz_points_lie_on_the_curve(people, n):
    points = lorenz.lorenz_points(people, "y", "w", ["g"], n).orderBy("g", "point").collect()
    for name in set(GROUPS) - {"zeros", "zero_weights"}:
        mine = [p for p in points if p["g"] == name]
        assert [p["point"] for p in mine] == list(range(n + 1)), name
        y, w = brute.ranked(*GROUPS[name])
        x = np.r_[0, np.cumsum(w) / w.sum()]
        z = np.r_[0, np.cumsum(w * y) / (w * y).sum()]
        # rows of equal value lie on one straight line, so the row-wise curve is the same
        np.testing.assert_allclose(
            [p["cum_income"] for p in mine], np.interp(np.arange(n + 1) / n, x, z), atol=1e-9
        )


def test_lorenz_from_quantiles(people):
    shares = quantiles.quantile_shares(people, "y", "w", ["g"]).filter("g = 'steps'")
    curve = lorenz.lorenz_from_quantiles(shares, ["g"]).orderBy("cum_population").collect()
    assert [round(p["cum_population"], 9) for p in curve] == [0, 0.2, 0.4, 0.6, 0.8, 1]
    assert curve[-1]["cum_income"] == pytest.approx(1)
