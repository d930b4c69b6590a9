from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parityframe import constants as C
from parityframe.functions import labels as L
from parityframe.operators import refine as R
from parityframe.operators import sampling
from parityframe.operators.demographics import AGE_ORDER, EDUCATION_ORDER, ordered

NAN = float("nan")


def values(df, column):
    return [row[column] for row in df.collect()]


@pytest.fixture()
def raw(spark):
    columns = "SAMPLE long, SERIAL long, PERNUM int, COUNTRY int, YEAR int, PERWT double, " \
        "AGE int, SEX int, EDATTAIN int, EMPSTAT int, INCTOT double, INCEARN double"
    rows = [
        (1, 1, 1, 76, 2010, 2.0, 18, 1, 1, 1, 500.0, 400.0),
        (1, 1, 1, 76, 2010, 2.0, 70, 1, 1, 1, 900.0, 400.0),  # copy, kept one is 18
        (2, 1, 1, 484, 2010, 2.0, 30, 2, 2, 2, None, 800.0),  # same person key, other sample
        (1, 2, 1, 76, 2010, 1.0, 17, 1, 1, 1, 10.0, None),
        (1, 3, 1, 76, 2010, 1.0, 65, 2, 9, 0, 9_999_998.0, None),
        (1, 4, 1, 76, 2010, 1.0, 66, 2, 9, 0, 10.0, None),
        (1, 5, 1, 484, 2010, 1.0, 40, None, None, None, None, None),
        (1, 6, 1, 76, 2010, 1.0, 40, 3, 4, 3, 9_999_999.0, 100.0),
        (1, 7, 1, 76, 2010, 1.0, 40, 3, 4, 3, -50.0, 100.0),
        (1, 8, 1, 76, 2010, None, 40, 3, 4, 3, 70.0, 100.0),
        (1, 9, 1, 32, None, 1.0, 40, 3, 4, 3, 70.0, 100.0),
        (1, 10, 1, 32, 2010, 1.0, 40, 3, 4, 3, NAN, 100.0),
    ]
    return spark.createDataFrame(rows, columns)


def test_refine(raw):
    rows = R.refine(raw, order_by=["SAMPLE", "AGE"]).collect()
    got = {row["SERIAL"]: row for row in rows}
    assert sorted(got) == [1, 3, 5, 7]
    assert got[1]["income_analysis"] == 500 and got[1]["AGE"] == 18.0
    assert got[3]["income_analysis"] == 9_999_998 and got[3]["income_category"] == "high"
    assert got[5]["income_analysis"] == 0 and got[5]["income_category"] == "zero"
    assert got[7]["income_analysis"] == 0
    assert got[5]["sex_label"] == "Perempuan" and got[1]["country_name"] == "Brazil"
    assert "SAMPLE" not in rows[0].asDict() and rows[0]["_layer"] == "silver"


def test_refine_with_sample_key_keeps_both_persons(raw):
    df = R.refine(raw, dedup_keys=["SAMPLE", "SERIAL", "PERNUM"], order_by=["AGE"])
    assert df.filter("SERIAL = 1").count() == 2


def test_dedup_comes_before_the_age_filter(raw):
    kept = R.refine(raw, order_by=["SAMPLE", "INCTOT"]).filter("SERIAL = 1")
    assert values(kept, "INCTOT") == [500.0]
    dropped = raw.withColumn("AGE", F.when(F.col("INCTOT") == 500, 5).otherwise(F.col("AGE")))
    assert R.refine(dropped, order_by=["SAMPLE", "INCTOT"]).filter("SERIAL = 1").count() == 0


def test_dedup_without_order_is_repeatable(raw):
    first = sorted(map(str, R.deduplicate(raw).collect()))
    again = sorted(map(str, R.deduplicate(raw.repartition(7)).collect()))
    assert first == again and len(first) == 10


@pytest.mark.parametrize(
    "columns, expected",
    [
        (["INCTOT", "INCEARN"], [None, 5.0, 0.0, 0.0]),
        (["INCTOT"], [None, None, None, 0.0]),
        (["INCEARN"], [1.0, 5.0, None, 7.0]),
        ([], [0.0, 0.0, 0.0, 0.0]),
    ],
)
def test_harmonized_income_by_available_columns(spark, columns, expected):
    rows = [(1, 1e7, 1.0), (2, None, 5.0), (3, None, None), (4, -1.0, 7.0)]
    df = spark.createDataFrame(rows, "k int, INCTOT double, INCEARN double").orderBy("k")
    income = R.harmonized_income(columns)
    assert values(df.select(income.alias("y")), "y") == expected


def test_select_available_and_cast(spark):
    df = spark.createDataFrame([("7", "x", 1)], "INCTOT string, PERWT string, OTHER int")
    assert R.select_available(df).columns == ["PERWT", "INCTOT"]
    row = R.cast_numeric(df).first()
    assert row["INCTOT"] == 7.0 and row["PERWT"] is None


def test_steps_tolerate_missing_columns(spark):
    df = spark.createDataFrame([(1,)], "OTHER int")
    assert R.filter_age(df).count() == 1
    assert R.drop_null_keys(df).count() == 1
    assert R.add_derived(df).columns == ["OTHER", "_layer"]


def test_valid_income(spark):
    data = [0.0, 5.0, -1.0, None, NAN, 9999999.0, 99999999.0]
    df = spark.createDataFrame([(v,) for v in data], "INCTOT double")
    assert values(R.valid_income(df, sentinels=C.SENTINEL_CODES), "INCTOT") == [0.0, 5.0]
    assert values(R.valid_income(df, below=100, strict_low=True), "INCTOT") == [5.0]


def test_country_filter(raw):
    assert R.filter_countries(raw, []).count() == raw.count()
    assert R.filter_countries(raw, [484]).count() == 2


def test_labels(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (9,), (None,)], "c int")

    def of(column):
        return values(df.select(column.alias("x")), "x")

    assert of(L.sex_label("c")) == ["Laki-laki"] + ["Perempuan"] * 5
    assert of(L.sex_label("c", strict=True)) == ["Laki-laki", "Perempuan", None, None, None, None]
    assert of(L.employment_label("c"))[:4] == ["Bekerja", "Pengangguran", "Tidak Aktif", "Lainnya"]
    assert of(L.employment_label("c", strict=True))[2:] == ["Not in labor force", None, None, None]
    assert of(L.education_label("c"))[3:] == ["Perguruan Tinggi", "Lainnya", "Lainnya"]
    assert of(L.country_label("c"))[0] == "1"


def test_age_groups(spark):
    df = spark.createDataFrame([(a,) for a in (9, 10, 19, 20, 79, 80, None)], "a int")
    rows = df.select(L.age_decade("a").alias("x"), L.age_decade("a", strict=True).alias("y"))
    assert values(rows, "x") == ["80+", "10-19", "10-19", "20-29", "70-79", "80+", "80+"]
    assert values(rows, "y") == [None, "10-19", "10-19", "20-29", "70-79", "80+", None]


def test_cut_is_right_closed(spark):
    df = spark.createDataFrame([(a,) for a in (14, 15, 24, 25, 65, 66, None)], "a int")
    group = L.cut("a", C.AGE_CUT_EDGES, C.AGE_CUT_LABELS)
    assert values(df.select(group.alias("x")), "x") == [
        None, "15-24", "15-24", "25-34", "55-65", None, None,
    ]
    low = L.cut("a", [14, 65], ["all"], include_lowest=True)
    assert values(df.select(low.alias("x")), "x")[0] == "all"
    with pytest.raises(ValueError):
        L.cut("a", [1, 2], ["one", "two"])


def test_status_bands(spark):
    df = spark.createDataFrame([(v,) for v in (0.2, 0.3, 0.4, 0.5, 0.55, None)], "gini double")
    rows = df.select(L.gini_status().alias("s"), L.gauge_band().alias("b"))
    assert values(rows, "s") == ["Moderat"] * 3 + ["Tinggi", "Sangat Tinggi", None]
    assert values(rows, "b") == [0, 1, 2, 2, 3, None]


def test_sectors_and_prices(spark):
    df = spark.createDataFrame([(1, 100, 76, 10.0), (0, 9990, 32, 10.0)],
                               "OCCISCO int, INDGEN int, COUNTRY int, y double")
    rows = {r["OCCISCO"]: r for r in L.with_sector_labels(df).collect()}
    assert rows[1]["occupation_label"] == "Manajer" and rows[0]["occupation_label"] is None
    assert rows[0]["industry_label"] == "Tidak Bekerja"
    assert values(df.select(L.ppp_income("y").alias("p")), "p") == pytest.approx([5.664, 10])
    flat = L.ppp_income("y", factors={}, default=0.85)
    assert values(df.select(flat.alias("p")), "p") == [8.5, 8.5]


def test_display_order(spark):
    df = spark.createDataFrame([(e,) for e in reversed(EDUCATION_ORDER)], "e string")
    assert values(ordered(df, "e", EDUCATION_ORDER), "e") == EDUCATION_ORDER
    assert AGE_ORDER[0] == "10-19" and AGE_ORDER[-1] == "80+"


def test_samples(spark):
    df = spark.range(20000).select(
        F.col("id").alias("h"), F.lit(1).alias("p"), (F.col("id") % 2 * 408 + 76).alias("c")
    )
    assert 1700 < sampling.bernoulli(df).count() < 2300
    strata = sampling.stratified(df, "c", {76: 0.1}).groupBy("c").count().collect()
    assert [r["c"] for r in strata] == [76] and 850 < strata[0]["count"] < 1150
    keyed = sampling.keyed(df, "h", "p", {76: 0.1, 484: 0.2}, "c")
    again = sampling.keyed(df.repartition(9), "h", "p", {76: 0.1, 484: 0.2}, "c")
    assert sorted(keyed.collect()) == sorted(again.collect())
    counts = {r["c"]: r["count"] for r in keyed.groupBy("c").count().collect()}
    assert 800 < counts[76] < 1200 and 1700 < counts[484] < 2300


def test_row_steps_accept_a_stream(spark, tmp_path):
    """Nothing in the row-wise steps keeps state."""
    path = str(tmp_path / "in")
    spark.createDataFrame([(76, 2010, 1.0, 30, 1, 5.0, None), (76, 2010, 1.0, 90, 1, 5.0, None)],
        "COUNTRY int, YEAR int, PERWT double, AGE int, SEX int, INCTOT double, INCEARN double",
    ).write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    refined = R.add_derived(R.drop_null_keys(R.harmonize_income(R.filter_age(
        R.cast_numeric(R.select_available(stream))))))
    job = refined.writeStream.format("memory").queryName("refined").trigger(availableNow=True)
    job = job.option("checkpointLocation", str(tmp_path / "state")).start()
    job.awaitTermination(60)
    assert spark.table("refined").count() == 1


def test_baseline_refinement(raw):
    got = {r["SERIAL"]: r for r in R.refine_baseline(raw, ["AGE"]).collect()}
    assert sorted(got) == [1, 2, 3, 8, 9]  # 70 and 66 too old; NULL, negative, sentinel, NaN out
    assert got[1]["AGE"] == 18 and got[1]["income_ppp"] == pytest.approx(500 * 0.5664)
    assert got[2]["age_group"] == "15-24" and got[8]["sex_label"] is None
    assert got[9]["country_name"] is None and got[8]["empstat_label"] == "Not in labor force"


def test_cast_without_any_listed_column(spark):
    assert R.cast_numeric(spark.range(1)).columns == ["id"]
