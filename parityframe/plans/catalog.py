"""One named query per operator, bound to the test tables.

Every query reads its whole input table. Measures are rounded here, not in the operators, so
that results can be compared with an engine that adds in another order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parityframe import constants as C
from parityframe.functions import labels as L
from parityframe.functions.metrics import mld_col, theil_col, weighted_mean_col
from parityframe.operators import demographics as D
from parityframe.operators import inequality as I
from parityframe.operators import lorenz as Z
from parityframe.operators import quantiles as Q
from parityframe.operators import refine as R
from parityframe.operators import report as P
from parityframe.operators import sampling
from parityframe.operators import sketches as K
from parityframe.operators import stats as S
from parityframe.operators.prefix import weighted_cdf, weighted_rows
from parityframe.plans.persons import TIE_BREAK, persons
from parityframe.plans import stages
from parityframe.plans.stages import build_gold
from parityframe.sources import ingest
from parityframe.workspace import attach_groups, join_groups, scratch_path, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BY = ["COUNTRY", "YEAR"]
ID = ["SERIAL", "PERNUM"]
RAW = [name for name, _ in C.PERSON_COLUMNS]
INCOME, WEIGHT = "income_analysis", "PERWT"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({name: F.round(name, digits) for name in doubles})


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return persons(spark, sf_dir).select(*RAW)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.refine(persons(spark, sf_dir), order_by=TIE_BREAK)


def incomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refined columns the measures need, stored as the refined layer is."""
    return stage(silver(spark, sf_dir).select(*BY, INCOME, WEIGHT), "silver")


def explored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Working-age rows with a usable total income, as in ad-hoc exploration."""
    return R.valid_income(R.filter_age(persons(spark, sf_dir)), "INCTOT", below=9_999_998)


def positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a positive total income below the sentinel."""
    return R.valid_income(
        persons(spark, sf_dir), "INCTOT", below=C.SENTINEL_MIN, strict_low=True
    )


# --- sources and sinks -------------------------------------------------------------------


def _csv(spark: SparkSession, sf_dir: str, compression: str = "none") -> str:
    path = scratch_path(spark, "persons-csv")
    raw(spark, sf_dir).write.option("header", True).option("compression", compression).csv(path)
    return path


@query
def csv_ingest(spark, sf_dir):
    return ingest.read_persons_csv(spark, _csv(spark, sf_dir))


@query
def csv_ingest_gz(spark, sf_dir):
    return ingest.read_persons_csv(spark, _csv(spark, sf_dir, "gzip"))


@query
def csv_ingest_inferred(spark, sf_dir):
    inferred = ingest.read_persons_csv(spark, _csv(spark, sf_dir), infer=True)
    return inferred.select(*[F.col(name).cast(kind) for name, kind in C.PERSON_COLUMNS])


@query
def partition_preview(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    ingest.write_table(persons(spark, sf_dir), path, BY)
    order = [*ID, *TIE_BREAK]
    first = ingest.partition_preview(spark, path, 76, 1996, order)
    return first.select(*RAW, *TIE_BREAK)


@query
def ensure_bronze(spark, sf_dir):
    source, target = _csv(spark, sf_dir), scratch_path(spark, "bronze")
    ingest.ensure_bronze(spark, source, target)
    reused = ingest.ensure_bronze(spark, source, target)
    return reused.select(*RAW, "_layer")


@query
def gold_views(spark, sf_dir):
    """Every value of the published tables: table, country, year, label, measure, amount."""
    root = scratch_path(spark, "gold")
    build_gold(stage(silver(spark, sf_dir), "silver"), root)
    long = []
    for name in ingest.load_gold(spark, root):
        view = spark.table(name).withColumnsRenamed({"COUNTRY": "country", "YEAR": "year"})
        labels = [c for c in view.columns if c.endswith("_label") or c in ("age_group", "quantile")]
        label = F.col(labels[0]).cast("string") if labels else F.lit("")
        numbers = [f.name for f in view.schema.fields if f.dataType.typeName() in ("double", "long")]
        numbers = [c for c in numbers if c not in ("country", "year", *labels)]
        cells = view.select("country", "year", label.alias("label"), *[F.col(c).cast("double") for c in numbers])
        melted = cells.unpivot(["country", "year", "label"], numbers, "measure", "amount")
        long.append(melted.withColumn("table_name", F.lit(name)))
    return rounded(reduce(DataFrame.unionByName, long), 4)


@query
def layer_rows(spark, sf_dir):
    """Rows in and out of the first two layers, counted by the writes."""
    root, order = scratch_path(spark, "lake"), ["SAMPLE", "PERWT", "AGE"]
    first = stages.build_bronze(spark, _csv(spark, sf_dir), f"{root}/bronze")
    bronze = spark.read.parquet(f"{root}/bronze")
    second = stages.build_silver(bronze.filter("AGE % 2 = 0"), f"{root}/silver", dedup_keys=["SAMPLE", *ID], order_by=order)
    rows = [(r.layer, r.rows_in, r.rows_out) for r in (first, second)]
    return spark.createDataFrame(rows, "layer string, rows_in bigint, rows_out bigint")


@query
def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "table")
    ingest.write_table(raw(spark, sf_dir), path)
    return spark.read.parquet(path)


@query
def partitioned_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "table")
    ingest.write_table(raw(spark, sf_dir), path, BY)
    return spark.read.parquet(path).select(*RAW)


@query
def csv_export(spark, sf_dir):
    path = scratch_path(spark, "export")
    table = rounded(S.income_stats(incomes(spark, sf_dir)))
    ingest.write_csv(table, path, single_file=True)
    return spark.read.schema(table.schema).option("header", True).csv(path)


# --- refinement --------------------------------------------------------------------------


@query
def lineage_columns(spark, sf_dir):
    marked = R.add_lineage(persons(spark, sf_dir), "lineitem")
    return marked.select(*ID, *TIE_BREAK, "_source_file", "_layer")


@query
def select_available(spark, sf_dir):
    return R.select_available(persons(spark, sf_dir))


@query
def cast_numeric(spark, sf_dir):
    text = persons(spark, sf_dir).withColumn("INCTOT", F.col("INCTOT").cast("string"))
    text = text.withColumn("INCTOT", F.when(F.col("SEX") == 1, F.col("INCTOT")).otherwise("n/a"))
    return R.cast_numeric(text.select(*ID, *C.NUMERIC_COLUMNS))


@query
def filter_age(spark, sf_dir):
    return R.filter_age(raw(spark, sf_dir))


@query
def harmonize_income(spark, sf_dir):
    df = persons(spark, sf_dir).select(*BY, *ID, "INCTOT", "INCEARN")
    return R.harmonize_income(df)


@query
def drop_null_keys(spark, sf_dir):
    df = persons(spark, sf_dir).select(*BY, *ID, "INCEARN", "INCTOT")
    return R.drop_null_keys(df, ["YEAR", "INCTOT"])


@query
def income_category(spark, sf_dir):
    return silver(spark, sf_dir).select(*ID, INCOME, "income_category")


@query
def label_sex(spark, sf_dir):
    strict = L.sex_label("SEX + EMPSTAT", strict=True)
    df = persons(spark, sf_dir)
    return df.select(*ID, "SEX", L.sex_label().alias("sex_label"), strict.alias("strict_label"))


@query
def label_country(spark, sf_dir):
    return persons(spark, sf_dir).select(*ID, "COUNTRY", L.country_label().alias("country_name"))


@query
def label_employment(spark, sf_dir):
    return persons(spark, sf_dir).select(
        *ID,
        "EMPSTAT",
        L.employment_label().alias("empstat_label"),
        L.employment_label(strict=True).alias("strict_label"),
    )


@query
def label_education(spark, sf_dir):
    df = persons(spark, sf_dir)
    return df.select(*ID, "EDATTAIN", L.education_label().alias("education_label"))


@query
def label_age_decade(spark, sf_dir):
    younger = "AGE - 5"
    return persons(spark, sf_dir).select(
        *ID,
        "AGE",
        L.age_decade(younger).alias("age_group"),
        L.age_decade(younger, strict=True).alias("strict_group"),
    )


@query
def cut_age(spark, sf_dir):
    group = L.cut("AGE", C.AGE_CUT_EDGES, C.AGE_CUT_LABELS)
    return persons(spark, sf_dir).select(*ID, "AGE", group.alias("age_group"))


@query
def label_sector(spark, sf_dir):
    df = persons(spark, sf_dir).select(*ID, "OCCISCO", "INDGEN")
    return L.with_sector_labels(df)


@query
def normalize_ppp(spark, sf_dir):
    df = persons(spark, sf_dir)
    flat = L.ppp_income("INCEARN", factors={}, default=0.85)
    return rounded(
        df.select(
            *ID,
            "COUNTRY",
            L.ppp_income("INCEARN").alias("income_ppp"),
            flat.alias("income_flat"),
        ),
        4,
    )


@query
def filter_sentinels(spark, sf_dir):
    df = persons(spark, sf_dir).select(*BY, *ID, "INCTOT")
    return R.valid_income(df, "INCTOT", C.SENTINEL_CODES)


@query
def filter_countries(spark, sf_dir):
    df = R.filter_countries(persons(spark, sf_dir).select(*BY, *ID), [76, 484])
    return R.filter_countries(df, [])


@query
def dedup(spark, sf_dir):
    return R.deduplicate(persons(spark, sf_dir), ID, TIE_BREAK)


@query
def dedup_sample_key(spark, sf_dir):
    return R.deduplicate(persons(spark, sf_dir), ["SAMPLE", *ID], TIE_BREAK)


@query
def dedup_clustered(spark, sf_dir):
    """The same rows as ``dedup``, from a table dealt to buckets by the key."""
    path, people = scratch_path(spark, "clustered"), persons(spark, sf_dir)
    bronze = ingest.write_clustered(people, path, ID, ingest.fitting_buckets(people))
    return R.deduplicate(bronze, ID, TIE_BREAK)


@query
def refined_layer(spark, sf_dir):
    return silver(spark, sf_dir)


@query
def baseline_layer(spark, sf_dir):
    layer = R.refine_baseline(persons(spark, sf_dir), TIE_BREAK)
    columns = ["SAMPLE", *ID, "COUNTRY", "AGE", "INCTOT", "INCEARN", "income_ppp"]
    labels = ["country_name", "sex_label", "empstat_label", "age_group"]
    return rounded(layer.select(*columns, *labels), 4)


@query
def union_layers(spark, sf_dir):
    df = persons(spark, sf_dir).select(*BY, *ID, "INCEARN")
    parts = [R.filter_countries(df, [code]) for code in (76, 484)]
    return parts[0].unionByName(parts[1])


# --- aggregation and profiles ------------------------------------------------------------


@query
def count_by_group(spark, sf_dir):
    return silver(spark, sf_dir).groupBy(*BY).agg(F.count(F.lit(1)).alias("n_obs"))


@query
def mean_by_group(spark, sf_dir):
    return rounded(raw(spark, sf_dir).groupBy("COUNTRY").agg(F.mean("INCTOT").alias("mean_income")))


@query
def income_stats(spark, sf_dir):
    return rounded(S.income_stats(incomes(spark, sf_dir)))


@query
def demog_sex(spark, sf_dir):
    return D.demographic(silver(spark, sf_dir), "sex")


@query
def demog_emp(spark, sf_dir):
    return D.demographic(silver(spark, sf_dir), "emp")


@query
def demog_edu(spark, sf_dir):
    return D.demographic(silver(spark, sf_dir), "edu")


@query
def demog_age(spark, sf_dir):
    return D.demographic(silver(spark, sf_dir), "age")


@query
def demog_share(spark, sf_dir):
    counts = D.demographic(silver(spark, sf_dir), "emp")
    return rounded(D.share_of_total(counts, "weighted_count", BY))


@query
def demog_ordered(spark, sf_dir):
    counts = D.demographic(silver(spark, sf_dir), "edu")
    return D.ordered(counts, "education_label", D.EDUCATION_ORDER, BY)


@query
def eda_summary(spark, sf_dir):
    return rounded(S.eda_summary(explored(spark, sf_dir)))


@query
def zero_income_share(spark, sf_dir):
    return rounded(S.zero_share(explored(spark, sf_dir), "INCTOT", ["COUNTRY"]))


@query
def median_by_education(spark, sf_dir):
    by = ["COUNTRY", "EDATTAIN"]
    return S.median_by(explored(spark, sf_dir), "INCTOT", by).orderBy(*by)


@query
def palma_thresholds(spark, sf_dir):
    return S.share_thresholds(explored(spark, sf_dir), "INCTOT", ["COUNTRY"])


@query
def missing_counts(spark, sf_dir):
    columns = ["COUNTRY", "YEAR", "AGE", "SEX", "EMPSTAT", "INCTOT"]
    return S.missing_counts(raw(spark, sf_dir), columns)


@query
def missing_counts_long(spark, sf_dir):
    return S.missing_counts_long(raw(spark, sf_dir), ["YEAR", "AGE", "INCTOT", "INCEARN"])


@query
def null_percent(spark, sf_dir):
    return S.null_percent(raw(spark, sf_dir))


@query
def describe_income(spark, sf_dir):
    return rounded(S.describe(positive(spark, sf_dir), "INCTOT"), 4)


@query
def describe_balances(spark, sf_dir):
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return rounded(S.describe(customers, "c_acctbal", ["c_mktsegment"]), 4)


@query
def weighted_percentiles(spark, sf_dir):
    probs = {f"p{round(p * 100)}": p for p in (0.2, 0.4, 0.6, 0.8, 1.0)}
    return rounded(
        Q.quantiles(incomes(spark, sf_dir), INCOME, probs, ["COUNTRY"], frequency=WEIGHT), 4
    )


@query
def qcut_bins(spark, sf_dir):
    df = positive(spark, sf_dir).select("COUNTRY", *ID, *TIE_BREAK, "INCTOT")
    labels = ["Q1", "Q2", "Q3", "Q4", "Q5"]
    return Q.qcut(df, "INCTOT", 5, ["COUNTRY"], "quintile", labels)


@query
def qcut_summary(spark, sf_dir):
    return rounded(Q.qcut_summary(positive(spark, sf_dir), "INCTOT", 5))


@query
def iqr_outliers(spark, sf_dir):
    df = positive(spark, sf_dir).select("COUNTRY", *ID, *TIE_BREAK, "INCTOT")
    return Q.iqr_outliers(df, "INCTOT")


@query
def iqr_outliers_by_status(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    df = orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return Q.iqr_outliers(df, "o_totalprice", ["o_orderstatus"], factor=0.5)


@query
def income_histogram(spark, sf_dir):
    return rounded(S.histogram(positive(spark, sf_dir), "INCTOT", 50))


@query
def income_histogram_trimmed(spark, sf_dir):
    return rounded(S.trimmed_histogram(explored(spark, sf_dir), "INCTOT", ["COUNTRY"]))


@query
def iqr_outliers_lengths(spark, sf_dir):
    lengths = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "n_chars")
    return Q.iqr_outliers(lengths, "n_chars", ["lang"])


@query
def attrition(spark, sf_dir):
    bronze = persons(spark, sf_dir)
    layers = {"deduplicated": F.lit(True), "silver": R.survives(bronze.columns)}
    return rounded(S.attrition_in_one_pass(bronze, ID, TIE_BREAK, layers))


@query
def distinct_keys(spark, sf_dir):
    """Exact rows and keys by country and year and in all, and whether the sketches agree."""
    bronze = persons(spark, sf_dir).select(*BY, *ID)
    sketches = stage(K.distinct_sketches(bronze, ID, BY), "sketches")
    found = []
    for by in (BY, ["COUNTRY"], []):
        exact = K.key_counts(bronze, ID, by)
        told = K.estimated_counts(K.merge_distinct(sketches, by))
        told = told.withColumnsRenamed({"n_keys": "about", "n_rows": "same_rows"})
        both = join_groups(exact, told, by) if by else attach_groups(exact, told, [])
        near = F.abs(F.col("about") - F.col("n_keys")) <= 5 * K.DISTINCT_ERROR * F.col("n_keys") + 1
        both = both.withColumn("sketch_fits", near & (F.col("n_rows") == F.col("same_rows")))
        group = [(F.col(c).cast("string") if c in by else F.lit("all")).alias(c) for c in BY]
        found.append(both.select(*group, "n_rows", "n_keys", "sketch_fits"))
    return reduce(DataFrame.unionByName, found)


@query
def approximate_percentiles(spark, sf_dir):
    """Sketches by country and year, merged to countries; whether each answer's rank is right."""
    people = incomes(spark, sf_dir)
    probs = {f"p{round(p * 100)}": p for p in (0.1, 0.25, 0.4, 0.5, 0.75, 0.9, 0.99)}
    sketches = stage(K.quantile_sketches(people, INCOME, BY), "sketches")
    answers = stage(K.approximate_quantiles(K.merge_quantiles(sketches, ["COUNTRY"]), probs), "answers")
    errors = K.rank_errors(people, INCOME, answers, probs)
    counted = join_groups(errors, answers.select("COUNTRY", "n"), ["COUNTRY"])
    fits = F.col("rank_error") <= 2 * K.RANK_ERROR
    return counted.select("COUNTRY", "quantile", F.col("n").alias("n_obs"), fits.alias("rank_fits"))


@query
def describe_columns(spark, sf_dir):
    columns = ["AGE", "PERWT", "INCTOT", "INCEARN"]
    return rounded(S.describe_columns(raw(spark, sf_dir), columns), 4)


@query
def null_profile(spark, sf_dir):
    nested = F.struct("INCTOT", F.struct("INCEARN").alias("earned")).alias("incomes")
    nested = F.when(F.col("SEX") == 1, nested).alias("incomes")
    return S.null_profile(raw(spark, sf_dir).select(*RAW, nested))


@query
def baseline_metrics(spark, sf_dir):
    return S.baseline_metrics(incomes(spark, sf_dir), INCOME)


@query
def sector_boxplot(spark, sf_dir):
    df = explored(spark, sf_dir)
    return rounded(S.five_numbers(df, "INCTOT", ["INDGEN"]), 4)


@query
def dimension_values(spark, sf_dir):
    groups = silver(spark, sf_dir).select(*BY).distinct()
    lists = S.dimension_values(groups, "COUNTRY", "YEAR")
    return lists.select(*[F.array_join(c, ",").alias(c) for c in lists.columns])


# --- inequality --------------------------------------------------------------------------


@query
def running_totals(spark, sf_dir):
    return weighted_cdf(weighted_rows(incomes(spark, sf_dir), INCOME, WEIGHT, BY), BY)


@query
def gini(spark, sf_dir):
    return rounded(I.gini(incomes(spark, sf_dir), INCOME, WEIGHT, BY))


@query
def gini_lorenz_left(spark, sf_dir):
    return rounded(I.gini(incomes(spark, sf_dir), INCOME, WEIGHT, BY, "lorenz_left"))


@query
def gini_unweighted(spark, sf_dir):
    return rounded(I.gini(positive(spark, sf_dir), "INCTOT", by=["COUNTRY"], method="rank"))


@query
def gini_trapezoid(spark, sf_dir):
    return rounded(I.gini(positive(spark, sf_dir), "INCTOT", WEIGHT, method="trapezoid"))


@query
def gini_order_values(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return rounded(I.gini(orders, "o_totalprice", by=["o_orderstatus"]))


@query
def theil(spark, sf_dir):
    return rounded(I.theil(silver(spark, sf_dir), INCOME, WEIGHT, BY))


@query
def mean_log_deviation(spark, sf_dir):
    return rounded(I.mean_log_deviation(silver(spark, sf_dir), INCOME, WEIGHT, BY))


@query
def theil_agg_form(spark, sf_dir):
    cube = silver(spark, sf_dir).cube("COUNTRY", "SEX").agg(
        F.grouping_id().cast("int").alias("level"),
        theil_col(INCOME, WEIGHT).alias("theil"),
        mld_col(INCOME, WEIGHT).alias("mld"),
        weighted_mean_col(INCOME, WEIGHT).alias("mean_income"),
    )
    # level tells totals apart, so the keys of total rows are set to 0 rather than left NULL
    keys = {key: F.coalesce(key, F.lit(0)) for key in ("COUNTRY", "SEX")}
    return rounded(cube.withColumns(keys))


@query
def quantile_shares(spark, sf_dir):
    return rounded(Q.quintile_table(incomes(spark, sf_dir)))


@query
def decile_shares(spark, sf_dir):
    return rounded(Q.quantile_shares(incomes(spark, sf_dir), INCOME, WEIGHT, ["COUNTRY"], 10))


@query
def palma(spark, sf_dir):
    return rounded(I.palma(incomes(spark, sf_dir), INCOME, WEIGHT, BY))


@query
def palma_inclusive(spark, sf_dir):
    return rounded(I.palma(incomes(spark, sf_dir), INCOME, WEIGHT, BY, top_inclusive=True))


@query
def poverty_half_median(spark, sf_dir):
    return rounded(I.poverty_half_median(incomes(spark, sf_dir), INCOME, WEIGHT, BY))


@query
def weighted_median(spark, sf_dir):
    return rounded(I.weighted_median(incomes(spark, sf_dir), INCOME, WEIGHT, BY))


@query
def lorenz_curve(spark, sf_dir):
    return rounded(Z.lorenz_curve(incomes(spark, sf_dir), INCOME, WEIGHT, ["COUNTRY"]))


@query
def lorenz_points(spark, sf_dir):
    return rounded(Z.lorenz_points(incomes(spark, sf_dir), INCOME, WEIGHT, BY, 100))


@query
def lorenz_quintile(spark, sf_dir):
    table = Q.quintile_table(incomes(spark, sf_dir))
    return rounded(Z.lorenz_from_quantiles(table, ["country", "year"]))


@query
def shared_prosperity(spark, sf_dir):
    return rounded(I.shared_prosperity(incomes(spark, sf_dir), INCOME, WEIGHT, BY))


@query
def inequality_summary(spark, sf_dir):
    return rounded(I.inequality_table(incomes(spark, sf_dir)))


# --- reports on the aggregate tables -----------------------------------------------------


@query
def share_b40_vs_top20(spark, sf_dir):
    table = Q.quintile_table(incomes(spark, sf_dir))
    return rounded(Q.share_b40_vs_top20(table, ["country", "year"]))


@query
def quintile_ratio(spark, sf_dir):
    table = Q.quintile_table(incomes(spark, sf_dir))
    return rounded(Q.quintile_ratio(table, ["country", "year"]))


@query
def quintile_format(spark, sf_dir):
    return P.quintile_format(Q.quintile_table(incomes(spark, sf_dir)))


@query
def metric_trend_normalized(spark, sf_dir):
    return rounded(P.metric_trend(I.inequality_table(incomes(spark, sf_dir))))


@query
def gini_status(spark, sf_dir):
    table = P.with_status(I.inequality_table(incomes(spark, sf_dir)))
    return rounded(table.select("country", "year", "gini", "status", "gauge_band"))


@query
def target_gap(spark, sf_dir):
    return rounded(P.target_gap(I.inequality_table(incomes(spark, sf_dir))))


@query
def actual_vs_target(spark, sf_dir):
    return rounded(P.actual_vs_target(I.inequality_table(incomes(spark, sf_dir))))


@query
def metric_comparison(spark, sf_dir):
    return rounded(P.metric_comparison(I.inequality_table(incomes(spark, sf_dir))))


@query
def report_format(spark, sf_dir):
    return P.display_format(I.inequality_table(incomes(spark, sf_dir)))


@query
def kpi_summary(spark, sf_dir):
    people = incomes(spark, sf_dir)
    return rounded(P.kpi_summary(I.inequality_table(people), S.income_stats(people)))


# --- previews and samples ----------------------------------------------------------------


@query
def layer_preview(spark, sf_dir):
    return ingest.layer_preview(persons(spark, sf_dir), [*ID, *TIE_BREAK], 100)


@query
def sample_keyed(spark, sf_dir):
    df = persons(spark, sf_dir).select(*BY, *ID, *TIE_BREAK)
    return sampling.keyed(df, *ID, {76: 0.1, 484: 0.05}, "COUNTRY")


@query
def sample_bernoulli(spark, sf_dir):
    return sampling.bernoulli(raw(spark, sf_dir), 0.1, 42)


@query
def sample_stratified(spark, sf_dir):
    return sampling.stratified(raw(spark, sf_dir), "COUNTRY", {76: 0.1, 484: 0.1}, 42)


@query
def sample_bernoulli_profile(spark, sf_dir):
    df = persons(spark, sf_dir).select(*BY, *ID)
    rates = {76: 0.1, 484: 0.1, 32: 0.1}
    return sampling.profile(df, sampling.bernoulli(df, 0.1, 42), "COUNTRY", rates)


@query
def sample_stratified_profile(spark, sf_dir):
    df = persons(spark, sf_dir).select(*BY, *ID)
    rates = {76: 0.1}
    return sampling.profile(df, sampling.stratified(df, "COUNTRY", rates, 42), "COUNTRY", rates)
