"""The registered queries as SQL over the same tables, written row by row.

Nothing here is shared with the Spark side: persons are ranked one by one with window
functions, where the library works on distinct values and closed forms.
"""

from __future__ import annotations

TIES = "l_partkey, l_suppkey, l_extendedprice"
RAW = (
    "COUNTRY, YEAR, SAMPLE, SERIAL, HHWT, PERNUM, PERWT, AGE, SEX, EDATTAIN, EDATTAIND, "
    "EMPSTAT, EMPSTATD, OCCISCO, INDGEN, INCTOT, INCEARN"
)
# Label texts.
COUNTRY_NAME = (
    "CASE COUNTRY WHEN 76 THEN 'Brazil' WHEN 484 THEN 'Mexico' ELSE CAST(COUNTRY AS VARCHAR) END"
)
SEX_LABEL = "CASE WHEN SEX = 1 THEN 'Laki-laki' ELSE 'Perempuan' END"
EMPSTAT_LABEL = (
    "CASE EMPSTAT WHEN 1 THEN 'Bekerja' WHEN 2 THEN 'Pengangguran' WHEN 3 THEN 'Tidak Aktif' "
    "ELSE 'Lainnya' END"
)
EDUCATION_LABEL = (
    "CASE EDATTAIN WHEN 1 THEN 'Tdk Tamat SD' WHEN 2 THEN 'SD/Sederajat' "
    "WHEN 3 THEN 'SMA/Sederajat' WHEN 4 THEN 'Perguruan Tinggi' ELSE 'Lainnya' END"
)


def age_group(age: str, oldest: str = "ELSE '80+'") -> str:
    steps = " ".join(
        f"WHEN {age} BETWEEN {low} AND {low + 9} THEN '{low}-{low + 9}'"
        for low in range(10, 80, 10)
    )
    return f"CASE {steps} {oldest} END"


PERSONS = """persons AS (
  SELECT c AS COUNTRY, y AS YEAR, CAST(c AS BIGINT) * 10000 + y AS SAMPLE,
    l_orderkey AS SERIAL, l_quantity AS HHWT, l_linenumber AS PERNUM, l_quantity AS PERWT,
    CAST(10 + l_partkey % 75 AS INTEGER) AS AGE,
    CAST(1 + l_suppkey % 2 AS INTEGER) AS SEX,
    CAST(l_partkey % 6 AS INTEGER) AS EDATTAIN,
    CAST((l_partkey % 6) * 100 + l_partkey % 10 AS INTEGER) AS EDATTAIND,
    CAST(l_suppkey % 4 AS INTEGER) AS EMPSTAT,
    CAST((l_suppkey % 4) * 100 + l_suppkey % 10 AS INTEGER) AS EMPSTATD,
    CAST(CASE WHEN l_partkey % 13 = 12 THEN 99 ELSE l_partkey % 13 END AS INTEGER) AS OCCISCO,
    CAST(CASE WHEN l_suppkey % 14 = 13 THEN 9990
         ELSE 100 * (1 + l_suppkey % 14) END AS INTEGER) AS INDGEN,
    CAST(CASE WHEN l_returnflag = 'N' THEN NULL
         WHEN l_linenumber = 7 THEN 9999999
         WHEN l_linenumber = 6 THEN 0
         WHEN l_discount = CAST(0.1 AS DOUBLE) THEN -l_extendedprice
         ELSE floor(l_extendedprice / 100) * 100 END AS DOUBLE) AS INCTOT,
    CAST(CASE WHEN l_suppkey % 50 = 0 THEN NULL
         ELSE floor(l_extendedprice * CAST(0.8 AS DOUBLE) / 100) * 100 END AS DOUBLE) AS INCEARN,
    l_partkey, l_suppkey, l_extendedprice
  FROM (SELECT *, CAST(CASE l_returnflag WHEN 'A' THEN 76 WHEN 'N' THEN 484 ELSE 32 END
                       AS INTEGER) AS c, CAST(year(l_shipdate) AS INTEGER) AS y FROM lineitem))"""

DISTINCT = f"""single AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY SERIAL, PERNUM ORDER BY {TIES}) AS rn FROM persons)
  WHERE rn = 1)"""

SILVER = """silver AS (
  SELECT COUNTRY, YEAR, SERIAL, PERNUM, PERWT, CAST(AGE AS DOUBLE) AS AGE, SEX, EDATTAIN,
    EMPSTAT, INCTOT, INCEARN, CASE WHEN raw_income < 0 THEN 0 ELSE raw_income END AS y
  FROM (SELECT *, coalesce(INCTOT, INCEARN, 0) AS raw_income FROM single
        WHERE AGE BETWEEN 18 AND 65 AND YEAR IS NOT NULL AND PERWT IS NOT NULL)
  WHERE raw_income < 9999999)"""

EXPLORED = """explored AS (
  SELECT * FROM persons WHERE AGE BETWEEN 18 AND 65 AND INCTOT >= 0 AND INCTOT < 9999998)"""

POSITIVE = "positive AS (SELECT * FROM persons WHERE INCTOT > 0 AND INCTOT < 9999999)"


def cumulated(by: str, source: str = "silver", y: str = "y", name: str = "cum") -> str:
    part = f"PARTITION BY {by}"
    return f"""{name} AS (
  SELECT *, sum(PERWT) OVER ranked AS c, sum(PERWT * {y}) OVER ranked AS cy,
    sum(PERWT) OVER whole AS tw, sum(PERWT * {y}) OVER whole AS ty,
    sum(CASE WHEN {y} > 0 THEN PERWT * {y} END) OVER whole
      / nullif(sum(CASE WHEN {y} > 0 THEN PERWT END) OVER whole, 0) AS mu,
    row_number() OVER ranked AS i, count(*) OVER whole AS n
  FROM {source}
  WINDOW ranked AS ({part} ORDER BY {y}, PERWT ROWS UNBOUNDED PRECEDING), whole AS ({part}))"""


CUM = cumulated("COUNTRY, YEAR")

MEDIAN = """med AS (
  SELECT *, min(CASE WHEN c >= 0.5 * tw THEN y END) OVER (PARTITION BY COUNTRY, YEAR) AS median
  FROM cum)"""

THEIL = (
    "sum(CASE WHEN y > 0 THEN PERWT * (y / mu) * ln(y / mu) END) "
    "/ sum(CASE WHEN y > 0 THEN PERWT END)"
)
MLD = "sum(CASE WHEN y > 0 THEN PERWT * ln(mu / y) END) / sum(CASE WHEN y > 0 THEN PERWT END)"
GINI = (
    "greatest(least(2 * sum(PERWT * y * c) / (max(tw) * max(ty)) - (max(tw) + 1) / max(tw), 1), 0)"
)
PALMA = (
    "sum(CASE WHEN c > 0.9 * tw THEN PERWT * y END) "
    "/ nullif(sum(CASE WHEN c <= 0.4 * tw THEN PERWT * y END), 0)"
)
POVERTY = (
    "CASE WHEN max(median) = 0 THEN 0 "
    "ELSE coalesce(sum(CASE WHEN y < 0.5 * median THEN PERWT END), 0) / max(tw) END"
)
MEAN_B40 = (
    "coalesce(sum(CASE WHEN c <= 0.4 * tw THEN PERWT * y END) "
    "/ sum(CASE WHEN c <= 0.4 * tw THEN PERWT END), 0)"
)

INEQ = f"""ineq AS (
  SELECT COUNTRY AS country, {COUNTRY_NAME} AS country_name, YEAR AS year,
    {GINI} AS gini, {THEIL} AS theil, {PALMA} AS palma, {POVERTY} AS sdg_10_2_1,
    max(ty) / max(tw) AS mean_income, {MEAN_B40} AS mean_b40, count(*) AS n_obs
  FROM med GROUP BY COUNTRY, YEAR)"""


def quantile_cte(by: str, n: int, name: str = "parts") -> str:
    limits = " ".join(
        f"WHEN c <= CAST({q / n!r} AS DOUBLE) * tw THEN {q}" for q in range(1, n)
    )
    return f"""{name} AS (
  SELECT {by}, quantile, min(y) AS lower_bound, max(y) AS upper_bound,
    sum(PERWT * y) / sum(PERWT) AS mean_income, sum(PERWT * y) / max(ty) AS income_share
  FROM (SELECT *, CAST(CASE {limits} ELSE {n} END AS INTEGER) AS quantile FROM cum)
  GROUP BY {by}, quantile)"""


PARTS = quantile_cte("COUNTRY, YEAR", 5)


def sql(body: str, *ctes: str) -> str:
    return f"WITH {', '.join(ctes)} {body}"


def on_persons(body: str) -> str:
    return sql(body, PERSONS)


def on_silver(body: str, *more: str) -> str:
    return sql(body, PERSONS, DISTINCT, SILVER, *more)


def on_explored(body: str, *more: str) -> str:
    return sql(body, PERSONS, EXPLORED, *more)


def on_positive(body: str, *more: str) -> str:
    return sql(body, PERSONS, POSITIVE, *more)


def on_ineq(body: str) -> str:
    return on_silver(body, CUM, MEDIAN, INEQ)


def on_parts(body: str) -> str:
    return on_silver(body, CUM, PARTS)


def r(*columns: str, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


def demographic(label: str, name: str) -> str:
    return (
        f"SELECT COUNTRY, YEAR, {label} AS {name}, sum(PERWT) AS weighted_count, "
        f"count(*) AS raw_count FROM silver GROUP BY ALL"
    )


def melted(table: str, source: str, label: str, measures: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, COUNTRY AS country, YEAR AS year, {label} AS label, "
        f"'{m}' AS measure, round(CAST({m} AS DOUBLE), 4) AS amount FROM {source}"
        for m in measures
    )


GINI_MEASURES = [
    "gini", "theil", "palma", "sdg_10_2_1", "mean_income", "mean_b40", "n_obs",
]
PART_MEASURES = ["lower_bound", "upper_bound", "mean_income", "income_share"]
STATS_MEASURES = [
    "mean_income", "median_income", "std_income", "min_income", "max_income", "n_obs",
]


def described(source: str, value: str, by: str = "") -> str:
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    stats = {
        "count": "CAST(count(*) AS DOUBLE)",
        "mean": f"avg({value})",
        "std": f"stddev_samp({value})",
        "min": f"min({value})",
        "25%": f"quantile_cont({value}, 0.25)",
        "50%": f"quantile_cont({value}, 0.5)",
        "75%": f"quantile_cont({value}, 0.75)",
        "max": f"max({value})",
    }
    return " UNION ALL ".join(
        f"SELECT {key}'{name}' AS statistic, round({expr}, 4) AS amount FROM {source} {group}"
        for name, expr in stats.items()
    )


# Codes and labels, label texts above included.
OCCUPATION = {
    1: "Manajer",
    2: "Profesional",
    3: "Teknisi",
    4: "Klerikal",
    5: "Jasa/Penjualan",
    6: "Pertanian",
    7: "Kerajinan",
    8: "Operator Mesin",
    9: "Pekerja Kasar",
    10: "Militer",
    11: "Tidak Diidentifikasi",
    99: "Tidak Bekerja",
}
INDUSTRY = {
    100: "Pertanian",
    200: "Pertambangan",
    300: "Manufaktur",
    400: "Utilitas",
    500: "Konstruksi",
    600: "Perdagangan",
    700: "Transportasi",
    800: "Keuangan",
    900: "Jasa Bisnis",
    1000: "Jasa Publik",
    1100: "Pendidikan/Kesehatan",
    1200: "Jasa Lainnya",
    1300: "Rumah Tangga",
    9990: "Tidak Bekerja",
}


def sector(code: str, names: dict[int, str]) -> str:
    return f"CASE {code} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in names.items()) + " END"


COLUMN_TYPES = {
    "SAMPLE": "bigint", "SERIAL": "bigint", "HHWT": "double", "PERNUM": "int", "PERWT": "double",
    "INCTOT": "double", "INCEARN": "double",
}


def missing_union(columns: list[str], measure: str, alias: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {measure.format(c=c)} AS {alias} FROM persons"
        for c in columns
    )


EXACT_STATS = (
    "SELECT COUNTRY, YEAR, avg(y) AS mean_income, quantile_disc(y, 0.5) AS "
    "median_income, stddev_samp(y) AS std_income, min(y) AS min_income, "
    "max(y) AS max_income, count(*) AS n_obs FROM silver GROUP BY COUNTRY, YEAR"
)
STATS = (
    "SELECT * REPLACE (round(mean_income, 6) AS mean_income, round(std_income, 6) AS std_income) "
    f"FROM ({EXACT_STATS})"
)
IQR = (
    "SELECT {keep} FROM (SELECT *, quantile_cont({x}, 0.25) OVER ({part}) AS q1, "
    "quantile_cont({x}, 0.75) OVER ({part}) AS q3 FROM {source}) "
    "WHERE {x} < q1 - {f} * (q3 - q1) OR {x} > q3 + {f} * (q3 - q1)"
)

# PPP-adjusted incomes per country name, rows replicated by weight where asked for
PPP = f"""ppp AS (
  SELECT {COUNTRY_NAME} AS country_name, PERWT,
    y * CASE COUNTRY WHEN 76 THEN CAST(0.5664 AS DOUBLE) WHEN 484 THEN CAST(0.6838 AS DOUBLE)
        ELSE 1 END AS y FROM silver)"""
COPIES = """copies AS (
  SELECT country_name, quantile_cont(y, 0.2) AS q1, quantile_cont(y, 0.6) AS q3, max(y) AS q5
  FROM (SELECT country_name, y, unnest(range(greatest(CAST(PERWT AS BIGINT), 1))) FROM ppp)
  GROUP BY country_name)"""

ORACLES: dict[str, str] = {
    # sources and sinks
    "csv_ingest": on_persons(f"SELECT {RAW} FROM persons"),
    "csv_ingest_gz": on_persons(f"SELECT {RAW} FROM persons"),
    "csv_ingest_inferred": on_persons(f"SELECT {RAW} FROM persons"),
    "partition_preview": on_persons(
        f"SELECT {RAW}, {TIES} FROM persons WHERE COUNTRY = 76 AND YEAR = 1996 "
        f"ORDER BY SERIAL, PERNUM, {TIES} LIMIT 100"
    ),
    "ensure_bronze": on_persons(f"SELECT {RAW}, 'bronze' AS _layer FROM persons"),
    "gold_views": on_silver(
        " UNION ALL ".join(
            [
                melted("gold_gini_by_year", "ineq", "''", GINI_MEASURES),
                melted("gold_quintile_by_year", "parts", "CAST(quantile AS VARCHAR)", PART_MEASURES),
                melted("gold_theil_by_year", f"({EXACT_STATS})", "''", STATS_MEASURES),
            ]
            + [
                melted(f"gold_demog_{t}", f"({demographic(e, 'l')})", "l", ["weighted_count", "raw_count"])
                for t, e in (
                    ("sex", SEX_LABEL),
                    ("emp", EMPSTAT_LABEL),
                    ("edu", EDUCATION_LABEL),
                    ("age", age_group("AGE")),
                )
            ]
        ),
        CUM, MEDIAN, INEQ, PARTS,
    ),
    "layer_rows": on_persons(
        "SELECT 'bronze' AS layer, count(*) AS rows_in, count(*) AS rows_out FROM persons UNION ALL "
        "SELECT 'silver', (SELECT count(*) FROM persons WHERE AGE % 2 = 0), count(*) "
        "FROM (SELECT *, row_number() OVER (PARTITION BY SAMPLE, SERIAL, PERNUM "
        "ORDER BY SAMPLE, PERWT, AGE) AS rn FROM persons WHERE AGE % 2 = 0) WHERE rn = 1 "
        "AND AGE BETWEEN 18 AND 65 AND coalesce(INCTOT, INCEARN, 0) < 9999999"
    ),
    "parquet_roundtrip": on_persons(f"SELECT {RAW} FROM persons"),
    "partitioned_roundtrip": on_persons(f"SELECT {RAW} FROM persons"),
    "csv_export": on_silver(STATS),
    # refinement
    "lineage_columns": on_persons(
        f"SELECT SERIAL, PERNUM, {TIES}, 'lineitem' AS _source_file, 'bronze' AS _layer "
        "FROM persons"
    ),
    "select_available": on_persons(
        "SELECT COUNTRY, YEAR, SERIAL, PERNUM, PERWT, AGE, SEX, EDATTAIN, EMPSTAT, INCTOT, "
        "INCEARN FROM persons"
    ),
    "cast_numeric": on_persons(
        "SELECT SERIAL, PERNUM, CASE WHEN SEX = 1 THEN INCTOT END AS INCTOT, INCEARN, PERWT, "
        "CAST(AGE AS DOUBLE) AS AGE FROM persons"
    ),
    "filter_age": on_persons(f"SELECT {RAW} FROM persons WHERE AGE BETWEEN 18 AND 65"),
    "harmonize_income": on_persons(
        "SELECT COUNTRY, YEAR, SERIAL, PERNUM, INCTOT, INCEARN, greatest(v, 0) AS income_analysis "
        "FROM (SELECT *, coalesce(INCTOT, INCEARN, 0) AS v FROM persons) WHERE v < 9999999"
    ),
    "drop_null_keys": on_persons(
        "SELECT COUNTRY, YEAR, SERIAL, PERNUM, INCEARN, INCTOT FROM persons "
        "WHERE YEAR IS NOT NULL AND INCTOT IS NOT NULL"
    ),
    "income_category": on_silver(
        "SELECT SERIAL, PERNUM, y AS income_analysis, CASE WHEN y = 0 THEN 'zero' "
        "WHEN y < 10000 THEN 'low' WHEN y < 50000 THEN 'middle' "
        "WHEN y < 100000 THEN 'upper_middle' ELSE 'high' END AS income_category FROM silver"
    ),
    "label_sex": on_persons(
        f"SELECT SERIAL, PERNUM, SEX, {SEX_LABEL} AS sex_label, CASE SEX + EMPSTAT "
        "WHEN 1 THEN 'Laki-laki' WHEN 2 THEN 'Perempuan' END AS strict_label FROM persons"
    ),
    "label_country": on_persons(
        f"SELECT SERIAL, PERNUM, COUNTRY, {COUNTRY_NAME} AS country_name FROM persons"
    ),
    "label_employment": on_persons(
        f"SELECT SERIAL, PERNUM, EMPSTAT, {EMPSTAT_LABEL} AS empstat_label, CASE EMPSTAT "
        "WHEN 1 THEN 'Employed' WHEN 2 THEN 'Unemployed' WHEN 3 THEN 'Not in labor force' END "
        "AS strict_label FROM persons"
    ),
    "label_education": on_persons(
        f"SELECT SERIAL, PERNUM, EDATTAIN, {EDUCATION_LABEL} AS education_label FROM persons"
    ),
    "label_age_decade": on_persons(
        f"SELECT SERIAL, PERNUM, AGE, {age_group('(AGE - 5)')} AS age_group, "
        + age_group("(AGE - 5)", "WHEN AGE - 5 >= 80 THEN '80+'")
        + " AS strict_group FROM persons"
    ),
    "cut_age": on_persons(
        "SELECT SERIAL, PERNUM, AGE, CASE WHEN AGE BETWEEN 15 AND 24 THEN '15-24' "
        "WHEN AGE BETWEEN 25 AND 34 THEN '25-34' WHEN AGE BETWEEN 35 AND 44 THEN '35-44' "
        "WHEN AGE BETWEEN 45 AND 54 THEN '45-54' WHEN AGE BETWEEN 55 AND 65 THEN '55-65' END "
        "AS age_group FROM persons"
    ),
    "label_sector": on_persons(
        f"SELECT SERIAL, PERNUM, OCCISCO, INDGEN, {sector('OCCISCO', OCCUPATION)} AS "
        f"occupation_label, {sector('INDGEN', INDUSTRY)} AS industry_label FROM persons"
    ),
    "normalize_ppp": on_persons(
        "SELECT SERIAL, PERNUM, COUNTRY, round(INCEARN * CASE COUNTRY "
        "WHEN 76 THEN CAST(0.5664 AS DOUBLE) WHEN 484 THEN CAST(0.6838 AS DOUBLE) ELSE 1 END, 4) "
        "AS income_ppp, round(INCEARN * CAST(0.85 AS DOUBLE), 4) AS income_flat FROM persons"
    ),
    "filter_sentinels": on_persons(
        "SELECT COUNTRY, YEAR, SERIAL, PERNUM, INCTOT FROM persons "
        "WHERE INCTOT NOT IN (9999999, 99999999, 999999999) AND INCTOT >= 0"
    ),
    "filter_countries": on_persons(
        "SELECT COUNTRY, YEAR, SERIAL, PERNUM FROM persons WHERE COUNTRY IN (76, 484)"
    ),
    "dedup": sql(f"SELECT {RAW}, {TIES} FROM single", PERSONS, DISTINCT),
    "dedup_clustered": sql(f"SELECT {RAW}, {TIES} FROM single", PERSONS, DISTINCT),
    "dedup_sample_key": on_persons(
        "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY SAMPLE, SERIAL, "
        f"PERNUM ORDER BY {TIES}) AS rn FROM persons) WHERE rn = 1"
    ),
    "refined_layer": on_silver(
        "SELECT COUNTRY, YEAR, SERIAL, PERNUM, PERWT, AGE, SEX, EDATTAIN, EMPSTAT, INCTOT, "
        "INCEARN, y AS income_analysis, 'silver' AS _layer, CASE WHEN y = 0 THEN 'zero' "
        "WHEN y < 10000 THEN 'low' WHEN y < 50000 THEN 'middle' WHEN y < 100000 "
        f"THEN 'upper_middle' ELSE 'high' END AS income_category, {SEX_LABEL} AS sex_label, "
        f"{COUNTRY_NAME} AS country_name FROM silver"
    ),
    "baseline_layer": on_persons(
        "SELECT SAMPLE, SERIAL, PERNUM, COUNTRY, AGE, INCTOT, INCEARN, round(INCTOT * CASE COUNTRY "
        "WHEN 76 THEN CAST(0.5664 AS DOUBLE) WHEN 484 THEN CAST(0.6838 AS DOUBLE) ELSE 1 END, 4) "
        "AS income_ppp, CASE COUNTRY WHEN 76 THEN 'Brazil' WHEN 484 THEN 'Mexico' END AS "
        "country_name, CASE SEX WHEN 1 THEN 'Laki-laki' WHEN 2 THEN 'Perempuan' END AS sex_label, "
        "CASE EMPSTAT WHEN 1 THEN 'Employed' WHEN 2 THEN 'Unemployed' "
        "WHEN 3 THEN 'Not in labor force' END AS empstat_label, "
        "CASE WHEN AGE <= 24 THEN '15-24' WHEN AGE <= 34 THEN '25-34' WHEN AGE <= 44 THEN '35-44' "
        "WHEN AGE <= 54 THEN '45-54' ELSE '55-65' END AS age_group "
        "FROM (SELECT *, row_number() OVER (PARTITION BY SAMPLE, SERIAL, PERNUM "
        f"ORDER BY {TIES}) AS rn FROM persons WHERE AGE BETWEEN 15 AND 65 AND INCTOT >= 0 "
        "AND INCTOT NOT IN (9999999, 99999999, 999999999) "
        "AND coalesce(INCEARN NOT IN (9999999, 99999999, 999999999), true)) WHERE rn = 1"
    ),
    "union_layers": on_persons(
        "SELECT COUNTRY, YEAR, SERIAL, PERNUM, INCEARN FROM persons WHERE COUNTRY = 76 UNION ALL "
        "SELECT COUNTRY, YEAR, SERIAL, PERNUM, INCEARN FROM persons WHERE COUNTRY = 484"
    ),
    # aggregation and profiles
    "count_by_group": on_silver(
        "SELECT COUNTRY, YEAR, count(*) AS n_obs FROM silver GROUP BY COUNTRY, YEAR"
    ),
    "mean_by_group": on_persons(
        "SELECT COUNTRY, round(avg(INCTOT), 6) AS mean_income FROM persons GROUP BY COUNTRY"
    ),
    "income_stats": on_silver(STATS),
    "demog_sex": on_silver(demographic(SEX_LABEL, "sex_label")),
    "demog_emp": on_silver(demographic(EMPSTAT_LABEL, "empstat_label")),
    "demog_edu": on_silver(demographic(EDUCATION_LABEL, "education_label")),
    "demog_age": on_silver(demographic(age_group("AGE"), "age_group")),
    "demog_share": on_silver(
        "SELECT *, round(weighted_count / sum(weighted_count) OVER (PARTITION BY COUNTRY, YEAR), "
        f"6) AS share FROM ({demographic(EMPSTAT_LABEL, 'empstat_label')})"
    ),
    "demog_ordered": on_silver(
        "SELECT *, CAST(CASE education_label WHEN 'Tdk Tamat SD' THEN 0 WHEN 'SD/Sederajat' "
        "THEN 1 WHEN 'SMA/Sederajat' THEN 2 WHEN 'Perguruan Tinggi' THEN 3 ELSE 4 END AS INTEGER) "
        f"AS position FROM ({demographic(EDUCATION_LABEL, 'education_label')}) "
        "ORDER BY position, COUNTRY, YEAR"
    ),
    "eda_summary": on_explored(
        "SELECT COUNTRY, round(avg(INCTOT), 6) AS mean_income, quantile_disc(INCTOT, 0.5) AS "
        "median_income, max(INCTOT) AS max_income, count(INCTOT) AS population "
        "FROM explored GROUP BY COUNTRY"
    ),
    "zero_income_share": on_explored(
        "SELECT COUNTRY, count(INCTOT) AS population, count(*) FILTER (INCTOT = 0) AS n_zero, "
        "round(count(*) FILTER (INCTOT = 0) / count(INCTOT) * 100, 6) AS zero_pct "
        "FROM explored GROUP BY COUNTRY"
    ),
    "median_by_education": on_explored(
        "SELECT COUNTRY, EDATTAIN, quantile_disc(INCTOT, 0.5) AS median_income, "
        "count(INCTOT) AS n_obs FROM explored GROUP BY COUNTRY, EDATTAIN "
        "ORDER BY COUNTRY, EDATTAIN"
    ),
    "palma_thresholds": on_explored(
        "SELECT COUNTRY, quantile_disc(INCTOT, 0.4) AS bottom40_limit, "
        "quantile_disc(INCTOT, 0.9) AS top10_limit, sum(INCTOT) AS total_income "
        "FROM explored GROUP BY COUNTRY"
    ),
    "missing_counts": on_persons(
        "SELECT "
        + ", ".join(
            f"count(*) FILTER ({c} IS NULL) AS {c}"
            for c in ("COUNTRY", "YEAR", "AGE", "SEX", "EMPSTAT", "INCTOT")
        )
        + " FROM persons"
    ),
    "missing_counts_long": on_persons(
        missing_union(
            ["YEAR", "AGE", "INCTOT", "INCEARN"], "count(*) FILTER ({c} IS NULL)", "n_missing"
        )
    ),
    "null_percent": on_persons(
        missing_union(
            RAW.split(", "), "round(count(*) FILTER ({c} IS NULL) / count(*) * 100, 2)", "null_pct"
        )
    ),
    "describe_income": on_positive(described("positive", "INCTOT")),
    "describe_balances": described("customer", "c_acctbal", "c_mktsegment"),
    "weighted_percentiles": on_silver(
        "SELECT COUNTRY, "
        + ", ".join(
            f"round(quantile_cont(y, {p}), 4) AS p{round(p * 100)}" for p in (0.2, 0.4, 0.6, 0.8, 1)
        )
        + " FROM (SELECT COUNTRY, y, unnest(range(greatest(CAST(PERWT AS BIGINT), 1))) "
        "FROM silver) GROUP BY COUNTRY"
    ),
    "qcut_bins": on_positive(
        f"SELECT COUNTRY, SERIAL, PERNUM, {TIES}, INCTOT, CASE "
        + " ".join(f"WHEN INCTOT <= e{i} THEN 'Q{i}'" for i in range(1, 5))
        + " ELSE 'Q5' END AS quintile FROM (SELECT *, "
        + ", ".join(
            f"quantile_cont(INCTOT, {i / 5}) OVER (PARTITION BY COUNTRY) AS e{i}"
            for i in range(1, 5)
        )
        + " FROM positive)"
    ),
    "qcut_summary": on_positive(
        "SELECT bin, count(*) AS n_obs, round(avg(INCTOT), 6) AS mean, "
        "round(median(INCTOT), 6) AS median, min(INCTOT) AS min, max(INCTOT) AS max "
        "FROM (SELECT INCTOT, CAST(CASE "
        + " ".join(
            f"WHEN INCTOT <= (SELECT quantile_cont(INCTOT, {i / 5}) FROM positive) THEN {i}"
            for i in range(1, 5)
        )
        + " ELSE 5 END AS INTEGER) AS bin FROM positive) GROUP BY bin"
    ),
    "iqr_outliers": on_positive(
        IQR.format(
            keep=f"COUNTRY, SERIAL, PERNUM, {TIES}, INCTOT", x="INCTOT", part="",
            source="positive", f="1.5",
        )
    ),
    "iqr_outliers_by_status": IQR.format(
        keep="o_orderkey, o_orderstatus, o_totalprice", x="o_totalprice",
        part="PARTITION BY o_orderstatus", source="orders", f="0.5",
    ),
    "iqr_outliers_lengths": IQR.format(
        keep="doc_id, lang, n_chars", x="n_chars", part="PARTITION BY lang", source="documents",
        f="1.5",
    ),
    "distinct_keys": on_persons(
        " UNION ALL ".join(
            f"SELECT {c} AS COUNTRY, {y} AS YEAR, count(*) AS n_rows, "
            f"count(DISTINCT (SERIAL, PERNUM)) AS n_keys, true AS sketch_fits FROM persons {by}"
            for c, y, by in (
                ("CAST(COUNTRY AS VARCHAR)", "CAST(YEAR AS VARCHAR)", "GROUP BY COUNTRY, YEAR"),
                ("CAST(COUNTRY AS VARCHAR)", "'all'", "GROUP BY COUNTRY"),
                ("'all'", "'all'", ""),
            )
        )
    ),
    "approximate_percentiles": on_silver(
        "SELECT COUNTRY, q AS quantile, n_obs, true AS rank_fits "
        "FROM (SELECT COUNTRY, count(*) AS n_obs FROM silver GROUP BY COUNTRY) "
        "CROSS JOIN (VALUES ('p10'), ('p25'), ('p40'), ('p50'), ('p75'), ('p90'), ('p99')) v(q)"
    ),
    "describe_columns": on_persons(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, * FROM "
            f"({described(f'(SELECT {c} FROM persons WHERE {c} IS NOT NULL)', c)})"
            for c in ("AGE", "PERWT", "INCTOT", "INCEARN")
        )
    ),
    "null_profile": on_persons(
        " UNION ALL ".join(
            f"SELECT CAST({i} AS INTEGER) AS position, '{name}' AS column_name, '{kind}' AS type, "
            f"count(*) AS n_rows, count(*) FILTER ({test}) AS n_missing, "
            f"round(count(*) FILTER ({test}) / count(*) * 100, 2) AS missing_pct FROM persons"
            for i, (name, kind, test) in enumerate(
                [(c, COLUMN_TYPES.get(c, "int"), f"{c} IS NULL") for c in RAW.split(", ")]
                + [
                    ("incomes", "struct<INCTOT:double,earned:struct<INCEARN:double>>", "SEX <> 1"),
                    ("incomes.INCTOT", "double", "SEX <> 1 OR INCTOT IS NULL"),
                    ("incomes.earned", "struct<INCEARN:double>", "SEX <> 1"),
                    ("incomes.earned.INCEARN", "double", "SEX <> 1 OR INCEARN IS NULL"),
                ]
            )
        )
    ),
    "income_histogram": on_positive(
        "SELECT CAST(b.i AS INTEGER) AS bin, round(lo + b.i * ((hi - lo) / 50), 6) AS lower, "
        "round(lo + (b.i + 1) * ((hi - lo) / 50), 6) AS upper, count(INCTOT) AS n "
        "FROM (SELECT unnest(range(50)) AS i) b CROSS JOIN lim LEFT JOIN positive "
        "ON least(floor((INCTOT - lo) / (hi - lo) * 50), 49) = b.i GROUP BY b.i, lo, hi",
        "lim AS (SELECT min(INCTOT) AS lo, max(INCTOT) AS hi FROM positive)",
    ),
    "income_histogram_trimmed": on_explored(
        "SELECT g.COUNTRY, CAST(b.i AS INTEGER) AS bin, round(lo + b.i * ((hi - lo) / 50), 6) AS "
        "lower, round(lo + (b.i + 1) * ((hi - lo) / 50), 6) AS upper, count(INCTOT) AS n "
        "FROM (SELECT DISTINCT COUNTRY FROM trimmed) g "
        "CROSS JOIN (SELECT unnest(range(50)) AS i) b "
        "CROSS JOIN lim LEFT JOIN trimmed t ON t.COUNTRY = g.COUNTRY "
        "AND least(floor((INCTOT - lo) / (hi - lo) * 50), 49) = b.i "
        "GROUP BY g.COUNTRY, b.i, lo, hi",
        "trimmed AS (SELECT * FROM explored WHERE INCTOT < "
        "(SELECT quantile_cont(INCTOT, 0.95) FROM explored))",
        "lim AS (SELECT min(INCTOT) AS lo, max(INCTOT) AS hi FROM trimmed)",
    ),
    **{
        f"sample_{kind}_profile": on_persons(
            "SELECT COUNTRY, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_foreign, "
            "true AS size_fits FROM persons GROUP BY COUNTRY"
        )
        for kind in ("bernoulli", "stratified")
    },
    "attrition": on_silver(
        "SELECT b.COUNTRY, g.layer, coalesce(l.n_rows, 0) AS n_rows, "
        "round(coalesce(l.n_rows, 0) / b.n_rows * 100, 6) AS retained_pct, "
        "round(100 - coalesce(l.n_rows, 0) / b.n_rows * 100, 6) AS excluded_pct "
        "FROM (SELECT COUNTRY, count(*) AS n_rows FROM persons GROUP BY COUNTRY) b "
        "CROSS JOIN (VALUES ('bronze'), ('deduplicated'), ('silver')) g(layer) LEFT JOIN ("
        + " UNION ALL ".join(
            f"SELECT COUNTRY, '{layer}' AS layer, count(*) AS n_rows FROM {t} GROUP BY COUNTRY"
            for layer, t in (
                ("bronze", "persons"),
                ("deduplicated", "single"),
                ("silver", "silver"),
            )
        )
        + ") l ON l.COUNTRY = b.COUNTRY AND l.layer = g.layer"
    ),
    "baseline_metrics": on_silver(
        "SELECT country_name, count(*) AS n_individuals, CAST(sum(PERWT) AS BIGINT) AS n_weighted, "
        "round(median(y), 2) AS median_ppp, round(max(ty) / max(tw), 2) AS mean_ppp, "
        "round(1 - 2 * sum((cy - PERWT * y) / ty * (PERWT / tw)), 4) AS gini, "
        "round(sum(CASE WHEN c >= 0.9 * tw THEN PERWT * y END) "
        "/ nullif(sum(CASE WHEN c <= 0.4 * tw THEN PERWT * y END), 0), 4) AS palma, "
        f"round({THEIL}, 4) AS theil, round(max(q1), 2) AS q1_limit, "
        "round(max(q3), 2) AS q3_limit, round(max(q5), 2) AS q5_limit "
        "FROM cum JOIN copies USING (country_name) GROUP BY country_name",
        PPP, cumulated("country_name", "ppp"), COPIES,
    ),
    "sector_boxplot": on_explored(
        "SELECT INDGEN, round(min(INCTOT), 4) AS low, round(quantile_cont(INCTOT, 0.25), 4) AS q1, "
        "round(quantile_cont(INCTOT, 0.5), 4) AS median, "
        "round(quantile_cont(INCTOT, 0.75), 4) AS q3, round(max(INCTOT), 4) AS high "
        "FROM explored GROUP BY INDGEN"
    ),
    "dimension_values": on_silver(
        "SELECT (SELECT string_agg(CAST(v AS VARCHAR), ',' ORDER BY v) FROM "
        "(SELECT DISTINCT COUNTRY AS v FROM silver)) AS countries, "
        "(SELECT string_agg(CAST(v AS VARCHAR), ',' ORDER BY v) FROM "
        "(SELECT DISTINCT YEAR AS v FROM silver)) AS years"
    ),
    # inequality
    "running_totals": on_silver(
        "SELECT COUNTRY, YEAR, value, n, weight, weight_sq, weight_min, weight_max, income, "
        "coalesce(sum(weight) OVER earlier, 0) AS weight_before, "
        "coalesce(sum(income) OVER earlier, 0) AS income_before, "
        "sum(weight) OVER (PARTITION BY COUNTRY, YEAR) AS weight_total, "
        "sum(income) OVER (PARTITION BY COUNTRY, YEAR) AS income_total "
        "FROM (SELECT COUNTRY, YEAR, y AS value, count(*) AS n, sum(PERWT) AS weight, "
        "sum(PERWT * PERWT) AS weight_sq, min(PERWT) AS weight_min, max(PERWT) AS weight_max, "
        "sum(PERWT * y) AS income FROM silver GROUP BY COUNTRY, YEAR, y) "
        "WINDOW earlier AS (PARTITION BY COUNTRY, YEAR ORDER BY value "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    ),
    "gini": on_silver(
        f"SELECT COUNTRY, YEAR, round({GINI}, 6) AS gini FROM cum GROUP BY COUNTRY, YEAR", CUM
    ),
    "gini_lorenz_left": on_silver(
        "SELECT COUNTRY, YEAR, round(1 - 2 * sum((cy - PERWT * y) / ty * (PERWT / tw)), 6) AS gini "
        "FROM cum GROUP BY COUNTRY, YEAR",
        CUM,
    ),
    "gini_unweighted": on_positive(
        "SELECT COUNTRY, round(sum((2 * i - n - 1) * INCTOT) / (max(n) * sum(INCTOT)), 6) AS gini "
        "FROM (SELECT *, row_number() OVER (PARTITION BY COUNTRY ORDER BY INCTOT) AS i, "
        "count(*) OVER (PARTITION BY COUNTRY) AS n FROM positive) GROUP BY COUNTRY"
    ),
    "gini_trapezoid": on_positive(
        "SELECT round(1 - 2 * sum(PERWT * (cy - INCTOT * PERWT / 2)) / (sum(PERWT) * max(ty)), 6) "
        "AS gini FROM (SELECT *, sum(PERWT * INCTOT) OVER (ORDER BY INCTOT, PERWT "
        "ROWS UNBOUNDED PRECEDING) AS cy, sum(PERWT * INCTOT) OVER () AS ty FROM positive)"
    ),
    "gini_order_values": (
        "SELECT o_orderstatus, round(greatest(least(2 * sum(o_totalprice * i) / (max(n) * "
        "sum(o_totalprice)) - (max(n) + 1) / max(n), 1), 0), 6) AS gini FROM (SELECT *, "
        "row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice) AS i, "
        "count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders) GROUP BY o_orderstatus"
    ),
    "theil": on_silver(
        f"SELECT COUNTRY, YEAR, round({THEIL}, 6) AS theil FROM cum GROUP BY COUNTRY, YEAR", CUM
    ),
    "mean_log_deviation": on_silver(
        f"SELECT COUNTRY, YEAR, round({MLD}, 6) AS mld FROM cum GROUP BY COUNTRY, YEAR", CUM
    ),
    "theil_agg_form": on_silver(
        "SELECT coalesce(COUNTRY, 0) AS COUNTRY, coalesce(SEX, 0) AS SEX, "
        "CAST(grouping(COUNTRY, SEX) AS INTEGER) AS level, "
        "round(sum(wy * ln(y)) / sum(wy) - ln(sum(wy) / sum(w)), 6) AS theil, "
        "round(ln(sum(wy) / sum(w)) - sum(w * ln(y)) / sum(w), 6) AS mld, "
        "round(sum(wy) / sum(PERWT), 6) AS mean_income "
        "FROM (SELECT COUNTRY, SEX, PERWT, CASE WHEN y > 0 THEN y END AS y, "
        "CASE WHEN y > 0 THEN PERWT END AS w, CASE WHEN y > 0 THEN PERWT * y END AS wy "
        "FROM silver) GROUP BY CUBE (COUNTRY, SEX)"
    ),
    "quantile_shares": on_parts(
        f"SELECT quantile, {r('lower_bound', 'upper_bound', 'mean_income', 'income_share')}, "
        "COUNTRY AS country, YEAR AS year FROM parts ORDER BY country, year, quantile"
    ),
    "decile_shares": on_silver(
        "SELECT COUNTRY, quantile, "
        f"{r('lower_bound', 'upper_bound', 'mean_income', 'income_share')} FROM parts",
        cumulated("COUNTRY"), quantile_cte("COUNTRY", 10),
    ),
    "palma": on_silver(
        f"SELECT COUNTRY, YEAR, round({PALMA}, 6) AS palma FROM cum GROUP BY COUNTRY, YEAR", CUM
    ),
    "palma_inclusive": on_silver(
        f"SELECT COUNTRY, YEAR, round({PALMA.replace('c > 0.9', 'c >= 0.9')}, 6) AS palma "
        "FROM cum GROUP BY COUNTRY, YEAR",
        CUM,
    ),
    "poverty_half_median": on_silver(
        f"SELECT COUNTRY, YEAR, round({POVERTY}, 6) AS sdg_10_2_1 FROM med GROUP BY COUNTRY, YEAR",
        CUM, MEDIAN,
    ),
    "weighted_median": on_silver(
        "SELECT COUNTRY, YEAR, round(max(median), 6) AS median FROM med GROUP BY COUNTRY, YEAR",
        CUM, MEDIAN,
    ),
    "lorenz_curve": on_silver(
        "SELECT COUNTRY, round(max(c) / max(tw), 6) AS cum_population, "
        "round(max(cy) / max(ty), 6) AS cum_income FROM cum GROUP BY COUNTRY, y UNION ALL "
        "SELECT DISTINCT COUNTRY, 0, 0 FROM cum",
        cumulated("COUNTRY"),
    ),
    "lorenz_points": on_silver(
        "SELECT COUNTRY, YEAR, CAST(i AS INTEGER) AS point, round(i / 100, 6) AS cum_population, "
        "round(max((cy - PERWT * y + y * (i * tw / 100 - (c - PERWT))) / ty), 6) AS cum_income "
        "FROM (SELECT COUNTRY, YEAR, c, cy, tw, ty, PERWT, y, "
        "unnest(range(CAST(floor((c - PERWT) * 100 / tw) AS BIGINT) + 1, "
        "CAST(floor(c * 100 / tw) AS BIGINT) + 1)) AS i FROM cum) GROUP BY COUNTRY, YEAR, i "
        "UNION ALL SELECT DISTINCT COUNTRY, YEAR, 0, 0, 0 FROM cum",
        CUM,
    ),
    "lorenz_quintile": on_parts(
        "SELECT COUNTRY AS country, YEAR AS year, round(quantile / 5, 6) AS cum_population, "
        "round(sum(income_share) OVER (PARTITION BY COUNTRY, YEAR ORDER BY quantile), 6) AS "
        "cum_income FROM parts UNION ALL SELECT DISTINCT COUNTRY, YEAR, 0, 0 FROM parts"
    ),
    "shared_prosperity": on_silver(
        "SELECT COUNTRY, YEAR, round(m, 6) AS mean_income, round(b, 6) AS mean_b40, "
        "round((b / m - 1) * 100, 6) AS premium_pct, CASE WHEN b < 0.5 * m THEN 'Kritis' "
        f"ELSE 'Normal' END AS anomali_b40 FROM (SELECT COUNTRY, YEAR, max(ty) / max(tw) AS m, "
        f"{MEAN_B40} AS b FROM cum GROUP BY COUNTRY, YEAR)",
        CUM,
    ),
    "inequality_summary": on_ineq(
        "SELECT country, country_name, year, "
        + r("gini", "theil", "palma", "sdg_10_2_1", "mean_income", "mean_b40")
        + ", CASE WHEN mean_b40 < 0.5 * mean_income THEN 'Kritis' ELSE 'Normal' END AS "
        "anomali_b40, n_obs FROM ineq ORDER BY country, year"
    ),
    # reports
    "share_b40_vs_top20": on_parts(
        "SELECT COUNTRY AS country, YEAR AS year, 'Bottom 40% (Q1+Q2)' AS part, "
        "round(sum(income_share * 100), 6) AS income_share_pct FROM parts WHERE quantile <= 2 "
        "GROUP BY COUNTRY, YEAR UNION ALL SELECT COUNTRY, YEAR, 'Top 20% (Q5)', "
        "round(income_share * 100, 6) FROM parts WHERE quantile = 5"
    ),
    "quintile_ratio": on_parts(
        "SELECT a.COUNTRY AS country, a.YEAR AS year, round(a.income_share, 6) AS q1_share, "
        "round(b.income_share, 6) AS q5_share, CASE WHEN a.income_share > 0 "
        "THEN round(b.income_share / a.income_share, 6) END AS share_ratio, "
        "CASE WHEN a.mean_income > 0 THEN round(b.mean_income / a.mean_income, 6) END "
        "AS mean_ratio "
        "FROM parts a JOIN parts b ON a.COUNTRY = b.COUNTRY AND a.YEAR = b.YEAR "
        "WHERE a.quantile = 1 AND b.quantile = 5"
    ),
    "quintile_format": on_parts(
        "SELECT COUNTRY AS country, YEAR AS year, CASE quantile WHEN 1 THEN 'Q1 (20% Termiskin)' "
        "WHEN 5 THEN 'Q5 (20% Terkaya)' ELSE 'Q' || quantile END AS quintile, "
        "format('{:,.0f}', lower_bound) AS lower_bound, "
        "format('{:,.0f}', upper_bound) AS upper_bound, "
        "format('{:,.2f}', mean_income) AS mean_income, "
        "format('{:,.2f}', income_share * 100) || '%' AS income_share FROM parts"
    ),
    "metric_trend_normalized": on_ineq(
        " UNION ALL ".join(
            f"SELECT country, year, '{m}' AS metric, round(({m} - min({m}) OVER p) / "
            f"(max({m}) OVER p - min({m}) OVER p + 1e-10), 6) AS scaled FROM ineq "
            "WINDOW p AS (PARTITION BY country)"
            for m in ("gini", "theil", "palma")
        )
    ),
    "gini_status": on_ineq(
        "SELECT country, year, round(gini, 6) AS gini, CASE WHEN gini > 0.5 THEN 'Sangat Tinggi' "
        "WHEN gini > 0.4 THEN 'Tinggi' ELSE 'Moderat' END AS status, CAST(CASE WHEN gini < 0.3 "
        "THEN 0 WHEN gini < 0.4 THEN 1 WHEN gini < 0.55 THEN 2 ELSE 3 END AS INTEGER) "
        "AS gauge_band "
        "FROM ineq"
    ),
    "target_gap": on_ineq(
        "SELECT country, country_name, year, round(gini, 6) AS gini, "
        "CAST(0.3 AS DOUBLE) AS target, "
        "round(gini - CAST(0.3 AS DOUBLE), 4) AS gap FROM ineq"
    ),
    "actual_vs_target": on_ineq(
        "SELECT country, country_name, year, 'Aktual' AS kind, round(gini, 6) AS amount, "
        "round(gini - CAST(0.3 AS DOUBLE), 4) AS gap FROM ineq UNION ALL "
        "SELECT country, country_name, year, 'Target SDG', CAST(0.3 AS DOUBLE), NULL FROM ineq"
    ),
    "metric_comparison": on_ineq(
        " UNION ALL ".join(
            f"SELECT country, country_name, year, '{m}' AS metric, "
            f"round({m}, 6) AS amount FROM ineq"
            for m in ("gini", "theil", "palma", "sdg_10_2_1")
        )
    ),
    "report_format": on_ineq(
        "SELECT country_name, year, format('{:.4f}', gini) AS gini, "
        "format('{:.4f}', theil) AS theil, format('{:,.2f}', palma) || '×' AS palma, "
        "format('{:.1f}', sdg_10_2_1 * 100) || '%' AS sdg_10_2_1, "
        "format('{:,.0f}', mean_income) AS mean_income, format('{:,.0f}', mean_b40) AS mean_b40, "
        "format('{:,}', n_obs) AS n_obs FROM ineq"
    ),
    "kpi_summary": on_silver(
        "SELECT country, country_name, year, round(gini, 6) AS gini, round(palma, 6) AS palma, "
        "m.median_income, n_obs, (SELECT count(*) FROM silver) AS n_obs_total FROM ineq JOIN "
        "(SELECT COUNTRY AS c, YEAR AS y, quantile_disc(y, 0.5) AS median_income FROM silver "
        "GROUP BY COUNTRY, YEAR) m ON m.c = country AND m.y = year",
        CUM, MEDIAN, INEQ,
    ),
    # previews and samples
    "layer_preview": on_persons(
        f"SELECT {RAW}, {TIES} FROM persons ORDER BY SERIAL, PERNUM, {TIES} LIMIT 100"
    ),
    "sample_keyed": on_persons(
        f"SELECT COUNTRY, YEAR, SERIAL, PERNUM, {TIES} FROM persons WHERE "
        "((SERIAL % 100003) * 7919 + PERNUM * 104729 + 12345) % 1000 < "
        "CASE COUNTRY WHEN 76 THEN 100 WHEN 484 THEN 50 ELSE 0 END"
    ),
}
