"""Person records projected from the ``lineitem`` test table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TIE_BREAK = ["l_partkey", "l_suppkey", "l_extendedprice"]


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole incomes in hundreds and whole weights: sums are exact and ties are plentiful.

    The tie-break columns give copies of a person a total order.
    """
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return items.selectExpr(
        "CAST(CASE l_returnflag WHEN 'A' THEN 76 WHEN 'N' THEN 484 ELSE 32 END AS INT) AS COUNTRY",
        "year(l_shipdate) AS YEAR",
        "CAST(CASE l_returnflag WHEN 'A' THEN 76 WHEN 'N' THEN 484 ELSE 32 END AS BIGINT) * 10000"
        " + year(l_shipdate) AS SAMPLE",
        "l_orderkey AS SERIAL",
        "l_quantity AS HHWT",
        "l_linenumber AS PERNUM",
        "l_quantity AS PERWT",
        "CAST(10 + l_partkey % 75 AS INT) AS AGE",
        "CAST(1 + l_suppkey % 2 AS INT) AS SEX",
        "CAST(l_partkey % 6 AS INT) AS EDATTAIN",
        "CAST(l_partkey % 6 * 100 + l_partkey % 10 AS INT) AS EDATTAIND",
        "CAST(l_suppkey % 4 AS INT) AS EMPSTAT",
        "CAST(l_suppkey % 4 * 100 + l_suppkey % 10 AS INT) AS EMPSTATD",
        "CAST(CASE WHEN l_partkey % 13 = 12 THEN 99 ELSE l_partkey % 13 END AS INT) AS OCCISCO",
        "CAST(CASE WHEN l_suppkey % 14 = 13 THEN 9990 ELSE 100 * (1 + l_suppkey % 14) END AS INT)"
        " AS INDGEN",
        "CAST(CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_linenumber = 7 THEN 9999999"
        " WHEN l_linenumber = 6 THEN 0 WHEN l_discount = 0.1D THEN -l_extendedprice"
        " ELSE floor(l_extendedprice / 100) * 100 END AS DOUBLE) AS INCTOT",
        "CAST(CASE WHEN l_suppkey % 50 = 0 THEN NULL"
        " ELSE floor(l_extendedprice * 0.8D / 100) * 100 END AS DOUBLE) AS INCEARN",
        *TIE_BREAK,
    )
