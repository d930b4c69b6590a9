"""Codes, labels, thresholds and column lists the results depend on.

Everything in this module is data, kept together so that the operators carry none.
"""

from __future__ import annotations

# Column order and types of a person record.
PERSON_COLUMNS = [
    ("COUNTRY", "int"),
    ("YEAR", "int"),
    ("SAMPLE", "bigint"),
    ("SERIAL", "bigint"),
    ("HHWT", "double"),
    ("PERNUM", "int"),
    ("PERWT", "double"),
    ("AGE", "int"),
    ("SEX", "int"),
    ("EDATTAIN", "int"),
    ("EDATTAIND", "int"),
    ("EMPSTAT", "int"),
    ("EMPSTATD", "int"),
    ("OCCISCO", "int"),
    ("INDGEN", "int"),
    ("INCTOT", "double"),
    ("INCEARN", "double"),
]
PERSON_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in PERSON_COLUMNS)

# Columns wanted in the refined table (EDUC is optional) and those cast to double.
REFINED_COLUMNS = [
    "COUNTRY", "YEAR", "SERIAL", "PERNUM", "PERWT", "AGE", "SEX",
    "EDUC", "EDATTAIN", "EMPSTAT", "INCTOT", "INCEARN",
]
NUMERIC_COLUMNS = ["INCTOT", "INCEARN", "PERWT", "AGE"]

# Code -> label.
COUNTRY_NAMES = {76: "Brazil", 484: "Mexico"}
SEX_NAMES = {1: "Laki-laki", 2: "Perempuan"}
EMPLOYMENT_NAMES = {1: "Bekerja", 2: "Pengangguran", 3: "Tidak Aktif"}
EMPLOYMENT_NAMES_EN = {1: "Employed", 2: "Unemployed", 3: "Not in labor force"}
EDUCATION_NAMES = {
    1: "Tdk Tamat SD",
    2: "SD/Sederajat",
    3: "SMA/Sederajat",
    4: "Perguruan Tinggi",
}
OTHER_LABEL = "Lainnya"
OCCUPATION_NAMES = {
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
INDUSTRY_NAMES = {
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

# Age limits, age groups and display orders.
MIN_AGE, MAX_AGE = 18, 65
AGE_DECADES = [(10, 19), (20, 29), (30, 39), (40, 49), (50, 59), (60, 69), (70, 79)]
OLDEST_LABEL = "80+"
AGE_CUT_EDGES = [14, 24, 34, 44, 54, 65]
AGE_CUT_LABELS = ["15-24", "25-34", "35-44", "45-54", "55-65"]

# Income sentinel codes, categories and price-level factors.
SENTINEL_MIN = 9_999_999
SENTINEL_CODES = [9999999, 99999999, 999999999]
INCOME_CATEGORIES = [(10_000, "low"), (50_000, "middle"), (100_000, "upper_middle")]
ZERO_CATEGORY, TOP_CATEGORY = "zero", "high"
PPP_FACTORS = {76: 0.5664, 484: 0.6838}

# Inequality targets, status bands and flags.
GINI_TARGET = 0.30
GINI_STATUS = [(0.50, "Sangat Tinggi"), (0.40, "Tinggi")]
GINI_STATUS_REST = "Moderat"
GAUGE_EDGES = [0.30, 0.40, 0.55]
BOTTOM_SHARE, TOP_SHARE = 0.40, 0.90
LAGGING_FLAG, NORMAL_FLAG = "Kritis", "Normal"
ACTUAL_LABEL, TARGET_LABEL = "Aktual", "Target SDG"
BOTTOM_40_LABEL, TOP_20_LABEL = "Bottom 40% (Q1+Q2)", "Top 20% (Q5)"
QUINTILE_LABELS = {
    1: "Q1 (20% Termiskin)",
    2: "Q2",
    3: "Q3",
    4: "Q4",
    5: "Q5 (20% Terkaya)",
}

# Names of the aggregate tables and of their folders.
GOLD_TABLES = [
    "gold_gini_by_year",
    "gold_quintile_by_year",
    "gold_theil_by_year",
    "gold_demog_sex",
    "gold_demog_emp",
    "gold_demog_edu",
    "gold_demog_age",
]
