"""Cut each group at given fractions of its total weight, exactly, row by row.

Rows are taken in the order (value, weight). The cumulative weight C of a row decides its band:
the number of cut points ``p`` with C > p * total (or C >= p * total for an inclusive cut).
Nearly every distinct value lies in one band as a whole. Only a value whose rows reach over a
cut needs to be looked at by weight; there is at most one per group and cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityframe.operators.prefix import running_totals
from parityframe.workspace import join_groups, quoted, stage

SALTS = 16  # tasks that share the rows of one straddling value, if it comes to a shuffle


def _band(cum: str, cuts: list[float], inclusive: list[bool]) -> str:
    """SQL for the band of a row with cumulative weight ``cum``."""
    passed = [
        f"CAST({cum} {'>=' if at else '>'} {cut!r}D * weight_total AS INT)"
        for cut, at in zip(cuts, inclusive)
    ]
    return "(" + " + ".join(passed) + ")"


def _rows_up_to(band: str, cuts: list[float], inclusive: list[bool]) -> str:
    """SQL for how many of the ``n`` equally weighted rows of a unit lie in bands up to ``band``."""
    limit = f"(get(array({', '.join(f'{c!r}D' for c in cuts)}), {band}) * weight_total)"
    open_end = f"get(array({', '.join(str(at).lower() for at in inclusive)}), {band})"

    def fits(k: str) -> str:
        reached = f"weight_before + {k} * unit"
        return f"if({open_end}, {reached} < {limit}, {reached} <= {limit})"

    # the quotient may be one off after rounding; the comparison itself decides
    guess = f"floor(try_divide({limit} - weight_before, unit))"
    exact = (
        f"CASE WHEN {fits(f'({guess} + 1)')} THEN {guess} + 1 "
        f"WHEN {fits(guess)} THEN {guess} ELSE {guess} - 1 END"
    )
    return (
        f"CASE WHEN {band} < 0 THEN 0 WHEN {band} >= {len(cuts)} THEN n "
        f"ELSE least(greatest({exact}, 0), n) END"
    )


def _pieces(units: DataFrame, by: list[str], n: str, weight: str) -> DataFrame:
    return units.selectExpr(
        *map(quoted, by),
        "band",
        "value",
        f"CAST({n} AS BIGINT) AS n",
        f"{weight} AS weight",
        f"{weight} * value AS income",
        "weight_before + weight AS weight_reached",
        "income_total",
    )


def _slice(units: DataFrame, by: list[str], cuts: list[float], inclusive: list[bool]) -> DataFrame:
    """Pieces of units, each a number of rows with equal value and equal weight ``unit``."""
    first = _band("(weight_before + unit)", cuts, inclusive)
    last = _band("(weight_before + weight)", cuts, inclusive)
    units = units.selectExpr("*", f"explode(sequence({first}, {last})) AS band")
    upper = _rows_up_to("band", cuts, inclusive)
    lower = _rows_up_to("(band - 1)", cuts, inclusive)
    units = units.selectExpr("*", f"{upper} - {lower} AS rows_in").filter("rows_in > 0")
    return _pieces(units, by, "rows_in", "rows_in * unit")


def _runs(rows: DataFrame, mixed: DataFrame, by: list[str]) -> DataFrame:
    """Units of the straddling values whose rows differ in weight: one per distinct weight.

    ``mixed`` is read from a stored table, so the planner knows its size and broadcasts it or
    shuffles; then a salt taken from the weight spreads the rows of a frequent value.
    """
    keys = [*by, "value"]
    carried = ["base", "whole", "income_total"]
    salt = F.expr(f"CAST(pmod(hash(w), {SALTS}) AS INT)")
    salted = mixed.withColumnRenamed("weight_total", "whole").withColumn(
        "_salt", F.expr(f"explode(sequence(0, {SALTS - 1}))")
    )
    found = join_groups(rows.select(*keys, "w", salt.alias("_salt")), salted, [*keys, "_salt"])
    runs = found.groupBy(*keys, *carried, "w").agg(F.expr("count(*) AS n"))
    runs = stage(runs.selectExpr("*", "w * n AS weight"), "runs")
    runs = running_totals(runs, keys, "w", ["weight"])
    return runs.selectExpr(
        *map(quoted, keys),
        "n",
        "w AS unit",
        "weight",
        "base + weight_before AS weight_before",
        "whole AS weight_total",
        "income_total",
    )


def weight_bands(
    rows: DataFrame,
    cdf: DataFrame,
    by: list[str],
    cuts: list[float],
    inclusive: list[bool] | None = None,
    reuse: bool = False,
) -> DataFrame:
    """Split the group totals of ``cdf`` at the cut fractions.

    ``rows`` is the input of the cdf, scanned again only for values that straddle a cut with
    unequal weights. With
    ``reuse`` the few split values are stored, so that several results can be taken from the
    bands at the price of one such scan.
    Result: one row per group, band and value with ``n``, ``weight`` and ``income``.
    """
    inclusive = inclusive or [False] * len(cuts)
    first = _band("(weight_before + weight_min)", cuts, inclusive)
    last = _band("(weight_before + weight)", cuts, inclusive)

    inside = cdf.selectExpr("*", f"{last} AS band").filter(f"{first} = band")
    pieces = _pieces(inside, by, "n", "weight")

    straddling = cdf.filter(f"{first} < {last}").selectExpr(
        *map(quoted, by),
        "value",
        "n",
        "weight_min AS unit",
        "weight",
        "weight_before AS base",
        "weight_total",
        "income_total",
        "weight_min < weight_max AS mixed",
    )
    straddling = stage(straddling, "straddling")  # at most one row per group and cut
    even = straddling.filter("NOT mixed").withColumnRenamed("base", "weight_before").drop("mixed")
    mixed = straddling.filter("mixed").select(*by, "value", "base", "weight_total", "income_total")
    units = even.unionByName(_runs(rows, mixed, by))
    split = _slice(units, by, cuts, inclusive)
    return pieces.unionByName(stage(split, "split") if reuse else split)
