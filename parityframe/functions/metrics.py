"""Inequality measures that are plain aggregate expressions, for any ``agg``, cube or rollup.

``value`` and ``weight`` are column names or SQL expressions over the rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def weighted_mean_col(value: str, weight: str | None = None) -> Column:
    """Weighted mean over rows where both are present; NULL when the weights add up to zero."""
    y, w = f"({value})", f"({weight or '1D'})"
    return F.expr(f"try_divide(sum({w} * {y}), sum(if({y} IS NULL, NULL, {w})))")


def _positive(value: str, weight: str | None) -> tuple[str, str]:
    """Value and weight of the rows with a positive value and a weight, NULL elsewhere."""
    y, w = f"CAST(({value}) AS DOUBLE)", f"({weight or '1D'})"
    used = f"{y} > 0 AND NOT isnan({y}) AND {w} IS NOT NULL"
    return f"if({used}, {y}, NULL)", f"if({used}, {w}, NULL)"


def theil_col(value: str, weight: str | None = None) -> Column:
    """Theil T over positive values: income-weighted mean of log income, less log of the mean."""
    y, w = _positive(value, weight)
    total, heads = f"sum({w} * {y})", f"sum({w})"
    return F.expr(
        f"try_divide(sum({w} * {y} * ln({y})), {total}) - ln(try_divide({total}, {heads}))"
    )


def mld_col(value: str, weight: str | None = None) -> Column:
    """Mean log deviation over positive values: log of the mean, less the mean of log income."""
    y, w = _positive(value, weight)
    total, heads = f"sum({w} * {y})", f"sum({w})"
    return F.expr(
        f"ln(try_divide({total}, {heads})) - try_divide(sum({w} * ln({y})), {heads})"
    )
