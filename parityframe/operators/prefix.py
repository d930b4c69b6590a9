"""Exact running totals per group, distributed.

A window ordered over a whole group would put that group into one task, and a group may hold
a third of all rows. So the values are cut into cells, intervals that each hold about as many rows
of all groups together. Running totals are taken inside each cell of a group, the totals of the
cells are accumulated over the short list of a group's cells, and both are added. A group's part of
a cell is no larger than the cell, so the windows are small however the rows are spread over groups
and values; a group whose values lie far from the others' has as many cells as its share of rows.
This is done at every size.

Where to cut is known before any row is moved: one pass over the rows builds a mergeable quantile
sketch, of which a few kilobytes a task are moved. A sketch may misjudge a rank a little, which
makes cells a little uneven and changes no result.

The rows are then collapsed to one per group, cell and distinct value, with map-side combining, so
a value shared by a third of all rows costs one row per task here. That is the only exchange of
rows. The window over group and cell is the only exchange of the distinct values.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parityframe.workspace import join_groups, quoted, stage

#: Cells of all rows together.
CELLS = 1_024
#: Accuracy of the quantile sketch: ranks are right within about 0.13 % of the rows.
SKETCH_SIZE = 4_096

_EARLIER = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
_ENDS = ("_before", "_total")
CDF_COLUMNS = [
    "value", "n", "weight", "weight_sq", "weight_min", "weight_max",
    "income", "weight_before", "income_before", "weight_total", "income_total",
]


def cell_limits(df: DataFrame, order: str) -> list[float]:
    """The values between the cells, rising: fewer than ``CELLS``."""
    ranks = f"CAST(split('{','.join(str(i / CELLS) for i in range(1, CELLS))}', ',') AS ARRAY<DOUBLE>)"
    sketch = f"kll_sketch_agg_double({quoted(order)}, {SKETCH_SIZE})"
    limits = f"IF(count(*) > 0, kll_sketch_get_quantile_double({sketch}, {ranks}), array())"
    return sorted(set(df.agg(F.expr(limits).alias("limits")).first()["limits"]))


def with_cells(df: DataFrame, order: str) -> DataFrame:
    """``df`` with ``_cell``, the number of limits up to ``order`` (a non-null double).

    ``df`` is read twice, once for the limits when this is called: what is dear to compute should
    be stored first. A row's cell is found by binary search in the JVM.
    """
    limits = [x for x in cell_limits(df, order) if math.isfinite(x)]
    if not limits:
        return df.withColumn("_cell", F.lit(0))
    splits = [-math.inf, *limits, math.inf]
    found = Bucketizer(splits=splits, inputCol=order, outputCol="_cell", handleInvalid="keep")
    return found.transform(df).withColumn("_cell", F.col("_cell").cast("int"))


def running_totals(df: DataFrame, keys: list[str], order: str, sums: list[str]) -> DataFrame:
    """Add ``<s>_before`` (total of the earlier rows) and ``<s>_total`` for every ``s`` in ``sums``.

    ``df`` is a stored table with one row per ``keys`` and ``order``, a non-null double. The
    result may be read several times without being stored again.
    """
    return _totals(with_cells(df, order), keys, order, sums)


def _totals(celled: DataFrame, keys: list[str], order: str, sums: list[str]) -> DataFrame:
    """Running totals of rows with a ``_cell``, which rises with ``order`` within a group.

    Two tables are written: the rows with the totals inside their cell, and one row per cell with
    what lies before it. The result joins both, on the true size of the second.
    """
    columns = [quoted(c) for c in celled.columns if c != "_cell"]
    group = [quoted(k) for k in keys]
    leaves = stage(inside_cells(celled, keys, order, sums), "leaves")

    cells = leaves.groupBy(*keys, "_cell").agg(*[F.sum(s).alias(s) for s in sums])
    whole = f"PARTITION BY {', '.join(group)}" if group else ""
    offsets = cells.selectExpr(
        *group,
        "_cell",
        *[f"{_before(s, group, '_cell')} AS _off_{s}" for s in sums],
        *[f"sum({s}) OVER ({whole}) AS {s}_total" for s in sums],
    )
    joined = join_groups(leaves, stage(offsets, "offsets"), [*keys, "_cell"])
    return joined.selectExpr(
        *columns,
        *[f"_off_{s} + _in_{s} AS {s}_before" for s in sums],
        *[f"{s}_total" for s in sums],
    )


def _before(s: str, within: list[str], by: str) -> str:
    clause = f"PARTITION BY {', '.join(within)}" if within else ""
    return f"coalesce(sum({s}) OVER ({clause} ORDER BY {by} {_EARLIER}), 0D)"


def inside_cells(celled: DataFrame, keys: list[str], order: str, sums: list[str]) -> DataFrame:
    """``celled`` with ``_in_<s>``, the total of ``s`` over the earlier rows of the cell."""
    cell = [*map(quoted, keys), "_cell"]
    inside = [f"{_before(s, cell, quoted(order))} AS _in_{s}" for s in sums]
    return celled.selectExpr("*", *inside)


def weighted_rows(
    df: DataFrame,
    value: str,
    weight: str | None,
    by: list[str],
    keep_negative: bool = False,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Keys plus ``value`` and ``w`` as doubles; rows without a usable value or weight dropped.

    ``extra`` adds further weights to be accumulated along with ``w``.
    """
    clash = sorted(set(by) & {*CDF_COLUMNS, "w"})
    if clash:
        raise ValueError(f"rename the grouping columns {clash}: the names are taken")
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    rows = df.select(
        *by,
        F.col(value).cast("double").alias("value"),
        w.alias("w"),
        *[c.cast("double").alias(name) for name, c in (extra or {}).items()],
    )
    usable = "value IS NOT NULL AND NOT isnan(value) AND w IS NOT NULL"
    return rows.filter(usable if keep_negative else f"{usable} AND value >= 0")


def weighted_cdf(
    rows: DataFrame,
    by: list[str],
    extra: list[str] = (),
) -> DataFrame:
    """One row per group and distinct value, with the weight and income that lie before it.

    The rows are read twice when this is called, for the sketches and for the collapse; rows that
    are dear to compute should be stored first. The result is read from stored tables.

    ``rows`` comes from :func:`weighted_rows`. ``weight``, ``weight_sq``, ``weight_min`` and
    ``weight_max`` describe the weights of the rows sharing the value, ``income`` is value times
    weight, ``*_total`` are group totals. Each name in ``extra`` gets the same three columns.
    """
    sums = ["weight", "income", *extra]
    blocks = collapse(with_cells(rows, "value"), [*by, "_cell"], extra)
    cdf = _totals(blocks, by, "value", sums)
    return cdf.select(*by, *CDF_COLUMNS, *[n + end for n in extra for end in ("", *_ENDS)])


def collapse(rows: DataFrame, by: list[str], extra: list[str] = ()) -> DataFrame:
    """One row per group and distinct value, with map-side combining."""
    blocks = rows.groupBy(*by, "value").agg(
        F.expr("count(*) AS n"),
        F.expr("sum(w) AS weight"),
        F.expr("sum(w * w) AS weight_sq"),
        F.expr("min(w) AS weight_min"),
        F.expr("max(w) AS weight_max"),
        *[F.sum(name).alias(name) for name in extra],
    )
    return blocks.selectExpr("*", "value * weight AS income")
