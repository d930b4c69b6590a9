"""Mixing sources to target weights, by weighted sampling without replacement.

Every document gets an exponential key ``-ln(u) / quality`` (Efraimidis and Spirakis), smaller
for better ones on average, with ``u`` from the hash of its content. Within its source the
documents are taken by rising key until their sizes add up to what the source's target leaves
after all complete epochs. DataFrame functions only.

A source may hold most of the rows, so no source is ordered as a whole: keys are cut into fixed
steps, the sizes of the steps are summed, and only the step in which a source reaches its target
is ordered row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parityframe.llm.words import free_name
from parityframe.workspace import stage

MAX_EPOCHS = 3
STEPS = 4_096
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"

_KEYS = ["_mix_source", "_mix_size", "_mix_key", "_mix_step", "_mix_tie"]


def quality_weight(text: str) -> str:
    """SQL for the default quality weight: the share of letters, 0.05 at least, 1 at most."""
    letters = rf"length(regexp_replace({text}, '[\\x00-@\\[-`{{-\\x7F]+', ''))"
    return f"coalesce(greatest(0.05D, try_divide({letters}, length({text}))), 0.05D)"


def keyed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weight: str | None = None,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with what the mix needs of each row, in columns named ``_mix_*``.

    ``weight`` names a positive quality column (null or not positive counts as 0.05); without it
    the share of letters is taken.
    """
    body = f"coalesce(CAST(`{text}` AS STRING), '')"
    name = f"coalesce(CAST(`{doc_id}` AS STRING), '')"
    quality = quality_weight(body)
    if weight:
        quality = f"IF(`{weight}` > 0, CAST(`{weight}` AS DOUBLE), 0.05D)"
    rows = docs.withColumns(
        {
            "_mix_source": F.col(source).cast("string"),
            "_mix_size": F.regexp_count(F.expr(body), F.lit(WORD)).cast("bigint"),
            "_mix_tie": F.expr(f"md5(concat('{seed}', '|', {name}, '|', {body}))"),
            "_mix_quality": F.expr(quality),
        }
    )
    u = "((CAST(conv(substr(_mix_tie, 1, 13), 16, 10) AS DOUBLE) + 0.5D) / 4503599627370496D)"
    rows = rows.withColumn("_mix_key", F.expr(f"-ln({u}) / _mix_quality"))
    step = F.expr(f"CAST(floor((1D - exp(-_mix_key)) * {STEPS}) AS INT)")
    return rows.withColumn("_mix_step", step).drop("_mix_quality")


def targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source its target: ``_mix_source``, ``source_size``, ``target``, ``epochs``, ``rest``.

    ``sizes`` has one row per source (``_mix_source``, ``source_size``). Sources by code point,
    null last, weigh 1, 2, 3 in turn and share the sum of all sizes; a target stops at
    ``max_epochs`` times its source's size and the excess is shared again by weight. That is
    ``least(cap, level * weight)`` for one level, found where the running totals of caps and
    weights, by rising cap per weight, use up the sum. One row per source goes through one task.
    """
    everything = Window.partitionBy()
    named = sizes.withColumn(
        "w",
        (F.row_number().over(Window.orderBy(F.col("_mix_source").asc_nulls_last())) - 1) % 3 + 1,
    )
    capped = named.withColumn("cap", F.lit(max_epochs) * F.col("source_size"))
    ranked = capped.withColumn("r", F.col("cap").cast("double") / F.col("w"))
    before = Window.orderBy("r", F.col("_mix_source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    total, weights = F.sum("source_size").over(everything), F.sum("w").over(everything)
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0))
    share = left.cast("double") / (weights - F.coalesce(F.sum("w").over(before), F.lit(0)))
    levels = ranked.withColumn("share", share)
    level = F.min(F.when(F.col("share") <= F.col("r"), F.struct("r", "share"))).over(everything)
    # the first source that its share does not fill sets the level for all from there on
    got = levels.withColumn("level", level["share"]).withColumn("from", level["r"])
    target = F.expr("IF(r < from, CAST(cap AS DOUBLE), least(CAST(cap AS DOUBLE), level * w))")
    return (
        got.withColumn("target", target)
        .withColumn("epochs", F.expr("CAST(coalesce(floor(try_divide(target, source_size)), 0) AS INT)"))
        .withColumn("rest", F.expr("target - epochs * source_size"))
        .select("_mix_source", "source_size", "target", "epochs", "rest")
    )


def plan(keys: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source its target and the last row that is taken once more than ``epochs`` times.

    ``keys`` has the columns of :func:`keyed`, staged. A row is taken when its middle lies within
    the rest, so that a source misses its target by half a document at most.
    """
    steps = keys.groupBy("_mix_source", "_mix_step").agg(F.sum("_mix_size").alias("size"))
    steps = stage(steps, "mix-steps")
    goals = stage(
        targets(steps.groupBy("_mix_source").agg(F.sum("size").alias("source_size")), max_epochs),
        "mix-targets",
    )
    ordered = Window.partitionBy("_mix_source").orderBy("_mix_step")
    before = F.coalesce(
        F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    reached = _with_source(steps.withColumn("before", before), goals.select("_mix_source", "rest"))
    # the step in which the rest is used up; all steps below it are taken
    edge = reached.filter("before < rest").groupBy("_mix_source").agg(
        F.max("_mix_step").alias("cut_step"), F.max("before").alias("before"), F.max("rest").alias("rest")
    )
    edge = stage(edge, "mix-edge")
    inside = _with_source(keys.select(*_KEYS), edge).filter("_mix_step = cut_step")
    rows = Window.partitionBy("_mix_source").orderBy("_mix_key", "_mix_tie")
    middle = (
        F.sum("_mix_size").over(rows.rowsBetween(Window.unboundedPreceding, 0))
        - F.col("_mix_size") / 2
    )
    taken = inside.withColumn("middle", F.col("before") + middle).filter("middle <= rest")
    last = taken.groupBy("_mix_source").agg(
        F.max(F.struct("_mix_key", "_mix_tie")).alias("cut"),
    )
    at = _with_source(taken.select(*_KEYS), last).filter(
        "_mix_key = cut._mix_key AND _mix_tie = cut._mix_tie"
    )
    cuts = at.groupBy("_mix_source").agg(
        F.first("_mix_key").alias("cut_key"),
        F.first("_mix_tie").alias("cut_tie"),
        F.count("*").alias("cut_rows"),
    )
    whole = _with_source(_with_source(goals, edge.drop("before", "rest"), "left"), cuts, "left")
    return stage(whole, "mix-plan")


def _with_source(rows: DataFrame, groups: DataFrame, how: str = "inner") -> DataFrame:
    """Join on the source, a null source being a source like others."""
    other = groups.withColumnRenamed("_mix_source", "_mix_other")
    return rows.join(other, F.expr("_mix_source <=> _mix_other"), how).drop("_mix_other")


def times_taken(keys: DataFrame, plan: DataFrame) -> DataFrame:
    """``keys`` with the plan's columns and ``times``, how often each row is taken.

    Rows equal in key and content differ in nothing, so when only some of them fit, any of them
    are taken; only those rows are numbered.
    """
    rows = _with_source(keys, plan)
    order = F.expr(
        "CASE WHEN cut_step IS NULL OR _mix_step > cut_step THEN 1 WHEN _mix_step < cut_step THEN -1 "
        "WHEN cut_key IS NULL OR _mix_key > cut_key THEN 1 WHEN _mix_key < cut_key THEN -1 "
        "WHEN _mix_tie > cut_tie THEN 1 WHEN _mix_tie < cut_tie THEN -1 ELSE 0 END"
    )
    rows = rows.withColumn("_mix_order", order)
    clear = rows.filter("_mix_order <> 0").withColumn(
        "times", F.expr("epochs + IF(_mix_order < 0, 1, 0)")
    )
    equal = Window.partitionBy("_mix_source").orderBy("_mix_tie")
    tied = rows.filter("_mix_order = 0").withColumn("_mix_rank", F.row_number().over(equal))
    tied = tied.withColumn("times", F.expr("epochs + IF(_mix_rank <= cut_rows, 1, 0)"))
    return clear.unionByName(tied.drop("_mix_rank")).drop("_mix_order")


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weight: str | None = None,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """The mixed documents, each as often as the mix takes it, with the columns of ``docs``.

    A null text has size 0; a null source is a source; repeated rows are documents of their own.
    Documents of size 0 are taken as their place in the order says. The same input gives the
    same mix again. The texts are shuffled in no step but where rows are equal in all the mix
    looks at; sums per source are built from partial sums.
    """
    clash = {c: free_name(docs, "_own" + c) for c in docs.columns if c in _PLAN_COLUMNS}
    renamed = docs.withColumnsRenamed(clash)
    names = [clash.get(c, c) for c in (doc_id, text, source)]
    rows = keyed(renamed, *names, clash.get(weight, weight), seed)
    chosen = plan(stage(rows.select(*_KEYS), "mix-keys"), max_epochs)
    out = times_taken(rows, chosen).filter("times > 0")
    out = out.withColumn("_mix_again", F.expr("explode(sequence(1, times))"))
    back = {new: old for old, new in clash.items()}
    return out.select(*renamed.columns).withColumnsRenamed(back)


_PLAN_COLUMNS = {
    *_KEYS, "source_size", "target", "epochs", "rest", "cut_step", "cut_key", "cut_tie", "cut_rows",
    "times", "_mix_order", "_mix_rank", "_mix_again", "_mix_quality", "_mix_other",
}


def taken_words(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options
) -> DataFrame:
    """Per document its size, its source's size and target, and the words the mix takes of it."""
    max_epochs = options.pop("max_epochs", MAX_EPOCHS)
    rows = keyed(docs, doc_id, text, source, **options)
    keys = stage(rows.select(F.col(doc_id).alias("doc_id"), *_KEYS), "mix-keys")
    return times_taken(keys, plan(keys, max_epochs)).selectExpr(
        "doc_id",
        "_mix_size AS size",
        "source_size",
        "target",
        "times * _mix_size AS taken",
    )
