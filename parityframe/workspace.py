"""Shared scratch space, durable intermediate tables and joins against per-group tables."""

from __future__ import annotations

import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_STAGED: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables, which all executors must share.

    That is ``spark.checkpoint.dir`` of the session, or the folder given to ``setCheckpointDir``.
    Without either it is a folder of the default Hadoop file system. On a cluster that must not
    be a machine's own disk, which the other machines would not see, so that is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    chosen = context._jsc.sc().getCheckpointDir()
    if chosen.isDefined():
        return chosen.get().rstrip("/")
    hadoop = context._jsc.hadoopConfiguration()
    default = context._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(hadoop)
    if default.getScheme() == "file" and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{default.toString().rstrip('/')}/tmp/parityframe/{context.applicationId}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system a path lies in, and the path as its own kind of object."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the shared scratch folder and return a scan of it.

    Cuts the lineage durably (a lost executor costs nothing that was written) and gives the
    optimizer the true size, so that a join against the result is broadcast only when its
    files are below ``spark.sql.autoBroadcastJoinThreshold``, and shuffled otherwise.
    """
    scope = _SCOPE.get()
    return _stored(df, name, _STAGED if scope is None else scope.paths)


def _stored(df: DataFrame, name: str, owner: list[str]) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    owner.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scope:
    """Tables staged within a ``with`` block by this thread, deleted at its end.

    A piece of work that stages many tables for one result runs in a scope and hands the result
    over, so that its scratch files are gone when it is done, also if it fails::

        with Scope(spark) as scope:
            ...
            return scope.hand_over(result)

    Scopes may be nested. What is handed over belongs to the scope around, or to the session.
    Results that were not handed over must not be used after the block.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Scope:
        self.around = _SCOPE.get()
        self.token = _SCOPE.set(self)
        return self

    def hand_over(self, df: DataFrame, name: str = "result") -> DataFrame:
        """Store ``df`` as a table that outlives the scope, and return a scan of it."""
        return _stored(df, name, _STAGED if self.around is None else self.around.paths)

    def __exit__(self, *_) -> None:
        _SCOPE.reset(self.token)
        _delete(self.spark, self.paths)


_SCOPE: ContextVar[Scope | None] = ContextVar("scope", default=None)


def _delete(spark: SparkSession, paths: list[str]) -> int:
    removed = 0
    while paths:
        fs, target = file_system(spark, paths.pop())
        removed += bool(fs.delete(target, True))
    return removed


def release(spark: SparkSession) -> int:
    """Delete the tables this process has staged, when nothing built on them is needed any more.

    Returns how many there were. Other content of the scratch folder is not touched.
    """
    return _delete(spark, _STAGED)


def quoted(name: str) -> str:
    """A column name for use inside SQL text."""
    return "`" + name.replace("`", "``") + "`"


def join_groups(left: DataFrame, right: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Join ``right`` (unique per ``by``) to ``left`` on ``by``, keeping one copy of the keys.

    Keys are compared null-safely, so that a null key is a group like in ``groupBy``. No hint is
    given: the planner broadcasts ``right`` when it knows it to be small, else it shuffles, with
    skewed keys of ``left`` split by adaptive execution.
    """
    renamed = {name: f"_right_{i}" for i, name in enumerate(by)}
    same = " AND ".join(f"{quoted(mine)} <=> {theirs}" for mine, theirs in renamed.items())
    joined = left.join(right.withColumnsRenamed(renamed), F.expr(same), how)
    return joined.drop(*renamed.values())


def attach_groups(rows: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """Put the columns of a one-row-per-group table beside every row of its group.

    Without keys the table is a single row, which is attached as literals; with keys it is
    written first, so that the join is planned on its true size.
    """
    if by:
        return join_groups(rows, stage(groups, "groups"), by)
    only = groups.first()
    return rows.withColumns(
        {f.name: F.lit(only[f.name]).cast(f.dataType) for f in groups.schema.fields}
    )
