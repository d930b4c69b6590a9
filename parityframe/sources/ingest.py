"""Reading raw person records and previews of stored layers."""

from __future__ import annotations

import hashlib
import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parityframe import constants as C
from parityframe.functions.labels import country_label
from parityframe.operators.refine import add_lineage
from parityframe.sources import bundle
from parityframe.workspace import file_system, quoted

logger = logging.getLogger(__name__)

#: Bytes of rows, as they are sorted, that one bucket of a clustered table is to hold.
BUCKET_BYTES = 256 << 20


def read_persons_csv(
    spark: SparkSession,
    path: str,
    infer: bool = False,
    schema: str = C.PERSON_SCHEMA,
    spread: bool | None = None,
) -> DataFrame:
    """Person records from CSV with a header; empty or malformed fields become NULL.

    Compression is told by the suffix. A gzip file is read by one task whatever its size, and
    plain text is split by Spark. With ``spread`` the rows are dealt out again after reading, in
    partitions of even size whose number adaptive execution takes from the bytes that were read,
    so that what follows is not bound to one task per file; left out, that is done if a file name
    says that the file cannot be split.
    """
    reader = spark.read.option("header", True).option("nullValue", "")
    reader = reader.option("inferSchema", True) if infer else reader.schema(schema)
    df = reader.csv(path)
    if spread is None:
        spread = any(name.endswith((".gz", ".deflate")) for name in df.inputFiles())
    return df.hint("rebalance") if spread else df


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return bool(fs.exists(target))


def is_written(spark: SparkSession, path: str) -> bool:
    """True for a table whose write was committed; a half-written folder does not count."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def ensure_bronze(
    spark: SparkSession, source: str, target: str, partition_by: list[str] = ()
) -> DataFrame | None:
    """The stored raw table; ingested from CSV first if it is not there yet.

    Without table and source there is nothing to do: logged, and ``None`` is returned.
    """
    if not is_written(spark, target):
        if not path_exists(spark, source):
            logger.error("source file not found: %s", source)
            return None
        raw = add_lineage(read_persons_csv(spark, source), source)
        write_table(raw, target, partition_by, rebalance=True)
    return spark.read.parquet(target)


def write_table(
    df: DataFrame, path: str, partition_by: list[str] = (), rebalance: bool = True
) -> None:
    """Overwrite a Parquet table, optionally in one folder per partition value.

    Every task writes a file per partition value it holds, which for many mixed tasks, as after a
    scan, are far too many. So ``rebalance`` brings the rows of a partition together first, in
    files of even size: large partitions are split, small ones share a task.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *[F.col(name) for name in partition_by])
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_counted(df: DataFrame, path: str, partition_by: list[str] = ()) -> int:
    """:func:`write_table`, and how many rows were written: counted by the write itself."""
    seen = Observation()
    write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, partition_by)
    return seen.get["rows"]


def fitting_buckets(df: DataFrame, least: int = 8) -> int:
    """How many buckets :func:`write_clustered` needs so that one holds ``BUCKET_BYTES`` of rows.

    A task sorts a whole bucket, so their number must grow with the table. Rows are counted and
    the columns of variable length measured, in a pass of its own: what is dear to compute should
    be stored first. Keys with very many copies make their bucket larger than the others. Fewer
    than ``least`` buckets would leave tasks idle.
    """
    sizes = [F.lit(8 * (len(df.columns) + 4))]
    for field in df.schema.fields:
        value = F.col(quoted(field.name))
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0)))
        elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(value), F.lit(0)))
    total = df.agg(F.sum(sum(sizes[1:], sizes[0]).cast("bigint"))).first()[0] or 0
    return max(least, -(-total // BUCKET_BYTES))


def write_clustered(df: DataFrame, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write a table whose rows are dealt to ``buckets`` files by ``keys``, and return a scan of it.

    What groups, ranks or joins by ``keys`` (or by more columns) then reads the table without an
    exchange. The rows are shuffled once, here. Each key is in one bucket: choose as many buckets
    as keep one within what a task can sort, as :func:`fitting_buckets` does.
    """
    spark = df.sparkSession
    name = _clustered_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    dealt = df.repartition(buckets, *[F.col(k) for k in keys])
    writer = dealt.write.format("parquet").mode("overwrite").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return spark.table(name)


def read_clustered(
    spark: SparkSession, path: str, keys: list[str], buckets: int, schema: str | None = None
) -> DataFrame:
    """A scan of a table that :func:`write_clustered` made, also in another session.

    ``keys`` and ``buckets`` are those it was written with. They and the schema are kept in the
    session's catalog only, so that they are stated again.
    """
    name = _clustered_name(path)
    if not spark.catalog.tableExists(name):
        columns = schema or spark.read.parquet(path).schema.toDDL()
        by = ", ".join(map(quoted, keys))
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (path '{path}') "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS"
        )
    return spark.table(name)


def _clustered_name(path: str) -> str:
    return "clustered_" + hashlib.sha256(path.rstrip("/").encode()).hexdigest()[:24]


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header; ``single_file`` is for small results, as one task writes it all.

    The rows are made by as many tasks as ever and only meet in the one that writes.
    """
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def partition_preview(
    spark: SparkSession,
    root: str,
    country: int,
    year: int,
    order_by: list[str] = ("SERIAL", "PERNUM"),
    n: int = 100,
) -> DataFrame:
    """First rows of one partition of a table stored by country and year.

    Only that folder is listed and read; the partition columns come back from its name.
    """
    part = spark.read.parquet(root).where((F.col("COUNTRY") == country) & (F.col("YEAR") == year))
    return part.orderBy(*order_by).limit(n)


def layer_preview(df: DataFrame, order_by: list[str], n: int = 100) -> DataFrame:
    """First rows in a stated order, so that the preview is reproducible."""
    return df.orderBy(*order_by).limit(n)


def load_gold(spark: SparkSession, root: str, tables: list[str] = C.GOLD_TABLES) -> dict | None:
    """All aggregate tables of the published version by name, or ``None`` if one is missing.

    Every table gets the country name beside its code, and a temporary view of its name.
    """
    version = bundle.current(spark, root)
    missing = [t for t in tables if version is None or t not in version.tables]
    if missing:
        logger.error("aggregate tables missing: %s", missing)
        return None
    loaded = {}
    for name in tables:
        df = version.read(spark, name)
        loaded[name] = df.withColumn("country_name", country_label("COUNTRY"))
        loaded[name].createOrReplaceTempView(name)
    return loaded
