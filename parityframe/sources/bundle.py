"""Tables that belong together, published at once.

A bundle is a folder. Every build writes its tables into a folder of its own below ``versions``,
which no reader looks at yet, and then adds one small commit file that names the version and its
tables. The commit file with the highest number is the current one; readers list the commits and
follow it. So a build that fails, or is killed, or loses its driver amid the tables leaves the old
bundle as it was, and a reader that has opened a version keeps reading it while the next is built.

    <root>/versions/<version>/<table>.parquet
    <root>/commits/00000007.json

A commit is written under another name first and renamed, which file systems do in one step.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from parityframe.workspace import file_system

_COMMIT = re.compile(r"(\d{8})\.json")


@dataclass(frozen=True)
class Version:
    """A published version: its commit number, folder and tables."""

    number: int
    folder: str
    tables: tuple[str, ...]

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(self.path(table))


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = file_system(spark, f"{root}/commits")
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(found[1]) for name in names if (found := _COMMIT.fullmatch(name)))


def _load(spark: SparkSession, root: str, number: int) -> Version:
    fs, path = file_system(spark, f"{root}/commits/{number:08d}.json")
    source = fs.open(path)
    try:
        utils = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        about = json.loads(utils.toString(source, "UTF-8"))
    finally:
        source.close()
    return Version(number, f"{root}/versions/{about['version']}", tuple(about["tables"]))


def current(spark: SparkSession, root: str) -> Version | None:
    """The published version, or ``None`` if there is none yet."""
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    return _load(spark, root, numbers[-1]) if numbers else None


def publish(tables: dict[str, DataFrame], root: str, write=None) -> Version:
    """Write all tables, then make them the current version in one step.

    The tables are written side by side, as their jobs do not depend on each other. If one fails
    nothing is published and the error is raised; what the others have written stays in a folder
    that no commit names, until :func:`expire`. Of two builds at the same time each publishes
    its whole bundle, the later one is current. ``write`` is called as ``write(df, path)``.
    """
    root = root.rstrip("/")
    spark = next(iter(tables.values())).sparkSession
    version = f"{time.strftime('%Y%m%d-%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:12]}"
    made = Version(0, f"{root}/versions/{version}", tuple(tables))
    write = write or (lambda df, path: df.write.parquet(path))
    with ThreadPoolExecutor(len(tables)) as pool:
        jobs = [pool.submit(write, df, made.path(name)) for name, df in tables.items()]
        for job in jobs:
            job.result()
    number = _commit(spark, root, {"version": version, "tables": list(tables)})
    return Version(number, made.folder, made.tables)


def _commit(spark: SparkSession, root: str, about: dict) -> int:
    fs, draft = file_system(spark, f"{root}/commits/draft-{uuid.uuid4().hex}")
    fs.mkdirs(draft.getParent())
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(about).encode()))
    finally:
        out.close()
    while True:
        number = max(_numbers(spark, root), default=0) + 1
        _, target = file_system(spark, f"{root}/commits/{number:08d}.json")
        if not fs.exists(target) and fs.rename(draft, target):  # else another build was faster
            return number


def expire(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete all but the last ``keep`` versions and what failed builds have left; how many went.

    Not to be called while a build runs, whose folder no commit names yet.
    """
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    kept = {_load(spark, root, n).folder.rsplit("/", 1)[1] for n in numbers[-keep:]}
    removed = 0
    for number in numbers[:-keep]:
        fs, path = file_system(spark, f"{root}/commits/{number:08d}.json")
        fs.delete(path, False)
    fs, folder = file_system(spark, f"{root}/versions")
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        if status.getPath().getName() not in kept:
            removed += bool(fs.delete(status.getPath(), True))
    return removed
