from __future__ import annotations

import gzip
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pytest
from pyspark.sql import functions as F

from parityframe import constants as C
from parityframe import workspace
from parityframe.operators import refine
from parityframe.operators.inequality import inequality_table
from parityframe.operators.quantiles import quintile_table
from parityframe.operators.stats import income_stats
from parityframe.plans import stages
from parityframe.plans.catalog import QUERIES
from parityframe.plans.persons import TIE_BREAK, persons
from parityframe.sources import bundle, ingest
from parityframe.workspace import attach_groups, scratch_root, stage
from tests.conftest import SF

HEADER = ",".join(name for name, _ in C.PERSON_COLUMNS)
LINES = [
    "76,2010,1,1,2.5,1,2.5,30,1,1,100,1,100,1,100,500,400",
    "484,2010,2,1,1,1,1,40,2,2,200,2,200,2,200,,300",
    "76,2010,1,2,1,1,x,25,1,1,100,1,100,1,100,9999999,",
]


@pytest.fixture()
def csv_file(tmp_path):
    path = tmp_path / "people.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n")
    return str(path)


def test_explicit_schema(spark, csv_file):
    rows = ingest.read_persons_csv(spark, csv_file).orderBy("COUNTRY", "SERIAL").collect()
    assert [r["INCTOT"] for r in rows] == [500.0, 9999999.0, None]
    assert rows[1]["PERWT"] is None and rows[1]["INCEARN"] is None
    assert dict(ingest.read_persons_csv(spark, csv_file).dtypes) == dict(C.PERSON_COLUMNS)


def test_inferred_schema_and_gzip(spark, csv_file, tmp_path):
    assert dict(ingest.read_persons_csv(spark, csv_file, infer=True).dtypes)["PERWT"] == "string"
    packed = str(tmp_path / "people.csv.gz")
    with open(csv_file, "rb") as source, gzip.open(packed, "wb") as out:
        out.write(source.read())
    df = ingest.read_persons_csv(spark, packed)
    assert df.count() == 3
    assert "REBALANCE_PARTITIONS" in plan_of(df)
    assert "REBALANCE_PARTITIONS" not in plan_of(ingest.read_persons_csv(spark, packed, spread=False))
    assert "REBALANCE_PARTITIONS" not in plan_of(ingest.read_persons_csv(spark, csv_file))


def test_gzip_is_spread_by_size(spark, tmp_path):
    packed = str(tmp_path / "many.csv.gz")
    columns = [name for name, _ in C.PERSON_COLUMNS]
    with gzip.open(packed, "wt") as out:
        out.write(",".join(columns) + "\n")
        for k in range(30_000):
            out.write(",".join(str((k * 7919 + i) % 100_003) for i in range(len(columns))) + "\n")
    keys = "advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize", "coalescePartitions.parallelismFirst"
    before = {k: spark.conf.get(f"spark.sql.adaptive.{k}") for k in keys}
    written = {}
    for size in ("20kb", "1gb"):
        for k, value in zip(keys, (size, "20kb", "false")):
            spark.conf.set(f"spark.sql.adaptive.{k}", value)
        ingest.write_table(ingest.read_persons_csv(spark, packed), str(tmp_path / size))
        written[size] = len(list((tmp_path / size).glob("part-*")))
        assert spark.read.parquet(str(tmp_path / size)).count() == 30_000
    for k, value in before.items():
        spark.conf.set(f"spark.sql.adaptive.{k}", value)
    assert written["1gb"] < 4 < written["20kb"]


def test_ensure_bronze(spark, csv_file, tmp_path):
    target = str(tmp_path / "bronze")
    assert ingest.ensure_bronze(spark, str(tmp_path / "absent.csv"), target) is None
    first = ingest.ensure_bronze(spark, csv_file, target)
    stamp = first.agg(F.max("_ingested_at")).first()[0]
    again = ingest.ensure_bronze(spark, csv_file, target)
    assert again.agg(F.max("_ingested_at")).first()[0] == stamp
    assert again.select("_source_file", "_layer").distinct().collect() == [(csv_file, "bronze")]


def test_half_written_table_is_not_reused(spark, csv_file, tmp_path):
    target = tmp_path / "bronze"
    (target / "_temporary").mkdir(parents=True)
    (target / "part-0.parquet").write_bytes(b"")
    assert ingest.ensure_bronze(spark, csv_file, str(target)).count() == 3


def test_partition_preview_reads_one_folder(spark, tmp_path):
    root = str(tmp_path / "t")
    ingest.write_table(persons(spark, SF), root, ["COUNTRY", "YEAR"])
    df = ingest.partition_preview(spark, root, 76, 1996, n=10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(COUNTRY" in plan and "TakeOrderedAndProject" in plan
    rows = df.collect()
    assert len(rows) == 10 and {(r["COUNTRY"], r["YEAR"]) for r in rows} == {(76, 1996)}


def test_single_csv_file(spark, tmp_path):
    out = tmp_path / "csv"
    ingest.write_csv(spark.range(1000).repartition(5), str(out), single_file=True)
    files = list(out.glob("part-*.csv"))
    assert len(files) == 1 and files[0].read_text().startswith("id\n")


def test_all_stages(spark, tmp_path):
    source = str(tmp_path / "raw")
    columns = [name for name, _ in C.PERSON_COLUMNS]
    persons(spark, SF).select(*columns).write.option("header", True).csv(source)
    made = stages.run(spark, source, str(tmp_path / "out"))
    tables = made.tables
    assert list(tables) == C.GOLD_TABLES
    raw = spark.read.option("header", True).csv(source).count()
    bronze, silver = made.rows
    assert (bronze.layer, bronze.rows_in, bronze.rows_out) == ("bronze", raw, raw)
    assert (silver.layer, silver.rows_in) == ("silver", raw)
    assert silver.rows_out == spark.read.parquet(str(tmp_path / "out/silver")).count() < raw
    assert all("country_name" in df.columns for df in tables.values())
    n = tables["gold_gini_by_year"].agg(F.sum("n_obs")).first()[0]
    stored = spark.read.parquet(str(tmp_path / "out/silver"))
    assert n == stored.count() == silver.rows_out > 0
    for name in C.GOLD_TABLES[3:]:
        assert tables[name].agg(F.sum("raw_count")).first()[0] == n
    shares = tables["gold_quintile_by_year"].groupBy("country", "year")
    sums = shares.agg(F.sum("income_share").alias("s")).collect()
    assert [r["s"] for r in sums] == pytest.approx([1] * len(sums))
    for name, single in (
        ("gold_gini_by_year", inequality_table),
        ("gold_quintile_by_year", quintile_table),
        ("gold_theil_by_year", income_stats),
    ):
        alone = single(spark.read.parquet(str(tmp_path / "out/silver"))).toPandas()
        together = tables[name].toPandas()[alone.columns]
        keys = [c for c in together.columns if c.lower() in ("country", "year", "quantile")]
        pd.testing.assert_frame_equal(
            together.sort_values(keys, ignore_index=True),
            alone.sort_values(keys, ignore_index=True),
            check_exact=False,
            rtol=1e-9,
        )
    assert spark.sql("SELECT count(*) FROM gold_demog_age").first()[0] > 0
    assert stages.run(spark, str(tmp_path / "none"), str(tmp_path / "other")) is None
    again = stages.run(spark, source, str(tmp_path / "out"))
    assert again.rows[0].rows_in is None and again.rows[1] == silver
    assert bundle.current(spark, str(tmp_path / "out/gold")).number == 2


def test_sample_file(spark, csv_file, tmp_path):
    stages.extract_sample(spark, csv_file, str(tmp_path / "sample"), {76: 1.0})
    df = spark.read.option("header", True).csv(str(tmp_path / "sample"))
    assert {r["COUNTRY"] for r in df.collect()} == {"76"} and df.count() == 2


def test_incomplete_bundle_is_refused(spark, tmp_path):
    assert ingest.load_gold(spark, str(tmp_path)) is None
    bundle.publish({"gold_gini_by_year": spark.range(3)}, str(tmp_path))
    assert ingest.load_gold(spark, str(tmp_path)) is None


def numbered(spark, root):
    version = bundle.current(spark, root)
    return {t: {r[0] for r in version.read(spark, t).collect()} for t in version.tables}


def test_bundle_is_published_at_once(spark, tmp_path):
    root = str(tmp_path / "b")
    assert bundle.current(spark, root) is None
    names = [f"t{k}" for k in range(7)]
    first = bundle.publish({t: spark.range(1).withColumn("id", F.lit(1)) for t in names}, root)
    assert first.number == 1 and numbered(spark, root) == {t: {1} for t in names}
    opened = first.read(spark, "t6")

    second = {t: spark.range(1).withColumn("id", F.lit(2)) for t in names}
    done = []

    def killed_after_four(df, path):
        if len(done) >= 4:
            raise RuntimeError("killed")
        done.append(path)
        df.write.parquet(path)

    with pytest.raises(RuntimeError):
        bundle.publish(second, root, write=killed_after_four)
    assert len(done) >= 4 and numbered(spark, root) == {t: {1} for t in names}
    assert bundle.publish(second, root).number == 2
    assert numbered(spark, root) == {t: {2} for t in names}
    assert opened.first()[0] == 1  # a reader keeps the version it has opened
    (tmp_path / "b/commits/draft-0").write_text("half a comm")
    assert bundle.current(spark, root).number == 2
    assert bundle.expire(spark, root, keep=1) == 2  # the first version and the failed build
    assert numbered(spark, root) == {t: {2} for t in names}


def test_builds_side_by_side_each_publish_a_whole_bundle(spark, tmp_path):
    root = str(tmp_path / "b")

    def build(k):
        return bundle.publish({t: spark.range(1).withColumn("id", F.lit(k)) for t in "xyz"}, root)

    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(build, range(4)))
    assert sorted(v.number for v in versions) == [1, 2, 3, 4]
    assert len(set(map(frozenset, numbered(spark, root).values()))) == 1


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_clustered_table_needs_no_exchange(spark, tmp_path):
    path = str(tmp_path / "clustered")
    people = persons(spark, SF)
    stored = ingest.write_clustered(people, path, ["SERIAL", "PERNUM"], 4)
    for table in (stored, None):
        if table is None:  # as in a session that did not write it
            spark.sql(f"DROP TABLE {ingest._clustered_name(path)}")
            table = ingest.read_clustered(spark, path, ["SERIAL", "PERNUM"], 4)
        kept = refine.deduplicate(table, ["SERIAL", "PERNUM"], TIE_BREAK)
        assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
        want = refine.deduplicate(people, ["SERIAL", "PERNUM"], TIE_BREAK)
        assert kept.exceptAll(want.select(*kept.columns)).isEmpty() and kept.count() == want.count()
    assert "Exchange" in plan_of(refine.deduplicate(stored, ["SERIAL"], TIE_BREAK))


def test_buckets_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(ingest, "BUCKET_BYTES", 64 << 10, raising=False)
    kept = QUERIES["dedup_clustered"](spark, SF)
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.rdd.getNumPartitions() > 8  # one task per bucket
    want = QUERIES["dedup"](spark, SF)
    assert kept.exceptAll(want.select(*kept.columns)).isEmpty() and kept.count() == want.count()
    rows = persons(spark, SF)
    n = ingest.fitting_buckets(rows)
    assert abs(ingest.fitting_buckets(rows.unionAll(rows)) - 2 * n) <= 1 < n
    wide = rows.withColumn("a b.c", F.repeat(F.lit("é"), 500)).withColumn("l", F.array("`a b.c`"))
    assert ingest.fitting_buckets(wide) > rows.count() * 2000 / ingest.BUCKET_BYTES
    nulls = spark.range(10).select(F.lit(None).cast("string").alias("s"))
    assert ingest.fitting_buckets(nulls) == ingest.fitting_buckets(rows.limit(0)) == 8


def test_counted_write(spark, tmp_path):
    rows = spark.range(1000).withColumn("k", F.col("id") % 3)
    assert ingest.write_counted(rows.filter("id < 990"), str(tmp_path / "a"), ["k"]) == 990
    assert ingest.write_counted(rows.limit(0), str(tmp_path / "b")) == 0


def test_stage_uses_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert scratch_root(spark) == configured.rstrip("/")
    df = stage(spark.range(5).withColumn("x", F.lit(None).cast("string")))
    assert df.count() == 5 and df.columns == ["id", "x"]


def test_attach_groups_keeps_null_keys(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2)], "g string, v int")
    groups = spark.createDataFrame([("a", 10), (None, 20)], "g string, t int")
    got = attach_groups(rows, groups, ["g"]).orderBy("v").collect()
    assert [(r["v"], r["t"]) for r in got] == [(1, 10), (2, 20)]
    single = attach_groups(rows.select("v"), groups.agg(F.sum("t").alias("t")), [])
    assert {r["t"] for r in single.collect()} == {30}


def test_rebalanced_partitions_have_few_files(spark, tmp_path):
    df = persons(spark, SF).repartition(16)
    for name, rebalance in (("plain", False), ("even", True)):
        ingest.write_table(df, str(tmp_path / name), ["COUNTRY"], rebalance)
    files = {n: len(list((tmp_path / n).glob("*/*.parquet"))) for n in ("plain", "even")}
    assert files == {"plain": 48, "even": 3}
    even = spark.read.parquet(str(tmp_path / "even"))
    assert even.count() == df.count()


def test_release_deletes_only_what_was_staged(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(workspace, "_STAGED", [])
    monkeypatch.setattr(workspace, "scratch_root", lambda _: str(tmp_path))
    (tmp_path / "other").mkdir()
    workspace.stage(spark.range(3))
    assert len(list(tmp_path.iterdir())) == 2
    assert workspace.release(spark) == 1
    assert [p.name for p in tmp_path.iterdir()] == ["other"]


def test_scopes_delete_what_they_staged(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(workspace, "scratch_root", lambda _: str(tmp_path))
    monkeypatch.setattr(workspace, "_STAGED", [])

    def names():
        return sorted(p.name.split("-")[0] for p in tmp_path.iterdir())

    with workspace.Scope(spark) as outer:
        stage(spark.range(3), "one")
        with workspace.Scope(spark) as inner:
            kept = inner.hand_over(stage(spark.range(4), "two"), "kept")
            assert names() == ["kept", "one", "two"]
        assert names() == ["kept", "one"] and kept.count() == 4
        last = outer.hand_over(kept, "last")
    assert names() == ["last"] and last.count() == 4
    with pytest.raises(ValueError), workspace.Scope(spark):
        stage(spark.range(3), "one")
        raise ValueError
    assert names() == ["last"]
    with ThreadPoolExecutor(1) as pool, workspace.Scope(spark):
        pool.submit(stage, spark.range(2), "aside").result()
    assert names() == ["aside", "last"] and workspace.release(spark) == 2


def test_partitioned_ingest(spark, csv_file, tmp_path):
    target = str(tmp_path / "bronze")
    ingest.ensure_bronze(spark, csv_file, target, ["COUNTRY", "YEAR"])
    df = ingest.partition_preview(spark, target, 484, 2010)
    assert [r["INCEARN"] for r in df.collect()] == [300.0]
