"""Tables on files: versions, upserts into partitions, compaction, views, audit."""

import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from merchtide.model import AUDIT_DDL
from merchtide.sources import storage, tables
from merchtide.sources.audit import audited


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_replace_keeps_readers_and_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.replace_table(spark.range(5), path) == 5
    reader = tables.read_table(spark, path)
    assert tables.replace_table(spark.range(3).withColumn("x", F.lit(1)), path) == 3
    assert reader.count() == 5
    assert tables.read_table(spark, path).columns == ["id", "x"]
    tables.replace_table(spark.range(1), path)
    assert len(tables.versions(spark, path)) == 2


def test_unfinished_version_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(4), path)
    (tmp_path / "t" / "v00000002").mkdir()
    assert tables.read_table(spark, path).count() == 4


def test_a_repeated_upsert_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    source = spark.createDataFrame([(1, "a")], "k int, v string")
    for _ in range(2):
        assert tables.upsert_table(source, path, ["k"]) == 1
    assert rows_of(tables.read_table(spark, path)) == [(1, "a")]


def test_rows_move_between_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame(
        [(1, "a", 1), (2, "a", 1), (3, "b", 1), (4, "c", 1), (5, None, 1)],
        "k int, part string, v int")
    tables.upsert_table(first, path, ["k"], ["part"])
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "part=c").iterdir()}
    # Row 3 leaves b, which has no other row; row 6 is new; row 5 gets a partition.
    second = spark.createDataFrame(
        [(1, "a", 2), (3, "a", 2), (5, "d", 2), (6, "d", 2)], "k int, part string, v int")
    expected = [(1, "a", 2), (2, "a", 1), (3, "a", 2), (4, "c", 1), (5, "d", 2), (6, "d", 2)]
    for _ in range(2):
        assert tables.upsert_table(second, path, ["k"], ["part"]) == 4
        read = tables.read_table(spark, path).select("k", "part", "v")
        assert rows_of(read) == expected
    assert not (tmp_path / "t" / "part=b").exists()
    assert untouched == {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "part=c").iterdir()}


def test_partition_filter_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).withColumn("hour_key", (F.col("id") % 4).cast("string"))
    tables.write_partitioned(df, path, ["hour_key"])
    read = tables.read_table(spark, path, df.schema)
    newest = read.filter(F.col("hour_key") == read.agg(F.max("hour_key")).scalar())
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour_key" in plan
    assert newest.count() == 25


def test_compaction_keeps_rows_and_sorts_files(spark, tmp_path):
    path = str(tmp_path / "t")
    # Half of the rows share one cluster value.
    df = spark.range(2000).withColumn(
        "sku", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("P"), "id")))
    tables.replace_table(df.repartition(20), path)
    before = rows_of(tables.read_table(spark, path))
    size = storage.total_bytes(spark, tables.current_path(spark, path))
    assert tables.compact_table(spark, path, ["sku"], size // 4) >= 4
    after = tables.read_table(spark, path)
    assert rows_of(after) == before
    sizes = after.groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in sizes) < 1000
    tables.compact_table(spark, path)
    assert rows_of(tables.read_table(spark, path)) == before


def test_new_columns_are_appended(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_rows(spark.range(2), path)
    tables.append_rows(spark.range(2, 3).withColumn("x", F.lit("new")), path)
    got = rows_of(tables.read_table(spark, path, merge=True).select("id", "x"))
    assert got == [(0, None), (1, None), (2, "new")]


def test_view_follows_rewrites(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(4), path)
    tables.publish_view(spark, "followed_view", path, ["id"], "id > 1")
    for n in (6, 9, 5):
        tables.replace_table(spark.range(n).withColumn("x", F.lit(n)), path)
        assert spark.table("followed_view").count() == n - 2
    tables.compact_table(spark, path)
    tables.compact_table(spark, path)
    assert rows_of(spark.table("followed_view")) == [(2,), (3,), (4,)]


def test_newest_partition_comes_from_folder_names(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.newest_partition(spark, path, "k") is None
    df = spark.createDataFrame([(1, "a:1"), (2, "a:2 x"), (3, None)], "v int, k string")
    tables.write_partitioned(df, path, ["k"])
    assert tables.newest_partition(spark, path, "k") == "a:2 x"


def test_view_follows_a_new_publish(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (4, 6):
        tables.replace_table(spark.range(n), path)
        name = tables.publish_view(spark, "tested_view", path, ["id"], "id > 1")
        assert spark.table(name).count() == n - 2


def test_audit_records_failure_and_raises(spark, tmp_path):
    log = str(tmp_path / "log")
    with audited(spark, log, "r", "good", "t") as outcome:
        outcome["row_count"] = 7
    with pytest.raises(ZeroDivisionError), audited(spark, log, "r", "bad", "t"):
        1 / 0  # noqa: B018
    read = spark.read.schema(AUDIT_DDL).parquet(log)
    got = {r.task_name: (r.status, r.row_count, r.message) for r in read.collect()}
    assert got == {"good": ("SUCCESS", 7, None), "bad": ("FAILED", None, "division by zero")}
    assert read.filter(F.col("ended_at") < F.col("started_at")).count() == 0


def test_typed_append_orders_and_fills(spark, tmp_path):
    path = str(tmp_path / "ops")
    rows = spark.createDataFrame([("run", datetime.now(timezone.utc))], "run_id string, ended_at timestamp")
    tables.append_typed(rows, path, AUDIT_DDL)
    read = spark.read.parquet(path)
    assert read.columns == [c.split()[0] for c in AUDIT_DDL.split(", ")]
    assert read.first().status is None


def test_partition_values_stay_text(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "007", 1), (2, "7", 1)], "k int, part string, v int")
    tables.upsert_table(first, path, ["k"], ["part"])
    tables.upsert_table(
        spark.createDataFrame([(1, "007", 2)], "k int, part string, v int"), path, ["k"], ["part"])
    read = tables.read_table(spark, path, partition_by=["part"]).select("k", "part", "v")
    assert rows_of(read) == [(1, "007", 2), (2, "7", 1)]


def test_staged_tables_are_removed(spark):
    with storage.staging(spark):
        kept = storage.stage(spark.range(3), "tested")
        path = kept.inputFiles()[0].rsplit("/", 1)[0]
        assert kept.count() == 3
    assert not storage.exists(spark, path)


def test_cluster_without_shared_folder_is_refused(monkeypatch):
    class Context:
        master = "spark://somewhere"

        def getCheckpointDir(self):  # noqa: N802 - Spark's name
            return None

    class Session:
        sparkContext = Context()  # noqa: N815 - Spark's name
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.scratch_root(Session())


def test_rows_that_pack_well_are_sorted_in_bounded_lots(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    # 4,000 rows of 1,000 equal characters: 4 MB to sort, a few KB on disk; one has no text.
    df = spark.range(4000).withColumn("sku", F.when(F.col("id") > 0, F.repeat(F.lit("x"), 1000))).withColumn(
        "tags", F.array(F.lit("a"), F.lit("b")))
    tables.replace_table(df, path)
    monkeypatch.setattr(tables, "SORT_BYTES", 1 << 20)
    assert tables.compact_table(spark, path, ["sku"]) >= 4
    after = tables.read_table(spark, path)
    assert after.exceptAll(df).count() == 0 and after.count() == 4000
    sizes = after.groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in sizes) < 2000
    tables.replace_table(df.limit(0), path)
    assert tables.compact_table(spark, path, ["sku"]) == 1


def test_published_rows_are_joined_once(spark, monkeypatch):
    from merchtide.queries import QUERIES, load

    load()
    staged, stage = [], storage.stage
    monkeypatch.setattr(storage, "stage", lambda df, label: staged.append(label) or stage(df, label))
    found = QUERIES["src12_published_view"](spark, "/root/testdata/sf0.001")
    assert staged.count("decided") == 1
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_shuffled_for_two_joins_only(data):
    lines = data.transactions._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = [next(n for n, c in enumerate(line) if c.isalpha()) for line in lines if line]
    at = next(n for n, line in enumerate(lines) if "l_linenumber" in line and "Relation" in line)
    joins, level = 0, depth[at]
    for n in range(at, -1, -1):
        if depth[n] < level:
            level = depth[n]
            joins += "Join" in lines[n]
    assert joins == 2


def shuffle_files(spark):
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    return {p.name for d in folders for p in Path(str(d)).rglob("shuffle_*.data")}


def test_a_write_leaves_no_shuffle_behind(spark, tmp_path):
    df = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.max("id").alias("v"))
    spread = df.repartition(3)
    before, setting = shuffle_files(spark), spark.conf.get(storage.SHUFFLES_GO)
    staged = storage.stage(spread, "tested")
    tables.replace_table(spread, str(tmp_path / "a"))
    tables.append_rows(spread, str(tmp_path / "b"))
    tables.write_partitioned(spread, str(tmp_path / "c"), ["k"])
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(storage.SHUFFLES_GO) == setting
    # What was shuffled is made anew where it is asked for again.
    assert rows_of(spread) == rows_of(staged) == rows_of(tables.read_table(spark, str(tmp_path / "a")))


def test_writes_side_by_side_put_the_setting_back(spark, tmp_path):
    setting = spark.conf.get(storage.SHUFFLES_GO)
    with ThreadPoolExecutor(4) as pool:
        counts = list(pool.map(
            lambda n: tables.replace_table(spark.range(50).repartition(2), str(tmp_path / str(n))), range(12)))
    assert counts == [50] * 12 and spark.conf.get(storage.SHUFFLES_GO) == setting


def test_partitions_are_written_in_lots(spark, tmp_path, monkeypatch):
    rows = spark.range(300).select(
        F.col("id").alias("k"), F.when(F.col("id") % 7 > 0, (F.col("id") % 7).cast("string")).alias("part"))
    monkeypatch.setattr(storage, "LOT_BYTES", 500)
    seen, lots = [], storage.lots
    monkeypatch.setattr(storage, "lots", lambda df, by, n: seen.append(n) or lots(df, by, n))
    path = str(tmp_path / "t")
    more = [rows.filter("k % 3 = 1"), rows.filter("k % 3 = 2")]
    assert tables.upsert_table(rows.filter("k % 3 = 0"), path, ["k"], ["part"], more) == 300
    assert rows_of(tables.read_table(spark, path).select("k", F.col("part").cast("string"))) == rows_of(rows)
    # Into the table that is there: every row moves to the partition of its third.
    moved = rows.select("k", (F.col("k") % 3).cast("string").alias("part"))
    assert tables.upsert_table(moved, path, ["k"], ["part"]) == 300
    assert rows_of(tables.read_table(spark, path).select("k", F.col("part").cast("string"))) == rows_of(moved)
    assert len(seen) == 2 and min(seen) > 1
