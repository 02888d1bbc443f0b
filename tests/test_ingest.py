"""CSV drops into bronze and silver, in batches and as a stream."""

import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from merchtide import model
from merchtide.operators.columns import cast_to_schema
from merchtide.plans import gold, layers, silver
from merchtide.plans.layers import Lake
from merchtide.queries.layers import RUN_AT, SILVER_SPECS, drop_csv, source_rows
from merchtide.sources import bronze, files, storage, tables
from merchtide.streaming import ingest

HEADER = "SKU,Product_Name,Scheduled_Restock_Timestamp,Restock_Units,Status\n"


def drop(root, name, body, source="restock_schedule"):
    folder = root / "raw" / source
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(HEADER + body, encoding="utf-8")


FIRST = (
    'P1,"Ring, small",2024-02-01 00:00:00,10,Planned\n'
    'P2,"two\nlines ""quoted""",2024-02-01 00:00:00,many,Planned\n'
)
SECOND = "P1,Ring,2024-02-01 00:00:00,12.0,Done\nP3,Rod,2024-02-02 00:00:00,5,Planned\n"


def test_awkward_csv_values(spark, tmp_path):
    drop(tmp_path, "a.csv", FIRST)
    rows = files.read_source(spark, str(tmp_path / "raw"), model.RESTOCK, multi_line=True)
    typed = cast_to_schema(files.with_lineage(rows, "restock_schedule"), model.RESTOCK)
    got = {r.sku: r for r in typed.collect()}
    assert got["P1"].product_name == "Ring, small"
    assert got["P2"].product_name == 'two\nlines "quoted"'
    assert (got["P1"].restock_units, got["P2"].restock_units) == (10, None)
    assert got["P1"]._input_file_name.endswith("a.csv")


def test_file_comes_before_folder(spark, tmp_path):
    drop(tmp_path, "a.csv", FIRST)
    (tmp_path / "raw" / "restock_schedule.csv").write_text(HEADER + SECOND)
    rows = files.read_source(spark, str(tmp_path / "raw"), model.RESTOCK)
    assert {r[0] for r in rows.collect()} == {"P1", "P3"}


def test_other_header_is_refused(spark, tmp_path):
    drop(tmp_path, "a.csv", FIRST)
    (tmp_path / "raw" / "restock_schedule" / "b.csv").write_text(
        "Status,SKU,Product_Name,Scheduled_Restock_Timestamp,Restock_Units\nDone,P1,Ring,x,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_source(spark, str(tmp_path / "raw"), model.RESTOCK).collect()


def test_stream_takes_each_file_once(spark, tmp_path):
    lake = Lake(str(tmp_path))
    spec = model.RESTOCK

    def run():
        layers.ingest_incremental(spark, lake, [spec], multi_line=True)
        ingest.upsert_new_rows(
            spark, lake.layer("bronze"), lake.layer("silver"), lake.layer("ops"),
            lake.layer("checkpoints"), spec)
        bronze = tables.read_table(spark, lake.table("bronze", f"raw_{spec.source}"))
        silver = layers.read_silver(spark, lake, spec)
        return bronze.count(), {r.sku: (r.status, r.restock_units) for r in silver.collect()}

    drop(tmp_path, "a.csv", FIRST)
    assert run() == (2, {"P1": ("Planned", 10), "P2": ("Planned", None)})
    drop(tmp_path, "b.csv", SECOND)
    expected = (4, {"P1": ("Done", 12), "P2": ("Planned", None), "P3": ("Planned", 5)})
    assert run() == expected
    assert run() == expected


def test_stream_keeps_rows_that_do_not_fit(spark, tmp_path):
    lake = Lake(str(tmp_path))
    drop(tmp_path, "a.csv", SECOND + "P9,Rod,2024-02-02 00:00:00,5,Planned,extra\n")
    target = ingest.ingest_new_files(
        spark, lake.layer("raw"), lake.layer("bronze"), lake.layer("checkpoints"), model.RESTOCK)
    rows = tables.read_table(spark, target)
    assert rows.count() == 3
    bad = rows.filter(F.col(ingest.CORRUPT).isNotNull()).collect()
    assert [r[ingest.CORRUPT] for r in bad] == ["P9,Rod,2024-02-02 00:00:00,5,Planned,extra"]


def drop_plain(root, name, text, source="restock_schedule"):
    folder = root / "raw" / source
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def test_columns_are_tracked_over_drops(spark, tmp_path):
    lake, spec = Lake(str(tmp_path)), model.RESTOCK
    target, schemas = lake.table("bronze", f"raw_{spec.source}"), ingest.schema_path(lake.layer("checkpoints"), spec)

    def run(run_id):
        layers.ingest_incremental(spark, lake, [spec], run_id=run_id)
        rows = bronze.read_bronze(spark, target, spec, schemas, typed=True)
        return {r.sku: r for r in rows.collect()}, dict(bronze.record(spark, schemas))

    drop_plain(tmp_path, "a.csv", "SKU,Product_Name,Restock_Units,Status\nP1,Ring,10,\n")
    rows, known = run("a")
    assert known == {"sku": "string", "product_name": "string", "restock_units": "bigint", "status": None}
    # Another order, a new column, a wider type; a file with its own columns in the same run; an empty one.
    drop_plain(tmp_path, "b.csv", "\ufeffRestock Units,Due On,SKU\n1.5,2024-02-01,P2\n")
    drop_plain(tmp_path, "c.csv", 'SKU,"Zip, code",Due-On\nP3,0123,2024-02-01 10:00:00\nP4,1,2024-02-02 10:00:00,x\n')
    drop_plain(tmp_path, "d.csv", "")
    rows, known = run("b")
    assert known["restock_units"] == "double" and known["due_on"] == "timestamp" and known["zip,_code"] == "string"
    assert (rows["P1"].restock_units, rows["P1"].due_on, rows["P2"].restock_units) == (10.0, None, 1.5)
    assert rows["P3"].due_on == datetime(2024, 2, 1, 10) and rows["P3"]["zip,_code"] == "0123"
    assert rows["P2"].product_name is None and rows["P4"][files.CORRUPT] == "P4,1,2024-02-02 10:00:00,x"
    before = spark.read.parquet(schemas).agg(F.max("version")).first()[0]
    assert run("c") == (rows, known)
    assert spark.read.parquet(schemas).agg(F.max("version")).first()[0] == before
    log = tables.read_table(spark, lake.table("ops", "etl_audit_log"))
    assert {r.run_id: r.row_count for r in log.collect()} == {"a": 1, "b": 3, "c": 0}


@pytest.mark.parametrize("old, new, common", [
    ("bigint", "double", "double"), ("date", "timestamp", "timestamp"), (None, "date", "date"),
    ("boolean", None, "boolean"), ("bigint", "date", "string"), ("string", "bigint", "string"), (None, None, None)])
def test_types_widen(old, new, common):
    assert bronze.widened(old, new) == bronze.widened(new, old) == common


def test_a_drop_that_is_complete_is_not_written_again(spark, tmp_path):
    target, schemas = str(tmp_path / "raw_x"), str(tmp_path / "schemas")
    rows = spark.createDataFrame(
        [("1", "x", None, "f")], "a string, _source_name string, _ingested_at timestamp, _input_file_name string")
    for _ in range(2):
        assert bronze.write_drop(rows, target, schemas, "run-1") == 1
    assert bronze.drops(spark, target) == ["run-1"] and spark.read.parquet(target).count() == 1
    # A folder without its mark is a drop that broke off: it is written again.
    (tmp_path / "raw_x" / f"{bronze.DROP}=run-1" / "_SUCCESS").unlink()
    assert bronze.drops(spark, target) == []
    assert bronze.write_drop(rows.union(rows), target, schemas, "run-1") == 2
    assert spark.read.parquet(target).count() == 2


def test_silver_reads_new_drops_only(spark, tmp_path):
    lake, spec = Lake(str(tmp_path)), model.RESTOCK
    drop(tmp_path, "a.csv", SECOND)
    layers.ingest_incremental(spark, lake, [spec], run_id="a")
    assert layers.build_silver(spark, lake, [spec], "a") == {spec.target: 2}
    # The first drop's files are unreadable from here on.
    for file in (tmp_path / "bronze").rglob("part-*"):
        file.write_bytes(b"broken")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    assert layers.build_silver(spark, lake, [spec], "b") == {spec.target: 0}
    drop(tmp_path, "b.csv", "P1,Ring,2024-02-01 00:00:00,9,Late\nP5,Rod,2024-02-02 00:00:00,1,Planned\n")
    layers.ingest_incremental(spark, lake, [spec], run_id="c")
    assert layers.build_silver(spark, lake, [spec], "c") == {spec.target: 2}
    silver = {r.sku: r.status for r in layers.read_silver(spark, lake, spec).collect()}
    assert silver == {"P1": "Late", "P3": "Planned", "P5": "Planned"}


def test_no_batch_is_lost_after_a_new_checkpoint(spark, tmp_path):
    lake, spec = Lake(str(tmp_path)), model.RESTOCK
    for n, body in enumerate((SECOND, "P7,Rod,2024-02-02 00:00:00,5,Planned\n,No key,2024-02-02 00:00:00,5,Planned\n")):
        drop(tmp_path, f"{n}.csv", body)
        layers.ingest_incremental(spark, lake, [spec])
        # Each time with a checkpoint of its own, so both batches have the number 0.
        ingest.upsert_new_rows(
            spark, lake.layer("bronze"), lake.layer("silver"), lake.layer("ops"), str(tmp_path / f"cp{n}"), spec)
    assert {r.sku for r in layers.read_silver(spark, lake, spec).collect()} == {"P1", "P3", "P7"}
    assert tables.read_table(spark, lake.table("ops", "quarantine")).count() == 1


def test_misfits_stay_out_of_silver(spark, tmp_path):
    spec = model.RESTOCK
    body = SECOND + "P9,Rod\n" + ",Rod,2024-02-02 00:00:00,5,Planned\n"
    seen = []
    for kind in ("batch", "stream"):
        lake = Lake(str(tmp_path / kind))
        drop(tmp_path / kind, "a.csv", body)
        staged = len(storage._staged())
        if kind == "batch":
            layers.ingest_batch(spark, lake, [spec])
            for _ in range(2):
                layers.build_silver(spark, lake, [spec], "run")
        else:
            layers.ingest_incremental(spark, lake, [spec])
            ingest.upsert_new_rows(
                spark, lake.layer("bronze"), lake.layer("silver"), lake.layer("ops"),
                lake.layer("checkpoints"), spec)
        assert len(storage._staged()) == staged
        silver = layers.read_silver(spark, lake, spec)
        assert {r.sku for r in silver.collect()} == {"P1", "P3"}
        bad = tables.read_table(spark, lake.table("ops", "quarantine"))
        assert sorted(r.reason for r in bad.collect()) == ["columns", "key"]
        log = tables.read_table(spark, lake.table("ops", "etl_audit_log"))
        assert log.filter("message = '2 rows in quarantine'").count() > 0
        seen.append(sorted(silver.columns))
    assert seen[0] == seen[1]


def test_builds_at_once_keep_their_staged_tables(spark):
    def build(n):
        with storage.staging(spark):
            rows = storage.stage(spark.range(n), "side")
            time.sleep(1)
            return rows.count()

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(build, (3, 5))) == [3, 5]


def test_failed_source_is_audited(spark, tmp_path):
    lake = Lake(str(tmp_path))
    with pytest.raises(Exception, match="(?i)path"):
        layers.ingest_batch(spark, lake, [model.RESTOCK], "run")
    log = tables.read_table(spark, lake.table("ops", "etl_audit_log")).first()
    assert (log.status, log.task_name) == ("FAILED", "ingest_bronze_batch")


def test_drops_to_gold(spark, data, tmp_path):
    lake = Lake(str(tmp_path))
    for spec in SILVER_SPECS:
        drop_csv(source_rows(data, spec), f"{lake.layer('raw')}/{spec.source}")
    layers.ingest_batch(spark, lake, SILVER_SPECS, "run")
    first = layers.build_silver(spark, lake, SILVER_SPECS, "run")
    # The same drops again: bronze doubles, silver keeps one row per key.
    layers.ingest_batch(spark, lake, SILVER_SPECS, "again")
    assert layers.build_silver(spark, lake, SILVER_SPECS, "again") == first
    silver = layers.read_silver(spark, lake, model.MARKETING)
    assert silver.count() == data.marketing.count()
    # All drops at once hold every key twice.
    assert layers.build_silver(spark, lake, SILVER_SPECS, "full", full=True) == first
    checks = tables.read_table(spark, lake.table("ops", "data_quality_results"))
    failed = checks.filter("rule_status = 'FAIL' and rule_name like 'unique_key%' and run_id = 'full'")
    assert {r.table_name for r in failed.collect()} == {s.target for s in SILVER_SPECS}
    counts = gold.build_gold(spark, lake, run_at=RUN_AT, view="vw_tested_low_stock")
    assert counts["main_dashboard_kpis"] == 1
    assert counts["recommended_actions_current_hour"] == 5
    pushed = tables.read_table(spark, lake.table("gold", "product_pushnow_current"))
    direct = gold.prioritized(
        gold.push_now(data.marketing, data.stock, data.product, clock=data.clock))
    names = ["priority_rank", "sku", "decision", "stock_cover_hrs"]
    assert sorted(map(tuple, pushed.select(*names).collect())) == sorted(
        map(tuple, direct.select(*names).collect()))
    low = pushed.filter("stock_cover_hrs < 12").count()
    assert spark.table("vw_tested_low_stock").count() == low
    report = layers.maintain(spark, lake, [model.PRODUCT], gold.GOLD_TABLES)
    assert set(report.values()) == {"1 files"}


def test_gold_scans_one_hour_of_the_facts(spark, data, tmp_path):
    lake = Lake(str(tmp_path))
    for spec in SILVER_SPECS:
        drop_csv(source_rows(data, spec), f"{lake.layer('raw')}/{spec.source}")
    layers.ingest_batch(spark, lake, SILVER_SPECS, "run")
    layers.build_silver(spark, lake, SILVER_SPECS, "run")
    # Only the newest hour's files can be read: the build opens no others, not for footers either.
    newest = data.marketing.agg(F.max("hour_key")).first()[0]
    for spec in (model.MARKETING, model.STOCK):
        for file in (tmp_path / "silver" / spec.target).rglob("part-*"):
            if file.parent.name != f"hour_key={newest}":
                file.write_bytes(b"broken")
                (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    counts = gold.build_gold(spark, lake, run_at=RUN_AT)
    assert counts["main_dashboard_kpis"] == 1 and counts["product_pushnow_current"] > 0
    assert dict(layers.read_silver(spark, lake, model.MARKETING).dtypes)["hour_key"] == "string"


def test_looks_of_values(spark):
    looks = {
        "12": bronze.BIGINT, "-0": bronze.BIGINT, "9" * 18: bronze.BIGINT, "9" * 19: bronze.DOUBLE,
        "-" + "9" * 19: bronze.DOUBLE, "007": bronze.TEXT, ".5": bronze.DOUBLE, "-.5e3": bronze.DOUBLE,
        "1-URGENT": bronze.TEXT, "1234-5": bronze.TEXT, "-": bronze.TEXT, "": bronze.TEXT, "e5": bronze.TEXT,
        "NaN": bronze.TEXT, "2024-02-03": bronze.DATE, "2024-02-30": bronze.TEXT, "2024-02-03 ": bronze.TEXT,
        "2024-02-03T10:00": bronze.TIMESTAMP, "2024-02-03 25:00:00": bronze.TEXT, "tRUE": bronze.BOOLEAN,
        "False": bronze.BOOLEAN, "falsey": bronze.TEXT, "Tin": bronze.TEXT, "İ": bronze.TEXT, None: 0}
    rows = spark.createDataFrame([(v,) for v in looks], "v string")
    assert {r[0]: r[1] for r in rows.select("v", bronze._look(F.col("v"))).collect()} == looks
    # Text is told by its first character, before any pattern.
    assert "ascii(v)" in str(bronze._look(F.col("v")))


def test_a_row_that_does_not_fit_has_no_look(spark):
    rows = spark.createDataFrame([("x", "x,1,2"), (None, None), ("7", None)], f"v string, {files.CORRUPT} string")
    assert tuple(rows.agg(*bronze._seen(["v"])).first()) == (3, bronze.BIGINT)
    assert not rows.limit(1).where(f"{files.CORRUPT} is not null").agg(*bronze._seen(["v"])).first()["look0"]


def test_silver_is_loaded_in_lots_of_keys(spark, tmp_path, monkeypatch):
    spec = model.RESTOCK
    rows = "".join(
        f"P{n % 40},Ring {n},2024-02-0{1 + n % 3} 00:00:00,{n},Planned\n" for n in range(200)) + ",none,,1,Planned\n"
    loaded, keep = [], silver.keep_newest
    monkeypatch.setattr(silver, "keep_newest", lambda *a: loaded.append(1) or keep(*a))
    found = []
    for name, most in (("whole", 1 << 30), ("lots", 1 << 10)):
        monkeypatch.setattr(storage, "LOT_BYTES", most)
        lake = Lake(str(tmp_path / name))
        drop(tmp_path / name, "a.csv", rows)
        layers.ingest_batch(spark, lake, [spec], run_id="a")
        del loaded[:]
        assert layers.build_silver(spark, lake, [spec], run_id="a") == {spec.target: 120}
        assert len(loaded) == 1 if name == "whole" else len(loaded) > 2
        read = layers.read_silver(spark, lake, spec)
        # One stamp for all lots of a load.
        assert read.select(model.STAMP_COLUMN).distinct().count() == 1
        found.append(sorted(map(tuple, read.select(*spec.columns).collect())))
    assert found[0] == found[1] and len(found[0]) == 120


def test_packed_drops_are_the_same_rows(spark, tmp_path):
    rows = spark.createDataFrame(
        [("P1", 'a "b", c', 1), ("P2", None, 2)], "sku string, product_name string, restock_units int")
    got = []
    for packed in (False, True):
        folder = tmp_path / str(packed)
        drop_csv(rows, f"file://{folder}/raw/restock_schedule", packed)
        names = {p.suffix for p in (folder / "raw" / "restock_schedule").glob("part-*")}
        assert names == {".gz" if packed else ".csv"}
        lake = Lake(str(folder))
        layers.ingest_batch(spark, lake, [model.RESTOCK], run_id="a")
        bronze_rows = bronze.read_bronze(spark, lake.table("bronze", "raw_restock_schedule"), model.RESTOCK)
        got.append(sorted(map(tuple, bronze_rows.select("sku", "product_name", "restock_units").collect())))
    assert got[0] == got[1] == [("P1", 'a "b", c', "1"), ("P2", None, "2")]


def test_the_lake_of_the_whole_builds_is_packed(spark, data, monkeypatch):
    """The lake that flow03 and flow12 are built in: raw files packed, rows those of the test tables."""
    from merchtide.queries import layers as built

    specs = (model.PRODUCT, model.RESTOCK)
    monkeypatch.setattr(built, "SILVER_SPECS", specs)
    lake = built.silver_lake(data)
    for spec in specs:
        raw = lake.table("raw", spec.source)
        names = [n for n in storage.child_names(spark, raw) if n.startswith("part-")]
        assert names and all(n.endswith(".csv.gz") for n in names)
        assert layers.read_silver(spark, lake, spec).count() == source_rows(data, spec).count()
