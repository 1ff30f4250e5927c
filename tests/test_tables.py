from datetime import date

import pytest
from conftest import t, values
from pyspark.sql import functions as F

from coldhaul import schemas
from coldhaul.session import scratch_path
from coldhaul.sinks import tables
from coldhaul.sources import files

DAY = date(2024, 3, 2)


def facts(spark, rows):
    return spark.createDataFrame(rows, "k int, v string, d date")


def read(spark, path):
    return values(spark.read.option("mergeSchema", True).parquet(path).select("k", "v", "d"))


BASE = [(1, "a", date(2024, 3, 1)), (2, "b", DAY), (3, "c", DAY)]


def test_merge_moves_updates_and_inserts(spark):
    path = scratch_path(spark, "merge")
    tables.merge_partitions(path, facts(spark, BASE), "k", "d")
    updates = facts(spark, [(1, "A", DAY), (4, "n", date(2024, 3, 3))])
    expected = sorted([(1, "A", DAY), (2, "b", DAY), (3, "c", DAY), (4, "n", date(2024, 3, 3))], key=repr)
    for _ in range(2):
        tables.merge_partitions(path, updates, "k", "d")
        assert read(spark, path) == expected
    tables.merge_partitions(path, updates.where("k = 4").withColumn("extra", F.lit("x")), "k", "d")
    merged = spark.read.option("mergeSchema", True).parquet(path)
    assert values(merged, "k", "extra") == [(1, None), (2, None), (3, None), (4, "x")]


def test_merge_keeps_and_moves_rows_without_a_partition(spark):
    path = scratch_path(spark, "merge-null")
    tables.merge_partitions(path, facts(spark, [*BASE, (7, "x", None), (8, "y", None)]), "k", "d")
    for _ in range(2):
        tables.merge_partitions(path, facts(spark, [(9, "new", None)]), "k", "d")
        assert values(tables.read_partitioned(spark, path, "d"), "k") == [(1,), (2,), (3,), (7,), (8,), (9,)]
    for _ in range(2):
        tables.merge_partitions(path, facts(spark, [(7, "dated", DAY), (8, "dated", DAY), (9, "dated", DAY)]), "k", "d")
        merged = tables.read_partitioned(spark, path, "d")
        assert merged.schema["d"].dataType.typeName() == "date"
        assert values(merged, "k", "v", "d") == sorted(
            [(1, "a", date(2024, 3, 1)), (2, "b", DAY), (3, "c", DAY), *[(k, "dated", DAY) for k in (7, 8, 9)]], key=repr)


def test_a_late_position_moves_nothing(spark):
    status = spark.createDataFrame([(1, 1.0, 2.0, t("10:05"), "RED", "DOOR_OPEN"), (2, 1.0, 2.0, None, "WHITE", "OK")],
                                   "vehicle_id long, lat double, lon double, last_event_time timestamp_ntz, "
                                   "incident_color string, incident_label string")
    latest = spark.createDataFrame([(1, 9.0, 9.0, t("10:00")), (2, 3.0, 3.0, t("10:00")), (3, 4.0, 4.0, None)],
                                   "vehicle_id long, lat double, lon double, event_time timestamp_ntz")
    assert values(tables.upsert_positions(status, latest), "vehicle_id", "lat", "last_event_time", "incident_color") == [
        (1, 1.0, t("10:05"), "RED"), (2, 3.0, t("10:00"), "WHITE"), (3, 4.0, None, "WHITE")]


def test_replace_partition_is_repeatable_and_clears(spark):
    path = scratch_path(spark, "replace")
    facts(spark, BASE).write.partitionBy("d").parquet(path)
    for _ in range(2):
        assert tables.replace_partition(facts(spark, [(9, "z", DAY)]), path, "d", DAY) == 1
        assert read(spark, path) == [(1, "a", date(2024, 3, 1)), (9, "z", DAY)]
    assert tables.replace_partition(facts(spark, []), path, "d", DAY) == 0
    assert read(spark, path) == [(1, "a", date(2024, 3, 1))]


def test_replace_by_key_and_day(spark):
    df = spark.createDataFrame([(1, t("2024-03-02 00:00:00")), (2, t("2024-03-02 23:59:59")),
                                (3, t("2024-03-03 00:00:00")), (4, None)], "k int, ts timestamp_ntz")
    new = df.where("k = 1").withColumn("k", F.lit(9))
    assert values(tables.replace_by_start_date(df, new, "ts", DAY), "k") == [(3,), (4,), (9,)]
    assert tables.replace_by_key(df, df.where("k < 3"), "k").count() == 4
    assert values(tables.insert_if_absent(df, new.unionByName(df), "k"), "k") == [(1,), (2,), (3,), (4,), (9,)]


def test_row_counts_and_audit_copy(spark):
    path = scratch_path(spark, "overwrite")
    assert tables.write_overwrite(facts(spark, BASE), path, audit_path="nowhere://x") == 3
    assert tables.write_staging(facts(spark, BASE), path) == 3
    assert files.scan_parquet(spark, path).count() == 3
    with pytest.raises(FileNotFoundError):
        files.scan_parquet(spark, f"{path}-none")


def test_quiet_day_is_empty(spark):
    schema = schemas.typed(k="int", v="string")
    path = scratch_path(spark, "slices")
    assert files.scan_daily_slice(spark, path, schema, "d", DAY).count() == 0
    facts(spark, BASE).write.partitionBy("d").parquet(path)
    assert values(files.scan_daily_slice(spark, path, schema, "d", DAY), "k", "d") == [(2, DAY), (3, DAY)]
    assert files.scan_daily_slice(spark, path, schema, "d", date(2030, 1, 1)).count() == 0
    out = f"{path}-copy"
    assert tables.copy_partition_forward(spark, path, out, schema, "d", DAY) == 2
    assert tables.copy_partition_forward(spark, path, out, schema, "d", date(2030, 1, 1)) == 0


def test_csv_sources(spark, tmp_path):
    (tmp_path / "depots.csv").write_text(
        'depot_id,address,governorate,lat,lon,vehicles_capacity\n1,"Dock 1, East",Cairo,30,31,040\n')
    df = files.scan_csv_strings(spark, f"{tmp_path}/depots.csv", schemas.RAW["depots"])
    assert values(df, "address", "vehicles_capacity") == [("Dock 1, East", "040")]
    shards = tmp_path / "slow"
    shards.mkdir()
    for v in (3, 12):
        (shards / f"{v}.csv").write_text(f"sensor_id,fuel_amount_l\nS{v},1.5\n")
    out = files.scan_sharded_by_vehicle(spark, str(shards), schemas.strings("sensor_id", "fuel_amount_l"))
    assert values(out, "vehicle_id", "sensor_id") == [(12, "S12"), (3, "S3")]


def test_a_file_per_vehicle(spark, tmp_path):
    rows = [(v, f"S{v}-{i}", "a,b") for v in (3, 12, None) for i in range(4)]
    df = spark.createDataFrame(rows, "v long, sensor_id string, note string").repartition(3)
    path = str(tmp_path / "vehicles")
    assert tables.write_file_per_key(df, path, "v") >= 3
    names = [n for n in files.child_names(spark, path) if not n.startswith(".")]
    assert {"3.csv", "12.csv", "none.csv"} <= set(names) and {n.split("-")[0].split(".")[0] for n in names} == {"3", "12", "none"}
    found = files.scan_sharded_by_vehicle(spark, path, schemas.strings("v", "sensor_id", "note"))
    assert values(found, "vehicle_id", "sensor_id") == sorted([(v, s) for v, s, _ in rows], key=repr)
    assert tables.write_file_per_key(df.limit(0), f"{path}-none", "v") == 0


def test_files_per_key_are_written_by_the_tasks(spark, tmp_path, monkeypatch):
    rows = [(v, f"S{i}", n) for v in ("7", "a/b", "", None) for i, n in enumerate(['say "x"', "a,b", None, "two\nlines"])]
    df = spark.createDataFrame(rows, "v string, sensor_id string, note string")
    df = df.unionByName(spark.range(50).selectExpr("'9' AS v", "concat('S', id) AS sensor_id", "'n' AS note"))
    monkeypatch.setattr(tables, "rename", lambda *a, done=[]: (done.append(a), files.rename(*a), len(done) > 1 and pytest.fail("a rename per file")))
    path = str(tmp_path / "named")
    written = tables.write_file_per_key(df, path, "v", rows_per_file=10)
    names = files.child_names(spark, path)
    assert written == len(names) > 4 and {"7.csv", "a%2Fb.csv", "none.csv", "9.csv", "9-1.csv"} <= set(names)
    plain = str(tmp_path / "plain")
    df.drop("v").write.csv(plain, header=True)
    reader = spark.read.schema("sensor_id string, note string")
    named = spark.read.schema("v string, sensor_id string, note string").csv(path, header=True, multiLine=True).drop("v")
    assert values(named) == values(reader.csv(plain, header=True, multiLine=True))
    with pytest.raises(FileExistsError):
        tables.write_file_per_key(df, path, "v")
    clash = spark.createDataFrame([("3",)] * 30 + [("3-1",)], "v string").selectExpr("v", "uuid() AS u")
    with pytest.raises(FileExistsError):
        tables.write_file_per_key(clash.localCheckpoint(), str(tmp_path / "clash"), "v", rows_per_file=10)


def test_shards_are_listed_once(spark, tmp_path):
    (tmp_path / "3.csv").write_text("sensor_id\nS3\n")
    (tmp_path / "notes.txt").write_text("sensor_id\nS4\n")
    out = files.scan_sharded_by_vehicle(spark, str(tmp_path), schemas.strings("sensor_id"))
    assert values(out, "vehicle_id", "sensor_id") == [(3, "S3")]
    with pytest.raises(FileNotFoundError):
        (tmp_path / "empty").mkdir()
        files.scan_sharded_by_vehicle(spark, f"{tmp_path}/empty", schemas.strings("sensor_id"))
