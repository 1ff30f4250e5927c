"""What a table's writers keep beside it: declared columns, and the partitions of its keys."""

from datetime import date, timedelta

import pytest
from conftest import values
from pyspark.sql import functions as F
from test_daily import FIRST, RAW, SECOND, landed

from coldhaul import schemas
from coldhaul.plans import daily
from coldhaul.session import scratch_path
from coldhaul.sinks import key_map, schema_log, tables
from coldhaul.sources import files

DAYS = [date(2024, 3, 1) + timedelta(days=n) for n in range(12)]


def facts(spark, rows):
    return spark.createDataFrame(rows, "k int, v string, d date")


def grown(spark):
    path = scratch_path(spark, "grown")
    tables.merge_partitions(path, facts(spark, [(10 * n + i, "old", d) for n, d in enumerate(DAYS) for i in range(3)]), "k", "d")
    return path


def jobs_of(spark, work):
    """The Spark jobs that the work runs."""
    spark.sparkContext.setJobGroup(scratch_path(spark, "group"), "counted")
    group = spark.sparkContext.getLocalProperty("spark.jobGroup.id")
    work()
    return list(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.fixture
def folders_read(monkeypatch):
    """The partition folders that merges name, and the tables that are read whole."""
    named, whole = [], []
    scan, read = files.scan_folders, schema_log.read_table
    for module in (tables, key_map):
        monkeypatch.setattr(module, "scan_folders", lambda spark, path, schema, folders: (
            named.extend(f"{path.rsplit('/', 2)[1]}/{f}" for f in folders), scan(spark, path, schema, folders))[1])
    monkeypatch.setattr(tables, "read_table", lambda spark, path, *typed: (whole.append(path), read(spark, path, *typed))[1])
    return named, whole


def test_a_merge_reads_the_map_and_the_touched_partitions_only(spark, folders_read):
    path = grown(spark)
    named, whole = folders_read
    tables.merge_partitions(path, facts(spark, [(10, "new", DAYS[7]), (999, "new", DAYS[3])]), "k", "d")
    partitions = {n.split("/")[1] for n in named if "/d=" in n}
    # the two days of the updates, and the one where key 10 was
    assert partitions == {f"d={DAYS[1]}", f"d={DAYS[7]}", f"d={DAYS[3]}"} and whole == []
    # of the map, the folders of the two keys
    buckets = {n.rsplit("/", 1)[1] for n in named if "bucket=" in n}
    assert 1 <= len(buckets) <= 2
    found = tables.read_partitioned(spark, path, "d")
    assert values(found.where("v = 'new'"), "k", "d") == [(10, DAYS[7]), (999, DAYS[3])] and found.count() == 37


def test_a_crash_between_map_and_data_loses_and_repeats_nothing(spark, monkeypatch):
    path = grown(spark)
    write = tables.replace_partitions
    monkeypatch.setattr(tables, "replace_partitions", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    moved = facts(spark, [(0, "moved", DAYS[5])])
    with pytest.raises(RuntimeError):
        tables.merge_partitions(path, moved, "k", "d")
    monkeypatch.setattr(tables, "replace_partitions", write)
    # another merge comes first, folds included, and then the lost one again
    monkeypatch.setattr(key_map, "MOST_GENERATIONS", 1)
    for updates, day in ((facts(spark, [(0, "other", DAYS[9])]), DAYS[9]), (moved, DAYS[5])):
        tables.merge_partitions(path, updates, "k", "d")
        found = tables.read_partitioned(spark, path, "d")
        assert values(found.where("k = 0"), "d") == [(day,)] and found.count() == 36


def test_fold_keeps_the_newest_settled_place_and_what_came_since(spark):
    path = scratch_path(spark, "mapped")
    rows = facts(spark, [])
    known = key_map.KeyMap(spark, path, rows.schema["k"], rows.schema["d"])
    known.build(facts(spark, [(1, "", DAYS[0]), (2, "", DAYS[0]), (3, "", None), (None, "", DAYS[0])]))
    known.settle(known.add(facts(spark, [(1, "", DAYS[1])])))
    known.add(facts(spark, [(1, "", DAYS[2]), (2, "", DAYS[2])]))  # never settled
    assert {r.part for r in known.lookup(facts(spark, [(1, "", None)]), list(range(key_map.BUCKETS))).collect()} == set(DAYS[:3])
    known.fold()
    assert values(known.rows(), "key", "part") == sorted(
        [(1, DAYS[1]), (1, DAYS[2]), (2, DAYS[0]), (2, DAYS[2]), (3, None)], key=repr)
    assert len(files.child_names(spark, known.root)) == 1
    known.settle(known.add(facts(spark, [(1, "", DAYS[4]), (3, "", DAYS[4])])))
    known.fold()
    assert values(known.rows(), "key", "part") == sorted(
        [(1, DAYS[4]), (2, DAYS[0]), (2, DAYS[2]), (3, DAYS[4])], key=repr)


def test_other_writers_make_the_map_anew(spark):
    path = grown(spark)
    tables.replace_partition(facts(spark, [(0, "x", None)]), path, "d", DAYS[11])
    tables.merge_partitions(path, facts(spark, [(0, "y", DAYS[0])]), "k", "d")
    assert values(tables.read_partitioned(spark, path, "d").where("k = 0"), "v", "d") == [("y", DAYS[0])]
    assert tables.read_partitions(spark, path, "d", [DAYS[11]]).count() == 0


def test_replaced_keys_go_and_emptied_partitions_are_removed_without_a_job_each(spark):
    path = grown(spark)
    gone = facts(spark, [(10 * n + i, "", None) for n in range(2, 8) for i in range(3)])
    tables.merge_partitions(path, facts(spark, []), "k", "d", replaced=gone)
    found = tables.read_partitioned(spark, path, "d")
    assert found.count() == 18 and {r.d for r in found.select("d").distinct().collect()} == {*DAYS[:2], *DAYS[8:]}
    assert len([n for n in files.child_names(spark, path) if n.startswith("d=")]) == 6

    def emptied(n):
        return len(jobs_of(spark, lambda: tables.replace_partitions(facts(spark, [(1, "a", DAYS[0])]), path, "d", DAYS[:n])))
    assert emptied(12) == emptied(1)


def test_declared_columns(spark):
    path = scratch_path(spark, "declared")
    a = spark.createDataFrame([(1, date(2024, 3, 1))], "k int, d date")
    tables.write_partitioned(a, path, "d")
    tables.replace_partition(spark.createDataFrame([(2, "x")], "k int, note string"), path, "d", DAYS[1])
    assert schema_log.declared(spark, path).simpleString() == "struct<k:int,d:date,note:string>"
    assert len(files.child_names(spark, schema_log.beside(path, "_schemas"))) == 2
    found = []
    assert jobs_of(spark, lambda: found.append(tables.read_partitioned(spark, path, "d"))) == []
    assert values(found[0], "k", "d", "note") == sorted([(1, DAYS[0], None), (2, DAYS[1], "x")], key=repr)
    with pytest.raises(ValueError, match="note is declared as string, not int"):
        tables.replace_partition(spark.createDataFrame([(2, 3)], "k int, note int"), path, "d", DAYS[1])
    # written anew, the table has the new columns only
    tables.write_partitioned(a, path, "d")
    assert tables.read_partitioned(spark, path, "d").columns == ["k", "d"]


def test_a_foreign_table_is_declared_once(spark):
    path = scratch_path(spark, "foreign")
    for n, columns in enumerate(("k int, a string", "k int, b string")):
        spark.createDataFrame([(n, "x")], columns).write.parquet(f"{path}/d={DAYS[n]}")
    first, again = [], []
    assert jobs_of(spark, lambda: first.append(tables.read_partitioned(spark, path, "d")))
    assert not jobs_of(spark, lambda: again.append(tables.read_partitioned(spark, path, "d")))
    assert values(first[0]) == values(again[0]) and sorted(again[0].columns) == ["a", "b", "d", "k"]


def test_two_writers_declare_at_once(spark, monkeypatch):
    path = scratch_path(spark, "raced")
    k, a, b = [spark.createDataFrame([], s).schema for s in ("k int", "k int, a int", "k int, b int")]
    schema_log.declare(spark, path, k)
    write = schema_log.write_text

    def late(spark_, target, text):
        monkeypatch.setattr(schema_log, "write_text", write)
        schema_log.declare(spark, path, b)  # takes the number first
        return write(spark_, target, text)

    monkeypatch.setattr(schema_log, "write_text", late)
    assert schema_log.declare(spark, path, a).names == ["k", "b", "a"] == schema_log.declared(spark, path).names


def test_a_day_reads_the_partitions_it_names(spark, monkeypatch):
    """A third day with one trip and one ping: no partition of trips that ended before it is read, none rewritten."""
    third = SECOND + timedelta(days=1)
    trips = [r for r in RAW["trips"] if r[0] in "12"]
    lake = landed(spark, trips)
    daily.backfill_run(lake, SECOND)
    lake.control.ensure()
    for stage in daily.DAY_STAGES:
        lake.control.rewind(stage, SECOND)
    row = ("9", "1", "1", "1", *["2024-03-03 12:00:00", "2024-03-03 13:00:00"] * 2)
    spark.createDataFrame([row], schemas.RAW["trips"]).write.parquet(f"{lake.path('landing', 'trips')}/dt={third}")
    seen = []
    scan = files.scan_folders

    def spied(spark_, path, schema, folders):
        folders = list(folders)
        seen.extend((path.split("/lake-")[1].split("/", 1)[1], f) for f in folders)
        return scan(spark_, path, schema, folders)

    for module in (tables, files):
        monkeypatch.setattr(module, "scan_folders", spied)
    assert lake.since(third) == third and lake.since(FIRST) == FIRST
    daily.daily_run(lake)
    assert {f for p, f in seen if p == "silver/trips"} == {f"start_date={third}"}
    assert {f for p, f in seen if p.startswith("silver/") and "cargo" not in p and "trips" not in p} <= {f"dt={third}"}
    assert lake.fact().count() == 3


def test_cargo_moves_with_its_trip(spark):
    lake = landed(spark)
    daily.backfill_run(lake, FIRST)
    moved = ("1", "1", "1", "1", *["2024-03-02 01:00:00", "2024-03-02 02:00:00"] * 2)
    spark.createDataFrame([moved], schemas.RAW["trips"]).write.mode("append").parquet(f"{lake.path('landing', 'trips')}/dt={SECOND}")
    spark.createDataFrame([("1", "1", "Delivered")], schemas.RAW["trip_cargo"]).write.mode("append").parquet(
        f"{lake.path('landing', 'trip_cargo')}/dt={SECOND}")
    daily.daily_run(lake)
    cargo = lake.read("silver", "trip_cargo").where("trip_id = 1")
    assert values(cargo, "trip_id", "start_date") == [(1, SECOND)]
    assert values(lake.read("staging", "trip_cargo_agg").where("trip_id = 1"), "start_date") == [(SECOND,)]
    assert lake.fact().where(F.col("trip_id_bk") == 1).count() == 1
