import pytest
from conftest import t, values

from coldhaul import schemas
from coldhaul.operators import audits, quality
from coldhaul.operators.joins import orphans, row_loss
from coldhaul.operators.ordered import dedupe_by_key
from coldhaul.plans import silver


def raw(spark, table, rows):
    return spark.createDataFrame(rows, schemas.RAW[table])


def test_dirty_vehicle_rows(spark):
    out = silver.silver_vehicles(raw(spark, "vehicles", [
        ("1", "  Actros ", "10", "70", "Diesel", "n/a"), ("2", "Axor", "10", "70", "Diesel", "5"),
        ("2", "Axor B", "10", "70", "Diesel", "5")]))
    assert values(out, "vehicle_id", "model", "current_mileage") == [(1, "Actros", None), (2, "Axor", 5.0)]


def test_survivor_does_not_depend_on_order(spark):
    rows = [(1, None, 5), (1, "b", 1), (1, "a", 9), (2, "c", 3), (None, "d", 1), (None, "c", 2)]
    df = spark.createDataFrame(rows, "k int, s string, n int")
    expected = sorted([(1, "a", 9), (2, "c", 3), (None, "c", 2)], key=repr)  # a row with a null loses
    assert values(dedupe_by_key(df, ["k"])) == expected
    assert values(dedupe_by_key(spark.createDataFrame(rows[::-1], df.schema).repartition(3), ["k"])) == expected


def test_trip_key_checks(spark):
    trips = raw(spark, "trips", [
        ("1", "1", "1", "1", *["2024-03-01 08:00:00"] * 4), ("2", "x", "1", "1", *["2024-03-01 08:00:00"] * 4),
        ("3", "1", "9", "1", *["2024-03-01 08:00:00"] * 3, "soon")])
    one = spark.createDataFrame([(1,)], "id bigint")
    dims = [one.withColumnRenamed("id", k) for k in ("vehicle_id", "driver_id", "route_id")]
    out = silver.silver_trips(trips, *dims)
    assert values(out, "trip_id", "actual_end_time") == [(1, t("08:00"))]
    loss = row_loss(silver.typed_trips(trips), dict(zip(("vehicle_id", "driver_id", "route_id"), dims)))
    assert tuple(loss.first()) == (3, 1, 2)
    bridge = raw(spark, "trip_cargo", [("1", "7", " Loaded "), ("1", "8", "x"), ("3", "7", "x")])
    cargo = spark.createDataFrame([(7,)], "cargo_id bigint")
    assert values(silver.silver_trip_cargo(bridge, out, cargo)) == [(1, 7, "Loaded")]


def test_routes_keep_unknown_depots_as_nulls(spark):
    out = silver.silver_routes(raw(spark, "routes", [("1", "0", "5"), ("1", "0", "5")]),
                               raw(spark, "depots", [("0", " Dock, 1", "Cairo", "1", "2", "40")]))
    assert values(out, "route_id", "origin_address", "destination_address") == [(1, "Dock, 1", None)]


def test_audits(spark):
    df = spark.createDataFrame([("a",)] * 2 + [("b",)], "s string")
    assert values(audits.share_by(df, "s")) == [("a", 2, 66.67), ("b", 1, 33.33)]
    bookings = spark.createDataFrame([(1, t("08:00"))] * 3 + [(2, t("08:00"))],
                                     "vehicle_id bigint, scheduled_start_time timestamp_ntz")
    assert audits.double_bookings(bookings).first()[0] == 2


def test_gate(spark):
    dims = {f"dim_{n}s": spark.createDataFrame([("k1", 1), ("k2", 2)], f"{n}_sk string, {n}_id bigint")
            for n in ("vehicle", "driver", "route")}
    schema = "trip_sk string, trip_id_bk bigint, vehicle_key_sk string, driver_key_sk string, route_key_sk string"
    good = spark.createDataFrame([("a", 1, "k1", "k1", "k2"), ("b", 2, "k2", None, "k1")], schema)
    quality.enforce(quality.summary({**dims, "fct_trip_operations": good}))
    bad = good.unionByName(spark.createDataFrame([("a", None, "k9", "k1", "k1")], schema))
    tests = {r.test: r.violations for r in quality.summary({**dims, "fct_trip_operations": bad}).collect()}
    assert {k: v for k, v in tests.items() if v} == {
        "unique_fct_trip_operations_trip_sk": 1, "not_null_fct_trip_operations_trip_id_bk": 1,
        "relationships_fct_trip_operations_vehicle_key_sk": 1}
    assert values(orphans(bad, "driver_key_sk", dims["dim_drivers"], "driver_sk")) == []
    with pytest.raises(quality.QualityError):
        quality.enforce(quality.summary({**dims, "fct_trip_operations": bad}))


def test_the_gate_reads_each_table_once(spark, tmp_path):
    columns = {**quality.KEYS, quality.FACT: [*quality.KEYS[quality.FACT], *quality.REFERENCES]}
    models = {}
    for name, keys in columns.items():
        path = str(tmp_path / name)
        rows = [tuple(f"{k}{i}" if k.endswith("sk") else i for k in keys) for i in (1, 2, None)]
        schema = ", ".join(f"{k} {'string' if k.endswith('sk') else 'bigint'}" for k in keys)
        spark.createDataFrame(rows[:2], schema).write.parquet(path)
        models[name] = spark.read.schema(schema).parquet(path)
    tests = quality.summary(models)
    found = {r.test: r.violations for r in tests.collect()}
    plan = tests._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Scan parquet") == len(columns) == 4
    assert len(found) == 2 * 8 + 3 and {t: n for t, n in found.items() if n} == {
        f"relationships_{quality.FACT}_{c}": 2 for c in quality.REFERENCES}
    empty = quality.summary({n: df.limit(0) for n, df in models.items()})
    assert {r.violations for r in empty.collect()} == {0} and empty.count() == len(found)
