"""The questions over the stored star against those over the fact."""

import re
from decimal import Decimal

import pytest

from coldhaul.plans import bi
from coldhaul.plans.star import StarStore
from tests.conftest import values

FACT = ("vehicle_key_sk string, driver_key_sk string, route_key_sk string, start_date_key_sk int, speeding_ticks bigint, "
        "drift_ticks bigint, battery_fault_ticks bigint, engine_fault_ticks bigint, delivery_delay_min double, "
        "loading_lag_min double, fuel_cost_egp decimal(18,4), total_fuel_consumed_l decimal(18,4), "
        "base_cargo_type_fees decimal(12,2), weight_surcharge_fees decimal(18,4)")


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    # a third of the trips are of vehicle 0 and route 0; some keys, delays and fees are null
    def trip(i):
        key = 0 if i % 3 == 0 else i % 7
        return (f"v{key}", None if i % 11 == 0 else f"d{i % 5}", f"r{key}", 20240101 + i % 4, i % 3, i % 2, i % 4, i % 5,
                None if i % 6 == 0 else i * 1.5, float(i), Decimal(i) / 4, Decimal(i) / 8,
                None if i % 13 == 0 else Decimal(100), Decimal(i) / 2)

    fact = spark.createDataFrame([trip(i) for i in range(200)], FACT)
    dims = {"driver": spark.createDataFrame([(f"d{i}", i, f"name {i % 3}") for i in range(5)], "driver_sk string, driver_id bigint, full_name string"),
            "vehicle": spark.createDataFrame([(f"v{i}", i, f"m{i % 2}", 30000.0 * i) for i in range(7)],
                                             "vehicle_sk string, vehicle_id bigint, model string, current_mileage double"),
            "route": spark.createDataFrame([(f"r{i}", f"o{i % 3}", f"t{i % 2}") for i in range(7)],
                                           "route_sk string, origin_governorate string, destination_governorate string")}
    star = StarStore(spark, str(tmp_path_factory.mktemp("star")), "star_test", 4)
    star.write(fact, dims)
    return fact, dims, star


QUESTIONS = {
    "driver": [bi.dangerous_drivers, bi.aggressive_by_name],
    "vehicle": [lambda f, v: bi.risk_list(f, v, 20), bi.mileage_wear, lambda f, v: bi.risk_band(f, 20)],
    "route": [bi.corridors, bi.loading_lag, bi.fuel_cost_by_governorate, bi.net_profit, bi.net_profit_by_corridor],
}


@pytest.mark.parametrize("role", QUESTIONS)
def test_stored_sums_answer_as_the_fact_does(made, role):
    fact, dims, star = made
    for question in QUESTIONS[role]:
        want = values(question(fact, dims[role]))
        assert want and values(question(star.sums(role), star.dim(role))) == want


def test_a_busy_key_has_a_row_per_day(made):
    fact, _, star = made
    assert star.sums("route").where("route_key_sk = 'r0'").count() == 4
    assert star.sums("route").agg({"trips": "sum"}).first()[0] == fact.count()


@pytest.mark.parametrize("role", QUESTIONS)
def test_no_exchange_below_the_join(spark, made, role):
    star = made[2]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        question = {"driver": bi.aggressive_by_name, "vehicle": bi.mileage_wear, "route": bi.net_profit_by_corridor}[role]
        plan = question(star.sums(role), star.dim(role))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Join" in plan and plan.count("Bucketed: true") == 2
    assert not re.search("Exchange", plan[plan.index("Join"):])


def test_another_session_attaches_the_buckets(spark, made):
    fact, dims, star = made
    other = StarStore(spark, star.root, "star_again", 4)
    other.attach()
    assert values(bi.corridors(other.sums("route"), other.dim("route"))) == values(bi.corridors(fact, dims["route"]))
    per_key = other.sums("route").groupBy("route_key_sk").count()
    assert "Exchange" not in per_key._jdf.queryExecution().executedPlan().toString()


def test_an_empty_fact_gives_no_rows(spark, made, tmp_path):
    fact, dims, _ = made
    star = StarStore(spark, str(tmp_path), "star_empty", 2)
    star.write(fact.limit(0), dims)
    assert bi.corridors(star.sums("route"), star.dim("route")).count() == 0
