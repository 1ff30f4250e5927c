"""Queries against their SQL twins: a cross-section by default, all with COLDHAUL_ALL=1."""

import os

import pytest

from checks.compare import connect, differences
from checks.oracle import oracle_sql
from coldhaul.catalog import queries

SF_DIR = "/root/testdata/sf0.001"
SOME = ["asof_trip_match", "trip_telemetry_agg", "silver_trips", "silver_trip_cargo", "dedupe_by_key",
        "fct_trip_operations", "dim_date", "q1_1_dangerous_drivers", "q2_2_mileage_wear", "q5_2_net_profit",
        "incident_feed", "refresh_colours", "resequence_ids", "status_distribution", "row_loss_report", "dq_gate",
        "merge_fact", "stream_static_asof", "fuel_drop_state", "advance_checkpoint", "daily_pipeline", "backfill_pipeline", "lag_fuel"]
NAMES = sorted(queries()) if os.environ.get("COLDHAUL_ALL") else SOME


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_equals_twin(spark, duck, name):
    assert differences(spark, duck, name, SF_DIR) == []
