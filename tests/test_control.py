from datetime import date

import pytest
from conftest import values

from coldhaul import schemas
from coldhaul.operators.quality import QualityError
from coldhaul.plans import control, daily
from coldhaul.session import scratch_path

NEXT = date(2025, 5, 9)


@pytest.fixture
def table(spark):
    return control.ControlTable(spark, scratch_path(spark, "control"))


def test_fresh_seed_and_single_advance(table):
    assert {table.target(s) for s in control.STAGES} == {NEXT}
    table.advance("silver", NEXT, 7)
    table.ensure()
    assert table.target("silver") == date(2025, 5, 10)
    assert table.target("bronze") == NEXT
    table.rewind("silver", control.BACKFILL_END)
    assert table.target("silver") == NEXT
    assert table.current().count() == 5


def test_seed_keeps_existing_rows(spark):
    existing = control.seed_rows(spark, date(2024, 1, 1)).where("stage_name = 'silver'")
    seeded = control.checkpoints_seed(existing)
    assert values(control.next_target_date(seeded)) == sorted(
        (s, date(2024, 1, 2) if s == "silver" else NEXT) for s in control.STAGES)
    assert [r.stage_name for r in control.checkpoint_report(seeded).collect()] == sorted(control.STAGES)


def test_unknown_stage_changes_nothing(table):
    table.ensure()
    before = values(table.current())
    table.advance("typo", NEXT, 1)
    table.rewind("typo", NEXT)
    assert values(table.current()) == before
    table.advance("dbt", NEXT, control.UNKNOWN_ROWS)
    assert values(table.current().where("stage_name = 'dbt'"), "last_processed_date", "rows_processed") == [(NEXT, -1)]


def test_failed_stage_keeps_its_date(spark, monkeypatch):
    lake = daily.Lake(spark, scratch_path(spark, "lake"), control.BACKFILL_END)

    def fail(lake, day):
        raise QualityError("broken")

    monkeypatch.setattr(daily, "DAY_STAGES", {"bronze": lambda lake, day: 3, "silver": fail})
    with pytest.raises(QualityError):
        daily.daily_run(lake)
    done = {r.stage_name: r for r in lake.control.current().collect()}
    assert (done["bronze"].last_processed_date, done["bronze"].rows_processed) == (NEXT, 3)
    assert done["silver"].last_processed_date == control.BACKFILL_END


def test_quiet_day_processes_nothing(spark):
    lake = daily.Lake(spark, scratch_path(spark, "lake"), control.BACKFILL_END)
    assert daily.bronze_day(lake, NEXT) == 0
    assert lake.read("bronze", "quick").select("kafka_key").count() == 0
    assert schemas.RAW["trips"].names[0] in lake.read("bronze", "trips").columns
