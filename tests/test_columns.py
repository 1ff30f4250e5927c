from datetime import date
from decimal import Decimal

from conftest import t
from pyspark.sql import functions as F

from coldhaul.functions import columns as c
from coldhaul.operators.joins import decode_routes, encode_route
from coldhaul.plans import gold


def one(spark, **cols):
    return spark.range(1).select(*[v.alias(k) for k, v in cols.items()]).first()


def test_keys(spark):
    r = one(spark, a=c.surrogate_key(F.lit(17)), b=c.surrogate_key(F.lit(None).cast("int")),
            d=c.date_key(F.lit(t("2024-01-05 23:59:59"))))
    assert r.a == "70efdf2ec9b086079795c442636b55fb"
    assert r.b == "68633484e25105c6d6f21d8b4698ba59"
    assert r.d == 20240105


def test_money(spark):
    kind, none = F.lit("Frozen"), F.lit(None).cast("string")
    r = one(spark, fuel=c.fuel_cost(F.lit(10)), fee=c.base_fee(kind), weight=c.weight_surcharge(F.lit(4)),
            total=c.total_trip_cost(F.lit(10), kind, F.lit(4)), default=c.base_fee(none))
    assert tuple(r) == (Decimal("180.00"), Decimal("800.00"), Decimal("10.00"), Decimal("990.00"),
                        Decimal("250.00"))


def test_calendar(spark):
    days = {r.full_date: r for r in gold.dim_date(spark).collect()}
    assert len(days) == 1461
    friday, sunday = days[date(2024, 1, 5)], days[date(2024, 1, 7)]
    assert (friday.date_sk, friday.day_of_week, friday.is_weekend) == (20240105, "Friday", True)
    assert (sunday.day_of_week, sunday.is_weekend, sunday.month_name) == ("Sunday", False, "January")


def test_labels_and_times(spark):
    r = one(spark, low=c.mileage_bracket(F.lit(99999.9)), mid=c.mileage_bracket(F.lit(100000.0)),
            top=c.mileage_bracket(F.lit(250000.0)), bin=c.distance_bin(F.lit(149.9)),
            label=c.corridor_label(F.lit("A"), F.lit("B")), none=c.full_name(F.lit("A"), F.lit(None)),
            late=c.minutes_between(F.lit(t("08:00")), F.lit(t("07:59:30"))),
            short=c.travel_hours(F.lit(1.0)), far=c.travel_hours(F.lit(140.0)),
            km=F.round(c.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)), 2),
            sev=c.severity_code(F.lit("RED")), white=c.severity_code(F.lit("WHITE")))
    assert tuple(r) == ("0-100k", "100k-250k", "250k+", 100.0, "A -> B", None, -0.5, 1.5, 3.0, 20015.09, 4, 0)


def test_tolerant_timestamp(spark):
    texts = ["2024-03-01 08:00:00", "2024-03-01 08:00:00.25", "2024-13-01 08:00:00", "x", None]
    df = spark.createDataFrame([(x,) for x in texts], "s string").select(c.tolerant_timestamp("s").alias("v"))
    assert [r.v for r in df.collect()] == [t("08:00"), t("08:00"), None, None, None]


def test_rounding_is_half_up_in_decimal(spark):
    r = one(spark, a=c.rounded_ratio(F.lit(285), F.lit(1000), 2), b=c.rounded_ratio(F.lit(1), F.lit(8), 2))
    assert tuple(r) == (0.29, 0.13)


def test_route_numbers_cover_every_ordered_pair_once(spark):
    n = 7
    pairs = decode_routes(spark.range(n * (n - 1)).withColumnRenamed("id", "route_id"), n)
    rows = pairs.withColumn("code", encode_route("origin_depot_id", "destination_depot_id", n)).collect()
    assert all(r.code == r.route_id and r.origin_depot_id != r.destination_depot_id for r in rows)
    assert len({(r.origin_depot_id, r.destination_depot_id) for r in rows}) == n * (n - 1)
