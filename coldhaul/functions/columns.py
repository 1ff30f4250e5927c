"""Scalar column expressions: keys, calendar, money, labels, geography."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Business rates, handling fees and colour ranks.
DIESEL_EGP_PER_L = "18.0"
SURCHARGE_EGP_PER_KG = "2.5"
BASE_FEES = {
    "Deep frozen": 1200,
    "Pharmaceutical": 1000,
    "Frozen": 800,
    "Chilled": 500,
    "Controlled ambient": 300,
}
DEFAULT_FEE = 250
SEVERITY = {"RED": 4, "ORANGE": 3, "YELLOW": 2, "BLUE": 1}
EARTH_RADIUS_KM = 6371.0
MILEAGE_BRACKETS = [(100000, "0-100k"), (250000, "100k-250k")]
MILEAGE_TOP = "250k+"

READING = "decimal(18,6)"  # one sensor reading
AMOUNT = "decimal(18,2)"   # litres, kilometres, kilograms and money after rounding


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(key: Column, values: dict, default) -> Column:
    """A CASE over fixed values; a null or unknown key gives ``default``."""
    branches = None
    for name, value in values.items():
        branches = (F.when if branches is None else branches.when)(key == F.lit(name), F.lit(value))
    return branches.otherwise(F.lit(default))


def surrogate_key(*fields: Column | str) -> Column:
    parts = [F.coalesce(_col(f).cast("string"), F.lit("_null_")) for f in fields]
    return F.md5(F.concat_ws("-", *parts))


def date_key(ts: Column | str) -> Column:
    d = F.to_date(_col(ts))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_parts(day: Column | str) -> dict[str, Column]:
    d = _col(day)
    return {
        "date_sk": date_key(d),
        "full_date": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "day_of_week": F.date_format(d, "EEEE"),
        # the weekend is Friday and Saturday
        "is_weekend": F.dayofweek(d).isin(6, 7),
    }


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Signed fractional minutes from ``start`` to ``end``."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)).cast("double") / F.lit(60e6)


def minute_index(ts: Column | str) -> Column:
    """Whole minutes since 1970-01-01, without any time-zone conversion."""
    t = _col(ts)
    return F.unix_date(F.to_date(t)).cast("bigint") * 1440 + F.hour(t) * 60 + F.minute(t)


def number(c: Column | str, kind: str = "double") -> Column:
    """A text or number as ``kind``; null if it is malformed, out of range or not a number."""
    value = _col(c).try_cast(kind)
    return F.when(~F.isnan(value), value) if kind in ("double", "float") else value


def reading(c: Column | str) -> Column:
    """One sensor reading; null if it is out of range."""
    return _col(c).try_cast(READING)


def amount(c: Column) -> Column:
    """Round half up to two decimals; null if out of range."""
    return F.round(c, 2).try_cast(AMOUNT)


def rounded_ratio(total: Column, count: Column, digits: int) -> Column:
    """``total / count`` rounded half up in decimal, as a double."""
    ratio = (total.cast("double") / count.cast("double")).cast("decimal(28,10)")
    return F.round(ratio, digits).cast("double")


def raw_fuel_cost(litres: Column | str) -> Column:
    return _col(litres).try_cast(AMOUNT) * F.lit(DIESEL_EGP_PER_L).cast("decimal(6,2)")


def raw_surcharge(kg: Column | str) -> Column:
    return _col(kg).try_cast(AMOUNT) * F.lit(SURCHARGE_EGP_PER_KG).cast("decimal(6,2)")


def fuel_cost(litres: Column | str) -> Column:
    return amount(raw_fuel_cost(litres))


def weight_surcharge(kg: Column | str) -> Column:
    return amount(raw_surcharge(kg))


def base_fee(cargo_type: Column | str) -> Column:
    return lookup(_col(cargo_type), BASE_FEES, DEFAULT_FEE).cast(AMOUNT)


def total_trip_cost(litres: Column | str, cargo_type: Column | str, kg: Column | str) -> Column:
    """The unrounded parts are summed and rounded once."""
    return amount(raw_fuel_cost(litres) + base_fee(cargo_type) + raw_surcharge(kg))


def severity_code(colour: Column | str) -> Column:
    return lookup(_col(colour), SEVERITY, 0)


def mileage_bracket(km: Column | str) -> Column:
    value = _col(km)
    (low, low_name), (mid, mid_name) = MILEAGE_BRACKETS
    return F.when(value < low, low_name).when(value < mid, mid_name).otherwise(MILEAGE_TOP)


def distance_bin(km: Column | str, width: int = 50) -> Column:
    return (F.floor(_col(km) / F.lit(width)) * width).cast("double")


def corridor_label(origin: Column | str, destination: Column | str) -> Column:
    return F.concat(_col(origin), F.lit(" -> "), _col(destination))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance between two points given in degrees."""
    phi1, phi2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    half_dlat = (phi2 - phi1) / 2
    half_dlon = F.radians(_col(lon2) - _col(lon1)) / 2
    a = F.pow(F.sin(half_dlat), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_dlon), 2)
    return F.asin(F.sqrt(F.least(a, F.lit(1.0)))) * (2 * EARTH_RADIUS_KM)


def travel_hours(km: Column | str) -> Column:
    """70 km/h plus one hour, never under an hour and a half."""
    hours = F.greatest(F.lit(1.5), _col(km) / 70.0 + 1.0)
    return F.round(hours.cast("decimal(18,8)"), 2).cast("double")


def full_name(first: Column | str, last: Column | str) -> Column:
    """Null when either part is null."""
    return F.concat(_col(first), F.lit(" "), _col(last))


def tolerant_timestamp(text: Column | str) -> Column:
    """The first 19 characters as ``yyyy-MM-dd HH:mm:ss``, else null."""
    head = F.substring(_col(text), 1, 19)
    shaped = head.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")
    return F.when(shaped, head.try_cast("timestamp_ntz"))
