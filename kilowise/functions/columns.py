"""Column expressions shared by the jobs; all of them stay inside the JVM."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = dt.date | str

# Name of each peak definition -> (hours, weekdays only).
PEAK_RULES: dict[str, tuple[tuple[int, ...], bool]] = {
    "evening": (tuple(range(17, 22)), False),
    "daytime": (tuple(range(7, 22)), False),
    "weekday_rush": ((7, 8, 17, 18, 19, 20), True),
}

# Price per kWh by region; other or missing regions use the default.
REGION_RATES = {"Auckland": "0.25", "Wellington": "0.23"}
DEFAULT_REGION_RATE = "0.20"

# Nominal voltages and the accepted kWh range of one reading.
VALID_VOLTAGES = (230, 240)
VALID_KWH = (0, 20)


def to_date_value(value: DateLike) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def month_floor(value: DateLike) -> dt.date:
    return to_date_value(value).replace(day=1)


def add_months(value: dt.date, n: int) -> dt.date:
    """Same day n months on, cut to the end of a shorter month."""
    index = value.year * 12 + value.month - 1 + n
    year, month = divmod(index, 12)
    first = dt.date(year, month + 1, 1)
    last = (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
    return first.replace(day=min(value.day, last.day))


def day_of(ts: str | Column) -> Column:
    return F.to_date(ts)


def month_of(ts: str | Column) -> Column:
    return F.trunc(ts, "MM")


def hour_of(ts: str | Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def within(ts: str, start: DateLike | None = None, before: DateLike | None = None) -> Column:
    """start <= ts < before, on the bare column so that the scan can use it."""
    test = F.lit(True)
    if start is not None:
        test = test & (F.col(ts) >= F.lit(to_date_value(start)))
    if before is not None:
        test = test & (F.col(ts) < F.lit(to_date_value(before)))
    return test


def between_midnights(ts: str, start: DateLike | None, end: DateLike | None) -> Column:
    """start 00:00 <= ts <= end 00:00, the bounds of BETWEEN two dates."""
    test = within(ts, start)
    if end is not None:
        test = test & (F.col(ts) <= F.lit(to_date_value(end)))
    return test


def in_month(ts: str, month: DateLike | None) -> Column:
    if month is None:
        return F.lit(True)
    first = month_floor(month)
    return within(ts, first, add_months(first, 1))


def mean_of(total: str | Column, n: str | Column) -> Column:
    """Mean from an exact sum and a count; NULL when nothing was counted."""
    total = F.col(total) if isinstance(total, str) else total
    return F.try_divide(total.cast("double"), n)


def sum_where(test: Column, value: str | Column) -> Column:
    """Sum of the values that pass the test; the others add zero."""
    value = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(test, value).otherwise(0))


def count_where(test: Column) -> Column:
    return F.count_if(test)


def money(value: Column) -> Column:
    """Two decimals, half up; wide enough for the sum of a very large customer."""
    return value.cast("decimal(20,2)")


def temp_band(temp: str | Column) -> Column:
    temp = F.col(temp) if isinstance(temp, str) else temp
    return F.when(temp < 10, "Cold").when(temp.between(10, 20), "Mild").otherwise("Hot")


def degree_band(temp: str | Column) -> Column:
    temp = F.col(temp) if isinstance(temp, str) else temp
    return F.when(temp < 10, "<10°C").when(temp.between(10, 20), "10-20°C").otherwise(">20°C")


# Labels of the temperature ranges, in report order.
TEMPERATURE_RANGES = ("Below 0°C", "0-10°C", "10-20°C", "20-30°C", "Above 30°C")


def temperature_range(temp: str | Column) -> Column:
    """First matching range; a missing temperature falls into the last one."""
    temp = F.col(temp) if isinstance(temp, str) else temp
    below, cool, mild, warm, above = TEMPERATURE_RANGES
    return (
        F.when(temp < 0, below)
        .when(temp <= 10, cool)
        .when(temp <= 20, mild)
        .when(temp <= 30, warm)
        .otherwise(above)
    )


def is_peak(ts: str | Column, rule: str) -> Column:
    hours, weekdays_only = PEAK_RULES[rule]
    test = F.hour(ts).isin(*hours)
    return test & F.dayofweek(ts).between(2, 6) if weekdays_only else test


def is_peak_reading() -> Column:
    return F.col("is_peak_hours")


def lookup(key: str | Column, values: Mapping[str, str], kind: str) -> Column:
    """Constant small map as an expression; NULL for unknown keys."""
    key = F.col(key) if isinstance(key, str) else key
    found = F.lit(None).cast(kind)
    for name, value in values.items():
        found = F.when(key == name, F.lit(value).cast(kind)).otherwise(found)
    return found


def region_rate(
    region: str | Column,
    rates: Mapping[str, str] = REGION_RATES,
    default: str = DEFAULT_REGION_RATE,
) -> Column:
    return F.coalesce(lookup(region, rates, "double"), F.lit(default).cast("double"))


def valid_voltage(voltage: str | Column, allowed: Sequence[int] = VALID_VOLTAGES) -> Column:
    voltage = F.col(voltage) if isinstance(voltage, str) else voltage
    return F.coalesce(voltage.isin(*allowed), F.lit(False))


def valid_kwh(kwh: str | Column, bounds: tuple[int, int] = VALID_KWH) -> Column:
    kwh = F.col(kwh) if isinstance(kwh, str) else kwh
    return F.coalesce(kwh.between(*bounds), F.lit(False))


def mask_email(email: str | Column) -> Column:
    return F.regexp_replace(email, "[^@]+", "****")


def row_key(*columns: str) -> Column:
    """Surrogate key that needs no sequence: a hash of the natural key."""
    return F.xxhash64(*columns)
