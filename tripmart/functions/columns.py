"""Column expressions shared by the layers. All are built-in Spark functions,
so they stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"
MONEY_SUM = "decimal(28,2)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trip_key(service_type, pickup_ts, dropoff_ts, pu_location, do_location) -> Column:
    """md5 of the five columns concatenated with no delimiter (NULLs skipped).

    Like the reference this is not collision-free: locations (1, 23) and
    (12, 3) give the same text. Uniqueness is a check, not an assumption."""
    parts = [_c(x).cast("string") for x in (service_type, pickup_ts, dropoff_ts,
                                              pu_location, do_location)]
    return F.md5(F.concat_ws("", *parts))


def date_key(d) -> Column:
    """``yyyymmdd`` as int, by arithmetic instead of text formatting."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_day_of_week(d) -> Column:
    """Monday 1 .. Sunday 7 (``dayofweek`` would give Sunday 1)."""
    return (F.weekday(_c(d)) + 1).cast("int")


def duration_micros(start, end) -> Column:
    """Wall-clock difference of two ``timestamp_ntz`` values in microseconds.

    NTZ subtraction gives an interval without any time zone; ``timestamp_diff``
    would go through the session zone and be off when an end falls in a
    daylight-saving gap."""
    seconds = (_c(end) - _c(start)).cast("interval second").cast("decimal(24,6)")
    return (seconds * 1_000_000).cast("bigint")


def minutes_between(start, end) -> Column:
    return duration_micros(start, end).cast("double") / 60_000_000.0


def hours_between(start, end) -> Column:
    return duration_micros(start, end).cast("double") / 3_600_000_000.0


def safe_ratio(num, den) -> Column:
    """num / den in double; NULL when den is 0 or NULL (never raises in ANSI)."""
    return _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))


def tip_pct_exact(tip="tip_amount", fare="fare_amount") -> Column:
    """Mean of tip/fare times 100; zero fares are left out of the mean."""
    return F.avg(safe_ratio(tip, fare)) * 100.0


def tip_pct(tip="tip_amount", fare="fare_amount") -> Column:
    return round6(tip_pct_exact(tip, fare))


def money_sum(c) -> Column:
    return F.sum(_c(c)).cast(MONEY_SUM)


def round6(c) -> Column:
    return F.round(_c(c).cast("double"), 6)


def month_start(d) -> Column:
    return F.trunc(_c(d), "MM")


def month_text(d) -> Column:
    """``yyyy-MM``, the form of ``source_month``."""
    return F.date_format(_c(d), "yyyy-MM")


def partition_suffix(d) -> Column:
    """``yyyy_MM``, the suffix of a monthly fact partition."""
    return F.date_format(_c(d), "yyyy_MM")


def nulls_large_desc(c) -> Column:
    """Descending with NULL first: NULL sorts as the largest value."""
    return _c(c).desc_nulls_first()


def nulls_large_asc(c) -> Column:
    return _c(c).asc_nulls_last()
