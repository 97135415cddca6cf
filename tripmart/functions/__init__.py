"""Scalar column expressions (surrogate keys, calendar parts, durations, ratios)."""

from tripmart.functions.columns import (  # noqa: F401
    MONEY,
    MONEY_SUM,
    date_key,
    duration_micros,
    hours_between,
    iso_day_of_week,
    minutes_between,
    money_sum,
    month_start,
    month_text,
    nulls_large_asc,
    nulls_large_desc,
    partition_suffix,
    round6,
    safe_ratio,
    tip_pct,
    trip_key,
)
