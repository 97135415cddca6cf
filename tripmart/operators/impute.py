"""Median imputation: NULLs in each numeric column become that column's
upper median ``sorted(non_null)[floor(n / 2)]``.

The columns of one type are unpivoted to
``(column, value)`` and the exact histogram median runs grouped by column
(see ``operators.percentiles``), so a column is reduced to its distinct
values before any ordering. The result is one small row per column; it is
fetched once (like a fitted model's parameters) and applied with ``coalesce``.
An all-NULL column has no median and stays NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.percentiles import upper_median

c = F.col


def upper_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, median`` (as text, which gives the value back exactly), one row
    per column. Columns of one type are unpivoted together, so every median is
    a value of its column; the input is read once per type."""
    by_type: dict[str, list[str]] = {}
    for x in columns:
        by_type.setdefault(df.schema[x].dataType.simpleString(), []).append(x)
    parts = [upper_median(df.select(*names).unpivot([], names, "column", "value"),
                          ["column"], c("value"), "median")
             .select("column", c("median").cast("string").alias("median"))
             for names in by_type.values()]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def upper_median_row(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row, one column per input column, each holding its upper median in
    the column's own type."""
    m = upper_medians(df, columns)
    pivot = m.groupBy().pivot("column", list(columns)).agg(F.first("median"))
    return pivot.select(*[c(x).cast(df.schema[x].dataType).alias(x) for x in columns])


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict:
    """Column -> upper median (None for an all-NULL column). One aggregate
    job; the driver receives one value per column."""
    row = upper_median_row(df, columns).first()
    return {x: row[x] for x in columns}


def median_fill(df: DataFrame, columns: Sequence[str], medians: dict | None = None) -> DataFrame:
    """Fill NULLs in ``columns`` with their upper medians; other columns unchanged."""
    medians = fit_medians(df, columns) if medians is None else medians
    wanted = set(columns)
    out = []
    for f in df.schema.fields:
        col = c(f"`{f.name}`")
        if f.name in wanted and medians.get(f.name) is not None:
            col = F.coalesce(col, F.lit(medians[f.name]).cast(f.dataType))
        out.append(col.alias(f.name))
    return df.select(*out)

