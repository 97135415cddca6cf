"""Data-quality checks (column tests). Each returns the failing rows as a
DataFrame; ``run_checks`` returns one summary row per check.

* ``not_null``: rows where the column is NULL;
* ``unique``: values held by more than one row (NULL ignored), with counts;
  ``unique_by_sketch``: the same for large keys, without shuffling every value;
* ``accepted_values``: values outside the list (NULL passes), with counts;
* ``relationships``: child rows whose key has no parent (NULL child passes).

All are single-pass aggregates or an anti join; no check collects rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import REFERENCE
from tripmart.operators.duplicates import duplicates

c = F.col
MAX_BROADCAST_ROWS = REFERENCE.broadcast_max_rows


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(c(column).isNull())


def unique(df: DataFrame, column: str, hexadecimal: bool = False) -> DataFrame:
    """``value, row_count`` for each non-NULL value held by more than one row.
    A combinable count: a hot value is pre-counted on every map task.
    ``hexadecimal``: the values are lower-case hex text, which is counted as
    the bytes it stands for (half the bytes to shuffle)."""
    value = F.unhex(c(column)) if hexadecimal else c(column)
    out = (df.where(c(column).isNotNull()).groupBy(value.alias("value"))
           .agg(F.count(F.lit(1)).alias("row_count")).where(c("row_count") > 1))
    return out.withColumn("value", F.lower(F.hex("value"))) if hexadecimal else out


def unique_by_sketch(df: DataFrame, column: str, hexadecimal: bool = False, rows: int | None = None) -> DataFrame:
    """``unique`` for a key that is nearly unique: only the rows that may be
    duplicates are shuffled (``operators.duplicates``). ``rows``: how many there are, if
    known."""
    value = F.unhex(c(column)) if hexadecimal else c(column)
    out = duplicates(df, value, rows)
    return out.withColumn("value", F.lower(F.hex("value"))) if hexadecimal else out


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """``value, row_count`` for each non-NULL value not in ``values``."""
    vals = list(values)
    return (df.where(c(column).isNotNull() & ~c(column).isin(vals))
            .groupBy(c(column).alias("value")).agg(F.count(F.lit(1)).alias("row_count")))


def parent_keys(parent: DataFrame, field: str, alias: str,
                max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                parent_rows: int | None = None) -> DataFrame:
    """Distinct non-NULL parent keys, broadcast when the parent's row count
    (an upper bound of its keys; pass ``parent_rows`` if already known) is
    within the bound; otherwise a shuffle join on the key."""
    keys = parent.select(c(field).alias(alias)).where(c(alias).isNotNull()).distinct()
    n = parent.count() if parent_rows is None else parent_rows
    return F.broadcast(keys) if n <= max_broadcast_rows else keys


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str,
                  max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Child rows whose non-NULL ``column`` has no ``field`` in ``parent``:
    a left anti join against the parent's key set."""
    keys = parent_keys(parent, field, "_parent_key", max_broadcast_rows)
    return (child.where(c(column).isNotNull())
            .join(keys, child[column] == keys["_parent_key"], "left_anti"))


@dataclass(frozen=True)
class Check:
    model: str
    kind: str                 # not_null | unique | accepted_values | relationships
    column: str
    values: tuple = ()
    parent: str | None = None
    field: str | None = None
    hexadecimal: bool = False


def failing(check: Check, models: dict[str, DataFrame]) -> DataFrame:
    df = models[check.model]
    if check.kind == "not_null":
        return not_null(df, check.column)
    if check.kind == "unique":
        return unique(df, check.column, check.hexadecimal)
    if check.kind == "accepted_values":
        return accepted_values(df, check.column, check.values)
    if check.kind == "relationships":
        return relationships(df, check.column, models[check.parent], check.field)
    raise ValueError(f"unknown check {check.kind}")


def failure_count(check: Check, models: dict[str, DataFrame]) -> DataFrame:
    """One row: ``model, check_name, column_name, failures`` (failing rows, or for
    unique/accepted_values the rows carrying a failing value)."""
    f = failing(check, models)
    n = (F.coalesce(F.sum("row_count"), F.lit(0)) if check.kind in ("unique", "accepted_values")
         else F.count(F.lit(1)))
    return f.agg(n.cast("bigint").alias("failures")).select(
        F.lit(check.model).alias("model"), F.lit(check.kind).alias("check_name"),
        F.lit(check.column).alias("column_name"), "failures")


def _model_summary(model: str, checks: Sequence[Check], df: DataFrame,
                   models: dict[str, DataFrame], sizes: dict[str, int]) -> DataFrame:
    """not_null, accepted_values and relationships checks of one model in one
    scan: every check is a failing-row flag, all flags are counted by one
    aggregate, and the one result row is unpivoted. A relationship joins the
    parent's distinct non-NULL keys, so it cannot multiply child rows."""
    joined, flags = df, {}
    for i, ch in enumerate(checks):
        col = c(ch.column)
        if ch.kind == "not_null":
            flags[i] = col.isNull()
        elif ch.kind == "accepted_values":
            flags[i] = col.isNotNull() & ~col.isin(list(ch.values))
        elif ch.kind == "relationships":
            if ch.parent not in sizes:
                sizes[ch.parent] = models[ch.parent].count()
            keys = parent_keys(models[ch.parent], ch.field, f"_k{i}",
                               parent_rows=sizes[ch.parent]).withColumn(f"_ok{i}", F.lit(True))
            joined = joined.join(keys, col == c(f"_k{i}"), "left")
            flags[i] = col.isNotNull() & c(f"_ok{i}").isNull()
        else:
            raise ValueError(f"not a row check: {ch.kind}")
    one = joined.agg(*[F.count_if(f).alias(f"c{i}") for i, f in flags.items()])
    long = one.unpivot([], [f"c{i}" for i in flags], "_idx", "failures")

    def lookup(attr):
        pairs = [x for i in flags for x in (F.lit(f"c{i}"), F.lit(getattr(checks[i], attr)))]
        return F.create_map(*pairs)[c("_idx")]

    return long.select(F.lit(model).alias("model"), lookup("kind").alias("check_name"),
                       lookup("column").alias("column_name"),
                       c("failures").cast("bigint").alias("failures"))


def run_checks(spark: SparkSession, checks: Sequence[Check],
               models: dict[str, DataFrame]) -> DataFrame:
    """All checks as one DataFrame of ``model, check_name, column_name, failures``.

    Per model, the row-level checks share one scan; each ``unique`` check is
    its own combinable count (it needs a shuffle on the column)."""
    by_model: dict[str, list[Check]] = {}
    for ch in checks:
        by_model.setdefault(ch.model, []).append(ch)
    parts, sizes = [], {}
    for model, chs in by_model.items():
        row_checks = [ch for ch in chs if ch.kind != "unique"]
        if row_checks:
            parts.append(_model_summary(model, row_checks, models[model], models, sizes))
        parts += [failure_count(ch, models) for ch in chs if ch.kind == "unique"]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# The suite the reference declares (silver and gold schema files), aimed at
# the real model names so that it runs.
REFERENCE_SUITE = (
    Check("silver_trips", "not_null", "pickup_ts"),
    Check("silver_trips", "not_null", "dropoff_ts"),
    Check("silver_trips", "relationships", "pickup_location_id", parent="zone_lookup",
          field="locationid"),
    Check("silver_trips", "relationships", "dropoff_location_id", parent="zone_lookup",
          field="locationid"),
    Check("dim_service_type", "accepted_values", "service_type", values=("yellow", "green")),
    Check("dim_payment_type", "accepted_values", "payment_type",
          values=("cash", "card", "other/unknown")),
    Check("dim_zone", "unique", "zone_key"),
    Check("dim_zone", "not_null", "zone_key"),
    Check("dim_date", "unique", "date_key"),
    Check("dim_date", "not_null", "date_key"),
    Check("fct_trips", "unique", "trip_key", hexadecimal=True),
    Check("fct_trips", "not_null", "trip_key"),
    Check("fct_trips", "relationships", "pu_zone_key", parent="dim_zone", field="zone_key"),
    Check("fct_trips", "relationships", "do_zone_key", parent="dim_zone", field="zone_key"),
    Check("fct_trips", "relationships", "pickup_date_key", parent="dim_date", field="date_key"),
)
