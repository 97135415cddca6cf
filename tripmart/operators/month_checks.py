"""Check results of the written fact by month, kept with the star and merged on read.

A full report reads whole tables each time. Here each month of the fact has a state:
how many rows fail each check. States of different months add up, since every check
of ``FACT_CHECKS`` is about single rows, or (unique) about a key that only rows of one
month can share: ``trip_key`` is made of the pickup time, among others.

``refresh_checks`` reads the months whose fact was written anew since their state was
made, in one pass for the row checks and one combinable count for ``unique``. A
relationship is checked again in all months when the keys of its parent have changed.
The states are entries of the star's version: months times checks, whatever the data.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import REFERENCE
from tripmart.operators import checks as K
from tripmart.schemas import star_schema
from tripmart.sources import versioned as V

c = F.col
FACT, STATES = "fct_trips", "checks"
FACT_CHECKS = tuple(ch for ch in K.REFERENCE_SUITE if ch.model == FACT)


def _name(ch: K.Check) -> str:
    return f"{ch.kind}:{ch.column}"


def _parents(spark: SparkSession, path: str, version: V.Version, checks) -> dict[str, str]:
    """A checksum of the keys of each check's parent."""
    out = {}
    for ch in checks:
        if ch.kind == "relationships":
            keys = V.read(spark, path, ch.parent, version, schema=star_schema(ch.parent)).select(ch.field).distinct()
            n, total = keys.agg(F.count(ch.field), F.sum(F.xxhash64(ch.field).cast("decimal(20,0)"))).first()
            out[_name(ch)] = f"{n}:{total}"
    return out


def _failures(spark: SparkSession, path: str, version: V.Version, keys: list[str], checks) -> dict[str, dict[str, int]]:
    """Part of the fact -> check -> failing rows, of the given parts only."""
    if not keys or not checks:
        return {}
    fact = V.read(spark, path, FACT, version, keys=keys, schema=star_schema(FACT))
    month = c("pickup_month").cast("string").alias("month")
    rows, flags = fact, {}
    for i, ch in enumerate(x for x in checks if x.kind != "unique"):
        col = c(ch.column)
        if ch.kind == "not_null":
            flags[_name(ch)] = col.isNull()
        elif ch.kind == "accepted_values":
            flags[_name(ch)] = col.isNotNull() & ~col.isin(list(ch.values))
        else:
            parent = V.read(spark, path, ch.parent, version, schema=star_schema(ch.parent))
            keyed = K.parent_keys(parent, ch.field, f"_k{i}", REFERENCE.broadcast_max_rows,
                                  version.rows(ch.parent)).withColumn(f"_ok{i}", F.lit(True))
            rows = rows.join(keyed, col == c(f"_k{i}"), "left")
            flags[_name(ch)] = col.isNotNull() & c(f"_ok{i}").isNull()
    counted = []
    if flags:
        counted.append(rows.groupBy(month).agg(*[F.count_if(f).alias(k) for k, f in flags.items()]))
    for ch in checks:
        if ch.kind == "unique":
            value = F.unhex(c(ch.column)) if ch.hexadecimal else c(ch.column)
            held = fact.where(c(ch.column).isNotNull()).groupBy(month, value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
            counted.append(held.groupBy("month").agg(
                F.coalesce(F.sum(F.when(c("n") > 1, c("n"))), F.lit(0)).alias(_name(ch))))
    all_counted = functools.reduce(lambda a, b: a.join(b, "month", "full"), counted)
    return {f"{FACT}/pickup_month={r['month']}": {k: r[k] or 0 for k in all_counted.columns[1:]}
            for r in all_counted.collect()}  # one row a month


def refresh_checks(spark: SparkSession, path: str, checks=FACT_CHECKS) -> list[str]:
    """Bring the states of the star at ``path`` up to date; the months that were read."""
    base = V.latest(spark, path)
    fact = base.of(FACT)
    old = {k: s for k, s in base.info.get(STATES, {}).items() if k in fact and s["run"] == fact[k]["run"]}
    parents = _parents(spark, path, base, checks)
    states = {k: {"run": p["run"], "failures": {}, "parents": parents} for k, p in fact.items()}
    todo: dict[tuple[str, ...], list[str]] = {}
    for k in fact:
        had = old.get(k, {"failures": {}, "parents": {}})
        valid = {n: v for n, v in had["failures"].items() if had["parents"].get(n) == parents.get(n)}
        states[k]["failures"] = {_name(ch): valid[_name(ch)] for ch in checks if _name(ch) in valid}
        missing = tuple(_name(ch) for ch in checks if _name(ch) not in valid)
        if missing:
            todo.setdefault(missing, []).append(k)
    for names, keys in todo.items():
        for k, found in _failures(spark, path, base, keys, [ch for ch in checks if _name(ch) in names]).items():
            states[k]["failures"] |= found
    if todo or states.keys() != base.info.get(STATES, {}).keys():
        V.commit(spark, path, base, {}, info={STATES: states})
    return sorted(k.split("=", 1)[1] for keys in todo.values() for k in keys)


def report(spark: SparkSession, path: str, checks=FACT_CHECKS) -> DataFrame:
    """``model, check_name, column_name, failures`` from the states; no data is read.
    States that are older than their month raise."""
    version = V.latest(spark, path)
    states, fact = version.info.get(STATES, {}), version.of(FACT)
    if {k: s["run"] for k, s in states.items()} != {k: p["run"] for k, p in fact.items()}:
        raise ValueError(f"the check states at {path} are older than the fact: refresh_checks brings them up to date")
    rows = [(ch.model, ch.kind, ch.column, sum(s["failures"][_name(ch)] for s in states.values())) for ch in checks]
    return spark.createDataFrame(rows, "model string, check_name string, column_name string, failures long")
