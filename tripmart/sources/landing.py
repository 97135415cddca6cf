"""Landing sources: the monthly load plan, monthly trip files, the zone CSV
and the generic CSV sample.

The driver only plans (which month files exist); executors read. A month
file that is absent is skipped, so the rows already loaded for it stay.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import SERVICES
from tripmart.functions.columns import month_text

# Text that pandas ``read_csv`` reads as missing by default.
# The zone lookup is read as text and each of these becomes NULL.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Column names the warehouse writer prefixes with "_".
RESERVED_NAMES = ("zone",)

TRIP_FILE = "{service}_tripdata_{month}.parquet"


def _lit_date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return F.lit(d)


def first_month_on_or_after(d: Column) -> Column:
    return F.when(F.dayofmonth(d) == 1, d).otherwise(F.add_months(F.trunc(d, "MM"), 1))


def load_plan_from(bounds: DataFrame, start_col: str = "start_date",
                   end_col: str = "end_date",
                   services: Iterable[str] = SERVICES) -> DataFrame:
    """Every month start in [start, end] x services, one row per bounds row.

    ``year, month, source_month (yyyy-MM), service_type``. Generators, not a
    join: the plan has months x services rows and no more."""
    start = F.col(start_col).cast("date")
    end = F.col(end_col).cast("date")
    first = first_month_on_or_after(start)
    months = F.when(first <= end, F.sequence(first, end, F.expr("interval 1 month")))
    svc = F.array(*[F.lit(s) for s in services])
    return (
        bounds.select(F.explode(months).alias("month_start"))
        .select("month_start", F.explode(svc).alias("service_type"))
        .select(
            F.year("month_start").cast("int").alias("year"),
            F.month("month_start").cast("int").alias("month"),
            month_text("month_start").alias("source_month"),
            "service_type",
        )
    )


def load_plan(spark: SparkSession, start_date="2022-01-01", end_date="2023-12-31",
              services: Iterable[str] = SERVICES) -> DataFrame:
    """The plan for literal dates (defaults as in the reference)."""
    bounds = spark.range(1).select(_lit_date(start_date).alias("start_date"),
                                   _lit_date(end_date).alias("end_date"))
    return load_plan_from(bounds, services=services)


def trip_file_name(service: str, source_month: str) -> str:
    return TRIP_FILE.format(service=service, month=source_month)


TRIP_PATH = r"^(.*/([a-z]+)_tripdata_(\d{4}-\d{2})\.parquet)(/.*)?$"


def available_trip_files(spark: SparkSession, landing_dir: str) -> DataFrame:
    """Month files present under ``landing_dir``: path, service_type, source_month.

    A month is a file ``{service}_tripdata_{yyyy-MM}.parquet`` or a folder of
    that name holding part files (as Spark writes it). Listed with the
    binaryFile source; only ``path`` is selected, so contents are not read."""
    files = (spark.read.format("binaryFile")
             .option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.parquet")
             .load(landing_dir)
             .select("path"))
    return (files.where(F.col("path").rlike(TRIP_PATH))
            .select(F.regexp_extract("path", TRIP_PATH, 1).alias("path"),
                    F.regexp_extract("path", TRIP_PATH, 2).alias("service_type"),
                    F.regexp_extract("path", TRIP_PATH, 3).alias("source_month"))
            .distinct())


def planned_files(spark: SparkSession, plan: DataFrame, landing_dir: str) -> list[tuple[str, str, str]]:
    """(service_type, source_month, path) for each planned month whose file exists.

    The result is bounded by the plan (months x services), not by data."""
    found = available_trip_files(spark, landing_dir)
    rows = (plan.join(found, ["service_type", "source_month"], "inner")
            .select("service_type", "source_month", "path")
            .orderBy("source_month", "service_type")
            .collect())
    return [(r.service_type, r.source_month, r.path) for r in rows]


def planned_fingerprints(spark: SparkSession, plan: DataFrame,
                         landing_dir: str) -> list[tuple[str, str, str, str]]:
    """(service_type, source_month, path, fingerprint) for each planned month whose
    file exists. The fingerprint covers names, sizes and times of the month's files,
    in any order: a month delivered again has another one. Bounded by the plan."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.parquet").load(landing_dir)
             .select("path", "length", "modificationTime").where(F.col("path").rlike(TRIP_PATH)))
    part = F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")
    months = files.groupBy(F.regexp_extract("path", TRIP_PATH, 1).alias("path"),
                           F.regexp_extract("path", TRIP_PATH, 2).alias("service_type"),
                           F.regexp_extract("path", TRIP_PATH, 3).alias("source_month")).agg(
        F.concat_ws(":", F.count(F.lit(1)), F.sum("length"), F.sum(part)).alias("fingerprint"))
    rows = (plan.join(months, ["service_type", "source_month"]).orderBy("source_month", "service_type")
            .select("service_type", "source_month", "path", "fingerprint").collect())
    return [tuple(r) for r in rows]


def lower_case_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name; two names equal after that is an error."""
    lowered = [c.lower() for c in df.columns]
    dupes = sorted({c for c in lowered if lowered.count(c) > 1})
    if dupes:
        raise ValueError(f"columns differ only by case: {dupes}")
    return df.toDF(*lowered)


def alias_reserved(df: DataFrame, reserved: Iterable[str] = RESERVED_NAMES) -> DataFrame:
    """``zone`` becomes ``_zone``, as the warehouse writer aliases reserved words."""
    res = set(reserved)
    return df.toDF(*[f"_{c}" if c in res else c for c in df.columns])


def null_tokens(df: DataFrame, tokens: Iterable[str] = NULL_TOKENS) -> DataFrame:
    """Every string column: the missing-value tokens become NULL."""
    toks = list(tokens)
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.simpleString() == "string":
            c = F.when(c.isin(toks), F.lit(None).cast("string")).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Zone CSV with header, read as text; NULL tokens applied; ``locationid`` bigint."""
    # a small file: line feeds within quotes are worth reading it whole
    raw = (spark.read.option("header", True).option("inferSchema", False).option("escape", '"')
           .option("multiLine", True).csv(path))
    df = null_tokens(raw)
    df = lower_case_columns(df)
    return df.withColumn("locationid", F.col("locationid").cast("bigint"))


def read_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """CSV sample with header. With a schema, the NULL tokens are applied on
    text first and the columns cast afterwards; without one, types are inferred."""
    reader = spark.read.option("header", True).option("escape", '"')
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    from pyspark.sql.types import StructType
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    raw = null_tokens(reader.option("inferSchema", False).csv(path))
    return raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in st.fields])
