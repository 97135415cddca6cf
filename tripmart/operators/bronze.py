"""Bronze: landing rows -> typed raw tables, one per service plus the zone lookup.

A month is the unit of load. The bronze table is partitioned by
``service_type, source_month`` and written with dynamic partition overwrite,
so loading a month again replaces exactly that month, an empty or missing
month leaves old rows untouched, and all months load in one Spark job
(no per-month delete, no driver loop over data).
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, NullType, StringType, StructType

from tripmart.config import INT_REPAIR_COLUMNS, SERVICES
from tripmart.sources import landing as L
from tripmart.sources import tables as T
from tripmart.sources import versioned as V

BRONZE_PARTITIONS = ("service_type", "source_month")
# What Spark's errors say of a file that is absent or no Parquet file.
UNREADABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "is not a Parquet file",
              "FileNotFoundException")
# What they say of files that disagree on the type of a column.
MERGE_FAILS = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE", "FAILED_MERGE_FIELDS",
               "Failed to merge", "CANNOT_READ_FILE_FOOTER", "Could not read footer", "FAILED_READ_FILE")
INGEST_COLUMNS = ("ingest_ts", "source_month", "service_type")


def utc_now():
    """Current time as a UTC wall-clock ``timestamp_ntz``, whatever the session zone."""
    return F.convert_timezone(None, F.lit("UTC"), F.current_timestamp())


def with_ingest_columns(df: DataFrame, service_type: str,
                        source_month: str | None = None) -> DataFrame:
    """Append ``ingest_ts, source_month, service_type``. With ``source_month``
    None the frame already carries it (one column per landing month file)."""
    month = F.col("source_month") if source_month is None else F.lit(source_month)
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in INGEST_COLUMNS]
    return df.select(*keep, utc_now().alias("ingest_ts"), month.alias("source_month"),
                     F.lit(service_type).alias("service_type"))


def repair_int_columns(df: DataFrame, columns: Iterable[str] = INT_REPAIR_COLUMNS) -> DataFrame:
    """Integer codes that arrive as float become ``bigint``, and NaN NULL.

    A value with a fraction is an error raised by the executor that meets it;
    it is never truncated."""
    wanted = set(columns)
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in wanted:
            if f.dataType.typeName() in ("double", "float", "decimal"):
                if f.dataType.typeName() != "decimal":
                    c = F.when(~F.isnan(c), c)  # a missing code may arrive as NaN
                frac = c.isNotNull() & (c != F.floor(c))
                c = F.when(frac, F.raise_error(F.concat(
                    F.lit(f"fractional value in integer column {f.name}: "),
                    c.cast("string")))).otherwise(c.cast("bigint"))
            else:
                c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def to_bronze_trips(landing_df: DataFrame, service_type: str,
                    source_month: str | None = None) -> DataFrame:
    """Landing rows of one service -> bronze rows (ingest columns, lower-case
    names, integer repair), in the order the reference applies them."""
    df = with_ingest_columns(landing_df, service_type, source_month)
    df = L.lower_case_columns(df)
    return repair_int_columns(df)


def to_bronze_zones(landing_df: DataFrame) -> DataFrame:
    """Zone lookup -> bronze: constants ``static``/``lookup``, lower-case, ``_zone``."""
    df = with_ingest_columns(landing_df, "lookup", "static")
    df = L.lower_case_columns(df)
    df = L.alias_reserved(df)
    return df.withColumn("locationid", F.col("locationid").cast("bigint"))


def align_to(df: DataFrame, schema: StructType) -> tuple[DataFrame, list[str]]:
    """Keep the table's columns (cast to its types; absent ones NULL) and
    report the input columns the table does not know."""
    have = {c: c for c in df.columns}
    cols = [
        (F.col(f"`{f.name}`").cast(f.dataType) if f.name in have
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    known = {f.name for f in schema.fields}
    dropped = [c for c in df.columns if c not in known]
    return df.select(*cols), dropped


def load_months(spark: SparkSession, df: DataFrame, path: str) -> dict:
    """Idempotent load of whatever months ``df`` holds into the bronze table
    at ``path``: creates the table on first load, afterwards aligns to its
    schema and replaces only the (service_type, source_month) partitions present."""
    dropped: list[str] = []
    if T.table_exists(spark, path):
        df, dropped = align_to(df, T.read_table(spark, path).schema)
    stats = T.write_table(df, path, mode="overwrite", partition_by=BRONZE_PARTITIONS,
                          dynamic=True, observe="bronze_load")
    stats["dropped_columns"] = dropped
    return stats


#: Numeric types from the narrowest to the widest; a decimal lies between bigint and double.
INTEGERS = ("tinyint", "smallint", "int", "bigint")
#: Digits before the point that hold any value of an integer type.
INTEGER_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def widest(a: DataType, b: DataType) -> DataType:
    """The narrowest type that holds the values of both: integers, decimals, float and
    double widen to one another (bigint and decimal to double only where a double is one
    of them); date to timestamp; anything else that differs becomes text."""
    names = [a.simpleString(), b.simpleString()]
    if names[0] == names[1]:
        return a
    if all(n in INTEGERS for n in names):
        return max((a, b), key=lambda t: INTEGERS.index(t.simpleString()))
    digits = [(t.precision - t.scale, t.scale) if isinstance(t, DecimalType) else
              (INTEGER_DIGITS[n], 0) if n in INTEGERS else None for t, n in zip((a, b), names)]
    if all(digits):
        whole, scale = (max(x) for x in zip(*digits))
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else DoubleType()
    if all(d or n in ("float", "double") for d, n in zip(digits, names)):
        return DoubleType()
    if "date" in names and ("timestamp_ntz" in names or "timestamp" in names):
        return a if names[1] == "date" else b
    if isinstance(a, NullType):
        return b
    return a if isinstance(b, NullType) else StringType()


def widened(schemas: Sequence[StructType], columns: Iterable[str]) -> StructType:
    """The given columns, each in the widest type that any of the schemas has for it,
    whatever their order."""
    out = StructType()
    for name in columns:
        types = [s[name].dataType for s in schemas if name in s.names]
        out.add(name, functools.reduce(widest, types))
    return out


def read_landing_months(spark: SparkSession, files: list[tuple[str, str, str]],
                        service: str, dropped: list[str] | None = None,
                        failed: list[str] | None = None) -> DataFrame | None:
    """Read the planned month files of one service.

    One distributed job merges the footers of all files, however many (and the part
    files of a month's folder); the months are then one scan, in which a column that a
    file lacks is NULL. Where files disagree on a type, or one cannot be read, the
    schemas are read month by month, concurrently, and months of equal schema are one
    scan: a thousand files with two schema versions make two scans, not a
    thousand-way union. ``source_month`` comes from the month file (or folder) name.
    The columns are those of the first file, each in the widest type that any file
    has for it; the columns this drops are appended to ``dropped``. A month whose file
    is gone or is no Parquet file is skipped, so its month in bronze stays as it was,
    and it is appended to ``failed``; any other error is raised."""
    mine = [(month, path) for svc, month, path in files if svc == service]
    if not mine:
        return None

    def merged_schema(*paths: str) -> str | None:
        try:
            return spark.read.option("mergeSchema", True).parquet(*paths).schema.json()
        except Exception as exc:
            if any(x in str(exc) for x in (*UNREADABLE, *(MERGE_FAILS if len(paths) > 1 else ()))):
                return None
            raise

    groups: dict[str, list[str]] = {}
    together = merged_schema(*[p for _, p in mine]) if len(mine) > 1 else None
    first = None
    if together:
        groups[together] = [p for _, p in mine]
        first = merged_schema(mine[0][1])
    else:
        # footers only; read concurrently so that many files do not queue up
        with ThreadPoolExecutor(max_workers=16) as pool:
            schemas = list(pool.map(merged_schema, [p for _, p in mine]))
        for (month, path), schema in zip(mine, schemas):
            if schema is None:
                if failed is not None:
                    failed.append(month)
                continue
            first = first or schema
            groups.setdefault(schema, []).append(path)
    if not groups:
        return None
    path = F.col("_metadata.file_path")
    # cut out, which is cheaper for every row than the pattern, where the cut looks like a month
    cut = F.substring_index(F.substring_index(path, "_tripdata_", -1), ".parquet", 1)
    month = F.when((F.length(cut) == 7) & (F.substring(cut, 5, 1) == "-"), cut) \
        .otherwise(F.regexp_extract(path, r"_tripdata_(\d{4}-\d{2})\.parquet", 1))

    def struct(text: str) -> StructType:
        return StructType.fromJson(json.loads(text))

    frames = [to_bronze_trips(spark.read.schema(struct(schema)).parquet(*paths)
                              .withColumn("source_month", month), service)
              for schema, paths in groups.items()]
    names = [f.name.lower() for f in struct(first).fields]
    ours = [c for c in frames[0].columns if c in names or c in INGEST_COLUMNS]
    target = widened([f.schema for f in frames], ours)
    out = None
    for f in frames:
        aligned, lost = align_to(f, target)
        if dropped is not None:
            dropped.extend(c for c in lost if c not in dropped)
        out = aligned if out is None else out.unionByName(aligned)
    return out


def load_from_landing(spark: SparkSession, landing_dir: str, plan: DataFrame,
                      bronze_dir: str, services: Iterable[str] = SERVICES) -> dict:
    """Plan -> files that exist -> one load per service table. Returns per
    service the rows written and the columns dropped by alignment."""
    files = L.planned_files(spark, plan, landing_dir)
    report = {}
    for service in services:
        dropped: list[str] = []
        failed: list[str] = []
        df = read_landing_months(spark, files, service, dropped, failed)
        if df is None:
            report[service] = {"rows": 0, "dropped_columns": [], "failed_months": failed,
                               "skipped": True}
            continue
        report[service] = load_months(spark, df, f"{bronze_dir}/{service}_tripdata")
        report[service]["dropped_columns"] = sorted(set(dropped)
                                                    | set(report[service]["dropped_columns"]))
        report[service]["failed_months"] = failed
    return report


TRIPS = "trips"


def month_key(service: str, source_month: str) -> str:
    """The part of a versioned bronze table that holds a month."""
    return f"{TRIPS}/service_type={service}/source_month={source_month}"


def row_checksum(df: DataFrame, without: Iterable[str] = ("ingest_ts",)) -> Column:
    """An aggregate over rows in any order: two tables with the same rows, repeated
    ones included, have the same sum."""
    cols = [F.col(f"`{x}`") for x in sorted(df.columns) if x not in set(without)]
    return F.sum(F.xxhash64(*cols).cast("decimal(20,0)")).cast("string")


def load_changed(spark: SparkSession, files: list[tuple[str, str, str, str]], path: str, service: str) -> dict:
    """Load those planned months of a service into the versioned bronze table at
    ``path`` whose files differ from the ones loaded last (``files``: with
    fingerprints, from ``landing.planned_fingerprints``). All of them are one commit;
    readers and other months are not disturbed, and a writer that loaded one of these
    months meanwhile makes this one raise ``V.Conflict``.

    The version keeps a ledger entry for each month: fingerprint, rows, an order-free
    checksum, and the pickup months that its trips fall into. A month without rows
    leaves the old one as it is."""
    base = V.latest(spark, path)
    mine = [f for f in files if f[0] == service]
    prints = {month_key(s, m): fingerprint for s, m, _, fingerprint in mine}
    new = [f[:3] for f in mine if base.parts.get(month_key(f[0], f[1]), {}).get("fingerprint") != f[3]]
    dropped: list[str] = []
    failed: list[str] = []
    report = {"rows": 0, "months": [], "unchanged_months": len(mine) - len(new), "dropped_columns": dropped,
              "failed_months": failed}
    df = read_landing_months(spark, new, service, dropped, failed)
    if df is None:
        return report | {"skipped": True}
    known = base.info.get(f"schema:{TRIPS}")
    if known:
        df, lost = align_to(df, StructType.fromJson(known))
        dropped.extend(c for c in lost if c not in dropped)
    pickup = next(c for c in df.columns if c.endswith("pickup_datetime"))
    month = F.date_format(F.col(pickup), "yyyy-MM-01")
    parts = V.write(df, path, TRIPS, partition_by=BRONZE_PARTITIONS, observe="bronze_load", measures={
        "pickup_months": F.sort_array(F.collect_set(month)),  # at most one for each month there is
        "checksum": row_checksum(df)})
    if not parts:
        return report | {"skipped": True}
    for key, part in parts.items():
        part["fingerprint"] = prints[key]
    V.commit(spark, path, base, parts, info=None if known else V.schema_info(**{TRIPS: df.schema}))
    report["rows"] = sum(p["rows"] for p in parts.values())
    report["months"] = sorted(k.rsplit("=", 1)[1] for k in parts)
    report["dropped_columns"] = sorted(dropped)
    return report


LEDGER = "service_type string, source_month string, rows_loaded long, checksum string, fingerprint string, version int"


def ledger(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """One row per loaded month of versioned bronze tables, as they were committed."""
    rows = []
    for path in paths:
        version = V.latest(spark, path)
        for key, p in version.of(TRIPS).items():
            service, month = (x.split("=", 1)[1] for x in key.split("/")[1:])
            rows.append((service, month, p["rows"], p["checksum"], p["fingerprint"], version.number))
    return spark.createDataFrame(rows, LEDGER)


def reconciled(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """service_type, source_month, rows_found, checksum_found of what is there to be
    read of versioned bronze tables: one scan and a combinable aggregate. Files that
    are gone count as rows that are gone."""
    out = None
    for path in paths:
        version = V.latest(spark, path)
        schema = StructType.fromJson(version.info[f"schema:{TRIPS}"])
        with_files = {k: p for k, p in version.of(TRIPS).items() if T.table_exists(spark, V.folder(path, k, p))}
        df = V.read(spark, path, TRIPS, version, keys=with_files, schema=schema)
        found = df.groupBy("service_type", "source_month").agg(
            F.count(F.lit(1)).alias("rows_found"), row_checksum(df).alias("checksum_found"))
        out = found if out is None else out.unionByName(found)
    return out


def load_coverage(plan: DataFrame, loads: DataFrame, found: DataFrame, landed: DataFrame) -> DataFrame:
    """``year_month, service_type, status, rows_loaded`` for each planned month, from
    the ledger, what the tables hold (``reconciled``) and the landing files with
    their fingerprints: ``missing`` (never loaded), ``partial`` (the table does not
    hold the rows that were loaded), ``stale`` (delivered again since), ``loaded``."""
    keys = ["service_type", "source_month"]
    now = landed.select(*keys, F.col("fingerprint").alias("landed"))
    all_there = F.col("rows_found").eqNullSafe(F.col("rows_loaded")) & F.col("checksum_found").eqNullSafe(F.col("checksum"))
    status = (F.when(F.col("rows_loaded").isNull(), "missing").when(~all_there, "partial")
              .when(F.col("landed") != F.col("fingerprint"), "stale").otherwise("loaded"))
    return (plan.join(loads, keys, "left").join(found, keys, "left").join(now, keys, "left")
            .select(F.col("source_month").alias("year_month"), "service_type", status.alias("status"),
                    F.coalesce("rows_loaded", F.lit(0)).cast("long").alias("rows_loaded")))


def loaded_months(bronze: DataFrame) -> DataFrame:
    """Distinct (service_type, source_month) present in bronze rows."""
    return bronze.select("service_type", "source_month").distinct()


def loaded_months_listed(spark: SparkSession, table_path: str) -> DataFrame:
    """Distinct (service_type, source_month) of a written bronze table, from
    its directory listing: partition values come from the paths and no data
    file is opened, however many files the table has."""
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
               .load(table_path))
    return listing.select(F.col("service_type").cast("string").alias("service_type"),
                          F.col("source_month").cast("string").alias("source_month")).distinct()


def coverage(plan: DataFrame, loaded: DataFrame) -> DataFrame:
    """``year_month, service_type, status`` for each planned chunk:
    ``loaded`` when bronze has rows for it, else ``missing``."""
    flag = loaded.select("service_type", "source_month", F.lit(True).alias("_loaded"))
    return (plan.join(flag, ["service_type", "source_month"], "left")
            .select(F.col("source_month").alias("year_month"), "service_type",
                    F.when(F.col("_loaded"), F.lit("loaded"))
                    .otherwise(F.lit("missing")).alias("status")))
