"""Registered queries: name -> ``(spark, sf_dir) -> DataFrame``.

Every entry starts from the supplied tables through the adapter
(``sources.fixtures``), then runs the real layers: bronze -> silver -> star ->
question or check. Nothing is sampled or capped; limits appear only where
the question is a top-k.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import SERVICE_KEYS, TESTDATA, Settings
from tripmart.functions.columns import MONEY, MONEY_SUM
from tripmart.operators import bronze as B
from tripmart.operators import checks as K
from tripmart.operators import gold as G
from tripmart.operators import impute as I
from tripmart.operators import joins as J
from tripmart.operators import month_checks as M
from tripmart.operators import rollup as R
from tripmart.operators import silver as S
from tripmart.plans.questions import QUESTIONS
from tripmart.session import new_table_path
from tripmart.sources import fixtures
from tripmart.sources import landing as L
from tripmart.sources import tables as T
from tripmart.sources import versioned as V

# trips that a task of fact_compaction writes as small files
SMALL_FILE_TRIPS = 2_000_000
# integer columns the adapter lands as float or int (trip_type is not landed)
REPAIRED = ("vendorid", "passenger_count", "pulocationid", "dolocationid", "ratecodeid",
            "payment_type")


@dataclass
class Bronze:
    yellow: DataFrame
    green: DataFrame
    zones: DataFrame       # lookup


@dataclass
class Layers:
    bronze: Bronze
    silver: DataFrame
    star: G.Star


def bronze_layers(spark: SparkSession, sf_dir: str) -> Bronze:
    land = fixtures.landing(spark, sf_dir)
    return Bronze(B.to_bronze_trips(land.yellow, "yellow"),
                  B.to_bronze_trips(land.green, "green"),
                  B.to_bronze_zones(land.zones))


def layers(spark: SparkSession, sf_dir: str, settings: Settings = TESTDATA) -> Layers:
    """The lazy layers. The zone lookup is counted once; silver and the star
    use that count for their broadcast checks."""
    b = bronze_layers(spark, sf_dir)
    zone_rows = b.zones.count()
    silver = S.silver_trips(b.yellow, b.green, b.zones, settings.broadcast_max_rows, zone_rows)
    star = G.build_star(spark, silver, b.zones, settings, zone_rows)
    return Layers(b, silver, star)


def _question(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = QUESTIONS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(layers(spark, sf_dir).star)

    run.__name__ = name
    return run


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    REGISTRY[fn.__name__] = fn
    return fn


# Sources and bronze (B1-B13) ------------------------------------------------

@register
def load_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month starts x services between the first and last ship date landed."""
    li = fixtures.read_table(spark, sf_dir, "lineitem")
    bounds = li.agg(F.min("l_shipdate").cast("date").alias("start_date"),
                    F.max("l_shipdate").cast("date").alias("end_date"))
    return L.load_plan_from(bounds)


@register
def bronze_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both bronze tables (ingest columns, lower-case names, integer repair),
    without the wall-clock ``ingest_ts``."""
    b = bronze_layers(spark, sf_dir)
    return (b.yellow.drop("ingest_ts")
            .unionByName(b.green.drop("ingest_ts"), allowMissingColumns=True))


@register
def bronze_int_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per service: rows, and for each repaired integer column its non-NULL
    count and sum (the columns are ``bigint`` after repair)."""
    b = bronze_layers(spark, sf_dir)
    both = b.yellow.unionByName(b.green, allowMissingColumns=True)
    aggs = [F.count(F.lit(1)).alias("trips")]
    for col in REPAIRED:
        aggs += [F.count(col).alias(f"{col}_n"), F.sum(col).alias(f"{col}_sum")]
    return both.groupBy("service_type").agg(*aggs)


@register
def bronze_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load every month of both services twice into bronze tables under the
    shared folder, read them back, and count rows per loaded month: the
    second load replaces the first instead of adding to it."""
    b = bronze_layers(spark, sf_dir)
    root = new_table_path(spark, "bronze_reload")
    for _ in range(2):
        for svc, df in (("yellow", b.yellow), ("green", b.green)):
            B.load_months(spark, df, f"{root}/{svc}_tripdata")
    back = [T.read_table(spark, f"{root}/{svc}_tripdata").select(
        "service_type", "source_month", "total_amount") for svc in ("yellow", "green")]
    both = back[0].unionByName(back[1])
    return both.groupBy("service_type", "source_month").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum(F.col("total_amount").cast(MONEY)).cast(MONEY_SUM).alias("revenue"))


@register
def bronze_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yellow rows loaded into an empty table; then the even months again with
    one column more and one fewer: the table keeps its columns, the new one is
    left out and the absent one is NULL in those months."""
    b = bronze_layers(spark, sf_dir)
    path = f"{new_table_path(spark, 'bronze_align')}/yellow_tripdata"
    B.load_months(spark, b.yellow, path)
    even = F.substring("source_month", 6, 2).cast("int") % 2 == 0
    B.load_months(spark, b.yellow.where(even).drop("ratecodeid").withColumn("brand_new", F.lit(1)), path)
    back = T.read_table(spark, path)
    return back.groupBy("source_month").agg(
        F.count(F.lit(1)).alias("trips"), F.count("ratecodeid").alias("ratecodes"),
        F.count("passenger_count").alias("passengers")).withColumn("n_columns", F.lit(len(back.columns)))


@register
def landing_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest path on month files: written under their names in two schema
    versions (even months without the rate code), every March left out of the
    folder, then planned, listed, read and loaded; rows per planned month."""
    s, root = TESTDATA, new_table_path(spark, "landing_load")
    land = fixtures.landing(spark, sf_dir)
    plan = L.load_plan(spark, s.plan_start, s.plan_end)
    for svc, df in (("yellow", land.yellow), ("green", land.green)):
        month = F.substring("source_month", 6, 2).cast("int")
        present = df.where(month != 3).withColumn("_file", F.concat(F.lit(f"{svc}_tripdata_"), "source_month", F.lit(".parquet")))
        for even in (0, 1):
            part = present.where(month % 2 != even).drop("source_month")
            part = part.drop("RatecodeID") if even else part
            part.write.mode("append").partitionBy("_file").parquet(f"{root}/staged/{svc}")
    T.rename_partitions(spark, [f"{root}/staged/{svc}" for svc in ("yellow", "green")], "_file", f"{root}/landing")
    loads = B.load_from_landing(spark, f"{root}/landing", plan, f"{root}/bronze")
    both = [T.read_table(spark, f"{root}/bronze/{svc}_tripdata").select("service_type", "source_month", "ratecodeid")
            for svc in ("yellow", "green")]
    counted = both[0].unionByName(both[1]).groupBy("service_type", "source_month").agg(
        F.count(F.lit(1)).alias("trips"), F.count("ratecodeid").alias("ratecodes"))
    total = F.when(F.col("service_type") == "yellow", loads["yellow"]["rows"]).otherwise(loads["green"]["rows"])
    zero = F.lit(0).cast("long")
    return plan.join(counted, ["service_type", "source_month"], "left").select(
        "service_type", "source_month", F.coalesce("trips", zero).alias("trips"),
        F.coalesce("ratecodes", zero).alias("ratecodes"), total.cast("long").alias("rows_loaded"))


def _land_months(spark: SparkSession, land: fixtures.Landing, root: str, keep=None) -> str:
    """Month files under their names, as they are delivered; the landing folder."""
    for svc, df in (("yellow", land.yellow), ("green", land.green)):
        df = df if keep is None else df.where(keep)
        file = F.concat(F.lit(f"{svc}_tripdata_"), "source_month", F.lit(".parquet")).alias("_file")
        df.select("*", file).drop("source_month").repartition("_file").write.partitionBy("_file").parquet(f"{root}/staged/{svc}")
    T.rename_partitions(spark, [f"{root}/staged/{svc}" for svc in ("yellow", "green")], "_file", f"{root}/landing")
    return f"{root}/landing"


@register
def refresh_changed_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months loaded and the star built; then yellow June 1997 is delivered again,
    without the trips of every fifth pickup zone and with those of the next fifth dated
    a month later, and the warehouse refreshed: per pickup month the trips and the
    revenue, as of a full rebuild, and the fact rows that the refresh wrote."""
    from tripmart.warehouse import refresh

    s, root = TESTDATA, new_table_path(spark, "refresh_changed_month")
    land = fixtures.landing(spark, sf_dir)
    landing = _land_months(spark, land, root)
    first = refresh(spark, landing, land.zones, f"{root}/wh", s, rebalance_fact=True, run_checks=False)
    june = land.yellow.where("source_month = '1997-06' AND PULocationID % 5 <> 0").drop("source_month")
    for col in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
        june = june.withColumn(col, F.when(F.col("PULocationID") % 5 == 1, F.col(col) + F.expr("interval 1 month"))
                               .otherwise(F.col(col)))
    june.write.mode("overwrite").parquet(f"{landing}/{L.trip_file_name('yellow', '1997-06')}")
    second = refresh(spark, landing, land.zones, f"{root}/wh", s, rebalance_fact=True, run_checks=False)
    assert first.loads["fct_trips"]["full"] and second.loads["yellow"]["months"] == ["1997-06"]
    written = second.loads["fct_trips"]
    of_month = F.col("pickup_month").cast("string").isin(written["months"])
    by_month = second.star.fct.groupBy("pickup_month").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("total_amount").cast(MONEY_SUM).alias("revenue"))
    return by_month.select("*", F.when(of_month, F.col("trips")).otherwise(F.lit(0)).cast("long").alias("rows_rewritten"),
                           F.lit(written["rows"]).cast("long").alias("all_rewritten"))


@register
def load_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage from the load ledger: every March was never delivered, every April's
    files are gone from the table, every May was delivered again since."""
    s, root = TESTDATA, new_table_path(spark, "load_ledger")
    land = fixtures.landing(spark, sf_dir)
    month = F.substring("source_month", 6, 2)
    landing = _land_months(spark, land, root, month != "03")
    plan = L.load_plan(spark, s.plan_start, s.plan_end)
    files = L.planned_fingerprints(spark, plan, landing)
    paths = {svc: f"{root}/bronze/{svc}_tripdata" for svc in ("yellow", "green")}
    for svc, path in paths.items():
        B.load_changed(spark, files, path, svc)
        for key, part in V.latest(spark, path).of(B.TRIPS).items():
            if key.endswith("-04"):
                T.remove(spark, V.folder(path, key, part))
    landed = spark.createDataFrame(files, "service_type string, source_month string, path string, fingerprint string")
    landed = landed.withColumn("fingerprint", F.when(month == "05", F.lit("another")).otherwise(F.col("fingerprint")))
    return B.load_coverage(plan, B.ledger(spark, paths.values()), B.reconciled(spark, paths.values()), landed)


@register
def lookup_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone lookup written, replaced by itself, then by an empty one, which
    changes nothing; with its ingest constants."""
    zones = bronze_layers(spark, sf_dir).zones
    path = f"{new_table_path(spark, 'lookup_reload')}/taxi_zone_lookup"
    for df in (zones, zones, zones.limit(0)):
        T.replace_table(df, path)
    return T.read_table(spark, path).select("locationid", "borough", "_zone", "source_month", "service_type")


@register
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land every month file of both services (``source_month=`` folders),
    ingest them with an available-now stream into bronze, read back and count
    rows per month: the streaming path loads exactly what the batch path does."""
    from tripmart.streaming import start_ingest

    land = fixtures.landing(spark, sf_dir)
    root = new_table_path(spark, "stream_ingest")
    for svc, df in (("yellow", land.yellow), ("green", land.green)):
        df.write.mode("overwrite").partitionBy("source_month").parquet(f"{root}/landing/{svc}")
        q = start_ingest(spark, f"{root}/landing/{svc}", svc, f"{root}/bronze/{svc}_tripdata",
                         f"{root}/checkpoints/{svc}")
        q.awaitTermination()
    back = [T.read_table(spark, f"{root}/bronze/{svc}_tripdata").select(
        "service_type", "source_month", "total_amount") for svc in ("yellow", "green")]
    both = back[0].unionByName(back[1])
    return both.groupBy("service_type", "source_month").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum(F.col("total_amount").cast(MONEY)).cast(MONEY_SUM).alias("revenue"))


@register
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned month x service -> loaded / missing, against bronze."""
    s = TESTDATA
    plan = L.load_plan(spark, s.plan_start, s.plan_end)
    b = bronze_layers(spark, sf_dir)
    loaded = B.loaded_months(b.yellow).unionByName(B.loaded_months(b.green))
    return B.coverage(plan, loaded)


@register
def zone_lookup_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones written as a header CSV (NULL as empty text), read back through
    the NULL-token reader, ingested to bronze and projected to ``dim_zone``."""
    path = new_table_path(spark, "zone_lookup_csv")
    T.write_csv(fixtures.landing_zones(spark, sf_dir), path)
    return G.dim_zone(B.to_bronze_zones(L.read_zone_lookup(spark, path)))


# Silver (P1-P5, U1, J1) -------------------------------------------------------

@register
def silver_yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.project_service(bronze_layers(spark, sf_dir).yellow, "tpep")


@register
def silver_green(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.project_service(bronze_layers(spark, sf_dir).green, "lpep")


@register
def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers(spark, sf_dir).silver


@register
def silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bronze_layers(spark, sf_dir)
    return S.silver_rejects(b.yellow, b.green, b.zones, TESTDATA.broadcast_max_rows)


# Gold (G1-G6, B24, B27-B29, P12) ------------------------------------------------

def _with_trips(dim: DataFrame, fact: DataFrame, dim_key: str, fact_key: str) -> DataFrame:
    """A dimension with the number of fact rows per member (0 when none):
    the fact is reduced to one row per key before the join."""
    counts = fact.groupBy(F.col(fact_key).alias("_k")).agg(F.count(F.lit(1)).alias("_trips"))
    return (dim.join(counts, dim[dim_key] == counts["_k"], "left")
            .select(*[dim[x] for x in dim.columns],
                    F.coalesce(F.col("_trips"), F.lit(0)).cast("bigint").alias("trips")))


@register
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = layers(spark, sf_dir).star
    d = star.dim_date.select(*G.DATE_COLUMNS)
    return _with_trips(d, star.fct, "date_key", "pickup_date_key")


@register
def dim_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.dim_zone(bronze_layers(spark, sf_dir).zones)


@register
def dim_service_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = layers(spark, sf_dir).star
    return _with_trips(star.dim_service_type, star.fct, "service_id", "service_key")


@register
def dim_payment_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = layers(spark, sf_dir).star
    return _with_trips(star.dim_payment_type, star.fct, "payment_type_key", "payment_type_key")


@register
def dim_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = layers(spark, sf_dir).star
    return _with_trips(star.dim_vendor, star.fct, "vendor_key", "vendor_key")


@register
def fct_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers(spark, sf_dir).star.fct.select(*G.FACT_COLUMNS)


@register
def fct_key_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source codes -> dimension keys, with trips per combination."""
    silver = layers(spark, sf_dir).silver
    service, payment, vendor = G.key_mapping()
    return (silver.groupBy("service_type", "payment_type", "vendor_id")
            .agg(F.count(F.lit(1)).alias("trips"))
            .select("service_type", "payment_type", "vendor_id",
                    service.cast("int").alias("service_key"),
                    payment.cast("int").alias("payment_type_key"),
                    vendor.cast("int").alias("vendor_key"), "trips"))


@register
def fct_rows_per_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the fact range-partitioned by month, read it back, rows per month."""
    fct = layers(spark, sf_dir).star.fct
    path = new_table_path(spark, "fct_trips")
    # lineitem is not clustered by month, so the write rebalances on it.
    T.write_table(fct, path, partition_by=("pickup_month",), rebalance=("pickup_month",))
    back = T.read_table(spark, path, schema=fct.schema)
    return back.groupBy("pickup_month").agg(F.count(F.lit(1)).alias("trips"))


@register
def gold_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star written twice: the second replaces the first. Rows per table."""
    star = layers(spark, sf_dir).star
    path = new_table_path(spark, "gold_reload")
    G.write_star(spark, star, path, rebalance=True)
    back = G.write_star(spark, star, path, rebalance=True)
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
              for name, df in (("fct_trips", back.fct), ("dim_date", back.dim_date), ("dim_zone", back.dim_zone),
                               ("dim_service_type", back.dim_service_type),
                               ("dim_payment_type", back.dim_payment_type), ("dim_vendor", back.dim_vendor))]
    out = counts[0]
    for x in counts[1:]:
        out = out.union(x)
    return out


@register
def fact_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact written as many small files, then rewritten by month into as few as
    their bytes ask for: trips, revenue and files of each month, as committed."""
    fct = layers(spark, sf_dir).star.fct
    path = new_table_path(spark, "fact_compaction")
    # six files a month, and more where a task would have more than two million trips
    trips = fixtures.read_table(spark, sf_dir, "lineitem").count()
    dealt = fct.repartition(max(6, -(-trips // SMALL_FILE_TRIPS)), "trip_key")
    small = V.write(dealt, path, "fct_trips", partition_by=("pickup_month",))
    V.commit(spark, path, V.latest(spark, path), small, info=V.schema_info(fct_trips=fct.schema))
    V.compact(spark, path, "fct_trips", ["pickup_month"])
    version = V.latest(spark, path)
    files = spark.createDataFrame([(k.split("=")[1], p["files"]) for k, p in version.parts.items()], "m string, files long")
    by_month = V.read(spark, path, "fct_trips", version).groupBy("pickup_month").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("total_amount").cast(MONEY_SUM).alias("revenue"))
    return by_month.join(files, F.col("pickup_month").cast("string") == F.col("m")).drop("m")


@register
def rollup_by_service_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star written, its rollup built by month, and the monthly figures of each
    service answered from the rollup alone."""
    path = new_table_path(spark, "rollup")
    star = G.write_star(spark, layers(spark, sf_dir).star, path, rebalance=True)
    R.refresh_rollup(spark, path)
    return R.by(star, R.read_rollup(spark, path), ["year", "month", "service_type"], list(R.MEASURES))


@register
def zone_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_zone as a table in four hash partitions, read back, with its trips."""
    star = layers(spark, sf_dir).star
    path = new_table_path(spark, "zone_buckets")
    name = f"zone_buckets_{path[-12:]}"
    T.save_bucketed(star.dim_zone, name, 4, "zone_key", path=path)
    return _with_trips(spark.table(name), star.fct, "zone_key", "pu_zone_key")


@register
def zone_join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips and revenue by zone from the fact and the zones in the same hash buckets,
    joined without an exchange, as beyond the broadcast bound."""
    star = layers(spark, sf_dir).star
    paths = (new_table_path(spark, "bucketed_fact"), new_table_path(spark, "bucketed_zones"))
    names = tuple(f"{p.rsplit('/', 1)[1].replace('-', '_')}" for p in paths)
    fct = star.fct.select("trip_key", "pu_zone_key", "total_amount")
    J.save_colocated(fct, star.dim_zone, "pu_zone_key", "zone_key", "trip_key", 8, *names, paths=paths)
    both = J.colocated_join(spark, *names, "pu_zone_key", "zone_key")
    return both.groupBy("zone_key", "zone_name", "borough").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("total_amount").cast(MONEY_SUM).alias("revenue"))


@register
def list_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The service dimension in one partition per listed service, read back
    with its trips."""
    star = layers(spark, sf_dir).star
    path = new_table_path(spark, "list_partitions")
    T.write_table(star.dim_service_type, path, partition_by=("service_type",),
                  accepted={"service_type": SERVICE_KEYS.keys()})
    back = T.read_table(spark, path, schema=star.dim_service_type.schema)
    return _with_trips(back.select(*star.dim_service_type.columns), star.fct, "service_id", "service_key")


@register
def month_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.month_bounds(layers(spark, sf_dir).silver)


@register
def partition_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per declared month partition, or ``default`` outside the range."""
    fct = layers(spark, sf_dir).star.fct
    route = G.partition_route("pickup_date", TESTDATA).alias("partition_name")
    return fct.groupBy(route).agg(F.count(F.lit(1)).alias("trips"))


# Checks (C1-C5, J7, A11) -----------------------------------------------------

@register
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver trips with no passenger count."""
    return K.not_null(layers(spark, sf_dir).silver, "passengers_count")


@register
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact surrogate keys held by more than one trip."""
    return K.unique(layers(spark, sf_dir).star.fct, "trip_key", hexadecimal=True)


@register
def check_unique_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the written fact, by a sketch of the keys: only rows that may
    be duplicates are shuffled."""
    fct = layers(spark, sf_dir).star.fct.select("trip_key", "pickup_month")
    path = new_table_path(spark, "check_unique_sketch")
    rows = T.write_table(fct, path)["rows"]
    return K.unique_by_sketch(T.read_table(spark, path, schema=fct.schema), "trip_key", True, rows)


@register
def check_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver vendor codes outside the vendor dimension's known codes."""
    return K.accepted_values(layers(spark, sf_dir).silver, "vendor_id", (1, 2))


@register
def check_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows whose pickup date key is not in the calendar."""
    star = layers(spark, sf_dir).star
    fct = star.fct.select(*G.FACT_COLUMNS)
    return K.relationships(fct, "pickup_date_key", star.dim_date, "date_key")


@register
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's declared test suite on the real model names: one pass of
    silver, the star as it is written."""
    ly = layers(spark, sf_dir)
    star = G.write_star(spark, ly.star, new_table_path(spark, "quality_report"), rebalance=True)
    models = {
        "silver_trips": ly.silver, "zone_lookup": ly.bronze.zones,
        "dim_service_type": star.dim_service_type,
        "dim_payment_type": star.dim_payment_type,
        "dim_zone": star.dim_zone, "dim_date": star.dim_date,
        "fct_trips": star.fct,
    }
    return K.run_checks(spark, K.REFERENCE_SUITE, models)


@register
def quality_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact's checks from states by month: the star without June 1998 is written
    and checked, the month added, and only that month read; with the months of the
    second reading."""
    star, path = layers(spark, sf_dir).star, new_table_path(spark, "quality_by_month")
    june = F.col("pickup_month") == F.lit("1998-06-01").cast("date")
    G.write_star(spark, replace(star, fct=star.fct.where(~june)), path, rebalance=True)
    M.refresh_checks(spark, path)
    V.commit(spark, path, V.latest(spark, path), G.write_fact(star.fct.where(june), path, True))
    months = M.refresh_checks(spark, path)
    return M.report(spark, path).withColumn("months_read", F.lit(",".join(months)))


# Imputation (A12, T1) --------------------------------------------------------

NUMERIC_FACT_COLUMNS = ("passengers_count", "trip_distance", "fare_amount", "tip_amount",
                        "tolls_amount", "total_amount")


@register
def upper_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    fct = layers(spark, sf_dir).star.fct
    return I.upper_median_row(fct, NUMERIC_FACT_COLUMNS)


@register
def median_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    fct = layers(spark, sf_dir).star.fct.select("trip_key", *NUMERIC_FACT_COLUMNS)
    return I.median_fill(fct, NUMERIC_FACT_COLUMNS)


@register
def csv_sample_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numeric-sample flow on CSV: the fact's numeric columns exported as
    CSV, read back with a schema, selected and filled with upper medians."""
    fct = layers(spark, sf_dir).star.fct.select("trip_key", *NUMERIC_FACT_COLUMNS)
    path = new_table_path(spark, "csv_sample")
    T.write_csv(fct, path)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fct.schema.fields)
    back = L.read_csv(spark, path, schema)
    return I.median_fill(back, NUMERIC_FACT_COLUMNS)


REGISTRY.update({name: _question(name) for name in QUESTIONS})
