"""Join helpers: broadcast only behind a size check, and a calendar join that
lets the fact's month partitions be pruned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def bounded(dim: DataFrame, max_rows: int, rows: int | None = None) -> DataFrame:
    """``broadcast(dim)`` when it has at most ``max_rows`` rows, else ``dim``.

    The count is an action on the small side only (skipped when ``rows``, a
    known row count or upper bound, is given). Above the bound the planner
    keeps a shuffle join, and AQE may still broadcast at run time from
    measured sizes."""
    n = dim.count() if rows is None else rows
    return F.broadcast(dim) if n <= max_rows else dim


def literal(dim: DataFrame) -> DataFrame:
    """Broadcast for a dimension whose size is fixed by construction
    (literal rows, or a calendar whose length is set by the settings)."""
    return F.broadcast(dim)


SALT = "_salt"


def hot_keys(fact: DataFrame, key: str, buckets: int) -> DataFrame:
    """``key, _copies`` for each key with more rows than a bucket should have: at most
    ``buckets`` keys, since each holds more than one in ``buckets`` of the rows."""
    counts = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    share = F.greatest(F.lit(1), F.ceil(F.lit(fact.count()) / buckets))
    return counts.where(F.col("_rows") > share).select(key, F.ceil(F.col("_rows") / share).cast("int").alias("_copies"))


def save_colocated(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, row_key: str, buckets: int,
                   fact_table: str, dim_table: str, paths: tuple[str, str] | None = None) -> None:
    """Save a fact and a dimension that is too large to broadcast as catalog tables in
    the same hash buckets, by the join key and a salt, so that ``colocated_join`` needs
    no exchange. The rows of a hot key are dealt over as many salts as it fills
    buckets (by the hash of ``row_key``), and the dimension has its row once for each;
    all other keys have salt 0."""
    from tripmart.sources import tables as T

    spark = fact.sparkSession
    hot = spark.createDataFrame(hot_keys(fact, fact_key, buckets).collect(),
                                f"{fact_key} {fact.schema[fact_key].dataType.simpleString()}, _copies int")
    copies = F.coalesce(F.col("_copies"), F.lit(1))
    salted = fact.join(F.broadcast(hot), fact_key, "left").withColumn(
        SALT, F.pmod(F.xxhash64(row_key), copies).cast("int")).drop("_copies")
    wide = dim.join(F.broadcast(hot.withColumnRenamed(fact_key, dim_key)), dim_key, "left").withColumn(
        SALT, F.explode(F.sequence(F.lit(0), copies - 1))).drop("_copies")
    path = paths or (None, None)
    # one task for each bucket writes one file of it
    T.save_bucketed(salted.repartition(buckets, fact_key, SALT), fact_table, buckets, (fact_key, SALT), path=path[0])
    T.save_bucketed(wide.repartition(buckets, dim_key, SALT), dim_table, buckets, (dim_key, SALT), path=path[1])


def colocated_join(spark: SparkSession, fact_table: str, dim_table: str, fact_key: str, dim_key: str) -> DataFrame:
    """The inner join of two tables of ``save_colocated``, bucket by bucket."""
    f, d = spark.table(fact_table).alias("f"), spark.table(dim_table).alias("d")
    both = f.join(d.hint("merge"), (F.col(f"f.{fact_key}") == F.col(f"d.{dim_key}")) & (F.col(f"f.{SALT}") == F.col(f"d.{SALT}")))
    return both.drop(SALT)


def join_date(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Fact x calendar on the date key, plus ``pickup_month = month_start``.

    The second equality does not change the result (the month is a function
    of the date) but lets a filter on the calendar prune the fact's month
    partitions dynamically."""
    d = literal(dim_date)
    return fact.join(d, (fact.pickup_date_key == d.date_key)
                     & (fact.pickup_month == d.month_start))
