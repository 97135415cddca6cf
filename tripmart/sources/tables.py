"""Table sinks and readers: Parquet paths by default, optional catalog tables,
CSV export and JDBC.

Modes follow the reference's materializations:

* full replace (lookup, literal dimensions, gold truncate+append) -> ``overwrite``;
* idempotent month load (bronze) -> dynamic partition overwrite;
* range partitions by month (fact) -> ``partitionBy`` on a derived month;
* list partitions (service or payment type) -> ``partitionBy`` on the value,
  after an accepted-values check;
* hash partitions (zone) -> ``bucketBy`` on a catalog table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] = (), dynamic: bool = False,
                rebalance: Sequence[str] | None = None,
                accepted: dict[str, Iterable] | None = None,
                observe: str | None = None, fmt: str = "parquet",
                max_rows_per_file: int | None = None) -> dict:
    """Write ``df`` to ``path``; return ``{"rows": n}`` counted during the write.

    ``dynamic=True`` replaces only the partitions present in ``df`` (a month
    loaded twice leaves one copy; an empty input changes nothing).
    ``rebalance`` adds a REBALANCE on those columns: AQE splits a hot value
    into several tasks and merges small ones, so one big month does not land
    in one task and many small months do not make many tiny files.
    ``accepted`` checks list-partition values before writing (null passes)."""
    if accepted:
        for col, values in accepted.items():
            bad = F.col(col).isNotNull() & ~F.col(col).isin(list(values))
            df = df.withColumn(col, F.when(bad, F.raise_error(
                F.concat(F.lit(f"value outside the list partitions of {col}: "),
                         F.col(col).cast("string")))).otherwise(F.col(col)))
    if rebalance:
        df = df.hint("rebalance", *rebalance)
    obs = Observation(observe or "write")
    df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if max_rows_per_file:
        w = w.option("maxRecordsPerFile", max_rows_per_file)
    w.save(path)
    return dict(obs.get)


def ensure_database(spark: SparkSession, name: str) -> None:
    """Create the catalog database (schema) when it does not exist."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def save_table(df: DataFrame, qualified_name: str, mode: str = "overwrite",
               partition_by: Sequence[str] = (), path: str | None = None) -> dict:
    """Full replace (or append) of a named catalog table ``schema.table``;
    the schema is created when absent. With ``path`` the table's files live
    there (an external table in the shared folder)."""
    spark = df.sparkSession
    if "." in qualified_name:
        ensure_database(spark, qualified_name.split(".", 1)[0])
    obs = Observation(f"save_{qualified_name.replace('.', '_')}")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(qualified_name)
    return dict(obs.get)


def save_bucketed(df: DataFrame, table: str, buckets: int, key: str | Sequence[str],
                  path: str | None = None) -> None:
    """Hash-partitioned catalog table (``bucketBy``). A later join or
    aggregation on ``key`` with the same bucket count needs no shuffle."""
    if "." in table:
        ensure_database(df.sparkSession, table.split(".", 1)[0])
    keys = [key] if isinstance(key, str) else list(key)
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def read_table(spark: SparkSession, path: str, base_path: str | None = None,
               schema=None) -> DataFrame:
    """Read a Parquet table; with ``schema`` the partition columns get the
    written types instead of inferred ones."""
    r = spark.read if schema is None else spark.read.schema(schema)
    if base_path:
        r = r.option("basePath", base_path)
    return r.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a Parquet file, asked of the file system that
    the path belongs to (the default one if it names none). Any error but the
    path's absence is raised."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return False
    files = fs.listFiles(p, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def replace_table(df: DataFrame, path: str, observe: str = "replace") -> dict:
    """Full replace by a table written beside the old one and renamed into its
    place, so a failed write leaves the old table. An empty ``df`` replaces
    nothing: ``{"rows": 0, "skipped": True}``."""
    spark = df.sparkSession
    fs, target = _file_system(spark, path)
    new = f"{path.rstrip('/')}.new-{uuid.uuid4().hex[:12]}"
    stats = write_table(df, new, observe=observe)
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    if not stats["rows"]:
        fs.delete(jpath(new), True)
        return stats | {"skipped": True}
    old = jpath(f"{path.rstrip('/')}.old-{uuid.uuid4().hex[:12]}")
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"cannot move {path}")
    if not fs.rename(jpath(new), target):
        raise OSError(f"cannot put the new table in place of {path}")
    if had:
        fs.delete(old, True)
    return stats


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, written beside the old one and renamed into its place."""
    fs, target = _file_system(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.new-{uuid.uuid4().hex[:12]}")
    out = fs.create(new, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(new, target):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """The whole of a small text file; None if there is none."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return None
    return spark.read.option("wholetext", True).text(path).first()[0]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table's folder, if it is there."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def rename_partitions(spark: SparkSession, paths: Iterable[str], column: str, target: str) -> None:
    """Move each partition folder ``column=value`` of tables to ``target/value``."""
    for path in paths:
        fs, p = _file_system(spark, path)
        out = spark._jvm.org.apache.hadoop.fs.Path(target)
        fs.mkdirs(out)
        for status in fs.listStatus(p):
            name = status.getPath().getName()
            if name.startswith(f"{column}="):
                fs.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(out, name.split("=", 1)[1]))


def preview(df: DataFrame, n: int = 1000) -> DataFrame:
    """First ``n`` rows of a model, as the orchestrator's block preview."""
    return df.limit(n)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV export with a header; quotes within a field are doubled."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict,
              partition_column: str, lower: int, upper: int, num_partitions: int) -> DataFrame:
    """Read a database table in parallel slices of a numeric column."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in properties.items():
        r = r.option(k, v)
    return (r.option("partitionColumn", partition_column).option("lowerBound", lower)
            .option("upperBound", upper).option("numPartitions", num_partitions).load())


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict,
               mode: str = "overwrite", batch_size: int = 10_000) -> None:
    """Full replace of a database table (``mode='overwrite'``) or append."""
    w = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", batch_size))
    for k, v in properties.items():
        w = w.option(k, v)
    w.save()
