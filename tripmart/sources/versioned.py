"""Tables that are replaced part by part while others read them.

A versioned folder holds any number of tables. Spark writes each new part (a
month, or a whole small table) to a folder of its own that no version names yet:
``data/<table>/run=<id>/<partition>``. A version is one small file,
``_versions/<number>.json``, that names the folder of every part; a commit puts
the next number there by a rename that fails if the number is taken.

* Readers take the highest version and read the folders that it names. A later
  commit changes no file of theirs.
* Writers start from the version that they read. If another commit came first, a
  writer whose parts it did not touch is put on top of it; one whose parts it did
  touch loses: its files are removed and ``Conflict`` is raised.
* ``vacuum`` removes folders and versions that were replaced longer ago than the
  given hours, and what writers that never committed left behind.

A version lists parts, not files: months times tables, whatever the data's size.
The rename is exclusive where the file system says so (HDFS does, in one step; a
local one checks first, which is enough for one machine's tests).
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripmart.sources import tables as T

VERSIONS, DATA, RUN = "_versions", "data", "run"
KEEP_HOURS = 24.0


class Conflict(RuntimeError):
    """Another writer committed the same parts first."""


@dataclass(frozen=True)
class Version:
    """parts: key (``table`` or ``table/partition``) -> run, of (parts of the table
    that the run wrote), rows, files, bytes, and what the writer added. touched: the
    keys that this commit changed, None for all."""

    number: int = 0
    committed: float = 0.0
    parts: dict[str, dict] = field(default_factory=dict)
    info: dict = field(default_factory=dict)
    touched: list[str] | None = None

    def of(self, table: str) -> dict[str, dict]:
        return {k: p for k, p in self.parts.items() if k == table or k.startswith(f"{table}/")}

    def rows(self, table: str) -> int:
        return sum(p["rows"] for p in self.of(table).values())


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = T._file_system(spark, f"{root}/{VERSIONS}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if re.fullmatch(r"\d+\.json", n))


def at(spark: SparkSession, root: str, number: int) -> Version:
    fs, file = T._file_system(spark, f"{root}/{VERSIONS}/{number:020d}.json")
    stream = fs.open(file)
    try:
        return Version(**json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def latest(spark: SparkSession, root: str) -> Version:
    """The highest version; number 0, without parts, if there is none."""
    numbers = _numbers(spark, root)
    return at(spark, root, numbers[-1]) if numbers else Version()


def _publish(spark: SparkSession, root: str, version: Version) -> bool:
    """Put a version there; False if its number is taken."""
    fs, target = T._file_system(spark, f"{root}/{VERSIONS}/{version.number:020d}.json")
    new = _path(spark, f"{root}/{VERSIONS}/.new-{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    out = fs.create(new, True)
    try:
        out.write(bytearray(json.dumps(version.__dict__).encode()))
    finally:
        out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), fs.getConf())
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        context.rename(fs.makeQualified(new), fs.makeQualified(target),
                       spark.sparkContext._gateway.new_array(kind, 0))
    except Exception as e:
        if "FileAlreadyExistsException" not in str(e):
            raise
        fs.delete(new, False)
        return False
    return True


def commit(spark: SparkSession, root: str, base: Version, put: dict[str, dict], drop: Iterable[str] = (),
           info: dict | None = None, whole: bool = False) -> Version:
    """The next version: ``base`` with the parts of ``put`` in place of theirs and
    those of ``drop`` gone; ``whole``: nothing but ``put``. ``info`` is kept with the
    version, entry by entry."""
    info, drop = info or {}, [k for k in drop if k not in put]
    touched = None if whole else [*put, *drop, *(f"info:{k}" for k in info)]
    while True:
        head = latest(spark, root)
        for number in range(base.number + 1, head.number + 1):
            theirs = at(spark, root, number).touched
            if theirs is None or touched is None or set(theirs) & set(touched):
                discard(spark, root, put)
                both = sorted(set(theirs or touched or []) & set(touched or theirs or []))
                raise Conflict(f"version {number} of {root} came first and changed {both[:5] or 'all parts'}")
        parts = {} if whole else {k: p for k, p in head.parts.items() if k not in set(drop)}
        mine = Version(head.number + 1, time.time(), parts | put, head.info | info, touched)
        if _publish(spark, root, mine):
            return mine


def folder(root: str, key: str, part: dict) -> str:
    table, _, partition = key.partition("/")
    return f"{root}/{DATA}/{table}/{RUN}={part['run']}" + (f"/{partition}" if partition else "")


def run_folder(root: str, key: str, part: dict) -> str:
    return folder(root, key.split("/", 1)[0], part)


def discard(spark: SparkSession, root: str, parts: dict[str, dict]) -> None:
    """Remove the runs of parts that are in no version."""
    for path in {run_folder(root, k, p) for k, p in parts.items()}:
        T.remove(spark, path)


def write(df: DataFrame, root: str, table: str, partition_by: Sequence[str] = (),
          measures: dict[str, Column] | None = None, **how) -> dict[str, dict]:
    """Write ``df`` as a new run and return its parts, not yet committed. ``how``:
    as for ``tables.write_table``. ``measures``: aggregates over the written rows, kept
    with each part (they must read as JSON). An empty ``df`` has no partitions; a table
    without partitions is one part also then."""
    spark, run = df.sparkSession, uuid.uuid4().hex[:16]
    base = f"{root}/{DATA}/{table}/{RUN}={run}"
    T.write_table(df, base, partition_by=partition_by, **how)
    measures = measures or {}
    rows = spark.read.schema(df.schema).parquet(base)
    # counted from the footers, unless a measure reads a column
    found = rows.groupBy(_partition(len(partition_by)).alias("partition")).agg(
        F.count(F.lit(1)).alias("rows"), *[m.alias(k) for k, m in measures.items()]).collect()
    sizes = _sizes(spark, base)
    parts = {}
    for r in found:
        files, size = sizes[r["partition"]]
        parts[f"{table}/{r['partition']}" if r["partition"] else table] = {
            "run": run, "of": len(found), "rows": r["rows"], "files": files, "bytes": size,
            **{k: r[k] for k in measures}}
    if not partition_by and not parts:
        parts[table] = {"run": run, "of": 1, "rows": 0, "files": 0, "bytes": 0, **dict.fromkeys(measures)}
    return parts


def _partition(levels: int) -> Column:
    """The partition folder, of so many levels, of the file that a row comes from. Cut
    out without a pattern, as this is done for every row."""
    if not levels:
        return F.lit("")
    return F.substring_index(F.substring_index("_metadata.file_path", "/", -levels - 1), "/", levels)


def _sizes(spark: SparkSession, base: str) -> dict[str, tuple[int, int]]:
    """Files and bytes by partition folder, listed by Spark."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet") \
        .option("recursiveFileLookup", True).load(base)
    inner = F.regexp_extract("path", rf"/{re.escape(base.rsplit('/', 1)[1])}/(?:(.*)/)?[^/]*$", 1)
    rows = files.groupBy(inner.alias("partition")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    return {r["partition"]: (r["files"], r["bytes"]) for r in rows.collect()}


def compact(spark: SparkSession, root: str, table: str, partition_by: Sequence[str],
            target_bytes: int = 128 << 20) -> dict[str, dict]:
    """Rewrite the parts of a table that have more files than their bytes ask for,
    into files of about ``target_bytes``, and commit them in place of the old ones; the
    new parts. Rows go to a file by hash, so a large part is written by many tasks. A
    part that another writer replaced meanwhile makes it raise ``Conflict``."""
    base = latest(spark, root)
    files = {k: max(1, -(-p["bytes"] // target_bytes)) for k, p in base.of(table).items()}
    small = {k: p for k, p in base.of(table).items() if p["files"] > files[k]}
    if not small:
        return {}
    rows = read(spark, root, table, base, keys=small)
    # which part a row belongs to is in the path of the file that it comes from
    large = [x for k in small if files[k] > 1 for x in (k.split("/", 1)[1], files[k])]
    file = F.lit(0).cast("long")
    if large:  # the other parts become one file
        counts = F.create_map(*[F.lit(x) for x in large])
        file = F.pmod(F.xxhash64(*[f"`{c}`" for c in rows.columns]),
                      F.coalesce(F.try_element_at(counts, _partition(len(partition_by))), F.lit(1)))
    dealt = rows.withColumn("_file", file)
    # many files: a task writes about one, however many there are
    n_files = sum(files[k] for k in small)
    tasks = [2 * n_files] if 2 * n_files > int(spark.conf.get("spark.sql.shuffle.partitions")) else []
    # two files of a part that meet in one task are cut there; hashing is even to a quarter
    most = max(-(-p["rows"] // files[k]) for k, p in small.items()) * 5 // 4 + 1
    put = write(dealt.repartition(*tasks, *partition_by, "_file").drop("_file"), root, table, partition_by=partition_by,
                max_rows_per_file=most)
    for k, p in small.items():
        if put.get(k, {}).get("rows") != p["rows"]:
            discard(spark, root, put)
            raise RuntimeError(f"{k} has {p['rows']} rows, its rewrite {put.get(k, {}).get('rows')}")
        put[k] = p | put[k]
    commit(spark, root, base, put)
    return put


def schema_info(**tables: StructType) -> dict:
    return {f"schema:{name}": schema.jsonValue() for name, schema in tables.items()}


def read(spark: SparkSession, root: str, table: str, version: Version | None = None,
         keys: Iterable[str] | None = None, schema: StructType | None = None) -> DataFrame:
    """A table as of a version (the latest if none is given); ``keys``: only these of
    its parts. One scan, whatever the number of runs behind it."""
    version = version or latest(spark, root)
    known = version.info.get(f"schema:{table}")
    if schema is None and known is None:
        raise FileNotFoundError(f"no table {table} at {root}")
    schema = schema or StructType.fromJson(known)
    parts = version.of(table)
    if keys is not None:
        parts = {k: p for k, p in parts.items() if k in set(keys)}
    by_run: dict[str, list[str]] = {}
    for k in parts:
        by_run.setdefault(parts[k]["run"], []).append(k)
    folders = []
    for run, mine in sorted(by_run.items()):
        if len(mine) == parts[mine[0]]["of"]:  # all that the run wrote: its folder
            folders.append(f"{root}/{DATA}/{table}/{RUN}={run}")
        else:
            folders += [folder(root, k, parts[k]) for k in sorted(mine)]
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(StructType([*schema.fields, StructField(RUN, StringType())])) \
        .option("basePath", f"{root}/{DATA}/{table}").parquet(*folders)
    return rows.select(*[F.col(f"`{f.name}`") for f in schema.fields])


def exists(spark: SparkSession, root: str, table: str) -> bool:
    return f"schema:{table}" in latest(spark, root).info


def vacuum(spark: SparkSession, root: str, hours: float = KEEP_HOURS) -> list[str]:
    """Remove what no version of the last ``hours`` names; the removed folders. The
    latest version always stays, and so do folders written to within these hours."""
    oldest = time.time() - hours * 3600
    versions = [at(spark, root, n) for n in _numbers(spark, root)]
    # the version that was current at that time, and all later ones
    first = max((i for i, v in enumerate(versions) if v.committed <= oldest), default=0)
    gone, kept = versions[:first], versions[first:]
    wanted = {folder(root, k, p) for v in kept for k, p in v.parts.items()}
    runs = {run_folder(root, k, p) for v in kept for k, p in v.parts.items()}
    removed = {folder(root, k, p) for v in gone for k, p in v.parts.items()} - wanted
    fs, data = T._file_system(spark, f"{root}/{DATA}")
    for table in fs.listStatus(data) if fs.exists(data) else []:
        for run in fs.listStatus(table.getPath()):
            path = f"{root}/{DATA}/{table.getPath().getName()}/{run.getPath().getName()}"
            if path not in runs and run.getModificationTime() / 1000 <= oldest:
                removed.add(path)
    for path in removed:
        T.remove(spark, path)
    for v in gone:
        T.remove(spark, f"{root}/{VERSIONS}/{v.number:020d}.json")
    return sorted(removed)
