"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc
import sys
import time
import types
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.session import new_table_path

#: What separates words, in the data contract: space and U+0009 to U+000D.
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """Write to a new folder under the shared checkpoint folder and read back:
    the lineage ends there, and a lost executor costs no earlier stage. tidy:
    then let the driver's cleaner find the shuffle files that nothing refers to
    any more, which it otherwise does when the driver happens to run out of heap."""
    spark = df.sparkSession
    path = new_table_path(spark, f"llm-{name}")
    df.write.parquet(path)
    if tidy:
        for _ in range(2):
            gc.collect()
            spark._jvm.System.gc()
            time.sleep(0.3)
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by ``written`` once nothing reads it any more."""
    path = getattr(df, "_llm_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo; null ids count as remainder 1,
    that is, never as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(1))


def unit_hash(*cols: Column | str) -> Column:
    """A number in [0, 1) fixed by the columns' values (for bounded samples)."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def row_key(*cols: str) -> Column:
    """A 64-bit key of a row's values; equal rows share it. Never null."""
    return F.xxhash64(*cols)


def per_worker(key: str, make):
    """One object per Python worker process, kept from task to task."""
    kept = sys.modules.setdefault("_kept_in_worker", types.ModuleType("_kept_in_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def trim() -> None:
    """Give the memory that this process no longer uses back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def given_back(run):
    """A function over Arrow batches that, when its task ends, gives the memory it no
    longer uses back to the system: workers live on, and what one job has touched would
    be missing in the next."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            trim()

    return task


#: Rows of whole texts that travel to Python at a time.
TEXT_ROWS = 2_000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def text_batches(spark: SparkSession):
    """Jobs that run inside send TEXT_ROWS rows to Python at a time, or fewer if the
    session says so: 10,000 texts are held several times on either side."""
    before = spark.conf.get(ARROW_ROWS)
    if not 0 < int(before) <= TEXT_ROWS:
        spark.conf.set(ARROW_ROWS, str(TEXT_ROWS))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without a copy, and the n + 1 offsets
    of its rows; a null row is empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, kind, n + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw, off


def as_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


_GAPS = np.zeros(256, bool)
_GAPS[[32, 9, 10, 11, 12, 13]] = True


def text_blocks(raw: np.ndarray, start: int, end: int, size: int = 1 << 20):
    """A text as bytes, about ``size`` at a time; a block ends at the end of a word."""
    while start < end:
        stop = min(end, start + size)
        while stop < end and not _GAPS[raw[stop]]:
            gap = np.flatnonzero(_GAPS[raw[stop:min(end, stop + 4096)]])
            stop = stop + int(gap[0]) if len(gap) else min(end, stop + 4096)
        yield raw[start:stop].tobytes()
        start = stop


def word_blocks(raw: np.ndarray, start: int, end: int, size: int = 1 << 20):
    """The words of a text as lists of bytes, a block of the text at a time."""
    for block in text_blocks(raw, start, end, size):
        words = block.split()
        if words:
            yield words


def mix(h: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, on uint64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered for up to ``most`` words at a time."""

    def __init__(self, most: int = 400_000):
        self.most = most

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def placed(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """The rows in ranges of (group, order), written, with the number of their
    range as ``part``: a group of any size spreads over many ranges."""
    return written(df.repartitionByRange(*group, *order).withColumn("part", F.spark_partition_id()), name)


def group_parts(rows: DataFrame, group: list[str]) -> DataFrame:
    """Of placed rows, per group and part: how many rows of the group come before
    the part (``before``) and how many it has in all (``group_n``). A group has at
    most a row for each range."""
    parts = rows.groupBy(*group, "part").agg(F.count(F.lit(1)).alias("n"))
    of_group = Window.partitionBy(*group)
    running = of_group.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return parts.select(*group, "part", (F.sum("n").over(running) - F.col("n")).alias("before"),
                        F.sum("n").over(of_group).alias("group_n"))


def numbered(rows: DataFrame, parts: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Placed rows with ``pos``, their place in their group from 0, and the other
    columns of parts. Groups are never null."""
    inner = F.row_number().over(Window.partitionBy(*group, "part").orderBy(*order))
    return rows.withColumn("inner_pos", inner).join(parts, [*group, "part"]) \
        .withColumn("pos", F.col("before") + F.col("inner_pos") - 1).drop("inner_pos", "before", "part")
