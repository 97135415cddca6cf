"""Values held by more than one row, without shuffling every value.

A plain count per value moves every value of a unique key. Here tasks first say, in
few bits a row, which hashes they have seen:

1. **Sketch.** A value's hash is cut to ``SPARE_BITS`` more bits than the rows need.
   A task sorts the hashes of a bounded number of its rows, cuts them into ranges of
   the hash space and writes each range as a sorted set of bits: two bits a row more
   than the logarithm of the space between two of its hashes. Sketches of one range
   merge by merging their hashes, so one seen twice, in one task or in two, is found.
2. **Exact count.** Only rows whose hash was seen twice are counted by value: the true
   duplicates and one row in 2^SPARE_BITS or so. They are found by a broadcast of the
   hashes, up to ``max_broadcast_rows`` of them; beyond (a key that is not nearly
   unique) the plain count is as good and is used instead.

A hash range holds about ``RANGE_ROWS`` rows, whatever the number of rows in all; a value
that many rows hold is written once or twice by each task, not once a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.config import REFERENCE
from tripmart.operators.joins import bounded
from tripmart.session import new_table_path
from tripmart.sources import tables as T

SPARE_BITS = 8
RANGE_ROWS = 1 << 20
#: Hashes that a task sorts at a time.
TASK_ROWS = 1 << 22


def encode(hashes: np.ndarray, width: int) -> bytes:
    """Ascending numbers below 2^width in about 2 + log2(2^width / their number) bits
    each: the low bits as they are, the high ones as steps of a bit string."""
    n = len(hashes)
    low = max(0, width - n.bit_length()) if n else 0
    steps = np.zeros((int(hashes[-1]) >> low) + n if n else 0, np.uint8)
    steps[(hashes >> low) + np.arange(n)] = 1
    rest = (hashes[:, None] >> np.arange(low) & 1).astype(np.uint8)
    return np.array([n, low], "<u4").tobytes() + np.packbits(rest).tobytes() + np.packbits(steps).tobytes()


def decode(raw: bytes) -> np.ndarray:
    n, low = np.frombuffer(raw, "<u4", 2).tolist()
    data, size = np.frombuffer(raw, np.uint8, offset=8), -(-n * low // 8)
    rest = np.unpackbits(data[:size], count=n * low).reshape(n, low).astype(np.int64)
    high = np.flatnonzero(np.unpackbits(data[size:])) - np.arange(n)
    return (high << low) + (rest << np.arange(low)).sum(axis=1)


def seen_twice(df: DataFrame, value: Column, rows: int) -> DataFrame:
    """``hash`` (cut to the bits that so many rows ask for) of every value that more
    than one row may hold."""
    bits = min(62, max(16, int(rows).bit_length() + SPARE_BITS))
    ranges = 1 << max(0, (rows // RANGE_ROWS).bit_length())
    width = bits - ranges.bit_length() + 1

    def sketch(batches):
        def flush(parts):
            h = np.sort(np.concatenate(parts))
            # a hash that a task has many times is written twice
            h = h[~np.concatenate([[False, False], (h[2:] == h[1:-1]) & (h[1:-1] == h[:-2])])] if len(h) > 2 else h
            of = h >> width
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            yield pa.record_batch([pa.array(of[starts], pa.int64()), pa.array(
                [encode(x & ((1 << width) - 1), width) for x in np.split(h, starts[1:])], pa.binary())], names=["range", "sketch"])

        parts, n = [], 0
        for batch in batches:
            parts.append(batch.column(0).to_numpy(zero_copy_only=False))
            n += len(parts[-1])
            if n >= TASK_ROWS:
                yield from flush(parts)
                parts, n = [], 0
        if n:
            yield from flush(parts)

    def merged(table: pa.Table) -> pa.Table:
        h = np.sort(np.concatenate([decode(x) for x in table["sketch"].to_pylist()]))
        twice = np.unique(h[1:][h[1:] == h[:-1]])
        return pa.table({"hash": twice + (table["range"][0].as_py() << width)})

    hashes = df.select(cut_hash(value, rows).alias("hash")).where(value.isNotNull())
    return hashes.mapInArrow(sketch, "range long, sketch binary").groupBy("range").applyInArrow(merged, "hash long")


def cut_hash(value: Column, rows: int) -> Column:
    bits = min(62, max(16, int(rows).bit_length() + SPARE_BITS))
    return F.shiftrightunsigned(F.xxhash64(value), 64 - bits)


def duplicates(df: DataFrame, value: Column, rows: int | None = None,
               max_broadcast_rows: int = REFERENCE.broadcast_max_rows) -> DataFrame:
    """``value, row_count`` for each non-NULL value held by more than one row. Reads
    ``df`` twice, or three times if its number of rows is not given; the first reading
    is done when this is called."""
    rows = df.count() if rows is None else rows
    path = new_table_path(df.sparkSession, "seen_twice")
    found = T.write_table(seen_twice(df, value, rows), path, observe="seen_twice")["rows"]
    kept = df.select(value.alias("value")).where(F.col("value").isNotNull())
    if found <= max_broadcast_rows:
        twice = bounded(df.sparkSession.read.schema("hash long").parquet(path), max_broadcast_rows, found)
        kept = kept.withColumn("hash", cut_hash(F.col("value"), rows)).join(twice, "hash", "left_semi")
    return kept.groupBy("value").agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)
