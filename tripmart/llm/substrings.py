"""Exact repeated substrings, by cover samples and suffix buckets.

Every byte goes that lies in a 100-byte string which also starts earlier in the
corpus (smaller doc_id, or earlier in the same document). Strings are judged on
the input, and never cross documents.

A suffix is only of interest up to 100 bytes. Instead of sorting all of them, a
cover is sampled: the position of the least hashed 32-byte string among those of
each 100-byte window. Like the positions of a difference cover, two equal windows
meet a sampled position at the same distance, because it depends on the window's
bytes alone; but it has 2 positions in 70 bytes, where a periodic difference
cover that leaves 32 equal bytes would have 9 in 73.

1. Cover samples with an equal 32-byte string are one suffix bucket. A bucket
   with one sample has no repeated window.
2. The windows of one sample are adjacent; their bytes together are the sample's
   context, of up to 168 bytes. The rank of a sample is its context's hash and
   first occurrence: within a bucket, equal contexts tie, and all but the first
   are repeated whole, however long the tie goes on.
3. In buckets with several contexts, each first context is cut into cells of up
   to 9 windows with like distances from the sample. All windows of a cell have
   its core in common (92 bytes); a cell whose core is the only one of its kind
   has no repeated window, and of equal cells all but the first are repeated.
4. Only cells with an equal core and different edges are resolved window by
   window: a window is the core, some of the 8 bytes before and some of the 8
   bytes after it.

Buckets are counted and ranked by partial aggregation and joined back in a join
that can be split, so no bucket is held by one task. Memory is one batch of
texts, taken in blocks of half a million positions.

Defined cases: null texts are empty; texts under 100 bytes lose nothing; equal
rows (same doc_id and text) are one document, neither is earlier; of different
texts with one doc_id, the one with the smaller hash is earlier; null doc_ids
come first; further columns are left out; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import as_array, bytes_of, discard, mix, row_key, written

LENGTH = 100
GRAM = 32
BLOCK = 1 << 19
_SPAN = LENGTH - GRAM + 1
CELL = 9
CORE = LENGTH - CELL + 1
_POSITION = np.uint64((1 << 20) - 1)


class Hasher:
    """Hashes of the substrings of a block: sums of random numbers per byte times
    powers of an odd number, modulo 2**64, shifted back to the substring's start."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 1 << 64, 256, np.uint64, endpoint=False)
        odd = int(rng.integers(1 << 62, 1 << 63)) * 2 + 1
        inverse = pow(odd, -1, 1 << 64)
        self.power, self.inverse = (
            np.cumprod(np.append(np.ones(1, np.uint64), np.full(BLOCK + 2 * LENGTH, x, np.uint64))) for x in (odd, inverse))

    def sums(self, block: np.ndarray) -> np.ndarray:
        out = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(self.table[block] * self.power[:len(block)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.inverse[start]

    def all(self, sums: np.ndarray, length: int) -> np.ndarray:
        n = len(sums) - length
        return (sums[length:] - sums[:n]) * self.inverse[:n]


def cover(block: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of the block: the place of its sample. Also the hashes of
    the 32-byte strings, and the sums."""
    sums = hasher.sums(block)
    grams = mix(hasher.all(sums, GRAM))
    least = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= _SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < _SPAN:
        least = np.minimum(least[:width - _SPAN], least[_SPAN - width:])
    return (least & _POSITION).astype(np.int64), grams, sums


def contexts(raw: np.ndarray, off: np.ndarray, hasher: Hasher) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, start, windows, lead, bucket, context) of the cover samples of texts
    that lie one after another in raw. lead: bytes from the first window's start
    to the sample."""
    first, last = int(off[0]), int(off[-1])
    for at in range(first, last - LENGTH + 1, BLOCK):
        block = raw[at:min(last, at + BLOCK + LENGTH - 1)]
        if len(block) < LENGTH:
            break
        place, grams, sums = cover(block, hasher)
        rows = np.arange(np.searchsorted(off, at, "right") - 1, np.searchsorted(off, at + len(place), "left"))
        inside = np.clip(off[np.append(rows, rows[-1] + 1)] - at, 0, len(place))
        room = np.repeat(off[rows + 1] - at, np.diff(inside)) - np.arange(len(place))
        window = np.flatnonzero(room >= LENGTH)
        if not len(window):
            continue
        place = place[window]
        cut = np.flatnonzero((np.diff(place) != 0) | (np.diff(window) != 1)) + 1
        start = window[np.concatenate([[0], cut])]
        end = window[np.concatenate([cut - 1, [len(window) - 1]])]
        row = np.searchsorted(off, start + at, "right") - 1
        place = place[np.concatenate([[0], cut])]
        yield (row, start + at - off[row], end - start + 1, place - start, grams[place].view(np.int64),
               mix(hasher.of(sums, start, end + LENGTH)).view(np.int64))


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, tie (tells texts with one doc_id apart), text."""
    return docs.select(F.col("doc_id").cast("long"), row_key("doc_id", "text").bitwiseAND(0x7FFFFFFF).cast("int").alias("tie"), "text")


def samples(docs: DataFrame) -> DataFrame:
    """doc_id, tie, start, windows, lead, bucket, context of every cover sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(1)
        for batch in batches:
            raw, off = bytes_of(as_array(batch.column(2)))
            for row, start, windows, lead, bucket, context in contexts(raw, off, hasher):
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(start, pa.int32()),
                     pa.array(windows, pa.int8()), pa.array(lead, pa.int8()), pa.array(bucket), pa.array(context)],
                    ["doc_id", "tie", "start", "windows", "lead", "bucket", "context"])

    return _keyed(docs).mapInArrow(
        run, "doc_id long, tie int, start int, windows tinyint, lead tinyint, bucket long, context long")


def _by_document(docs: DataFrame, parts: DataFrame, how: str) -> DataFrame:
    """doc_id, tie, text and the parts (lists of structs) of each document."""
    p = parts.select(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie"), "parts")
    return _keyed(docs).join(p, F.expr("tie = __tie AND doc_id <=> __id"), how).select("doc_id", "tie", "text", "parts")


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cells of each document's contexts: bucket, cell, core, content (hashes),
    near (distance, within the cell, of its last window), windows, and the 8 bytes
    before and after the core as numbers."""
    hasher = Hasher(1)
    for batch in batches:
        raw, off = bytes_of(as_array(batch.column(2)))
        rows, found = [], []
        for i in range(batch.num_rows):
            found.append(_cells_of(raw[off[i]:off[i + 1]], batch.column(3)[i].values, hasher))
            rows.append(np.full(len(found[-1]["start"]), i))
            if sum(map(len, rows)) > 100_000 or i == batch.num_rows - 1:
                take = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take),
                     *[pa.array(np.concatenate([f[k] for f in found]), kind) for k, kind in _CELL_TYPES.items()]],
                    ["doc_id", "tie", *_CELL_TYPES])
                rows, found = [], []


_CELL_TYPES = {"start": pa.int32(), "windows": pa.int8(), "near": pa.int8(), "bucket": pa.int64(), "cell": pa.int8(),
               **dict.fromkeys(("core", "content", "before", "after"), pa.int64())}


def _cells_of(text: np.ndarray, parts: pa.StructArray, hasher: Hasher) -> dict[str, np.ndarray]:
    start, windows, lead, bucket = (parts.field(k).to_numpy().astype(np.int64) for k in range(4))
    sample, last = start + lead, lead - windows + 1  # distances go from lead down to last
    n = lead // CELL - last // CELL + 1
    own = np.repeat(np.arange(len(start)), n)
    cell = np.arange(len(own)) - np.repeat(np.cumsum(n) - n - last // CELL, n)
    far = np.minimum(lead[own], cell * CELL + CELL - 1)
    near = np.maximum(last[own], cell * CELL)
    first, core = sample[own] - far, sample[own] - cell * CELL
    out = {"start": first, "windows": far - near + 1, "near": near - cell * CELL, "bucket": bucket[own], "cell": cell}
    out |= {k: np.zeros(len(own), np.int64) for k in ("core", "content", "before", "after")}
    for at in range(0, int(first.max()) + 1, BLOCK):
        mine = np.flatnonzero((first >= at) & (first < at + BLOCK))
        if not len(mine):
            continue
        low = max(0, at - CELL)
        block = text[low:at + BLOCK + LENGTH + CELL]
        sums = hasher.sums(block)
        c = core[mine] - low
        out["core"][mine] = mix(hasher.of(sums, c, c + CORE)).view(np.int64)
        out["content"][mine] = mix(hasher.of(
            sums, first[mine] - low, sample[own[mine]] - near[mine] - low + LENGTH)).view(np.int64)
        padded = np.concatenate([np.zeros(CELL, np.uint8), block, np.zeros(CELL, np.uint8)])
        for name, where in (("before", c + CELL - (CELL - 1)), ("after", c + CELL + CORE)):
            eight = padded[where[:, None] + np.arange(8)]
            out[name][mine] = eight.view(">u8").ravel().astype(np.uint64).view(np.int64)
    return out


def repeated(docs: DataFrame) -> DataFrame:
    """doc_id, tie, parts: for each document, (start, windows, kind) of stretches:
    0 a context in a shared bucket, 1 the same if it is the first of its kind, 2 a
    cell, 3 the same if it is the first of its kind, 4 a window that is repeated
    by itself."""
    docs = docs.select("doc_id", "text")
    place = F.struct("doc_id", "tie", "start")
    shared = samples(docs).groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    tied = written(samples(docs).join(shared, "bucket"), "tied", tidy=True)
    ranked = written(tied.groupBy("bucket", "context").agg(
        F.min(place).alias("first"), F.min("windows").alias("windows"), F.min("lead").alias("lead")), "contexts", tidy=True)
    several = ranked.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    open_ = ranked.join(several, "bucket").select("first.*", "windows", "lead", "bucket").groupBy("doc_id", "tie").agg(
        F.collect_list(F.struct("start", "windows", "lead", "bucket")).alias("parts"))
    cells = written(_by_document(docs, open_, "inner").mapInArrow(
        _cells, "doc_id long, tie int, start int, windows tinyint, near tinyint, bucket long, cell tinyint, core long, "
                "content long, before long, after long"), "cells", tidy=True)
    kind = ["bucket", "cell", "core"]
    firsts = written(cells.groupBy(*kind, "content", "windows", "near").agg(
        F.min(F.struct("doc_id", "tie", "start", "before", "after")).alias("first")), "first-cells", tidy=True)
    edges = firsts.groupBy(*kind).agg(F.count("*").alias("n")).where("n > 1").select(*kind)
    # distance k within the cell: the last k bytes before the core, the first 8 - k after it
    windows = firsts.join(edges, kind).select(*kind, "near", "windows", "first.*") \
        .select("*", F.explode(F.expr("sequence(int(near), near + windows - 1)")).alias("k")) \
        .select(*kind, "k", "doc_id", "tie", F.expr("int(start + (near + windows - 1 - k))").alias("start"),
                F.expr("if(k = 0, 0L, before & (shiftrightunsigned(-1L, 64 - 8 * k)))").alias("before"),
                F.expr("if(k = 8, 0L, shiftrightunsigned(after, 8 * k))").alias("after"))
    windows = written(windows, "windows", tidy=True)
    window = [*kind, "k", "before", "after"]
    again = windows.groupBy(*window).agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    later = windows.join(again, window).where(place != F.col("first"))

    def stretch(rows: DataFrame, code: int, at: str = "") -> DataFrame:
        return rows.select(f"{at}doc_id", f"{at}tie", f"{at}start", F.col("windows").cast("tinyint").alias("windows"),
                           F.lit(code).cast("tinyint").alias("kind"))

    stretches = stretch(tied, 0).union(stretch(ranked, 1, "first.")).union(stretch(cells, 2)) \
        .union(stretch(firsts, 3, "first.")).union(stretch(later.withColumn("windows", F.lit(1)), 4))
    parts = written(stretches.groupBy("doc_id", "tie").agg(
        F.collect_set(F.struct("start", "windows", "kind")).alias("parts")), "repeated", tidy=True)
    for t in (tied, ranked, cells, firsts, windows):
        discard(t)
    return parts


def _covered(n: int, parts: pa.Scalar) -> np.ndarray:
    """Which of n bytes lie in a repeated stretch."""
    edge = np.zeros(n + 1, np.int32)
    if parts.is_valid:
        start, windows, kind = (parts.values.field(k).to_numpy() for k in range(3))
        own = (kind == 4) | (kind == 0) & ~np.isin(start, start[kind == 1]) | (kind == 2) & ~np.isin(start, start[kind == 3])
        one = np.ones(int(own.sum()), np.int32)
        np.add.at(edge, start[own].astype(np.int64), one)
        np.add.at(edge, np.minimum(start[own] + windows[own].astype(np.int64) - 1 + LENGTH, n), -one)
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, spans (start and end of each
    removed run, in bytes) and kept (the remaining bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = bytes_of(as_array(batch.column(2)))
            size = max(1, 8_000_000 * batch.num_rows // max(1, int(off[-1] - off[0])))
            for k in range(0, batch.num_rows, size):
                rows = range(k, min(batch.num_rows, k + size))
                n_bytes, removed, spans, kept = [], [], [], []
                for i in rows:
                    text = raw[off[i]:off[i + 1]]
                    gone = _covered(len(text), batch.column(3)[i])
                    edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                    n_bytes.append(len(text))
                    removed.append(int(gone.sum()))
                    spans.append(edges.reshape(-1, 2).tolist())
                    kept.append(text[~gone].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(k, len(rows)), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array([len(s) for s in spans], pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                     pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    return _by_document(docs, repeated(docs), "left").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<array<long>>, kept binary")


def digest(docs: DataFrame) -> DataFrame:
    """remove_repeats() with the remaining bytes as their SHA-256."""
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                       F.sha2("kept", 256).alias("kept_sha256"))
