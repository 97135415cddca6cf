"""Near-duplicate documents by ProbMinHash.

A document is the set of its five-word shingles (words are runs of characters
other than space and U+0009 to U+000D; a text of one to four words is one
shingle). A shingle's weight is 1 + ln(its count in the text).

1. Signature: each shingle is a Poisson process of arrivals, at a rate equal to
   its weight, and each arrival falls on one of 128 registers; a register keeps
   the shingle of its first arrival. A shingle stops when its next arrival is
   later than the latest register. Two registers agree with a probability equal
   to the probability Jaccard similarity of the weighted sets.
2. Banding: 32 bands of 4 registers. At similarity 0.8 a pair shares no band
   with probability 5e-8.
3. Texts with equal words are one node. In each bucket, every node is verified
   against a leader, the node whose bands are in the largest buckets; a second
   pass does so with the leader of those outside the bucket's largest component;
   then every pair of a bucket whose nodes are still in different components is
   tried, after a bound from 1024 parity bits of each shingle set that no pair
   at 0.8 fails. A group of k near copies costs about k verified pairs, not
   k * k. A pair is linked when the exact Jaccard similarity of its shingle sets
   is 0.8 or more. A class is a connected component of links: no pair of a bucket
   with a link is left in two classes, and n_links counts the links found (a
   group's links through its leaders, not all k * k of them).

Defined cases: texts that are null or without a word belong to no class but
their own (class_id is their doc_id, n_links 0). Equal rows (same doc_id and
text) are one document: both get the same class. class_id is the least doc_id
of the class; null doc_ids do not count, and a class of null ids has class_id
null. Further columns are passed through.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import (WordHashes, as_array, bytes_of, discard, given_back, mix, row_key, word_blocks,
                                 written)

SHINGLE = 5
REGISTERS = 128
ROWS = 4
PARITY = 1024
STARS = 2
THRESHOLD = (4, 5)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _shingles(words: np.ndarray) -> np.ndarray:
    """Hash of each run of five words; of all words if there are fewer."""
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1 if len(words) else 0
    h = np.full(n, width, np.uint64)
    for k in range(width):
        h = mix(h * _STEP + words[k:k + n])
    return h


def _word_array(raw: np.ndarray, start: int, end: int, hashes: WordHashes) -> np.ndarray:
    parts = [hashes.of(words) for words in word_blocks(raw, start, end)]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def signatures(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """n x REGISTERS: the shingle that arrives first at each register. The rows
    of owner are in order."""
    first = np.full(n * REGISTERS, np.inf)
    sign = np.zeros(n * REGISTERS, np.uint64)
    latest = np.full(n, np.inf)
    at = np.zeros(len(owner))
    arrival = 0
    while len(owner):
        arrival += 1
        r = mix(shingle + np.uint64(arrival * int(_STEP) & (2**64 - 1)))
        at = at - np.log(((r >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53) / weight
        live = at < latest[owner]
        owner, shingle, weight, at, r = owner[live], shingle[live], weight[live], at[live], r[live]
        if not len(owner):
            break
        slot = owner * REGISTERS + (r & np.uint64(REGISTERS - 1)).astype(np.int64)
        np.minimum.at(first, slot, at)
        won = at == first[slot]
        sign[slot[won]] = shingle[won]
        docs = owner[np.flatnonzero(np.diff(owner, prepend=-1))]
        latest[docs] = first.reshape(n, REGISTERS)[docs].max(1)
        live = at < latest[owner]
        owner, shingle, weight, at = owner[live], shingle[live], weight[live], at[live]
    return sign.reshape(n, REGISTERS)


def _bands(sign: np.ndarray) -> np.ndarray:
    parts = sign.reshape(len(sign), REGISTERS // ROWS, ROWS)
    h = np.arange(1, REGISTERS // ROWS + 1, dtype=np.uint64) * _STEP + np.zeros((len(sign), 1), np.uint64)
    for k in range(ROWS):
        h = mix(h ^ parts[:, :, k])
    return h.view(np.int64)


def _sign_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    hashes = WordHashes()
    for batch in batches:
        raw, off = bytes_of(as_array(batch.column(2)))
        rows, nodes, sets, size = [], [], [], 0

        def flush():
            owner = np.repeat(np.arange(len(sets)), [len(s) for s, _ in sets])
            sign = signatures(owner, np.concatenate([s for s, _ in sets]),
                              np.concatenate([w for _, w in sets]), len(sets))
            bands = _bands(sign)
            flat = pa.array(bands.ravel())
            lists = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, bands.shape[1], dtype=np.int32), flat)
            take = pa.array(rows)
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(nodes, pa.binary()), lists],
                ["doc_id", "doc_key", "node", "bands"])

        for i in range(batch.num_rows):
            words = _word_array(raw, off[i], off[i + 1], hashes)
            if not len(words):
                continue
            shingle, count = np.unique(_shingles(words), return_counts=True)
            rows.append(i)
            nodes.append(xxhash.xxh3_128_digest(words.tobytes()))
            sets.append((shingle, 1 + np.log(count)))
            size += len(shingle)
            if size > 500_000:
                yield flush()
                rows, nodes, sets, size = [], [], [], 0
        if rows:
            yield flush()


def sign_documents(docs: DataFrame) -> DataFrame:
    """doc_id, doc_key, node (hash of the words) and bands, of each text with a word."""
    slim = docs.select("doc_id", row_key("doc_id", "text").alias("doc_key"), "text")
    return slim.mapInArrow(given_back(_sign_batches), "doc_id long, doc_key long, node binary, bands array<long>")


def _shingle_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingle set of each node, and its parity: PARITY bits, one of which
    is flipped for every shingle."""
    hashes = WordHashes()
    for batch in batches:
        raw, off = bytes_of(as_array(batch.column(1)))
        for i in range(0, batch.num_rows, 200):
            sets = [np.unique(_shingles(_word_array(raw, off[j], off[j + 1], hashes)))
                    for j in range(i, min(batch.num_rows, i + 200))]
            ends = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
            parity = [np.packbits(np.bincount((s >> np.uint64(8)).astype(np.int64) % PARITY, minlength=PARITY) & 1 == 1)
                      for s in sets]
            words = np.concatenate(parity).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, len(sets)),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sets).view(np.int64))),
                 pa.ListArray.from_arrays(np.arange(0, len(words) + 1, PARITY // 64, dtype=np.int32), pa.array(words))],
                ["node", "shingles", "parity"])


def _may_be_similar(a: str, b: str) -> Column:
    """Necessary for a Jaccard of 0.8, from n and parity of both: the differing
    bits are no more than the shingles that only one of them may have."""
    apart = " + ".join(f"bit_count({a}.parity[{k}] ^ {b}.parity[{k}])" for k in range(PARITY // 64))
    up, down = THRESHOLD
    return F.expr(f"{up} * {a}.n <= {down} * {b}.n AND {up} * {b}.n <= {down} * {a}.n "
                  f"AND {up + down} * ({apart}) <= {down - up} * ({a}.n + {b}.n)")


def _similar(pairs: DataFrame, facts: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (a, b), those whose shingle sets have a Jaccard of 0.8 or more.
    Only pairs that pass the bound of their parities are compared in full."""
    up, down = THRESHOLD
    x, y = facts.alias("x"), facts.alias("y")
    likely = pairs.join(x, F.col("a") == F.col("x.node")).join(
        y, (F.col("b") == F.col("y.node")) & _may_be_similar("x", "y")).select("a", "b")
    both = F.size(F.array_intersect("x", "y"))
    return (likely.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
            .where(down * both >= up * (F.size("x") + F.size("y") - both)).select("a", "b"))


def components(edges: DataFrame) -> DataFrame:
    """node, label: the least node of each connected component, for the nodes of
    edges (a, b). Labels spread along edges and double along their own chains;
    every step is written to the shared folder."""
    both = written(edges.select(F.col("a").alias("src"), F.col("b").alias("dst"))
                   .union(edges.select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy(F.col("src").alias("node")).agg(
        F.least(F.col("src"), F.min("dst")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "dst"), "dst").groupBy(F.col("src").alias("node")) \
            .agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("beyond"))
        moved = written(step.join(jump, "next").select(
            "node", F.least("next", "beyond").alias("label"), (F.col("label") != F.least("next", "beyond")).alias("moved")),
            "labels")
        discard(labels)
        labels = moved.select("node", "label")
        labels._llm_path = moved._llm_path
        if moved.where("moved").isEmpty():
            discard(both)
            return labels


def joined(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """node, label of the graph behind labels with more edges (a, b). What is known is
    not walked again: each component is one node, and only edges between different
    ones are left to spread along."""
    a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    between = written(edges.join(a, "a", "left").join(b, "b", "left").select(
        F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).where("a != b").distinct(), "between")
    if between.isEmpty():
        discard(between)
        return labels
    merged = components(between)
    discard(between)
    of = merged.select(F.col("node").alias("label"), F.col("label").alias("least"))
    out = written(labels.join(of, "label", "left").select("node", F.coalesce("least", "label").alias("label"))
                  .union(merged.join(labels, "node", "left_anti").select("node", "label")), "labels")
    for old in (labels, merged):
        discard(old)
    return out


def link_documents(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signed, links, labels): the signed documents with their nodes; the
    verified pairs of nodes; the component label of each node that has a link."""
    signed = written(sign_documents(docs), "signatures")
    here = F.struct("doc_id", "doc_key")
    nodes = signed.groupBy("node").agg(F.min(F.struct("doc_id", "doc_key")).alias("rep"))
    reps = signed.join(nodes, "node").where(here == F.col("rep")).dropDuplicates(["node"])
    rows = reps.select("doc_id", "doc_key", "node", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    buckets = written(rows.join(shared, "band"), "buckets")
    members = buckets.select("doc_id", "doc_key", "node").distinct()
    texts = docs.select("doc_id", row_key("doc_id", "text").alias("doc_key"), "text").alias("d") \
        .join(members.alias("m"), F.expr("d.doc_key = m.doc_key AND d.doc_id <=> m.doc_id")) \
        .select("node", "text").dropDuplicates(["node"])
    sets = written(texts.mapInArrow(given_back(_shingle_batches), "node binary, shingles array<long>, parity array<long>"), "shingles")
    facts = sets.select("node", F.size("shingles").alias("n"), "parity")
    # a node whose bands are all in large buckets is close to the middle of its group
    sizes = buckets.groupBy("band").agg(F.count("*").alias("size"))
    middle = buckets.join(sizes, "band").groupBy("node").agg(F.sum("size").alias("middle"))
    buckets = written(buckets.select("band", "node").join(middle, "node"), "buckets")

    found, labels = [], None
    for _ in range(STARS):
        placed = buckets.withColumn("label", F.col("node")) if labels is None else _labelled(buckets, labels)
        if labels is not None:
            placed = placed.join(_largest(placed), "band")
        else:
            placed = placed.withColumn("largest", F.lit(None).cast("binary"))
        open_ = placed.where(F.col("largest").isNull() | (F.col("label") != F.col("largest")))
        lead = open_.groupBy("band").agg(F.max(F.struct("middle", "node", "label")).alias("lead"))
        star = placed.join(lead, "band").where(F.col("label") != F.col("lead.label")) \
            .select(F.col("node").alias("a"), F.col("lead.node").alias("b")).distinct()
        found.append(written(_similar(star, facts, sets), "links"))
        labels = components(found[-1]) if labels is None else joined(labels, found[-1])
    placed = _labelled(buckets, labels)
    placed = placed.join(_largest(placed), "band").join(facts, "node")
    x, y = placed.where("label != largest").alias("x"), placed.alias("y")
    rest = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.label") != F.col("y.label"))
                  & ((F.col("x.node") < F.col("y.node")) | (F.col("y.label") == F.col("y.largest")))
                  & _may_be_similar("x", "y")) \
        .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    found.append(written(_similar(rest, facts, sets), "links"))
    labels = joined(labels, found[-1])
    links = written(functools.reduce(DataFrame.union, found).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    for df in (*found, buckets, sets):
        discard(df)
    return signed, links, labels


def _labelled(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    return buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _largest(placed: DataFrame) -> DataFrame:
    """band, largest: the label with most nodes in each bucket that has several."""
    counts = placed.groupBy("band", "label").agg(F.count("*").alias("n"))
    return counts.groupBy("band").agg(F.max(F.struct("n", "label")).alias("most"), F.count("*").alias("labels")) \
        .where("labels > 1").select("band", F.col("most.label").alias("largest"))


def classify(docs: DataFrame) -> DataFrame:
    """One row per different (doc_id, text): doc_id, doc_key, class_id, n_links
    (verified links to other texts), class_size (documents), and leads (whether
    it is the first document of its class)."""
    signed, links, labels = link_documents(docs)
    degree = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node") \
        .agg(F.count("*").alias("n_links"))
    placed = signed.select("doc_id", "doc_key", "node").distinct() \
        .join(labels, "node", "left").join(degree, "node", "left") \
        .withColumn("label", F.coalesce("label", "node"))
    placed = written(placed, "placed")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc_key")
    classes = placed.groupBy("label").agg(F.min(first).alias("first"), F.count("*").alias("class_size"))
    in_class = placed.join(classes, "label").select(
        "doc_id", "doc_key", F.col("first.doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "class_size",
        (F.col("first.doc_key") == F.col("doc_key")).alias("leads"))
    alone = docs.select("doc_id", row_key("doc_id", "text").alias("doc_key"), "text") \
        .where(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))).select(
        "doc_id", "doc_key", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("leads")).distinct()
    return in_class.union(alone)


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each class, the first by doc_id; equal rows count as
    copies, so one of them stays. Texts without a word stay."""
    kept = written(classify(docs).where("leads").select(
        F.col("doc_id").alias("__id"), F.col("doc_key").alias("__key")), "kept")
    names = docs.columns
    packed = docs.select(F.struct(*[docs[c] for c in names]).alias("__row"), docs["doc_id"].alias("__own_id"),
                         row_key("doc_id", "text").alias("__own_key"))
    rows = packed.join(kept, F.expr("__own_key = __key AND __own_id <=> __id"))
    twice = docs.groupBy("doc_id", row_key("doc_id", "text")).agg(F.count("*").alias("n")).where("n > 1")
    if not twice.isEmpty():
        rows = rows.dropDuplicates(["__key", "__id"])
    return rows.select("__row.*")
