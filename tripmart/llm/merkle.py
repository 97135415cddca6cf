"""Merkle manifest of a dataset, and proofs of its rows by octopus multiproof.

A row's leaf is the SHA-256 of its fields, each with its length in front. The
leaves of a source, in order of doc_id, are the lowest level of the source's
tree; every ``FAN`` consecutive nodes have one parent, the SHA-256 of their
digests (hexadecimal text) joined. The sources' roots, in order of the source,
are the leaves of one more tree, whose root stands for the dataset.

``manifest`` numbers the leaves of every source (by ranges of the rows, so that a
source of any size is spread over many tasks) and writes the levels one by one,
each a sixteenth of the one below.

``verify`` proves any set of leaves against a manifest:

1. Leaves come in blocks of ``BLOCK`` consecutive places of one source. A block
   computes the least set of nodes that its leaves' paths need and that do not
   follow from those leaves (``missing``): the union of all its proofs.
2. These coordinates of all blocks are fetched in one join with the levels. A
   node near a root is wanted by many blocks, at most by those below its parent;
   such a node is there in as many copies as that number asks for, and blocks
   choose among the copies by their own number.
3. The path from a source's root to the root of all is the same for the whole
   source: it is made once a source, by the same two steps over the tree of the
   sources, and handed to the source's blocks, again by copies.
4. With what it fetched a block derives the interior nodes that its leaves share,
   each once, and expands every leaf's own proof from them. A leaf that is
   presented with another digest than the manifest's is folded up on its own.

Defined results: a null field is hashed as ``-``, so a null and an empty text
differ; a null source is a source of its own and comes first; rows with one doc_id
are in order of their digests, and equal rows stay as separate, equal leaves; a
null doc_id comes first in its source and is never tampered with; long texts are
hashed whole; an empty table has no leaves, no root and no rows; columns other
than the five fields take no part.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import as_array, discard, group_parts, numbered, placed, written

#: Children of a node.
FAN = 16
#: Leaves of a block: two levels of a tree.
BLOCK = FAN * FAN
#: A node is there in one copy for every so many blocks that may want it.
DEMAND = 512
#: Name of the tree whose leaves are the sources' roots.
TOP = ""
#: Added to the levels of that tree among the nodes that a block fetches.
TOP_LEVEL = 100

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


class Manifest(NamedTuple):
    """leaves: tree, n (leaves of the tree), idx, doc_id, leaf; nodes: tree, n
    (leaves of the tree), level, idx, digest, for every level of every tree;
    sources: tree, n (number of sources), idx, digest (subroot), root. ``scratch``
    are the tables behind them."""

    leaves: DataFrame
    nodes: DataFrame
    sources: DataFrame
    scratch: list[DataFrame]

    def discard(self) -> None:
        for df in self.scratch:
            discard(df)


def leaf_digest(text: Column | str = "text") -> Column:
    """Digest of a row's fields, with ``text`` in place of its text."""
    values = [F.col(f) for f in FIELDS[:-1]] + [F.col(text) if isinstance(text, str) else text]
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def tree_of(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s:"), source.cast("string")), F.lit("-"))


def _levels(leaves: DataFrame, scratch: list[DataFrame]) -> list[DataFrame]:
    """All levels over leaves (tree, n, idx, digest), with ``size``, the nodes of
    the tree on that level."""
    levels = [leaves.select("tree", "n", F.lit(0).alias("level"), "idx", "digest", F.col("n").alias("size"))]
    while True:
        below = levels[-1].filter(F.col("size") > 1)
        children = F.array_sort(F.collect_list(F.struct("idx", "digest")))  # at most FAN
        up = below.groupBy("tree", "n", "size", F.floor(F.col("idx") / FAN).alias("up")).agg(children.alias("children"))
        up = written(up.select(
            "tree", "n", F.lit(len(levels)).alias("level"), F.col("up").alias("idx"),
            F.sha2(F.array_join(F.col("children.digest"), ""), 256).alias("digest"),
            F.ceil(F.col("size") / FAN).alias("size")), "level")
        scratch.append(up)
        if up.isEmpty():
            return levels
        levels.append(up)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def manifest(docs: DataFrame, *more: Column) -> Manifest:
    """The manifest of a documents table; ``more`` are further columns that its
    leaves keep, computed from docs."""
    rows = docs.select(tree_of(F.col("source")).alias("tree"), F.col("source").cast("string").alias("source"),
                       F.col("doc_id").cast("long").alias("doc_id"), leaf_digest().alias("leaf"), *more)
    rows = placed(rows, ["tree"], ["doc_id", "leaf"], "leaves")
    leaves = numbered(rows, group_parts(rows, ["tree"]), ["tree"], ["doc_id", "leaf"]) \
        .withColumnRenamed("pos", "idx").withColumnRenamed("group_n", "n")
    leaves = written(leaves, "leaf-places")
    scratch = [rows, leaves]
    own = _levels(leaves.select("tree", "n", "idx", F.col("leaf").alias("digest")), scratch)
    names = leaves.filter(F.col("idx") == 0).select("tree", "source")
    subroots = _union(own).filter(F.col("size") == 1).join(names, "tree") \
        .select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "source", "digest")
    subroots = placed(subroots, ["tree"], ["source"], "subroots")
    sources = written(numbered(subroots, group_parts(subroots, ["tree"]), ["tree"], ["source"])
                      .withColumnRenamed("pos", "idx").withColumnRenamed("group_n", "n"), "sources")
    scratch += [subroots, sources]
    top = _levels(sources.select("tree", "n", "idx", "digest"), scratch)
    root = _union(top).filter(F.col("size") == 1).first()  # at most one row
    nodes = _union(own + top).select("tree", "n", "level", "idx", "digest")
    sources = sources.select(F.col("of").alias("tree"), "n", "idx", "digest",
                             F.lit(root["digest"] if root else None).cast("string").alias("root"))
    return Manifest(leaves.drop("source"), nodes, sources, scratch)


def missing(wanted: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """Per level of a tree of n leaves, the nodes that the paths of the wanted
    leaves (ascending, different) need and that do not follow from these."""
    out, at, level = [], wanted, 0
    while n > 1:
        up = np.unique(at // FAN)
        run = (up[:, None] * FAN + np.arange(FAN)).ravel()
        out.append((level, np.setdiff1d(run[run < n], at, assume_unique=True)))
        at, n, level = up, -(-n // FAN), level + 1
    return out


def _wanted_nodes(blocks: DataFrame) -> DataFrame:
    """blocks: tree, n, idx; per block the coordinates that it misses."""

    def run(table: pa.Table) -> pa.Table:
        tree, n = table["tree"][0].as_py(), table["n"][0].as_py()
        idx = np.unique(table["idx"].to_numpy())
        found = missing(idx, n)
        level = np.concatenate([np.full(len(x), k, np.int32) for k, x in found] or [np.empty(0, np.int32)])
        at = np.concatenate([x for _, x in found] or [np.empty(0, np.int64)])
        return pa.table({"tree": [tree] * len(at), "n": np.full(len(at), n), "level": level, "idx": at,
                         "block": np.full(len(at), int(idx[0]) // BLOCK)}, schema)

    schema = pa.schema([("tree", pa.string()), ("n", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()),
                        ("block", pa.int64())])
    return blocks.groupBy("tree", "block").applyInArrow(run, "tree string, n long, level int, idx long, block long")


def _copies(blocks: Column) -> Column:
    return F.ceil(blocks / F.lit(DEMAND))


def fetched(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """For every block of leaves (tree, n, idx, block) the nodes that it misses:
    tree, block, level, idx, digest. One join; a node is copied by the number of
    blocks below its parent."""
    below = F.least(F.pow(F.lit(float(FAN)), F.col("level") + 1), F.col("n").cast("double")) / BLOCK
    copies = F.greatest(_copies(below), F.lit(1)).cast("int")
    wanted = _wanted_nodes(leaves.select("tree", "n", "idx", "block")) \
        .select("tree", "level", "idx", "block", F.pmod("block", copies).cast("int").alias("copy"))
    there = nodes.select("tree", "level", "idx", "digest", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    got = wanted.join(there, ["tree", "level", "idx", "copy"])
    return got.select(*[F.col(c).alias(c) for c in ("tree", "block", "level", "idx", "digest")])


def source_paths(m: Manifest, trees: DataFrame) -> DataFrame:
    """Per source in trees: its place among the sources, their number, the root,
    and the nodes beside its path to the root."""
    own = m.sources.join(trees, "tree", "left_semi").select(
        F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "n", "idx", "digest", "root")
    own = own.withColumn("block", F.floor(F.col("idx") / BLOCK))
    fetch = fetched(own, m.nodes.filter(F.col("tree") == TOP))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        n = left["n"][0].as_py()
        idx = left["idx"].to_numpy()
        block = Block(n, idx, left["digest"].to_pylist(), _known(right))
        rows = {"tree": [], "level": [], "idx": [], "digest": []}
        for tree, place, root in zip(left["of"].to_pylist(), idx.tolist(), left["root"].to_pylist(), strict=True):
            for level, at, digest in [(-1, place, root), (-2, n, ""), *block.beside(place)]:
                for k, v in zip(rows, (tree, level, at, digest), strict=True):
                    rows[k].append(v)
        return pa.table(rows, schema)

    schema = pa.schema([("tree", pa.string()), ("level", pa.int32()), ("idx", pa.int64()), ("digest", pa.string())])
    return own.groupBy("tree", "block").cogroup(fetch.groupBy("tree", "block")).applyInArrow(
        run, "tree string, level int, idx long, digest string")


def _known(table: pa.Table, levels: range = range(TOP_LEVEL)) -> dict[tuple[int, int], str]:
    return {(k, i): d for k, i, d in zip(table["level"].to_pylist(), table["idx"].to_pylist(),
                                         table["digest"].to_pylist(), strict=True) if k in levels}


def digest_of(joined: str) -> str:
    return hashlib.sha256(joined.encode()).hexdigest()


class Block:
    """The part of a tree of n leaves that some of its leaves span: every run of
    siblings on their paths as one joined text, interior nodes derived from below
    once, the rest as fetched."""

    def __init__(self, n: int, idx: np.ndarray, digests: list[str], known: dict[tuple[int, int], str]):
        at = dict(zip(idx.tolist(), digests, strict=True))
        self.runs: list[dict[int, str]] = []
        level = 0
        while n > 1:
            runs = {}
            for up in sorted({i // FAN for i in at}):
                members = range(up * FAN, min((up + 1) * FAN, n))
                runs[up] = "".join(at[i] if i in at else known[level, i] for i in members)
            self.runs.append(runs)
            at = {up: digest_of(joined) for up, joined in runs.items()}
            n, level = -(-n // FAN), level + 1
        self.root = at[0]
        self._above: dict[int, str] = {}

    def _beside(self, level: int, i: int) -> str:
        run, k = self.runs[level][i // FAN], 64 * (i % FAN)
        return run[:k] + run[k + 64:]

    def above(self, up: int) -> str:
        """The siblings of a node of level 1 and of all above it, joined."""
        if up not in self._above:
            parts, i = [], up
            for level in range(1, len(self.runs)):
                parts.append(self._beside(level, i))
                i //= FAN
            self._above[up] = "".join(parts)
        return self._above[up]

    def proof(self, i: int) -> str:
        """The siblings of leaf i and of the nodes above it, joined."""
        return self._beside(0, i) + self.above(i // FAN) if self.runs else ""

    def beside(self, i: int):
        """The same as (level, index, digest)."""
        for level, runs in enumerate(self.runs):
            run, first = runs[i // FAN], i // FAN * FAN
            for k in range(len(run) // 64):
                if first + k != i:
                    yield level, first + k, run[64 * k:64 * k + 64]
            i //= FAN

    def fold(self, i: int, digest: str) -> str:
        """The root that follows from another digest of leaf i and its siblings."""
        for runs in self.runs:
            run, k = runs[i // FAN], 64 * (i % FAN)
            digest = digest_of(run[:k] + digest + run[k + 64:])
            i //= FAN
        return digest


def verify(m: Manifest, leaves: DataFrame) -> DataFrame:
    """Proofs of the given leaves (rows of m.leaves, any subset, with ``presented``:
    the digest to be proved): doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified."""
    leaves = leaves.select("tree", "n", "idx", "doc_id", "leaf", "presented",
                           F.floor(F.col("idx") / BLOCK).alias("block"))
    own = m.nodes.filter(F.col("tree") != TOP)
    blocks = leaves.select("tree", "n", "block").distinct()
    copies = F.greatest(_copies(F.col("n") / BLOCK), F.lit(1)).cast("int")
    trees = blocks.select("tree", "n").distinct()
    paths = source_paths(m, trees.select("tree")).join(trees, "tree").select(
        "tree", (F.col("level") + TOP_LEVEL).cast("int").alias("level"), "idx", "digest",
        F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    to_root = blocks.withColumn("copy", F.pmod("block", copies).cast("int")).join(paths, ["tree", "copy"]) \
        .select("tree", "block", "level", "idx", "digest")
    fetch = fetched(leaves, own).unionByName(to_root)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        idx = left["idx"].to_numpy()
        leaf, presented = left["leaf"].to_pylist(), left["presented"].to_pylist()
        block = Block(left["n"][0].as_py(), idx, leaf, _known(right))
        top = _known(right, range(TOP_LEVEL - 2, 2 * TOP_LEVEL))
        place, root = next((i, d) for (k, i), d in top.items() if k == TOP_LEVEL - 1)
        n_sources = next(i for k, i in top if k == TOP_LEVEL - 2)
        path = Block(n_sources, np.array([place]), [block.root],
                     {(k - TOP_LEVEL, i): d for (k, i), d in top.items() if k >= TOP_LEVEL})
        to_top = path.proof(place)
        proofs = [digest_of(block.proof(i) + to_top) for i in idx.tolist()]
        folded = [path.root if a == b else path.fold(place, block.fold(i, b))
                  for i, a, b in zip(idx.tolist(), leaf, presented, strict=True)]
        size = len(leaf)
        return pa.table([as_array(left["doc_id"]), as_array(left["leaf"]), [block.root] * size, [root] * size, proofs,
                         folded, [x == root for x in folded]], schema=schema)

    schema = pa.schema([("doc_id", pa.int64())] + [(c, pa.string()) for c in (
        "leaf", "subroot", "root", "proof_sha256", "folded_root")] + [("verified", pa.bool_())])
    return leaves.groupBy("tree", "block").cogroup(fetch.groupBy("tree", "block")).applyInArrow(
        run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
             "verified boolean")


def tampered_leaf() -> Column:
    """The leaf of the row with the A-Z of its text in lower case."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return leaf_digest(lower)


def audit(docs: DataFrame) -> DataFrame:
    """Every row proved against the manifest of the table, after those rows are
    tampered with whose crc32 of the id is divisible by 5."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    presented = F.when(chosen, tampered_leaf()).otherwise(leaf_digest()).alias("presented")
    m = manifest(docs, presented)
    out = written(verify(m, m.leaves), "proofs")
    m.discard()
    return out
