"""Prefix trie of conversations, built by van Emde Boas recursion.

A conversation is the sequence of its turns (role, text) in order of turn. A
node is a different sequence of first turns of any conversation; the conversations
that start with it are its members.

1. **Names.** A turn is hashed (120 bits of SHA-256) and mixed with its place; the
   name of a prefix is the XOR of its turns' hashes. So a name follows from the name
   of any shorter prefix and the turns between, in whatever order prefixes are cut.
2. **Pieces.** Sequences are dealt into pieces of ``PIECE`` turns, one row each, so
   that one conversation of any length is many rows. Where a conversation has more
   than one piece, the names at which its pieces start are found by the same dealing
   of its pieces into pieces of pieces, and so on: a factor of ``PIECE`` a round.
3. **Cut.** All different pieces (same start, same turns: counted, with their
   smallest member) are cut at half depth. The first halves, again only the different
   ones, make the upper trie; the rest, whose start is now the name of the cut
   prefix, the lower forests. Both go through the next round together: one
   combinable aggregate a round, until every row is one turn and is a node.
4. **Graft.** Totals go up in the opposite order. After the round of depth d every
   node has the total of its subtree inside its own part of d levels. A cut prefix
   then hands the total of the forest under it to the d nodes on its way up to the
   start of its part. Each round sends at most half as many totals as there are
   turns. Totals of later pieces are found in the trie of whole pieces, in the same
   way, and handed down once.

Every join is on names that are different on both sides, but for the one that looks
up a node's parent (many children, one parent): Spark's skew join splits it.

Defined results: rows without a conv_id take no part; a null role or text counts as
empty; turns with the same number are in the order of their hashes, repeated rows
are repeated turns; texts of any length are hashed whole; an empty table gives no
node, not even a root; other columns take no part.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import discard, group_parts, numbered, placed, written

#: Turns of a piece, a power of two.
PIECE = 64
#: Ids joined to one text in the list of a node's ends.
IDS = 512
WORD = r"[^\x20\x09-\x0D]+"
NAME = ["hi", "lo"]


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, hi, lo (120 bits of the turn's role and text) and words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    half = lambda at: F.conv(F.substring("digest", at, 15), 16, 10).cast("long")
    return rows.select("conv_id", "turn", half(1).alias("hi"), half(16).alias("lo"), "words")


class Sequences(NamedTuple):
    """turns: conv_id, position, hi, lo, words (hashes mixed with the position);
    conversations: conv_id, also of those without a turn."""

    turns: DataFrame
    conversations: DataFrame
    scratch: list[DataFrame]


def _mixed(rows: DataFrame) -> DataFrame:
    return rows.select("conv_id", "position", F.xxhash64("position", "hi", "lo").alias("hi"),
                       F.xxhash64(F.lit(7), "lo", "position", "hi").alias("lo"), "words")


def sequences(conversations: DataFrame, rebuilt: bool = False) -> Sequences:
    """The turns of every conversation in order. rebuilt: conversation c starts with
    the first h turns of conversation c - c % 20 (as many as it has), in place of its
    own first h turns; h is crc32(c) % 4."""
    rows = placed(turns(conversations), ["conv_id"], ["turn", *NAME], "turns")
    parts = group_parts(rows, ["conv_id"])
    order = ["turn", *NAME]
    if not rebuilt:
        all_turns = numbered(rows, parts, ["conv_id"], order).withColumnRenamed("pos", "position")
        return Sequences(_mixed(all_turns), parts.select("conv_id").distinct(), [rows])
    sizes = parts.groupBy("conv_id").agg(F.max("group_n").alias("size"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    convs = sizes.select("conv_id", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % 20).alias("base"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    convs = written(convs.join(bases, "base", "left").select(
        "conv_id", "h", "base", F.least("h", F.coalesce("base_size", F.lit(0))).alias("borrowed")), "conversations")
    ranked = written(numbered(rows, parts.join(convs, "conv_id"), ["conv_id"], order), "turn-places")
    own = ranked.filter(F.col("pos") >= F.col("h")).select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("borrowed")).alias("position"), *NAME, "words")
    first = ranked.filter((F.col("conv_id") % 20 == 0) & (F.col("pos") < 3)).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", *NAME, "words"))).alias("first"))  # at most three
    first = first.select(F.col("conv_id").alias("base"), "first")
    lent = convs.filter(F.col("borrowed") > 0).join(first, "base").select(
        "conv_id", F.explode(F.slice("first", F.lit(1), F.col("borrowed").cast("int"))).alias("t")) \
        .select("conv_id", F.col("t.pos").alias("position"), "t.hi", "t.lo", "t.words")
    return Sequences(_mixed(own.unionByName(lent)), convs.select("conv_id"), [rows, convs, ranked])


def _xor(start: Column, seg: Column, field: str) -> Column:
    return F.aggregate(seg, start, lambda a, x: a.bitwiseXOR(x[field]))


class Level(NamedTuple):
    """pieces: conv_id, piece, seg (turns, in order: hi, lo, words), hi, lo (the name
    at which it starts); above: the level of these pieces, if a conversation has
    more than one; size: the longest piece, as a power of two."""

    pieces: DataFrame
    above: Level | None
    size: int


def dealt(symbols: DataFrame, scratch: list[DataFrame]) -> Level:
    """symbols: conv_id, position, hi, lo, words."""
    pieces = written(symbols.groupBy("conv_id", F.floor(F.col("position") / PIECE).alias("piece")).agg(
        F.array_sort(F.collect_list(F.struct("position", *NAME, "words"))).alias("seg")), "pieces")  # at most PIECE
    scratch.append(pieces)
    most, longest = pieces.agg(F.max("piece"), F.max(F.size("seg"))).first()
    size = 1 << max(0, (longest or 1) - 1).bit_length()
    zero = F.lit(0).cast("long")
    if not most:
        return Level(pieces.select("conv_id", "piece", "seg", zero.alias("hi"), zero.alias("lo")), None, size)
    above = dealt(pieces.select("conv_id", F.col("piece").alias("position"), *[_xor(zero, F.col("seg"), c).alias(c)
                                                                              for c in NAME],
                                zero.alias("words")), scratch)
    starts = above.pieces.select("conv_id", "hi", "lo", "seg", F.explode(F.sequence(F.lit(1), F.size("seg"))).alias("i"))
    before = F.slice("seg", F.lit(1), F.col("i") - 1)
    starts = starts.select("conv_id", F.element_at("seg", F.col("i"))["position"].alias("piece"),
                           *[_xor(F.col(c), before, c).alias(c) for c in NAME])
    pieces = written(pieces.join(starts, ["conv_id", "piece"]), "piece-starts")
    scratch.append(pieces)
    return Level(pieces, above, size)


class Trie(NamedTuple):
    """parts: hi, lo, depth (the start), seg of one turn, first (smallest member),
    n (members). cuts, lowest first: hi, lo, seg of the first halves that have a
    rest."""

    parts: DataFrame
    cuts: list[DataFrame]


def cut(level: Level, scratch: list[DataFrame]) -> Trie:
    """The trie inside the pieces of a level: cut at half depth until every row is
    one turn."""
    turn = F.transform("seg", lambda x: F.struct(x["hi"].alias("hi"), x["lo"].alias("lo"), x["words"].alias("words")))
    rows = level.pieces.select("hi", "lo", (F.col("piece") * PIECE).alias("depth"), turn.alias("seg"),
                               F.col("conv_id").alias("first"), F.lit(1).cast("long").alias("n"))
    key = ["hi", "lo", "depth", "seg"]
    rows = written(rows.groupBy(*key).agg(F.min("first").alias("first"), F.sum("n").alias("n")), "trie")
    scratch.append(rows)
    half, cuts = level.size // 2, []
    while half:
        top = F.slice("seg", F.lit(1), F.lit(half))
        longer = rows.filter(F.size("seg") > half)
        rest = longer.select(*[_xor(F.col(c), top, c).alias(c) for c in NAME], (F.col("depth") + half).alias("depth"),
                             F.slice("seg", F.lit(half + 1), F.lit(half)).alias("seg"), "first", "n")
        cuts.insert(0, longer.select(*NAME, top.alias("seg")).distinct())
        rows = written(rows.withColumn("seg", top).unionByName(rest).groupBy(*key).agg(
            F.min("first").alias("first"), F.sum("n").alias("n")), "trie")
        scratch.append(rows)
        half //= 2
    return Trie(rows, cuts)


def _ends(parts: DataFrame, *more: Column | str) -> DataFrame:
    """Rows with the name at the end of their seg in hi and lo."""
    seg = F.col("seg")
    return parts.select(*[_xor(F.col(c), seg, c).alias(c) for c in NAME], *more)


def _up(rows: DataFrame, sums: list[str]) -> DataFrame:
    """Each row's sums for every node along its seg."""
    along = rows.select(*NAME, "seg", *sums, F.explode(F.sequence(F.lit(1), F.size("seg"))).alias("i"))
    return along.select(*[_xor(F.col(c), F.slice("seg", F.lit(1), F.col("i")), c).alias(c) for c in NAME], *sums)


def graft(level: Level, trie: Trie, values: DataFrame, sums: list[str], scratch: list[DataFrame]) -> DataFrame:
    """values: hi, lo and the amounts of every node of the trie. The same, summed
    over each node's subtree; the name (0, 0) stands for the root, without its own
    amounts."""
    total = [F.sum(s).alias(s) for s in sums]
    own = _ends(trie.parts, "depth", F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo")).join(values, NAME)
    below = own.groupBy(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo"), "depth").agg(*total)
    sent, step = [values], 2
    for cuts in trie.cuts:
        below = written(below, "below")
        scratch.append(below)
        ends = _ends(cuts, F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), "seg")
        given = written(ends.join(below, NAME).select(
            F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo"), (F.col("depth") - step // 2).alias("depth"), "seg",
            *sums), "given")
        scratch.append(given)
        sent.append(_up(given, sums))
        below = below.filter(F.col("depth") % step == 0).unionByName(given.drop("seg")).groupBy(*NAME, "depth").agg(*total)
        step *= 2
    if level.above:
        # what lies under the end of a whole piece, over all later pieces
        below = written(below, "below")
        scratch.append(below)
        whole = level.pieces.filter(F.size("seg") == PIECE)
        upper = cut(level.above, scratch)
        empty = _ends(upper.parts).select(*NAME)
        under = empty.join(below.drop("depth"), NAME, "left").na.fill(0, sums)
        full = graft(level.above, upper, under, sums, scratch)
        part = whole.select(*NAME, F.transform("seg", lambda x: F.struct(x["hi"].alias("hi"), x["lo"].alias("lo")))
                            .alias("seg")).distinct()
        ends = _ends(part, F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), "seg").join(full, NAME)
        sent.append(_up(ends.select(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo"), "seg", *sums), sums))
        root = full.filter((F.col("hi") == 0) & (F.col("lo") == 0))
        below = below.filter(F.col("depth") == 0).drop("depth").unionByName(root)
    else:
        below = below.drop("depth")
    for s in [below.filter((F.col("hi") == 0) & (F.col("lo") == 0)), *sent[1:]]:
        values = values.unionByName(s.select(*NAME, *sums))
    out = written(values.groupBy(*NAME).agg(*total), "totals")
    scratch.append(out)
    return out


def digests_of_ends(ends: DataFrame) -> DataFrame:
    """ends: hi, lo, conv_id. Per name the SHA-256 of its ids in ascending order,
    joined by commas. Ids are joined to texts of up to IDS in ranges of (name, id);
    a name's texts then go through one hash in order, a batch at a time."""

    def join(batches):
        name, first, ids = None, None, []

        def row():
            return pa.record_batch([[name[0]], [name[1]], [first], [",".join(map(str, ids))]], schema=joined)

        for batch in batches:
            for hi, lo, c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if ids and (name != (hi, lo) or len(ids) == IDS):
                    yield row()
                    ids = []
                if not ids:
                    name, first = (hi, lo), c
                ids.append(c)
        if ids:
            yield row()

    def batched(batches):
        rows = []
        for b in join(batches):
            rows.append(b)
            if len(rows) == 512:
                yield pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
                rows = []
        if rows:
            yield pa.Table.from_batches(rows).combine_chunks().to_batches()[0]

    def digest(batches):
        name, state = None, None
        for batch in batches:
            out = []
            for hi, lo, _, ids in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if name == (hi, lo):
                    state.update(b"," + ids.encode())
                    continue
                if name:
                    out.append((*name, state.hexdigest()))
                name, state = (hi, lo), hashlib.sha256(ids.encode())
            yield hashed(out)
        if name:
            yield hashed([(*name, state.hexdigest())])

    def hashed(rows):
        return pa.record_batch(list(map(list, zip(*rows, strict=True))) or [[], [], []], schema=done)

    long = pa.int64()
    joined = pa.schema([("hi", long), ("lo", long), ("first", long), ("ids", pa.string())])
    done = pa.schema([("hi", long), ("lo", long), ("ends_sha256", pa.string())])
    texts = ends.select(*NAME, "conv_id").repartitionByRange(*NAME, "conv_id").sortWithinPartitions(*NAME, "conv_id") \
        .mapInArrow(batched, "hi long, lo long, first long, ids string")
    return texts.repartition(*NAME).sortWithinPartitions(*NAME, "first").mapInArrow(
        digest, "hi long, lo long, ends_sha256 string")


def trie(conversations: DataFrame, rebuilt: bool = False) -> DataFrame:
    """Per node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256 and last_words (the words of its
    last turn)."""
    seqs = sequences(conversations, rebuilt)
    scratch = list(seqs.scratch)
    level = dealt(seqs.turns, scratch)
    built = cut(level, scratch)
    nodes = _ends(built.parts, F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), (F.col("depth") + 1).alias("depth"),
                  F.col("first").alias("conv_id"), F.col("n").alias("n_convs"), F.col("seg")[0]["words"].alias("last_words"))
    zero = F.lit(0).cast("long")
    root = seqs.conversations.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")) \
        .filter("n_convs > 0").select(zero.alias("hi"), zero.alias("lo"), zero.alias("depth"), "conv_id", "n_convs",
                                      zero.alias("last_words"))
    children = nodes.groupBy(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.unionByName(root, allowMissingColumns=True).join(children, NAME, "left").na.fill(0, ["n_children"])
    nodes = written(nodes, "nodes")
    sums = ["n_leaves", "saved_tokens"]
    values = nodes.select(*NAME, (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                          ((F.col("n_convs") - 1) * F.col("last_words")).alias("saved_tokens"))
    totals = graft(level, built, values, sums, scratch)
    lengths = seqs.turns.groupBy("conv_id").agg(F.bit_xor("hi").alias("hi"), F.bit_xor("lo").alias("lo"))
    ends = seqs.conversations.join(lengths, "conv_id", "left").na.fill(0, NAME)
    parents = nodes.select(F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(totals, NAME).join(digests_of_ends(ends), NAME, "left").join(parents, ["up_hi", "up_lo"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *sums,
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "last_words")
    out = written(out, "conversation-trie")
    for df in [*scratch, nodes]:
        discard(df)
    return out
