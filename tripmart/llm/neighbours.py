"""Nearest neighbours by inner product: a forest of hash-prefix trees.

1. **Classes.** Equal vectors are one class, with the smallest ids of its rows (as
   many as an answer can hold); everything below works on the different vectors.
2. **Directions.** A vector v gets one more component, sqrt(1 - |v|^2 / m^2) with m
   the largest norm, and is divided by m, so that the angle to a query (divided by
   its norm, with a zero there) orders vectors as the inner product does. For
   vectors of one length the added component is zero.
3. **Hash strings.** Each of ``trees`` trees writes a vector as ``digits`` digits of
   five bits: the largest of 16 randomly turned coordinates, and its sign. A tree is
   the sorted array of these strings: the vectors that share a prefix are an interval
   of it.
4. **Descent and synchronous ascent.** The length of the prefixes, per query: the
   longest at which the intervals of all trees together hold at least ``wanted``
   vectors. The sizes of the intervals come from counts by prefix, taken in strides
   of eight bits as far down as a prefix still has a relevant share of ``wanted``.
5. **wanted** is fitted on a sample of ``sample`` queries (chosen by hash): they are
   compared with all vectors, and wanted is the least number at which the share of
   their true neighbours that lie in their intervals is at least ``recall``.
6. **Search.** A tree's array is cut into blocks of about ``block`` rows at quantiles
   of the strings; a string that fills more than one block is dealt over these by
   the vector. A row holds the vector in half precision with its scale. Queries go to
   the blocks that their intervals meet, and each block multiplies its rows with its
   queries and returns a query's best, with every row that the rounding could have
   put below them. No pair leaves a block but those.
7. The best of all blocks and trees are scored again on the original vectors in
   double precision, and the classes are opened to ids.

Only the choice of candidates is approximate: every vector is in every tree, and
nothing is cut off beyond the number of neighbours asked for.

Defined results: a vector that is null, empty, zero or holds a null or a number that
is not finite takes no part, nor does a row without an id; a shorter vector counts as
filled up with zeros; equal rows (id and vector) count once; with one id on several
vectors each of them is a query and none of them a neighbour of the others; fewer
vectors than neighbours asked for: all of them; empty tables give no rows; other
columns take no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import as_array, discard, written

#: Coordinates behind a digit; with the sign a digit has five bits.
TURNED = 16
DIGIT_BITS = 5
#: Bits of a stride of the prefix counts.
STRIDE = 8


@dataclass(frozen=True)
class Forest:
    """Parameters of the forest. max_blocks bounds the quantiles of one tree that
    every task gets; beyond it blocks grow."""

    trees: int = 16
    digits: int = 8
    recall: float = 0.93
    sample: int = 96
    block: int = 2048
    max_blocks: int = 16_384
    seed: int = 11

    @property
    def bits(self) -> int:
        return self.digits * DIGIT_BITS

    def turns(self, size: int) -> np.ndarray:
        """Per tree and digit, directions at right angles: (size, trees x digits x
        turned)."""
        rng = np.random.default_rng(self.seed)
        n = min(TURNED, size)
        return np.concatenate([np.linalg.qr(rng.standard_normal((size, n)))[0]
                               for _ in range(self.trees * self.digits)], axis=1).astype(np.float32)

    def strings(self, directions: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """(n, trees) strings, as integers of ``bits`` bits, of (n, size) unit vectors."""
        out = np.zeros((len(directions), self.trees), np.int64)
        n = turns.shape[1] // (self.trees * self.digits)
        for at in range(0, len(directions), 4096):
            d = directions[at:at + 4096].astype(np.float32)
            for t in range(self.trees):
                for k in range(self.digits):
                    first = (t * self.digits + k) * n
                    y = d @ turns[:, first:first + n]
                    best = np.abs(y).argmax(axis=1)
                    digit = 2 * best + (y[np.arange(len(y)), best] > 0)
                    out[at:at + 4096, t] = out[at:at + 4096, t] << DIGIT_BITS | digit
        return out


def valid(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    v = F.transform(F.col(embedding), lambda x: x.cast("double"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite
                       & F.exists("vector", lambda x: x != 0))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of a column of lists as a matrix; shorter ones are filled up with zeros."""
    column = as_array(column)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == size).all():
        return flat.reshape(-1, size)
    out = np.zeros((len(lengths), size))
    out[np.arange(size) < lengths[:, None]] = flat
    return out


def classes(rows: DataFrame, k: int) -> DataFrame:
    """vec_id and vector to one row per different vector: cls (128 bits of its
    SHA-256), vector, and the k + 1 smallest ids."""
    # trailing zeros and the sign of a zero make no other vector
    last = F.array_max(F.transform("vector", lambda x, i: F.when(x != 0, i + 1).otherwise(0)))
    rows = rows.withColumn("vector", F.transform(F.slice("vector", F.lit(1), last), lambda x: x + F.lit(0.0)))
    rows = rows.withColumn("cls", F.substring(F.sha2(F.to_json(F.struct("vector")), 256), 1, 32))
    ids = rows.select("cls", "vec_id").distinct().withColumn(
        "place", F.row_number().over(Window.partitionBy("cls").orderBy("vec_id"))).filter(F.col("place") <= k + 1) \
        .groupBy("cls").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    # a class's vectors are equal: any of them, one for each task before the shuffle
    return rows.dropDuplicates(["cls"]).select("cls", "vector").join(ids, "cls")


class Index:
    """The classes of a table and their strings, written; and the sizes that the
    search needs."""

    def __init__(self, vectors: DataFrame, queries: Column, k: int, forest: Forest):
        self.forest, self.k, self.scratch = forest, k, []
        rows = valid(vectors)
        asked = written(rows.filter(queries).select("vec_id", "vector"), "ann-queries")
        found = written(classes(rows, k), "ann-classes")
        norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
        self.n, self.norm, self.size = found.agg(F.count(F.lit(1)), F.max(norm), F.max(F.size("vector"))).first()
        self.scratch += [asked, found]
        self.classes = found
        if not self.n:
            return
        self.strings = written(found.mapInArrow(self._hashed(), self.SCHEMA), "ann-strings")
        self.scratch.append(self.strings)
        last = F.array_max(F.transform("vector", lambda x, i: F.when(x != 0, i + 1).otherwise(0)))
        key = asked.withColumn("vector", F.transform(F.slice("vector", F.lit(1), last), lambda x: x + F.lit(0.0)))
        self.queries = written(key.select(
            "vec_id", F.substring(F.sha2(F.to_json(F.struct("vector")), 256), 1, 32).alias("cls")).distinct(), "ann-asked")
        self.scratch.append(self.queries)

    SCHEMA = "cls string, vector array<double>, strings array<long>, query_strings array<long>"

    def _hashed(self):
        forest, size, norm = self.forest, self.size, self.norm
        schema = pa.schema([("cls", pa.string()), ("vector", pa.list_(pa.float64())), ("strings", pa.list_(pa.int64())),
                            ("query_strings", pa.list_(pa.int64()))])

        def run(batches):
            turns = forest.turns(size + 1)
            for batch in batches:
                v = _matrix(batch.column("vector"), size)
                scaled = v / norm
                rest = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1)))
                rest[rest < 1e-6] = 0
                data = forest.strings(np.column_stack([scaled, rest]), turns)
                own = v / np.abs(v).max(axis=1, keepdims=True)
                own /= np.sqrt((own * own).sum(axis=1, keepdims=True))
                asked = forest.strings(np.column_stack([own, np.zeros(len(v))]), turns)
                yield pa.record_batch([batch.column("cls"), batch.column("vector"), pa.array(list(data), schema.field(2).type),
                                       pa.array(list(asked), schema.field(3).type)], schema=schema)

        return run

    def asked(self) -> DataFrame:
        """cls, vector and query_strings of the different queries."""
        return self.strings.join(self.queries.select("cls").distinct(), "cls", "left_semi") \
            .select("cls", "vector", "query_strings")

    def discard(self) -> None:
        for df in self.scratch:
            discard(df)


def _shared_bits(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Length of the common prefix of strings of so many bits."""
    x = a ^ b
    # exact: strings have fewer bits than a double's fraction
    return np.where(x == 0, bits, bits - np.frexp(x.astype(np.float64))[1])


def _best(scores: np.ndarray, k: int, slack: np.ndarray | float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k largest finite scores and all within slack of
    the last of them."""
    if scores.shape[1] > k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    else:
        least = np.full(len(scores), -np.inf)
    return np.nonzero((scores >= (least - slack)[:, None]) & (scores > -np.inf))


def fit(index: Index) -> int:
    """The number of vectors (counted once a tree) that a query's intervals must
    hold together."""
    forest, k, size = index.forest, index.k, index.size
    trees, bits = forest.trees, forest.bits
    chosen = index.asked().orderBy(F.xxhash64("cls"), "cls").limit(forest.sample).collect()
    least = trees * (k + 1)
    if not chosen:
        return least
    names = [r["cls"] for r in chosen]
    q = np.zeros((len(chosen), size))
    for row, r in zip(q, chosen, strict=True):
        row[:len(r["vector"])] = r["vector"]
    q_strings = np.array([r["query_strings"] for r in chosen], np.int64)
    counted = pa.schema([("q", pa.int32()), ("at", pa.int32()), ("score", pa.float64()), ("n", pa.int64())])

    def run(batches):
        """Rows without a score count the strings by shared length; the others are
        a query's best rows and the longest prefix shared in any tree."""
        count = np.zeros((len(q), bits + 1), np.int64)
        for batch in batches:
            v = _matrix(batch.column("vector"), size)
            s = np.vstack(batch.column("strings").to_numpy(zero_copy_only=False))
            longest = np.zeros((len(q), len(v)), np.int64)
            for t in range(trees):
                shared = _shared_bits(q_strings[:, t, None], s[None, :, t], bits)
                np.maximum(longest, shared, out=longest)
                for i in range(len(q)):
                    count[i] += np.bincount(shared[i], minlength=bits + 1)
            scores = q @ v.T
            own = {c: i for i, c in enumerate(names)}
            for j, c in enumerate(batch.column("cls").to_pylist()):
                if c in own:
                    scores[own[c], j] = -np.inf
            row, col = _best(scores, k)
            yield pa.record_batch([row.astype(np.int32), longest[row, col].astype(np.int32), scores[row, col],
                                   np.zeros(len(row), np.int64)], schema=counted)
        row, at = np.nonzero(count)
        yield pa.record_batch([row.astype(np.int32), at.astype(np.int32), pa.nulls(len(row), pa.float64()), count[row, at]],
                              schema=counted)

    rows = index.strings.select("cls", "vector", "strings").mapInArrow(run, "q int, at int, score double, n long")
    rows = written(rows, "ann-sample")
    index.scratch.append(rows)
    counts = np.zeros((len(q), bits + 1), np.int64)
    for r in rows.filter("score IS NULL").groupBy("q", "at").agg(F.sum("n").alias("n")).collect():
        counts[r["q"], r["at"]] = r["n"]
    within = counts[:, ::-1].cumsum(axis=1)[:, ::-1]  # vectors that share at least so many bits
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.desc("at"))
    true = [[] for _ in q]
    for r in rows.filter("score IS NOT NULL").withColumn("place", F.row_number().over(best)) \
            .filter(F.col("place") <= k).collect():
        true[r["q"]].append(r["at"])
    # wanted w puts query i at the longest prefix with within[i] >= w: a neighbour
    # that shares b bits is found as long as w > within[i][b + 1]
    starts = np.array(sorted((int(within[i, b + 1]) + 1 if b < bits else 1) for i, found in enumerate(true) for b in found))
    if not len(starts):
        return least
    return max(least, int(starts[min(len(starts) - 1, int(np.ceil(forest.recall * len(starts))) - 1)]))


def _tree_strings(strings: DataFrame, column: str, *more: str) -> DataFrame:
    return strings.select(*more, F.posexplode(column).alias("tree", "string"))


def prefix_counts(index: Index, wanted: int) -> DataFrame:
    """tree, length, prefix, n: how many vectors share a prefix, for the prefixes
    of at least wanted / (4 trees) vectors and their extensions by one stride."""
    forest = index.forest
    rows, out, length = _tree_strings(index.strings, "strings"), None, 0
    enough = max(2, wanted // (4 * forest.trees))
    heavy = None
    while length < forest.bits:
        step = min(STRIDE, forest.bits - length)
        low = forest.bits - length - step
        cells = rows.select("tree", F.shiftright("string", low).alias("cell"))
        if heavy is not None:
            cells = cells.withColumn("prefix", F.shiftright("cell", step)).join(heavy, ["tree", "prefix"], "left_semi")
        cells = cells.groupBy("tree", "cell").agg(F.count(F.lit(1)).alias("n"))
        levels = cells.select("tree", "n", "cell", F.explode(F.sequence(F.lit(1), F.lit(step))).alias("i")) \
            .groupBy("tree", (F.col("i") + length).alias("length"),
                     F.expr(f"shiftright(cell, {step} - i)").alias("prefix")).agg(F.sum("n").alias("n"))
        levels = written(levels, "ann-prefixes")
        index.scratch.append(levels)
        out = levels if out is None else out.unionByName(levels)
        length += step
        heavy = levels.filter((F.col("length") == length) & (F.col("n") >= enough)).select("tree", "prefix")
        if heavy.isEmpty():
            break
    return out


def intervals(index: Index, wanted: int) -> DataFrame:
    """Per different query: cls, vector, query_strings and length, that of the
    prefixes on which its intervals hold at least wanted vectors."""
    asked, bits, trees = index.asked(), index.forest.bits, index.forest.trees
    counts = prefix_counts(index, wanted)
    deepest = counts.agg(F.max("length")).first()[0]
    paths = _tree_strings(asked, "query_strings", "cls").select(
        "cls", "tree", "string", F.explode(F.sequence(F.lit(1), F.lit(deepest))).alias("length"))
    paths = paths.select("cls", "tree", "length", F.expr(f"shiftright(string, {bits} - length)").alias("prefix"))
    longest = paths.join(counts, ["tree", "length", "prefix"]).groupBy("cls", "length").agg(F.sum("n").alias("n")) \
        .filter(F.col("n") >= wanted).groupBy("cls").agg(F.max("length").alias("length"))
    return asked.join(longest, "cls", "left").na.fill(0, ["length"])


def quantiles(index: Index) -> np.ndarray:
    """(trees, cuts): the strings at which a tree's array is cut into blocks."""
    forest = index.forest
    blocks = max(1, min(forest.max_blocks, -(-index.n // forest.block)))
    if blocks == 1:
        return np.empty((forest.trees, 0), np.int64)
    at = [i / blocks for i in range(1, blocks)]
    rows = _tree_strings(index.strings, "strings").groupBy("tree").agg(
        F.percentile_approx("string", at, max(10_000, 20 * blocks)).alias("cuts")).collect()
    return np.array([r["cuts"] for r in sorted(rows, key=lambda r: r["tree"])], np.int64)


def search(index: Index, wanted: int) -> DataFrame:
    """cls (the query's), near (another class or its own) and score, rounded: for
    every query at least the k + 1 best of all vectors in its intervals."""
    forest, size, k = index.forest, index.size, index.k
    bits, trees, cuts = forest.bits, forest.trees, quantiles(index)
    width = cuts.shape[1] + 1
    asked = intervals(index, wanted)

    def rows_to_blocks(batches):
        for batch in batches:
            v = _matrix(batch.column("vector"), size)
            scale = np.abs(v).max(axis=1)
            half = (v / scale[:, None]).astype(np.float16)
            raw = pa.array([x.tobytes() for x in half], pa.binary())
            s = np.vstack(batch.column("strings").to_numpy(zero_copy_only=False))
            spread = np.array([int(c[:8], 16) for c in batch.column("cls").to_pylist()])
            for t in range(trees):
                first = np.searchsorted(cuts[t], s[:, t], "left")
                last = np.searchsorted(cuts[t], s[:, t], "right")
                yield pa.record_batch([(t * width + first + spread % (last - first + 1)).astype(np.int32), s[:, t],
                                       batch.column("cls"), scale, raw], schema=there)

    def queries_to_blocks(batches):
        for batch in batches:
            v = _matrix(batch.column("vector"), size)
            raw = pa.array([x.tobytes() for x in v], pa.binary())
            s = np.vstack(batch.column("query_strings").to_numpy(zero_copy_only=False))
            free = bits - batch.column("length").to_numpy()
            for t in range(trees):
                low = s[:, t] >> free << free
                high = low + (np.int64(1) << free) - 1
                first = np.searchsorted(cuts[t], low, "left")
                n = np.searchsorted(cuts[t], high, "right") - first + 1
                row = np.repeat(np.arange(len(s)), n)
                block = np.repeat(first - np.cumsum(n) + n, n) + np.arange(len(row))
                yield pa.record_batch([(t * width + block).astype(np.int32), low[row], high[row],
                                       batch.column("cls").take(row), raw.take(row)], schema=wants)

    def best(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return pa.table([[], [], [], []], schema=result)
        string = rows["string"].to_numpy()
        order = np.argsort(string, kind="stable")
        string, scale = string[order], rows["scale"].to_numpy()[order]
        half = np.frombuffer(b"".join(rows["half"].to_pylist()), np.float16).reshape(-1, size)[order]
        names = rows["cls"].to_numpy()[order]
        v = half.astype(np.float64) * scale[:, None]
        # how far the rounding can move a score: half a unit of 11 bits, and of the least exponent
        error = scale * (np.sqrt((half.astype(np.float64) ** 2).sum(axis=1)) * 2.0 ** -11 + size ** 0.5 * 2.0 ** -25)
        first = np.searchsorted(string, queries["low"].to_numpy(), "left")
        last = np.searchsorted(string, queries["high"].to_numpy(), "right")
        raw, asked_by = queries["vector"].to_pylist(), queries["cls"].to_numpy()
        out = []
        for at in range(0, len(raw), 256):
            q = np.frombuffer(b"".join(raw[at:at + 256]), np.float64).reshape(-1, size)
            norm = np.sqrt((q * q).sum(axis=1))
            scores = q @ v.T
            place = np.arange(len(v))
            scores[(place < first[at:at + 256, None]) | (place >= last[at:at + 256, None])] = -np.inf
            worst = norm * error.max() * (1 + 1e-9)
            row, col = _best(scores, k + 1, 2 * worst)
            out.append(pa.table([asked_by[at + row], names[col], scores[row, col], norm[row] * error[col] * (1 + 1e-9)],
                                schema=result))
        return pa.concat_tables(out)

    text, number, raw = pa.string(), pa.float64(), pa.binary()
    there = pa.schema([("block", pa.int32()), ("string", pa.int64()), ("cls", text), ("scale", number), ("half", raw)])
    wants = pa.schema([("block", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("cls", text), ("vector", raw)])
    result = pa.schema([("cls", text), ("near", text), ("score", number), ("error", number)])
    rows = index.strings.select("cls", "vector", "strings").mapInArrow(
        rows_to_blocks, "block int, string long, cls string, scale double, half binary")
    queries = asked.mapInArrow(queries_to_blocks, "block int, low long, high long, cls string, vector binary")
    found = rows.groupBy("block").cogroup(queries.groupBy("block")).applyInArrow(
        best, "cls string, near string, score double, error double")
    found = found.groupBy("cls", "near").agg(F.max("score").alias("score"), F.max("error").alias("error"))
    # at least k + 1 classes score no less than the (k + 1)-th least sure of them
    place = F.row_number().over(Window.partitionBy("cls").orderBy(F.desc(F.col("score") - F.col("error"))))
    sure = F.max(F.when(F.col("place") == k + 1, F.col("score") - F.col("error"))).over(Window.partitionBy("cls"))
    return found.withColumn("place", place).withColumn("sure", sure).filter(
        F.col("sure").isNull() | (F.col("score") + F.col("error") >= F.col("sure"))).select("cls", "near")


def nearest(vectors: DataFrame, queries: Column, k: int = 20, forest: Forest = Forest()) -> DataFrame:
    """For every row of vectors (vec_id, embedding) that ``queries`` holds for (a
    condition on vec_id), its k nearest of all other rows: query_id, rank, vec_id,
    score."""
    index = Index(vectors, queries, k, forest)
    if not index.n:
        index.discard()
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    wanted = fit(index)
    pairs = written(search(index, wanted), "ann-pairs")
    own = index.classes.select("cls", F.col("vector").alias("q"))
    near = index.classes.select(F.col("cls").alias("near"), "vector", "ids")
    product = F.aggregate(F.arrays_zip("q", "vector"), F.lit(0.0),
                          lambda a, x: a + F.coalesce(x["q"] * x["vector"], F.lit(0.0)))
    scored = pairs.join(near, "near").join(own, "cls").select("cls", product.alias("score"), "ids")
    # the k + 1 best ids of a class's best classes: one of them may be the query itself
    place = F.row_number().over(Window.partitionBy("cls").orderBy(F.desc("score"), F.col("ids")[0]))
    opened = scored.withColumn("place", place).filter(F.col("place") <= k + 1).select(
        "cls", "score", F.explode("ids").alias("vec_id"))
    listed = opened.groupBy("cls").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id")))
                                       .alias("found"))  # at most (k + 1)^2
    answers = index.queries.join(listed, "cls").select(F.col("vec_id").alias("query_id"), "found")
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = answers.select("query_id", F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"),
        (-F.col("x.less")).alias("score"))
    out = written(out, "ann-nearest")
    index.discard()
    discard(pairs)
    return out
