"""Benchmark decontamination by latent semantic retrieval.

Words are runs of characters other than white space, with ASCII letters in
lower case and punctuation taken out. A word of the benchmark has an id of its
own, every other word that of one of 2^14 hashed buckets, so each word of the
corpus has a weight and a place in the latent space. An item of more than 64
words counts as its passages of 64 words, 32 apart.

1. Each text's ids are written, once; the document frequencies of the ids are
   counted over all passages of all documents.
2. Randomised SVD of the TF-IDF matrix of the items and all passages of all
   documents: power iterations A'(A Q), each a Spark job over all of the ids, with
   only an ids x rank matrix coming back; they start at the items' own leading
   directions. Passages are folded in: their weights times the singular vectors,
   each over its singular value.
3. Cosine candidate search: windows of 8, 16, 32 and 64 words, a quarter of their
   width apart, are projected and multiplied with all items that are nearest to
   that width. Every window of every document meets every such item; what comes
   to cosine 0.45 or more is a candidate, whether or not it shares a word.
4. Candidates are verified in the region of one and a half times the item's
   words around the window: the longest common subsequence of words covers 60 %
   of the item and at least 8 words of it, and half of the item's answer (the
   third of its words with the highest idf) is there.

Items of fewer than 8 words are too short for a paraphrase to be told from chance:
they match where all their words follow each other (cosine, covered, answer: 1).

The benchmark is taken in blocks of ``block_items`` items, so what travels with
a pass is bounded; documents are mapped over with no shuffle, long texts in
blocks that share their edges. The ids of one block of items are on disk at a time.

Defined cases: null and empty texts match nothing; items that are null or have no
word match nothing; equal items are all reported; repeated rows each are; of equal
scores the first window's stay; an empty benchmark or an empty documents table gives
no row. Null doc_ids are kept. Columns beyond doc_id, item_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import as_array, bytes_of, discard, given_back, row_key, text_batches, text_blocks, written

PASSAGE = 64
WIDTHS = (8, 16, 32, 64)
COSINE = 0.45
COVER = 0.6
ANSWER = 0.5
RANK = 96
SHORT = 8
BUCKETS = 1 << 14
PART = 1 << 10
GATHER = 1 << 15
BLOCK = 1 << 17
PASSAGE_ROWS = 1 << 11
FREQUENT = 1 << 9
ROWS = 1 << 10
SCORES = 1 << 21

_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[65:91] += 32
_LOWER = _CLEAN.tobytes()
_PUNCTUATION = b".,;:!?\"'()[]{}*_-"


class _Ids(dict):
    """Ids of words, remembered for up to ``most`` of them: the benchmark's own,
    then the buckets of all others."""

    def __init__(self, vocabulary: dict[bytes, int], most: int = 300_000):
        import xxhash

        self.vocabulary, self.most, self.hash = vocabulary, most, xxhash.xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        x = self.vocabulary.get(word)
        if x is None:
            x = len(self.vocabulary) + self.hash(word) % BUCKETS
        self[word] = x
        return x


def _words(text: bytes) -> list[bytes]:
    return text.translate(_LOWER, _PUNCTUATION).split()


class _Clean:
    """Texts in lower case and without punctuation, as word ids."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.ids_of = _Ids(vocabulary)
        self.size = len(vocabulary) + BUCKETS

    def ids(self, text: bytes) -> np.ndarray:
        clean = _words(text)
        return np.fromiter(map(self.ids_of.__getitem__, clean), np.int32, len(clean))


def _passages(n: int, width: int, step: int) -> np.ndarray:
    """Starts of the windows over n words; the last one ends with the text."""
    if n <= width:
        return np.zeros(min(n, 1), np.int64)
    return np.unique(np.append(np.arange(0, n - width, step), n - width))


def common_subsequence(masks: dict[int, int], n: int, ids: list[int]) -> int:
    """Length of the longest common subsequence; masks: the places of each word
    of an item of n words, as bits."""
    full = rest = (1 << n) - 1
    for x in ids:
        hit = rest & masks.get(x, 0)
        if hit:
            rest = ((rest + hit) | (rest - hit)) & full
    return n - rest.bit_count()


def _tokenised(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Written: doc_id and ids (32-bit numbers) of each text with a word; and, in rows
    of their own, word and n, the passages that have each id (after the last id: all
    passages), as far as each task has counted them."""
    size = len(vocabulary) + BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clean = _Clean(vocabulary)
        have = np.zeros(size + 1, np.int64)
        n_passages = 0

        def out(doc_id: pa.Array, ids: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([doc_id, pa.array(ids, pa.binary()), pa.nulls(len(ids), pa.int32()),
                                               pa.nulls(len(ids), pa.int64())], ["doc_id", "ids", "word", "n"])

        for batch in batches:
            raw, off = bytes_of(as_array(batch.column(1)))
            rows, texts, n_bytes = [], [], 0
            for i in range(batch.num_rows):
                ids = [clean.ids(text).tobytes() for text in text_blocks(raw, off[i], off[i + 1])]
                ids = b"".join(ids)
                if ids:
                    rows.append(i)
                    texts.append(ids)
                    n_bytes += len(ids)
                if texts and (n_bytes >= 8 * GATHER or i == batch.num_rows - 1):
                    part = pa.array(texts, pa.binary())
                    for words in _passage_rows(part, size):
                        have += np.bincount(words[_firsts(words)], minlength=size + 1)
                        n_passages += len(words)
                    yield out(batch.column(0).take(pa.array(rows, pa.int64())), texts)
                    rows, texts, n_bytes = [], [], 0
        have[size] = n_passages
        word = np.flatnonzero(have)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(word), pa.int64()), pa.nulls(len(word), pa.binary()),
                                          pa.array(word, pa.int32()), pa.array(have[word])], ["doc_id", "ids", "word", "n"])

    return written(docs.select("doc_id", "text").mapInArrow(given_back(run), "doc_id long, ids binary, word int, n long"), "word-ids")


def _passage_rows(texts: pa.Array, pad: int) -> Iterator[np.ndarray]:
    """The passages of texts, given as their ids: PASSAGE_ROWS at a time, the words of
    each in order of id, ``pad`` after them."""
    raw, off = bytes_of(texts)
    ids = raw[off[0]:off[-1]].view(np.int32)
    start, n_words = (off[:-1] - off[0]) // 4, np.diff(off) // 4
    n = -(-n_words // PASSAGE)
    text = np.repeat(np.arange(len(n)), n)
    skipped = (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * PASSAGE
    first, left = start[text] + skipped, n_words[text] - skipped
    place = np.arange(PASSAGE)
    for at in range(0, len(text), PASSAGE_ROWS):
        words = ids[np.minimum(first[at:at + PASSAGE_ROWS, None] + place, len(ids) - 1)]
        words[place >= left[at:at + PASSAGE_ROWS, None]] = pad
        words.sort(axis=1)
        yield words


def _firsts(words: np.ndarray) -> np.ndarray:
    """Where the words of passages, in order of id, are the first of their id."""
    first = np.ones(words.shape, bool)
    np.not_equal(words[:, 1:], words[:, :-1], out=first[:, 1:])
    return first


def _frequencies(tokens: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Passages that have each id, and all passages."""
    have = np.zeros(size + 1, np.int64)
    for r in tokens.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")).collect():
        have[r["word"]] = r["n"]
    return have[:-1], int(have[-1])


def _directions(words: np.ndarray, idf: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(passages x rank, squared lengths): the TF-IDF rows of passages times q. idf and
    q, whose rows hold the idf already, have a row of zeros for the filling."""
    at = np.flatnonzero(_firsts(words))
    weight = np.diff(at, append=words.size) * idf[words.ravel()[at]]
    square = np.add.reduceat(weight * weight, np.searchsorted(at, np.arange(len(words)) * PASSAGE))
    out = np.zeros((len(words), q.shape[1]), q.dtype)
    for row in np.ascontiguousarray(words.T):
        out += np.take(q, row, axis=0, mode="clip")
    return out, np.maximum(square, 1e-24)


def _add_rows(total: np.ndarray, words: np.ndarray, rows: np.ndarray) -> None:
    """Add the row of each passage to total once for each of its words. Frequent words,
    which have the least ids, go in one product; of each other word the first places go
    in one step, then the second ones, and so on."""
    n = min(FREQUENT, len(total) - 1)
    counts = np.bincount((np.arange(len(words))[:, None] * (n + 1) + np.minimum(words, n)).ravel(),
                         minlength=len(words) * (n + 1)).reshape(len(words), n + 1)
    total[:n] += counts[:, :n].T.astype(rows.dtype) @ rows
    flat = words.ravel()
    rest = np.flatnonzero((flat >= n) & (flat < len(total) - 1))
    rest = rest[np.argsort(flat[rest].astype(np.uint16) if len(total) <= 1 << 16 else flat[rest], kind="stable")]
    if not len(rest):
        return
    word, passage = flat[rest], rest // PASSAGE
    first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    count = np.diff(first, append=len(word))
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    sums = np.zeros((len(first), rows.shape[1]), rows.dtype)
    for nth in range(count[0]):
        live = np.searchsorted(-count, -nth, "left")
        sums[:live] += np.take(rows, passage[first[:live] + nth], axis=0, mode="clip")
    total[word[first]] += sums


def _filled(x: np.ndarray) -> np.ndarray:
    """With a last row of zeros, for the filling of passages; row after row."""
    return np.ascontiguousarray(np.concatenate([x, np.zeros((1, *x.shape[1:]))]), np.float32)


def randomised_svd(rows: DataFrame, idf: np.ndarray, start: np.ndarray,
                   powers: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """ids x rank, rank: the leading right singular vectors of the TF-IDF rows of all
    passages (each scaled to length 1) of the texts, whose ids rows has, and the
    singular values, largest first. start: ids x rank, where the iterations start."""
    size, rank = start.shape
    by_idf = np.argsort(idf, kind="stable")  # the most frequent ids first
    renamed = np.append(np.argsort(by_idf, kind="stable"), size).astype(np.int32)
    weights = idf[by_idf]

    def times(q: np.ndarray, gram: bool) -> np.ndarray:
        shared = rows.sparkSession.sparkContext.broadcast(_filled(weights[:, None] * q))
        filled = _filled(weights)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q = shared.value
            total = np.zeros((rank, rank) if gram else q.shape)
            for batch in batches:
                for words in _passage_rows(as_array(batch.column(0)), size):
                    words = np.sort(renamed[words], axis=1)
                    y, square = _directions(words, filled, q)
                    if gram:
                        y /= np.sqrt(square)[:, None]
                        total += y.T @ y
                    else:
                        _add_rows(total, words, y / square[:, None].astype(q.dtype))
            if not gram:
                total = total[:-1] * weights[:, None]
            parts = [total[at:at + PART].astype(np.float32).tobytes() for at in range(0, len(total), PART)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())],
                                             ["at", "part"])

        def add(parts: pa.Table) -> pa.Table:
            out = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in parts["part"])
            return pa.table({"at": parts["at"][:1].cast(pa.int32()), "part": pa.array([out.tobytes()], pa.binary())})

        schema = "at int, part binary"
        parts = rows.mapInArrow(given_back(run), schema).groupBy("at").applyInArrow(add, schema).collect()
        shared.destroy()
        out = np.concatenate([np.frombuffer(r["part"]) for r in sorted(parts, key=lambda r: r["at"])])
        return out.reshape((rank, rank) if gram else q.shape)

    q = np.linalg.qr(start[by_idf])[0]
    for _ in range(powers):
        q = np.linalg.qr(times(q, gram=False))[0]
    value, turn = np.linalg.eigh(times(q, gram=True))
    order = np.argsort(-value)
    return (q @ turn[:, order])[renamed[:-1]], np.sqrt(np.maximum(value[order], 0.0))


def _start(passages: list[np.ndarray], idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """ids x rank: the range of the items' TF-IDF rows, and random directions in it for
    the ids that no item has."""
    rank = max(1, min(rank, len(idf)))
    out = np.linalg.qr(np.random.default_rng(11).standard_normal((len(idf), rank)))[0]
    filled = _filled(idf)
    texts = pa.array([p.astype(np.int32).tobytes() for p in passages], pa.binary())
    for _ in range(2):
        total = np.zeros((len(idf) + 1, rank))
        for words in _passage_rows(texts, len(idf)):
            y, square = _directions(words, filled, _filled(idf[:, None] * out))
            _add_rows(total, words, y / square[:, None])
        total = total[:-1] * idf[:, None]
        out = out + total * (math.sqrt(rank) / max(np.linalg.norm(total), 1e-12))
    return out


class Index:
    """The items of one block, ready to be looked up. project: ids x rank."""

    def __init__(self, item_ids: list, passages: list[np.ndarray], idf: np.ndarray, project: np.ndarray):
        self.item_ids = item_ids
        self.passages = [p.tolist() for p in passages]
        self.pad = len(idf)  # stands between texts and weighs nothing
        # row after row: from any other layout, each lookup would copy the whole matrix
        self.project = np.vstack([project, np.zeros(project.shape[1])]).astype(np.float32, order="C")
        self.masks, self.answers, self.short = [], [], {}
        for k, p in enumerate(self.passages):
            masks: dict[int, int] = {}
            for at, x in enumerate(p):
                masks[x] = masks.get(x, 0) | 1 << at
            self.masks.append(masks)
            rare = sorted(masks, key=lambda x: (-idf[x], x))
            self.answers.append(frozenset(rare[:max(1, len(rare) // 3)]))
            if len(p) < SHORT:
                self.short.setdefault(rare[0], []).append((k, p.index(rare[0])))
        # the passages that each word answers, word after word
        pairs = sorted((x, k) for k, answer in enumerate(self.answers) for x in answer)
        self.answered = np.array([k for _, k in pairs], np.int64)
        self.n_answered = np.bincount([x for x, _ in pairs], minlength=self.pad + 1)
        self.first_answered = np.cumsum(self.n_answered) - self.n_answered
        self.needed = np.array([max(1, math.ceil(ANSWER * len(a))) for a in self.answers])
        self.reach = np.array([-(-3 * len(p) // 4) for p in self.passages])
        self.rarest = np.zeros(self.pad + 1, bool)
        self.rarest[list(self.short)] = True
        vectors = np.array([self.project[p].sum(0) for p in self.passages])
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        long = np.array([len(p) for p in self.passages])
        nearest = np.array(WIDTHS)[np.abs(np.log(long[:, None] / np.array(WIDTHS))).argmin(1)]
        self.members = {w: np.flatnonzero((nearest == w) & (long >= SHORT)) for w in WIDTHS}
        self.members = {w: m for w, m in self.members.items() if len(m)}
        self.vectors = {w: np.ascontiguousarray(vectors[m].T) for w, m in self.members.items()}

    def _whole(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """(passage, place) of the short items whose words follow each other."""
        for place in np.flatnonzero(self.rarest[ids]).tolist() if self.short else ():
            for k, before in self.short[int(ids[place])]:
                p, start = self.passages[k], place - before
                if start >= 0 and ids[start:start + len(p)].tolist() == p:
                    yield k, place

    def _candidates(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(passages, middles of windows, cosines) of the windows near an item."""
        step = min(self.members) // 4
        sums = np.empty((len(ids) // step, self.project.shape[1]), np.float32)
        words = np.ascontiguousarray(ids.reshape(-1, step).T)
        for at in range(0, len(sums), ROWS):
            out = sums[at:at + ROWS]
            np.take(self.project, words[0, at:at + ROWS], axis=0, out=out, mode="clip")
            for row in words[1:]:
                out += np.take(self.project, row[at:at + ROWS], axis=0, mode="clip")
        for width, members in self.members.items():
            while step < width // 4:
                sums, step = sums[::2] + sums[1::2], 2 * step
            windows = sums[:-3] + sums[1:-2] + sums[2:-1] + sums[3:]
            length = np.sqrt(np.einsum("ij,ij->i", windows, windows))
            windows /= np.maximum(length, 1e-9)[:, None]
            rows = max(1, SCORES // len(members))
            for at in range(0, len(windows), rows):
                score = windows[at:at + rows] @ self.vectors[width]
                flat = np.flatnonzero(score >= COSINE)
                row, item = np.divmod(flat, len(members))
                yield members[item], (row + at) * step + width // 2, score.ravel()[flat]

    def _answers_near(self, ids: np.ndarray) -> np.ndarray:
        """Each place of a word that answers a passage, as passage x words + place, sorted."""
        place = np.flatnonzero(self.n_answered[ids])
        count = self.n_answered[ids[place]]
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        passage = self.answered[np.repeat(self.first_answered[ids[place]], count) + nth]
        return np.sort(passage * len(ids) + np.repeat(place, count))

    def search(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, float, float, float]]:
        """(text, passage, cosine, covered share, share of the answer) of each match."""
        # between two texts there is more than a window reaches
        gap, unit = WIDTHS[-1] * 3 // 4, WIDTHS[-1] // 4
        first = np.cumsum([gap] + [gap + -(-len(t) // unit) * unit for t in texts])
        ids = np.full(first[-1], self.pad, np.int32)
        for t, at in zip(texts, first, strict=False):
            ids[at:at + len(t)] = t
        last = first[:-1] + np.array([len(t) for t in texts], np.int64)
        for k, place in self._whole(ids):
            yield int(np.searchsorted(first, place, "right")) - 1, k, 1.0, 1.0, 1.0
        if not self.members:
            return
        near = self._answers_near(ids)
        for passages, middles, cosines in self._candidates(ids):
            # in the gap the nearer text is meant
            which = np.clip(np.searchsorted(first - gap // 2, middles, "right") - 1, 0, len(texts) - 1)
            start = np.maximum(first[which], middles - self.reach[passages])
            end = np.maximum(start, np.minimum(last[which], middles + self.reach[passages]))
            # places of the answer's words, repeated ones too: at least as many as different words
            places = np.searchsorted(near, passages * len(ids) + end) - np.searchsorted(near, passages * len(ids) + start)
            rest = np.flatnonzero(places >= self.needed[passages])
            for k, lo, hi, cosine, t in zip(*[x[rest].tolist() for x in (passages, start, end, cosines, which)],
                                            strict=True):
                p, answer = self.passages[k], self.answers[k]
                region = ids[lo:hi].tolist()
                found = len(answer.intersection(region)) / len(answer)
                if found < ANSWER:
                    continue
                covered = common_subsequence(self.masks[k], len(p), region)
                if covered >= max(math.ceil(COVER * len(p)), SHORT):
                    yield t, k, min(cosine, 1.0), covered / len(p), found


def contaminated(docs: DataFrame, benchmark: DataFrame, block_items: int = 5_000) -> DataFrame:
    """doc_id, item_id, cosine, covered, answer: the best match of each document
    and item that passes. docs and benchmark may have further columns."""
    schema = "doc_id long, item_id long, cosine double, covered double, answer double"
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    items = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("long"), "text")
    out = spark.createDataFrame([], schema)
    n_blocks = -(-items.count() // block_items)
    for block in range(n_blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block)
        with text_batches(spark):
            out = out.union(_search(docs, mine.collect(), schema))
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that hold an item; all columns stay as they are."""
    names = docs.columns
    # a document is told by its text here, which is what is searched
    keyed = docs.select("text", row_key("text").alias("doc_id"))
    leaks = written(contaminated(keyed, benchmark).select(F.col("doc_id").alias("__leak")).distinct(), "leaks")
    packed = docs.select(F.struct(*[docs[c] for c in names]).alias("__row"), row_key("text").alias("__key"))
    return packed.join(leaks, F.col("__key") == F.col("__leak"), "left_anti").select("__row.*")


def _search(docs: DataFrame, items: list, schema: str) -> DataFrame:
    spark = docs.sparkSession
    listed = [(r["item_id"], _words(r["text"].encode())) for r in items]
    listed = sorted(((k, w) for k, w in listed if w), key=lambda x: (x[0] is None, x))
    if not listed:
        return spark.createDataFrame([], schema)
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, words in listed for w in words}))}
    item_ids, passages = [], []
    for k, words in listed:
        ids = np.array([vocabulary[w] for w in words], np.int32)
        for at in _passages(len(ids), PASSAGE, PASSAGE // 2):
            item_ids.append(k)
            passages.append(ids[at:at + PASSAGE])
    tokens = _tokenised(docs, vocabulary)
    have, n = _frequencies(tokens, len(vocabulary) + BUCKETS)
    idf = np.log((n + 1) / (have + 1)) + 0.01
    texts = tokens.where("ids IS NOT NULL").select("doc_id", "ids")
    own = spark.createDataFrame([(p.tobytes(),) for p in passages], "ids binary")
    basis, values = randomised_svd(texts.select("ids").union(own.coalesce(1)), idf, _start(passages, idf))
    used = values > 1e-6 * values[0]
    index = Index(item_ids, passages, idf, idf[:, None] * basis[:, used] / values[used])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = bytes_of(as_array(batch.column(1)))
            doc_ids = batch.column(0).to_pylist()
            best: dict = {}
            blocks, rows_of, n_words = [], [], 0

            def search() -> None:
                for t, passage, *scores in index.search(blocks) if blocks else ():
                    key = rows_of[t], index.item_ids[passage]
                    best[key] = max(best.get(key, scores), scores, key=lambda s: (s[1], s[0]))

            for i in range(batch.num_rows):
                ids = raw[off[i]:off[i + 1]].view(np.int32)
                for at in range(0, len(ids), BLOCK):
                    blocks.append(ids[max(0, at - 2 * PASSAGE):at + BLOCK])
                    rows_of.append(i)
                    n_words += len(blocks[-1])
                    if n_words >= GATHER:
                        search()
                        blocks, rows_of, n_words = [], [], 0
            search()
            found = [(doc_ids[i], item, *scores) for (i, item), scores in best.items()]
            columns = list(zip(*found, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 *[pa.array(c, pa.float64()) for c in columns[2:]]],
                ["doc_id", "item_id", "cosine", "covered", "answer"])

    found = written(texts.mapInArrow(given_back(run), schema), "found")
    discard(tokens)
    return found
