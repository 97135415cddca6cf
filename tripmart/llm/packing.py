"""Packing of tokenized documents by shortest-pack-first over the length histogram.

A document is the ids of its text and one closing id. Documents are cut into
pieces of at most 2048 ids; full pieces fill a sequence alone. The lengths of
all pieces are counted (at most 2048 counts reach the driver), and lengths are
placed from the longest to the shortest: each goes to the shortest packs that
have room, by whole counts, so what is built is a list of packing patterns with
how often each is used (at most two new patterns a length). Pieces are ranked
within their length, and rank ranges of the patterns say which sequence and
offset each piece gets. Ranks are made in blocks of about ``RANK_BLOCK`` pieces
with block offsets, so a length that a third of all pieces share is no single
task.

Words are tokenized once per Python worker and remembered (a bounded number); the
tokenizer's normalizer and splitter never reach across ASCII white space, which
is where texts are split, so the ids are those of the whole text.

Defined cases: a null text is empty; an empty document is the closing id alone;
repeated rows are packed as often as they come; a null doc_id is kept; further
columns are left out. An empty table gives no pieces. A very long text is cut into
pieces like any other; pieces of one length are ranked by doc_id, start and the
checksum of their ids, so only equal pieces tie.
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import as_array, bytes_of, given_back, per_worker, text_batches, word_blocks, written

SEQUENCE = 2048
END_ID = 1
PAD_ID = END_ID
RANK_BLOCK = 50_000
MOST_WORDS = 400_000
BATCH_BYTES = 1 << 21


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """Ids of words, little-endian 32-bit, remembering the last ``most`` words
    or more, up to twice as many.

    New words are tokenized many at a time, divided by a word of their own. If
    the tokenizer lower-cases, splits at the pattern SPLIT and merges the bytes
    of each part, words of Latin letters, digits and marks go to its merges
    directly, part by part: for them that is all that its other steps do."""

    DIVIDER = "\ue000"
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    PLAIN = r"[\x21-\x7e\u00a1-\u012f\u0131-\u024f]+"

    def __init__(self, path: str, most: int = MOST_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most = most
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.divider = self._encode(self.DIVIDER)
        self.plain, self.split = regex.compile(self.PLAIN), regex.compile(self.SPLIT)
        self.parts: dict[str, bytes] = {}
        self.older_parts: dict[str, bytes] = {}
        steps = json.loads(self.tokenizer.to_str())
        kinds = [x.get("pattern") or x["type"] for k in ("normalizer", "pre_tokenizer")
                 for x in (steps[k] or {}).get("normalizers", (steps[k] or {}).get("pretokenizers", []))]
        self.direct = kinds == ["NFC", {"Regex": r"\s+"}, "Lowercase", {"Regex": self.SPLIT}, "ByteLevel"]
        # byte-level alphabet: printable bytes stand for themselves, the others
        # follow from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = {b: 256 + k for k, b in enumerate(hidden)}
        self.merges = self.tokenizer.model.tokenize
        self.marks = {m.encode(): self._part(m) for m in ".,;:!?"} if self.direct else {}

    def forget(self) -> None:
        """At the end of a task: keep the latest words only."""
        self.older, self.older_parts = {}, {}

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _part(self, part: str) -> bytes:
        got = self.parts.get(part)
        if got is None:
            if len(self.parts) > self.most:
                self.older_parts, self.parts = self.parts, {}
            got = self.older_parts.get(part)
            if got is None:
                shown = part if part.isascii() else part.encode().decode("latin-1").translate(self.alphabet)
                tokens = self.merges(shown)
                got = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
            self.parts[part] = got
        return got

    def _learn(self, words: set[bytes]) -> None:
        """Put words that are not known into known."""
        known, older, part_of, marks, direct = self.known, self.older, self._part, self.marks, self.direct
        plain = []
        for w in words:
            ids = older.get(w)
            if ids is not None:
                known[w] = ids
                continue
            if direct and w.isalpha():  # of bytes: ASCII letters only
                known[w] = part_of(w.decode().lower())
                continue
            if direct and w[-1:] in marks and w[:-1].isalpha():
                known[w] = part_of(w[:-1].decode().lower()) + marks[w[-1:]]
                continue
            t = w.decode("utf-8", "replace")
            if direct and "<|" not in t and self.plain.fullmatch(t):
                known[w] = b"".join(map(part_of, self.split.findall(t.lower())))
            elif self.DIVIDER in t:
                known[w] = self._encode(t).tobytes()
            else:
                plain.append((w, t))
        for k in range(0, len(plain), 20_000):
            part = plain[k:k + 20_000]
            ids = self._encode(f" {self.DIVIDER} ".join(t for _, t in part))
            n = len(self.divider)
            at = np.flatnonzero(ids[:len(ids) - n + 1] == self.divider[0])
            for j in range(1, n):
                at = at[ids[at + j] == self.divider[j]]
            starts = np.concatenate([[0], at + n]) * 4
            ends = np.concatenate([at, [len(ids)]]) * 4
            if len(starts) != len(part):  # a tokenizer whose splits reach across white space
                known.update((w, self._encode(t).tobytes()) for w, t in part)
                continue
            raw = ids.tobytes()
            known.update((w, raw[a:b]) for (w, _), a, b in zip(part, starts.tolist(), ends.tolist(), strict=True))

    def ids(self, texts: list[list[bytes]]) -> list[bytes]:
        """The ids of each text, given as its words."""
        words = set().union(*texts)
        new = words.difference(self.known)
        if len(self.known) + len(new) > self.most:
            self.older, self.known, new = self.known, {}, words
        if new:
            self._learn(new)
        known = self.known.__getitem__
        return [b"".join(map(known, own)) for own in texts]


def tokenize(docs: DataFrame, tokenizer: str | None = None, most_words: int = MOST_WORDS) -> DataFrame:
    """One row per piece: doc_id, start (ids before it), length, doc_tokens, and
    ids (little-endian unsigned 32-bit). tokenizer: a file that every executor
    has at that path; by default that of the installed public tokenizers.
    most_words: how many words a worker remembers, for speed alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer or default_tokenizer()
        words_to_ids = per_worker(f"tokenizer {path} {most_words}", lambda: WordTokenizer(path, most_words))
        end = np.array([END_ID], "<u4").tobytes()

        def pieces(doc_ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
            rows, starts, lengths, totals, cut = [], [], [], [], []
            for i, ids in enumerate(texts):
                n = len(ids) // 4
                for at in range(0, n, SEQUENCE):
                    rows.append(i)
                    starts.append(at)
                    lengths.append(min(SEQUENCE, n - at))
                    totals.append(n)
                    cut.append(ids[4 * at:4 * (at + SEQUENCE)])
            return pa.RecordBatch.from_arrays(
                [doc_ids.take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                 pa.array(totals, pa.int64()), pa.array(cut, pa.binary())], ["doc_id", "start", "length", "doc_tokens", "ids"])

        for batch in batches:
            raw, off = bytes_of(as_array(batch.column(1)))
            at = 0
            while at < batch.num_rows:
                stop = at + 1
                while stop < batch.num_rows and off[stop + 1] - off[at] <= BATCH_BYTES:
                    stop += 1
                if off[stop] - off[at] <= BATCH_BYTES:
                    split = [raw[off[i]:off[i + 1]].tobytes().split() for i in range(at, stop)]
                    texts = [ids + end for ids in words_to_ids.ids(split)]
                else:  # one long text
                    parts = [words_to_ids.ids([words])[0] for words in word_blocks(raw, off[at], off[stop])]
                    texts = [b"".join([*parts, end])]
                yield pieces(batch.column(0).slice(at, stop - at), texts)
                at = stop
        words_to_ids.forget()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        given_back(run), "doc_id long, start long, length long, doc_tokens long, ids binary")


def patterns(counts: dict[int, int], size: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths, longest first) and how often each is used."""
    room: dict[int, list[list]] = {}  # room left -> [pattern, count]
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            most = max(room, default=-1)
            if most < length:
                room.setdefault(size - length, []).append([(length,), left])
                break
            pack = room[most][-1]
            n = min(left, pack[1])
            left -= n
            pack[1] -= n
            if not pack[1]:
                room[most].pop()
                if not room[most]:
                    del room[most]
            room.setdefault(most - length, []).append([(*pack[0], length), n])
    return sorted(((p, n) for packs in room.values() for p, n in packs), reverse=True)


def _segments(plan: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """Per place of a pattern: the ranks, within the place's length, that it takes."""
    ranks: dict[int, int] = {}
    rows, first = [], 0
    for lengths, n in plan:
        offset = 0
        for length in lengths:
            at = ranks.get(length, 0)
            rows.append((length, at, at + n, first, offset))
            ranks[length] = at + n
            offset += length
        first += n
    return pd.DataFrame(rows, columns=["length", "rank_from", "rank_to", "first_sequence", "offset"]).astype("int64")


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """pieces (length up to size, doc_id, start, and any others) with
    sequence_id and offset."""
    spark = pieces.sparkSession
    lengths = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    counts = {r["length"]: r["n"] for r in lengths}
    if not counts:
        zero = F.lit(0).cast("long")
        return pieces.select("*", zero.alias("sequence_id"), zero.alias("offset"))
    blocks = spark.createDataFrame([(k, -(-n // RANK_BLOCK)) for k, n in sorted(counts.items())],
                                   "length long, n_blocks long")
    # both tables have at most a few rows for each possible length
    dealt = pieces.join(F.broadcast(blocks), "length").withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "start"), F.col("n_blocks"))).drop("n_blocks")
    sizes = dealt.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = sizes.select("length", "block", (F.sum("n").over(
        Window.partitionBy("length").orderBy("block")) - F.col("n")).alias("before"))
    order = Window.partitionBy("length", "block").orderBy("doc_id", "start", *[c for c in ("ids_crc32",) if c in pieces.columns])
    ranked = dealt.withColumn("place", F.row_number().over(order) - 1).join(before, ["length", "block"]) \
        .withColumn("rank", F.col("before") + F.col("place")).drop("block", "place", "before")
    segments = F.broadcast(spark.createDataFrame(_segments(patterns(counts, size))))
    r, s = ranked.alias("r"), segments.alias("s")
    return r.join(s, F.expr("r.length = s.length AND r.rank >= s.rank_from AND r.rank < s.rank_to")) \
        .select(*[f"r.{c}" for c in pieces.columns],
                (F.col("s.first_sequence") + F.col("r.rank") - F.col("s.rank_from")).alias("sequence_id"),
                F.col("s.offset").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, most_words: int = MOST_WORDS) -> DataFrame:
    """Per piece: doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id,
    offset."""
    pieces = tokenize(docs, tokenizer, most_words).select("doc_id", "start", "length", "ids", F.crc32("ids").alias("ids_crc32"),
                                              "doc_tokens")
    with text_batches(docs.sparkSession):
        pieces = written(pieces, "pieces")
    return pack(pieces)


def sequences(packed: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """sequence_id, ids (joined in order of offset), n_ids, n_padding and
    padded_ids (ids and n_padding times PAD_ID), of pieces packed with their ids:
    padded to size, except at a power of two."""
    whole = packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("n_ids"))
    even = (F.col("n_ids").bitwiseAND(F.col("n_ids") - 1)) == 0
    return whole.select("sequence_id", F.expr("aggregate(parts.ids, X'', (a, x) -> concat(a, x))").alias("ids"), "n_ids",
                        F.when(even, F.lit(0)).otherwise(size - F.col("n_ids")).alias("n_padding")) \
        .withColumn("padded_ids", F.expr(f"concat(ids, unhex(repeat('{PAD_ID.to_bytes(4, 'little').hex()}', int(n_padding))))"))
