"""Language identification by error-correcting output codes.

Each language has a codeword of -1/+1 bits. One binary classifier per bit (a
naive Bayes log-odds table over hashed byte n-grams) votes on its bit; the
decoder takes the language whose codeword has the least weighted logistic loss
against the votes, and flags a text as ambiguous when the runner-up is close.

Fitting reads a bounded sample of labelled rows: about ``rows_per_language``
rows of each language, chosen by a hash of the id, whole texts. Predicting is a
map over all rows, whole texts in blocks, with no shuffle. What travels with it is
bits x 2**HASH_BITS float32 numbers; a codeword has 10 bits for each doubling of the
number of languages. Every value of lang is learned; the driver holds 2**HASH_BITS
numbers for each of them while it fits.

Defined cases: a null text, or one without a letter, is ``und`` with score 0
and not ambiguous; with no labelled row every text is ``und``, and
``keep_identified`` keeps those with a letter; with one language every other text
gets it with score 1. Of equally near codewords the language that sorts first is
taken. Repeated rows and further columns have no effect, and an empty table gives an
empty result. Null languages are never learned from.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import as_array, bytes_of, fold, unit_hash

HASH_BITS = 15
ORDERS = (2, 3, 4)
BLOCK = 1 << 20
UNDETERMINED = "und"

# bytes: A-Z to a-z, other ASCII to one space, the rest as it is
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917, 668265263], dtype=np.uint32)


def _ngram_slots(block: np.ndarray, order: int) -> np.ndarray:
    """Slot of the n-gram that starts at each byte; the last order - 1 have none."""
    n = len(block) - order + 1
    if n <= 0:
        return np.empty(0, np.int64)
    h = np.full(n, order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for k in range(order):
        h += block[k:k + n]
        h *= _MULTIPLIERS[k]
        h ^= h >> np.uint32(15)
    return (h >> np.uint32(32 - HASH_BITS)).astype(np.int64)


def _blocks(raw: np.ndarray, start: int, end: int):
    """A text in blocks that share order - 1 bytes, so that no n-gram is lost or
    counted twice: (bytes, how many n-gram starts belong to this block)."""
    for at in range(start, end, BLOCK):
        yield _FOLD[raw[at:min(end, at + BLOCK + max(ORDERS) - 1)]], BLOCK


def codewords(n: int) -> np.ndarray:
    """n x bits, -1 or +1. Up to 7 languages: every split of them, once. Beyond:
    the best of 64 seeded random codes by least distance between rows."""
    if n <= 1:
        return np.ones((n, 0), np.int8)
    if n <= 7:
        splits = np.arange(1, 1 << (n - 1))
        rows = [np.ones(len(splits))] + [np.where(splits >> k & 1, -1, 1) for k in range(n - 1)]
        return np.array(rows, dtype=np.int8)
    bits, rng, best = math.ceil(10 * math.log2(n)), np.random.default_rng(7), None
    for _ in range(64):
        m = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        m[0, np.abs(m.sum(0)) == n] *= -1
        g = m.astype(int) @ m.T
        far = (bits - (g - np.diag(np.diag(g))).max()) // 2
        if best is None or far > best[0]:
            best = far, m
    return best[1]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray       # languages x bits
    weights: np.ndarray    # bits x slots, float32
    scale: np.ndarray      # bits: mean size of a vote
    trust: np.ndarray      # languages x bits, rows sum to 1

    def votes(self, raw: np.ndarray, start: int, end: int) -> np.ndarray:
        """Mean log-odds of the text's n-grams, per bit."""
        total, n = np.zeros(len(self.weights)), 0
        for block, own in _blocks(raw, start, end):
            for order in ORDERS:
                slots = _ngram_slots(block, order)[:own]
                n += len(slots)
                for b, w in enumerate(self.weights):
                    total[b] += w[slots].sum(dtype=np.float64)
        return total / max(n, 1)

    def decode(self, votes: np.ndarray) -> tuple[int, float, float]:
        """Index of the language, its share, and its lead over the next."""
        if len(self.languages) == 1:
            return 0, 1.0, 1.0
        z = 3.0 * self.code * (votes / self.scale)
        loss = (self.trust * np.logaddexp(0, -z)).sum(1)
        share = np.exp(-4.0 * (loss - loss.min()))
        share /= share.sum()
        first, second = np.argsort(-share, kind="stable")[:2]
        return int(first), float(share[first]), float(share[first] - share[second])


def training_rows(docs: DataFrame, modulus: int) -> DataFrame:
    return docs.where((fold(F.col("doc_id"), modulus) != 0) & F.col("lang").isNotNull()
                      & F.col("text").isNotNull())


def fit(docs: DataFrame, modulus: int = 5, rows_per_language: int = 1000) -> Model | None:
    """Learn from the rows whose fold is not 0. None if no row has a label."""
    rows = training_rows(docs.select("doc_id", "text", "lang"), modulus)
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    code = codewords(len(languages))
    index = {name: i for i, name in enumerate(languages)}
    share = F.create_map(*[F.lit(x) for k in languages
                           for x in (k, min(1.0, 2.0 * rows_per_language / sizes[k]))])
    u = unit_hash(F.lit("language sample"), "doc_id")
    sample = rows.where(u < F.coalesce(share[F.col("lang")], F.lit(0.0))) \
        .select("lang", "text", (F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 0).alias("first"))

    def count(batches):
        def flush():
            cell, n = np.unique(np.concatenate(cells), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(cell >> HASH_BITS, pa.int32()), pa.array(
                cell & (1 << HASH_BITS) - 1, pa.int32()), pa.array(n, pa.int64())], ["lang", "slot", "n"])

        cells, size = [], 0
        for batch in batches:
            raw, off = bytes_of(as_array(batch.column(1)))
            for i, name in enumerate(batch.column(0).to_pylist()):
                for block, own in _blocks(raw, off[i], off[i + 1]):
                    for order in ORDERS:
                        cells.append(_ngram_slots(block, order)[:own] | index[name] << HASH_BITS)
                        size += len(cells[-1])
                    if size > 1 << 22:
                        yield flush()
                        cells, size = [], 0
        if size:
            yield flush()

    counted = sample.where("first").select("lang", "text").mapInArrow(count, "lang int, slot int, n long") \
        .groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    p = np.full((len(languages), 1 << HASH_BITS), 0.1, np.float32)
    got = counted.toPandas()
    p[got["lang"].to_numpy(int), got["slot"].to_numpy(int)] += got["n"].to_numpy(np.float32)
    p /= p.sum(1, keepdims=True, dtype=np.float64)
    weights = np.zeros((code.shape[1], 1 << HASH_BITS), np.float32)
    for b in range(code.shape[1]):
        odds = np.log(p[code[:, b] > 0].mean(0)) - np.log(p[code[:, b] < 0].mean(0))
        weights[b] = np.clip(odds, -3, 3)
    bits = code.shape[1]
    model = Model(languages, code, weights, np.ones(bits), np.full(code.shape, 1 / max(bits, 1)))
    if not bits:
        return model

    def weigh(batches):
        """On the other half of the sample: how large the votes of each bit are,
        and how often they are right for each language."""
        m = model
        total = np.zeros((len(languages), bits, 2))
        n = np.zeros(len(languages))
        for batch in batches:
            raw, off = bytes_of(as_array(batch.column(1)))
            for i, name in enumerate(batch.column(0).to_pylist()):
                v, row = m.votes(raw, off[i], off[i + 1]), index[name]
                n[row] += 1
                total[row, :, 0] += np.abs(v)
                total[row, :, 1] += v * m.code[row] > 0
        lang, bit = np.indices((len(languages), bits)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.int32()), pa.array(bit, pa.int32()), pa.array(total[lang, bit, 0]),
             pa.array(total[lang, bit, 1]), pa.array(n[lang])], ["lang", "bit", "size", "right", "n"])

    got = sample.where("NOT first").select("lang", "text") \
        .mapInArrow(weigh, "lang int, bit int, size double, right double, n double") \
        .groupBy("lang", "bit").agg(*[F.sum(c).alias(c) for c in ("size", "right", "n")]).collect()
    size, right = np.zeros(code.shape), np.ones(code.shape)
    for r in got:
        size[r["lang"], r["bit"]] = r["size"] / max(r["n"], 1)
        right[r["lang"], r["bit"]] = (r["right"] + 1) / (r["n"] + 1)
    model.scale = np.maximum(size.mean(0), 1e-6)
    trust = np.maximum(right - 0.5, 0.01)
    model.trust = trust / trust.sum(1, keepdims=True)
    return model


def predict(docs: DataFrame, model: Model | None, ambiguous_below: float = 0.2) -> DataFrame:
    """docs (doc_id, text and any others) with lang_pred, score and ambiguous;
    columns of these names are replaced."""
    new = ("lang_pred", "score", "ambiguous")
    docs = docs.drop(*new)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.select("*", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(False).alias("ambiguous"))

    # only the texts go to Python; the other columns stay where they are
    @F.arrow_udf("struct<lang_pred string, score double, ambiguous boolean>")
    def language(texts: pa.Array, lettered: pa.Array) -> pa.Array:
        raw, off = bytes_of(as_array(texts))
        lang, score, flag = [], [], []
        for i, has in enumerate(lettered.to_pylist()):
            if has:
                k, s, lead = model.decode(model.votes(raw, off[i], off[i + 1]))
                lang.append(model.languages[k])
            else:
                s, lead = 0.0, 1.0
                lang.append(UNDETERMINED)
            score.append(s)
            flag.append(lead < ambiguous_below)
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(flag, pa.bool_())], names=list(new))

    found = docs.withColumn("__language", language(F.col("text"), letters))
    return found.select(*docs.columns, *[F.col("__language")[c].alias(c) for c in new])


def identify(docs: DataFrame, modulus: int = 5) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, ambiguous."""
    model = fit(docs, modulus)
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold(F.col("doc_id"), modulus) == 0).alias("held_out"), "lang_pred", "score", "ambiguous")


def keep_identified(docs: DataFrame, modulus: int = 5) -> DataFrame:
    """The documents with a language; those without a letter go. Ambiguous ones
    stay: a text in two languages is not junk. Without a labelled row nothing is known
    of languages, and every text with a letter stays."""
    model = fit(docs, modulus)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return predict(docs, model).where(F.col("lang_pred") != UNDETERMINED).select(*docs.columns)
