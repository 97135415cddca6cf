"""Toxicity by a weighted finite-state pattern grammar.

Words are terminals: insults (learned, with weights), threat verbs, targets,
negations, verbs of reported speech, others. Five small transducers read a
clause's terminals one after another, each rewriting what the one before put
out: insults and threats become hits, a target close by raises a hit, a negation
or reported speech before it lowers it. Their composition is one table of
states; a clause's score is the sum of its hits' weights times their factors. A
logistic function of a text's clause scores is its toxicity.

Learning reads a bounded sample: about ``rows_per_class`` labelled rows of each
label, chosen by a hash of the id, whole texts, near copies of each other left
out (three minimum hashes of their five-word runs) so that a much copied text
counts once. Three quarters give the insults: words, and stems of 4 to 6 letters,
whose log-odds for label 1, less 1.5 standard errors, are 1 or more; all of them,
the sample bounds their number. The others fit the logistic function.

Scoring is a map over all documents with no shuffle. Inputs are texts alone.

Defined cases: null and empty texts have no clause and get the base score;
without labelled rows of both labels every score is 0; labels that are null or
of unknown documents are left out, a document labelled twice counts as toxic if
any label says so; of equal or nearly equal sampled texts one is learned from;
repeated rows get equal rows; further columns are left out; an empty documents
table gives no row. Very long texts are read whole, about 4 million characters at
a time up to the end of a word, and a clause goes on from one block to the next.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import WordHashes, as_array, bytes_of, fold, mix, unit_hash, word_blocks, written

INSULT, THREAT, TARGET, NEGATE, REPORT, OTHER, HIT = range(7)
STEMS = (4, 5, 6)
BLOCK = 1 << 22

#: Closed word classes of the grammar (fixed values; en, de, fr, es).
CLOSED = {
    THREAT: "kill hurt shoot stab strangle destroy murder beat töten umbringen erschießen schlagen tuer frapper "
            "égorger matar golpear disparar".split(),
    TARGET: "you your yours u he she him her they them people those these du dich dir ihr euch sie ihn tu toi vous "
            "ils elles lui usted ustedes vosotros ellos ellas él".split(),
    NEGATE: "not no never nobody neither nor without hardly don't isn't aren't nicht kein keine nie niemals ohne "
            "jamais aucun aucune sans nunca ningún ninguna sin jamás".split(),
    REPORT: "said says say told wrote writes claimed quoted called alleged reportedly sagte sagt schrieb behauptete "
            "dit disait écrit affirmait dijo dice escribió afirmó".split(),
}
#: How much a hit counts next to a target, when negated, in reported speech.
NEAR_TARGET, NEGATED, REPORTED = 1.25, 0.4, 0.5
THREAT_WEIGHT = 2.0

_TOKENS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[.!?;\n]")
_CLAUSE_END = frozenset(".!?;\n")
_GAP = re.compile(r"\s")


# A transducer: its start state, and step(state, symbol) -> (state, output, factor).

def _insults():
    return 0, lambda s, x: (0, HIT, 1.0) if x == INSULT else (0, x, 1.0)


def _threats():
    """A threat verb with a target up to four words before or after it. State:
    (words since the target, words since an open threat); 5 is too far."""
    def step(state, x):
        target, threat = (min(5, k + 1) for k in state)
        if x == THREAT:
            return ((target, 5), HIT, 1.0) if target < 5 else ((target, 0), OTHER, 1.0)
        if x == TARGET:
            return ((0, 5), HIT, 1.0) if threat < 5 else ((0, 5), x, 1.0)
        return (target, threat), x, 1.0
    return (5, 5), step


def _scope(opener: int, length: int, factor: float):
    """Hits within ``length`` words after an opener get the factor; 0: to the
    end of the clause."""
    def step(left, x):
        if x == opener:
            return length or -1, x, 1.0
        return (left - 1 if left > 0 else left), x, factor if left and x == HIT else 1.0
    return 0, step


def compose(*machines) -> list[list[tuple[int, float]]]:
    """The machines one after another as one table: [state][symbol] -> (state,
    factor of the hit, or 0 if there is none)."""
    index = {tuple(m[0] for m in machines): 0}
    table: list[list[tuple[int, float]]] = []
    waiting = list(index)
    while waiting:
        state = waiting.pop(0)
        row = []
        for symbol in range(HIT):
            x, factor, after = symbol, 1.0, []
            for (_, step), own in zip(machines, state, strict=True):
                own, x, f = step(own, x)
                after.append(own)
                factor *= f
            key = tuple(after)
            if key not in index:
                index[key] = len(index)
                waiting.append(key)
            row.append((index[key], factor if x == HIT else 0.0))
        table.append(row)
    return table


GRAMMAR = compose(_insults(), _threats(), _scope(TARGET, 4, NEAR_TARGET), _scope(NEGATE, 3, NEGATED),
                  _scope(REPORT, 0, REPORTED))


@dataclass
class Model:
    insults: dict[str, float]       # words, and stems with a star
    coefficients: np.ndarray | None

    def __post_init__(self):
        self.closed = {w: (symbol, THREAT_WEIGHT) for symbol, words in CLOSED.items() for w in words}
        self.known: dict[str, tuple[int, float]] = {}

    def terminal(self, word: str) -> tuple[int, float]:
        got = self.known.get(word)
        if got is None:
            weight = max((self.insults.get(w, 0.0) for w in terms(word)), default=0.0)
            got = (INSULT, weight) if weight else self.closed.get(word, (OTHER, 0.0))
            if len(self.known) > 300_000:
                self.known.clear()
            self.known[word] = got
        return got

    def features(self, text: str) -> list[float]:
        """Largest clause score, log of their sum, hits per word (log)."""
        most = total = 0.0
        hits = n = state = 0
        clause = 0.0
        for block in _blocks(text):
            tokens = _TOKENS.findall(block)
            n += len(tokens)
            if len(text) <= BLOCK and not any(self.terminal(w)[0] <= THREAT for w in set(tokens)):
                continue
            for w in tokens:
                if w in _CLAUSE_END:
                    most, total, state, clause = max(most, clause), total + clause, 0, 0.0
                    continue
                symbol, weight = self.terminal(w)
                state, factor = GRAMMAR[state][symbol]
                if factor:
                    hits += 1
                    clause += factor * (weight or THREAT_WEIGHT)
        most, total = max(most, clause), total + clause
        return [1.0, most, float(np.log1p(total)), float(np.log1p(100 * hits / n)) if n else 0.0]


def terms(word: str) -> list[str]:
    return [word, *[word[:k] + "*" for k in STEMS if len(word) > k]]


def _blocks(text: str) -> Iterator[str]:
    """Lower-case text, about 4 million characters at a time; a block ends where
    a word does."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + BLOCK)
        end = gap.end() if gap else len(text)
        yield text[at:end].lower()
        at = end


def _minimum_hashes(raw: np.ndarray, start: int, end: int, hashes: WordHashes) -> list[int]:
    """Three minimum hashes of the five-word runs of a text."""
    parts = [hashes.of(w) for w in word_blocks(raw, start, end)]
    words = np.concatenate(parts) if parts else np.zeros(1, np.uint64)
    h = np.zeros(max(1, len(words) - 4), np.uint64)
    for k in range(min(5, len(words))):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k:k + len(h)])
    return [int(mix(h ^ np.uint64(seed)).min() >> np.uint64(1)) for seed in (1, 2, 3)]


def _sample(docs: DataFrame, labels: DataFrame, modulus: int, rows_per_class: int) -> tuple[DataFrame, dict]:
    """(first, toxic, text) of the sampled rows, written; rows by label."""
    marked = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(fold(F.col("doc_id"), modulus) != 0) \
        .groupBy("doc_id").agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for k, n in sizes.items():
        share = F.when(F.col("toxic") == k, min(1.0, rows_per_class / n)).otherwise(share)
    u = unit_hash(F.lit("toxicity"), "doc_id")
    chosen = marked.where(u < share).withColumn("first", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(4)) != 0)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            raw, off = bytes_of(as_array(batch.column(2)))
            keys = np.array([_minimum_hashes(raw, off[i], off[i + 1], hashes) for i in range(batch.num_rows)],
                            np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(keys[:, k]) for k in range(3)]],
                                             ["first", "toxic", "text", "k1", "k2", "k3"])

    # the sample's ids are few: about two times rows_per_class
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id") \
        .select("first", "toxic", "text")
    rows = rows.mapInArrow(hashed, "first boolean, toxic int, text string, k1 long, k2 long, k3 long")
    for key in ("k1", "k2", "k3"):
        rows = rows.dropDuplicates([key])
    return written(rows.select("first", "toxic", "text"), "toxicity-sample"), sizes


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 5, rows_per_class: int = 12_000) -> Model | None:
    """Learn from labelled rows whose fold is not 0; None unless both labels occur."""
    sample, sizes = _sample(docs, labels, modulus, rows_per_class)
    if len(sizes) < 2:
        return None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), *[pa.array([v[k] for v in seen.values()], pa.int64()) for k in (0, 1)]],
                ["term", "clean", "toxic"])
            seen.clear()
            return out

        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = {t for block in _blocks(text) for w in set(_TOKENS.findall(block)) if w not in _CLAUSE_END
                         for t in terms(w)}
                for t in found:
                    seen.setdefault(t, [0, 0])[toxic] += 1
                if len(seen) > 300_000:
                    yield flush()
        yield flush()

    first = sample.where("first")
    n = {r["toxic"]: r["n"] for r in first.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return None
    odds = F.expr(f"ln((toxic + 0.5) / {n[1] + 1}) - ln((clean + 0.5) / {n[0] + 1}) "
                  "- 1.5 * sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))")
    counted = first.select("toxic", "text").mapInArrow(count, "term string, clean long, toxic long") \
        .groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")) \
        .where("toxic >= 4").withColumn("weight", odds).where("weight >= 1")
    # terms of four or more texts of the bounded sample
    insults = {r["term"]: r["weight"] for r in counted.collect()}
    model = Model(insults, None)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [model.features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["toxic", "x"])

    got = sample.where("NOT first").select("toxic", "text").mapInArrow(measured, "toxic int, x array<double>").toPandas()
    if got["toxic"].nunique() < 2:
        return None
    x, y = np.array(got["x"].tolist()), got["toxic"].to_numpy(float)
    model.coefficients = _logistic(x, y)
    # the sample has its own mix of labels; the intercept is that of the corpus
    model.coefficients[0] += np.log(sizes[1] / sizes[0]) - np.log(y.sum() / (len(y) - y.sum()))
    model.known = {}
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score, predicted, and the largest clause score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clause, scores = [], []
            for text in batch.column(1):
                x = model.features(text.as_py() or "") if model else [1.0, 0.0, 0.0, 0.0]
                clause.append(x[1])
                scores.append(float(1 / (1 + np.exp(-np.clip(np.dot(x, model.coefficients), -30, 30)))) if model else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                 pa.array(clause, pa.float64())], ["doc_id", "score", "predicted", "clause_score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, score double, predicted int, clause_score double")


def assess(docs: DataFrame, labels: DataFrame, modulus: int = 5) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, clause_score."""
    return score(docs, fit(docs, labels, modulus)).select(
        "doc_id", (fold(F.col("doc_id"), modulus) == 0).alias("held_out"), "score", "predicted", "clause_score")
