"""Nearest neighbours, conversation trie and Merkle manifest against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmart.llm import conv_trie, merkle, neighbours, queries
from tripmart.llm.common import table

SF = "/root/testdata/sf0.001"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# Merkle manifest

def _leaf(r, text):
    values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def _path(levels, i):
    for level in levels[:-1]:
        yield level[i // 16 * 16:i // 16 * 16 + 16], i % 16
        i //= 16


def merkle_rows(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    trees = {}
    for source, members in by.items():
        members.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r, r["text"])))
        trees[source] = _levels([_leaf(r, r["text"]) for r in members])
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    top = _levels([trees[s][-1][0] for s in order])
    lower, out = {c: c + 32 for c in range(65, 91)}, []
    for source, members in by.items():
        for i, r in enumerate(members):
            text, proof = r["text"], ""
            if r["doc_id"] is not None and text is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
                text = text.translate(lower)
            folded = _leaf(r, text)
            for run, k in [*_path(trees[source], i), *_path(top, order.index(source))]:
                proof += "".join(run[:k] + run[k + 1:])
                folded = sha("".join([*run[:k], folded, *run[k + 1:]]))
            root = top[-1][0]
            out.append((r["doc_id"], trees[source][0][i], trees[source][-1][0], root, sha(proof), folded, folded == root))
    return sorted(out, key=str)


def _audited(docs):
    return sorted(map(tuple, merkle.audit(docs).collect()), key=str)


@pytest.fixture(scope="module")
def many_sources(spark):
    """One source with a third of all rows, many small ones, a null one."""
    rng = random.Random(4)
    rows = []
    for i in range(1500):
        source = "hot" if i % 3 == 0 else None if i % 31 == 0 else f"s{'é' if i % 2 else 'e'}{rng.randrange(60)}"
        rows.append((i * 7, f"Text {i} of A Document" if i % 11 else None, "en" if i % 5 else None, source, i if i % 13 else None))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_merkle_against_brute_force(spark, many_sources):
    docs = table(spark, SF, "documents")
    got = sorted(map(tuple, queries.op13_merkle_manifest(spark, SF).collect()), key=str)
    assert got == merkle_rows([r.asDict() for r in docs.collect()])
    assert {v[-1] for v in got} == {True, False}
    assert _audited(many_sources) == merkle_rows([r.asDict() for r in many_sources.collect()])


def test_merkle_proves_any_subset(many_sources):
    m = merkle.manifest(many_sources)
    some = m.leaves.filter("doc_id % 49 = 0").withColumn(
        "presented", F.when(F.col("doc_id") % 2 == 0, F.col("leaf")).otherwise(F.sha2(F.col("leaf"), 256)))
    whole = {r[0]: r for r in merkle_rows([r.asDict() for r in many_sources.collect()])}
    rows = merkle.verify(m, some).collect()
    assert len(rows) == len([k for k in whole if k % 49 == 0])
    for r in rows:
        assert (r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) == whole[r["doc_id"]][1:5]
        assert r["verified"] == (r["doc_id"] % 2 == 0) == (r["folded_root"] == r["root"])


def test_merkle_missing_is_least():
    # of a tree of 40 leaves: 0 and 17 need their siblings, and the third run's node
    found = merkle.missing(np.array([0, 17]), 40)
    assert found[0][1].tolist() == [*range(1, 17), *range(18, 32)] and found[1][1].tolist() == [2]
    assert merkle.missing(np.arange(16), 16)[0][1].tolist() == [] and merkle.missing(np.array([0]), 1) == []


def test_merkle_odd_input(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("n_chars", F.lit(None).cast("long")).withColumn("leaf", F.lit("a clash")) \
        .withColumn("tree", F.lit("t")).withColumn("idx", F.lit(1)).withColumn("block", F.lit(2))
    assert _audited(docs) == merkle_rows([r.asDict() for r in docs.collect()])
    one = docs.filter("doc_id = 7")
    assert _audited(one) == merkle_rows([r.asDict() for r in one.collect()])
    assert merkle.audit(docs.limit(0)).count() == 0


# conversation trie

def trie_rows(rows, rebuilt=True):
    conv = defaultdict(list)
    for r in rows:
        if r["conv_id"] is not None:
            conv[r["conv_id"]].append(r)
    for c, members in conv.items():
        members.sort(key=lambda r: (r["turn"] is not None, r["turn"] or 0))
        conv[c] = [(r["role"] or "", r["text"] or "") for r in members]
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(conv):
        h = zlib.crc32(str(c).encode()) % 4 if rebuilt else 0
        s = tuple(conv.get(c - c % 20, [])[:h] + conv[c][h:])
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
            if d:
                children[s[:d - 1]].add(s[:d])
        ends[s].append(c)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        tokens = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += tokens
    return sorted(((m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]), leaves[p], saved[p],
                    sha(",".join(map(str, ends[p])))) for p, m in members.items()), key=str)


def _nodes(df, rebuilt=True):
    return sorted((tuple(r)[:8] for r in conv_trie.trie(df, rebuilt).collect()), key=str)


def test_trie_against_brute_force(spark):
    rows = [r.asDict() for r in table(spark, SF, "conversations").collect()]
    got = sorted((tuple(r) for r in queries.op12_conversation_trie(spark, SF).collect()), key=str)
    assert got == trie_rows(rows)
    assert _nodes(table(spark, SF, "conversations"), False) == trie_rows(rows, False)


def test_trie_of_long_conversations(spark, monkeypatch):
    """Conversations of many pieces, and of pieces of pieces; a third are copies."""
    rng = random.Random(5)
    rows = []
    for c in range(60):
        for i in range(90 if c % 3 == 0 else rng.choice([1, 3, 15, 17, 16, 70])):
            rows.append((c, i, "user" if i != 33 or c % 2 else None, rng.choice(["a b", "c", None]) if i % 20 == 19 else "x y z"))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    monkeypatch.setattr(conv_trie, "PIECE", 4)
    monkeypatch.setattr(conv_trie, "IDS", 3)
    assert _nodes(df) == trie_rows([r.asDict() for r in df.collect()])


def test_trie_odd_input(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, 1, "user", long), (1, None, None, None), (1, 2, "user", ""), (1, 3, "", "b"), (1, 3, "", "b"),
            (21, 1, "user", long), (20, 5, "user", "hi"), (40, 1, "user", "hi"), (41, 1, "user", "hi"), (62, 1, "u", "x"),
            (None, 1, "user", "nobody"), (3, 1, "user", " \t\r\n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS hi", "2 AS position", "3 AS n", "4 AS depth", "'x' AS part")
    assert _nodes(df) == trie_rows([r.asDict() for r in df.collect()])
    assert conv_trie.trie(df.limit(0)).count() == 0
    # turns with one number: a fixed order, the same in every conversation
    ties = spark.createDataFrame([(c, 1, "user", t) for c in (1, 2) for t in ("a", "b", "c")],
                                 "conv_id long, turn long, role string, text string")
    assert [r["n_convs"] for r in conv_trie.trie(ties).orderBy("depth").collect()] == [2, 2, 2, 2]


# nearest neighbours

def nearest_rows(rows, k, every):
    ids, seen = [], set()
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v) or (i, tuple(v)) in seen:
            continue
        seen.add((i, tuple(v)))
        ids.append((i, v))
    size = max((len(v) for _, v in ids), default=0)
    x = np.array([[*v, *[0.0] * (size - len(v))] for _, v in ids]).reshape(-1, size)
    names = np.array([i for i, _ in ids], np.int64)
    out = defaultdict(list)
    for j, q in enumerate(names):
        if q % every == 0:
            other = names != q
            score = x[other] @ x[j]
            order = np.lexsort((names[other], -np.round(score, 12)))[:k]
            out[int(q)] += list(zip(names[other][order].tolist(), score[order].tolist(), strict=True))
    return out


def _answers(df, times=None):
    """Per query the answers in order; times: how many vectors an id has, if more
    than one."""
    out, ranks = defaultdict(list), defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        out[r["query_id"]].append((r["vec_id"], r["score"]))
        ranks[r["query_id"]].append(r["rank"])
    times = times or {}
    for q, found in ranks.items():
        n = times.get(q, 1)
        assert sorted(found) == sorted([*range(1, len(found) // n + 1)] * n)
    return out


def _recall(got, true):
    assert set(got) == set(true)
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in true[q]}) / len(true[q]) for q in true])


def test_neighbours_recall(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, SF, "embeddings").collect()]
    true = nearest_rows(rows, 20, 20)
    got = _answers(queries.op11_nearest_neighbours(spark, SF))
    assert all(len(v) == 20 for v in got.values()) and _recall(got, true) >= 0.9
    vectors = dict(rows)
    for q, found in got.items():
        assert [f for _, f in found] == sorted((f for _, f in found), reverse=True)
        for i, score in found:
            assert i != q and score == pytest.approx(float(np.dot(vectors[q], vectors[i])), abs=1e-12)


def _made(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_neighbours_in_clusters_read_few(spark):
    """Clusters of vectors of different lengths, one with a third of all rows: the
    intervals stay small, and long vectors win."""
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((150, 24))
    rows = []
    for i in range(6000):
        c = 0 if i % 3 == 0 else rng.integers(150)
        rows.append((i, ((centres[c] + 0.1 * rng.standard_normal(24)) * rng.uniform(0.5, 1)).tolist()))
    df = _made(spark, rows)
    forest = neighbours.Forest(block=128)
    index = neighbours.Index(df, F.col("vec_id") % 20 == 0, 10, forest)
    wanted = neighbours.fit(index)
    assert wanted < 6000 * forest.trees / 4
    lengths = [r["length"] for r in neighbours.intervals(index, wanted).collect()]
    assert len(set(lengths)) > 1  # of variable length
    assert _recall(_answers(neighbours.nearest(df, F.col("vec_id") % 20 == 0, 10, forest)), nearest_rows(rows, 10, 20)) >= 0.88


def test_neighbours_odd_input(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (40, [-0.0, 2.0, 0.0]), (40, [0.0, 2.0]), (60, [3.0]), (1, None), (2, []),
            (3, [0.0, 0.0]), (4, [1.0, nan]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (7, [1.0, 1.0]),
            (8, [1.0, 1.0]), (9, [1.0, 1.0]), (80, [1.0, 1.0]), (60, [0.0, 1.0])]
    df = _made(spark, rows).selectExpr("*", "1 AS cls", "2 AS n", "3 AS vector", "'x' AS string", "4 AS query_id")
    got = _answers(neighbours.nearest(df, F.col("vec_id") % 20 == 0, 20), {60: 2})
    assert got[0] == [(60, 3.0), (7, 1.0), (8, 1.0), (9, 1.0), (20, 1.0), (80, 1.0), (40, 0.0), (60, 0.0)]
    assert sorted(i for i, _ in got[80]) == [0, 7, 8, 9, 20, 40, 60, 60]
    assert sorted(got) == [0, 20, 40, 60, 80] and len(got[60]) == 2 * 7
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0
    assert neighbours.nearest(df.filter("vec_id = 60"), F.lit(True)).count() == 0
    # a third of the rows is one vector: its smallest ids, but not the query's own
    many = [(i, [1.0, 2.0]) if i % 3 == 0 else (i, [float(i), 1.0]) for i in range(300)]
    copies = _answers(neighbours.nearest(_made(spark, many), F.col("vec_id") % 60 == 0, 5))
    true = nearest_rows(many, 5, 60)
    assert {q: [i for i, _ in v] for q, v in copies.items()} == {q: [i for i, _ in v] for q, v in true.items()}
