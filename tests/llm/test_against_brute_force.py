"""The operators against plain Python on sf0.001, and on made texts."""

import hashlib
import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tripmart.llm import (common, decontam, lang_id, line_dedup, lm_score, near_dup, packing, quality, substrings,
                          toxicity, url_filter)
from tripmart.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect()}


@pytest.fixture(scope="module")
def variants(spark):
    """A text, near copies of it at many distances, and texts made of the same words."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(150)]
    rows = []
    for i in range(120):
        w = list(base) if i % 3 else [rng.choice(words) for _ in range(rng.randint(4, 150))]
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(len(w))] = rng.choice(words)
        lines = [" ".join(w[k:k + 25]) for k in range(0, len(w), 25)]
        rows.append((i, "\n".join(lines)))
    rows += [(200 + i, "a " * 300) for i in range(3)] + [(300, "a b c d"), (301, "a b c d e"), (302, "e d c b a")]
    return spark.createDataFrame(rows, "doc_id long, text string").cache()


def _texts(df):
    return {r["doc_id"]: r["text"] or "" for r in df.collect()}


def _classes(texts):
    sets = {}
    for k, t in texts.items():
        w = t.encode().split()
        sets[k] = frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset([k])
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    where = defaultdict(list)
    for k in sorted(sets):
        common = Counter(j for s in sets[k] for j in where[s])
        for j, n in common.items():
            if 5 * n >= 4 * (len(sets[k]) + len(sets[j]) - n):
                a, b = root(k), root(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[k]:
            where[s].append(k)
    return {k: root(k) for k in sets}


def test_near_duplicates(docs, texts, variants):
    for df, own in ((docs, texts), (variants, _texts(variants))):
        got = {r["doc_id"]: r["class_id"] for r in near_dup.classify(df).collect()}
        assert got == _classes(own)


def test_probability_jaccard():
    """Equal registers estimate the probability Jaccard similarity."""
    rng = np.random.default_rng(0)
    shingle = rng.integers(1, 1 << 62, 300).astype(np.uint64)
    x, y = rng.integers(1, 5, 300).astype(float), rng.integers(1, 5, 300).astype(float)
    x[:60], y[240:] = 0, 0
    both = (x > 0) & (y > 0)
    with np.errstate(divide="ignore"):
        exact = sum(1 / np.maximum(x / x[d], y / y[d]).sum() for d in np.flatnonzero(both))
    hits = []
    for trial in range(40):
        s = near_dup.mix(shingle + np.uint64(trial))
        owner = np.concatenate([np.zeros((x > 0).sum(), int), np.ones((y > 0).sum(), int)])
        sign = near_dup.signatures(owner, np.concatenate([s[x > 0], s[y > 0]]), np.concatenate([x[x > 0], y[y > 0]]), 2)
        hits.append((sign[0] == sign[1]).mean())
    assert abs(np.mean(hits) - exact) < 0.02


def _line_matches(texts):
    out, seen, sets, where = defaultdict(lambda: [0, 0, 0]), set(), [], defaultdict(list)
    for k in sorted(texts):
        for line in texts[k].split("\n"):
            w = frozenset(line.encode().split())
            if not w:
                continue
            out[k][0] += 1
            if w in seen:
                out[k][1] += 1
                continue
            seen.add(w)
            common = Counter(j for x in w for j in where[x])
            out[k][2] += any(5 * n >= 4 * (len(w) + len(sets[j]) - n) for j, n in common.items())
            for x in w:
                where[x].append(len(sets))
            sets.append(w)
    return out


def test_lines(docs, texts, variants):
    for df, own in ((docs, texts), (variants, _texts(variants))):
        expected = _line_matches(own)
        got = {r["doc_id"]: [r["n_lines"], r["n_copies"], r["n_similar"]] for r in line_dedup.count_lines(df).collect()}
        assert got == {k: expected[k] for k in own}


def _repeats(texts, length=substrings.LENGTH):
    seen, out = set(), {}
    for k in sorted(texts):
        raw = texts[k].encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            s = raw[p:p + length]
            if s in seen:
                gone[p:p + length] = True
            seen.add(s)
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out[k] = (len(raw), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def test_substrings(spark, docs, texts, variants):
    rng = random.Random(9)
    parts = ["ab" * 80, "a" * 300, "x", "xyz" * 50, "".join(rng.choice("ab") for _ in range(130)), "é" * 120]
    made = spark.createDataFrame([(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 5)))) for i in range(60)],
                                 "doc_id long, text string").cache()
    for df, own in ((docs, texts), (variants, _texts(variants)), (made, _texts(made))):
        got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in substrings.digest(df).collect()}
        assert got == _repeats(own)


def test_substrings_across_blocks(spark, monkeypatch):
    """Blocks of the texts are cut anywhere without a difference."""
    rng = random.Random(4)
    line = "".join(rng.choice("abcdefgh ") for _ in range(400))
    own = {i: line[rng.randint(0, 200):][:rng.randint(90, 300)] * rng.randint(1, 9) for i in range(40)}
    df = spark.createDataFrame(list(own.items()), "doc_id long, text string")
    monkeypatch.setattr(substrings, "BLOCK", 1 << 8)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in substrings.digest(df).collect()}
    assert got == _repeats(own)


def test_quality_counts(docs, texts):
    for r in quality.judge(docs).collect():
        t = texts[r["doc_id"]]
        w = t.encode().split()
        windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        n = Counter(windows)
        inside = {j for i, x in enumerate(windows) if n[x] > 1 for j in range(i, i + 3)}
        lines = [x for x in t.encode().split(b"\n") if x.split()]
        repeat = len(inside)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (
            len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)),
            repeat, len(w) < 50 or 100 * repeat > 50 * len(w))


@given(st.lists(st.integers(0, 4), max_size=60))
@settings(max_examples=200, deadline=None)
def test_repeated_words(ids):
    windows = [tuple(ids[i:i + 3]) for i in range(len(ids) - 2)]
    n = Counter(windows)
    assert quality.repeated_words(np.array(ids, np.int64), 5) == len(
        {j for i, x in enumerate(windows) if n[x] > 1 for j in range(i, i + 3)})


def test_quality_verdicts(spark):
    """On rows of sf0.1 with a label: junk is rejected, clean texts are kept."""
    sf = "/root/testdata/sf0.1"
    got = quality.judge(table(spark, sf, "documents")).join(table(spark, sf, "labels"), "doc_id").where("NOT base_failed") \
        .groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {r["quality"]: r["kept"] for r in got}
    assert share[1] > 0.99 and share[0] < 0.05


def test_decontamination(spark, docs, texts):
    benchmark = table(spark, SF, "benchmark")
    items = {r["item_id"]: r["text"] for r in benchmark.collect()}
    whole = {(k, i) for k, t in texts.items() for i, x in items.items() if x in t}
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, benchmark).collect()}
    assert whole and got == whole


def test_decontamination_paraphrases(spark, texts):
    """One word in six replaced, long texts around it: still found; other texts are left alone."""
    benchmark = table(spark, SF, "benchmark")
    rng = random.Random(2)
    clean = [t for t in texts.values() if len(t.split()) > 300][:12]
    items = [r for r in benchmark.collect() if len(r["text"].split()) >= 20][:12]
    rows = []
    for i, (t, item) in enumerate(zip(clean, items, strict=True)):
        w = [x if rng.random() > 1 / 6 else "elsewhere" for x in item["text"].split()]
        half = len(t) // 2
        rows.append((i, t[:half] + " " + " ".join(w) + " " + t[half:]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(df, benchmark).collect()}
    wanted = {(i, item["item_id"]) for i, item in enumerate(items)}
    assert len(wanted & got) >= 0.9 * len(wanted)


def _exhaustive(index, ids):
    """passages of which any region of the text meets the rules of a match."""
    found = set()
    for k, p in enumerate(index.passages):
        reach = -(-3 * len(p) // 4)
        for middle in range(len(ids) + 1):
            region = ids[max(0, middle - reach):middle + reach].tolist()
            if len(index.answers[k].intersection(region)) >= 0.5 * len(index.answers[k]) and \
                    decontam.common_subsequence(index.masks[k], len(p), region) >= max(math.ceil(0.6 * len(p)), 8):
                found.add(k)
                break
    return found


def _latent_corpus(seed):
    """Texts in which the words s<i> and t<i> are used for each other, items of the s words, and
    paraphrases: synonyms for one word in four, sentences moved, one word in six replaced or left out."""
    rng = random.Random(seed)
    topics = [rng.sample(range(3000), 60) for _ in range(40)]

    def text(n, both=True):
        topic = rng.choice(topics)
        return [(rng.choice("st") if both else "s") + str(rng.choice(topic) if rng.random() < 0.6 else rng.randrange(3000))
                for _ in range(n)]

    items = [text(n, both=False) for n in [9, 12, 15, 20, 24, 31, 37, 44, 50, 64] * 3]
    rows, kinds = [], []
    for k, item in enumerate(items):
        swapped = [w.replace("s", "t") if rng.random() < 0.25 else w for w in item]
        cut = len(item) // 4
        moved = item[cut:] + item[:cut]
        replaced = [w if rng.random() > 1 / 6 else "s" + str(rng.randrange(3000)) for w in item]
        left_out = [w for w in item if rng.random() > 1 / 6]
        for kind, words in (("synonym", swapped), ("moved", moved), ("replaced", replaced), ("left out", left_out)):
            kinds.append((len(rows), k, kind))
            rows.append(text(rng.randint(0, 150)) + words + text(rng.randint(0, 150)))
    rows += [text(rng.randint(1, 300)) for _ in range(150)]
    return items, [" ".join(r) for r in rows], kinds


def test_decontamination_finds_what_an_exhaustive_search_finds(spark):
    """At least 0.9 of all matches, and of each kind of paraphrase, and nothing else."""
    items, rows, kinds = _latent_corpus(4)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    benchmark = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, benchmark).collect()}
    vocabulary = {w: i for i, w in enumerate(sorted({w.encode() for x in items for w in x}))}
    clean = decontam._Clean(vocabulary)
    ids = [clean.ids(r.encode()) for r in rows]
    have = np.zeros(clean.size)
    n = 0
    for t in ids:
        for at in range(0, len(t), decontam.PASSAGE):
            have[np.unique(t[at:at + decontam.PASSAGE])] += 1
            n += 1
    idf = np.log((n + 1) / (have + 1)) + 0.01
    index = decontam.Index(list(range(len(items))), [np.array([vocabulary[w.encode()] for w in x]) for x in items], idf,
                           np.zeros((clean.size, 1)))
    every = {(d, k) for d, t in enumerate(ids) for k in _exhaustive(index, t)}
    assert got <= every and len(got) >= 0.9 * len(every)
    for kind in {k for *_, k in kinds}:
        mine = {(d, k) for d, k, x in kinds if x == kind} & every
        assert len(mine) > 5 and len(mine & got) >= 0.9 * len(mine), kind


def test_decontamination_learns_from_every_passage(spark, monkeypatch):
    """The singular values are those of the TF-IDF rows of the items and of all passages, however many."""
    seen = {}

    def svd(rows, idf, *rest, svd=decontam.randomised_svd):
        seen["rows"], seen["idf"], seen["got"] = [r[0] for r in rows.collect()], idf, svd(rows, idf, *rest)
        return seen["got"]

    monkeypatch.setattr(decontam, "randomised_svd", svd)
    docs = spark.range(30_000).selectExpr(
        "id AS doc_id", "concat('a', id % 7, ' b', id % 11, ' c', id % 13, if(id % 5 = 0, repeat(' d', 70), ' a1 a1')) AS text")
    benchmark = spark.createDataFrame([(1, "a1 b2 c3 a1 b5 c6 a4 b7 c8 nowhere")], "item_id long, text string")
    decontam.contaminated(docs, benchmark).collect()
    passages = [ids[at:at + 64] for ids in (np.frombuffer(bytes(x), np.int32) for x in seen["rows"])
                for at in range(0, len(ids), 64)]
    assert len(passages) == 30_000 + 6_000 + 1
    used = np.unique(np.concatenate(passages))
    rows = np.array([np.bincount(np.searchsorted(used, x), minlength=len(used)) for x in passages]) * seen["idf"][used]
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    exact = np.linalg.svd(rows, compute_uv=False)
    basis, values = seen["got"]
    assert np.allclose(values[:10], exact[:10], rtol=1e-3)
    assert np.allclose(np.linalg.norm(rows @ basis[used][:, :10], axis=0), exact[:10], rtol=1e-3)


def test_decontamination_of_short_items(spark):
    """Under 8 words: all of them, one after the other, wherever they are."""
    benchmark = spark.createDataFrame([(1, "Alpha, beta"), (2, "beta gamma delta beta."), (3, "omega"), (4, "..."),
                                       (5, "beta alpha")], "item_id long, text string")
    rows = [(1, "x alpha beta"), (2, "beta gamma delta beta gamma"), (3, "alpha x beta"), (4, "beta gamma delta"),
            (5, "(Omega)"), (6, "alpha"), (7, "beta " * 100 + "alpha beta")]
    got = decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(1, 1), (2, 2), (5, 3), (7, 1), (7, 5)}
    assert {(r["cosine"], r["covered"], r["answer"]) for r in got} == {(1.0, 1.0, 1.0)}


@given(st.lists(st.integers(0, 3), max_size=20), st.lists(st.integers(0, 3), max_size=20))
@settings(max_examples=200, deadline=None)
def test_common_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            row[j], last = (last + 1 if x == y else max(row[j], row[j - 1])), row[j]
    masks = defaultdict(int)
    for k, x in enumerate(a):
        masks[x] |= 1 << k
    assert decontam.common_subsequence(masks, len(a), b) == row[-1]


def test_lm_base(docs, texts):
    counts = Counter()
    words = {k: [w.lower() for w in t.encode().split()] + [b""] for k, t in texts.items()}
    for k, w in words.items():
        if zlib.crc32(str(k).encode()) % 10:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    bits = []
    for r in lm_score.score_documents(docs).collect():
        w = words[r["doc_id"]]
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(counts[x] > 0 for x in w), n)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0)
        if r["held_out"] and r["n_tokens"] > 50:
            bits.append(r["bits_per_byte"])
    assert np.mean(bits) < 4        # far better than 8 bits a byte on texts not learned from


def test_lm_probabilities():
    """Along the tree, the two branches of every node share all probability."""
    tree = lm_score.huffman(np.arange(256))
    rng = np.random.default_rng(1)
    cells = rng.poisson(0.05, (1 << 6, 256))
    odds = [lm_score._odds(cells, *tree).ravel()]
    length, first, nodes, bits = tree
    p1 = 1 / (1 + np.exp(-(odds[0].reshape(-1, 256)[5] >> 2) / 16))
    total = sum(np.prod([p1[nodes[d]] if bits[d] else 1 - p1[nodes[d]] for d in range(first[s], first[s] + length[s])])
                for s in range(256) if s != lm_score.BEFORE)
    assert total <= 1 + 1e-9


def test_packing(docs, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.pack_documents(docs).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for k, t in texts.items():
        ids = np.array(tokenizer.encode(t, add_special_tokens=False).ids + [packing.END_ID], "<u4")
        at = 0
        for r in sorted(pieces[k], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    used = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE
        used += at
    assert sorted(sequences) == list(range(len(sequences)))
    assert used / (packing.SEQUENCE * len(sequences)) > 0.95


ODD = ["don't we'll it's", "ΑΣ ΣΑΣ", "İ İ", "é é", "a b\u0085c d", "x<|endoftext|>y <|startoftext|>", " ab",
       "１２ ½ ²³", "😀😀 ok", "ǅ ŉ ß", "", "a\x1cb", "中文 词"]


@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=8)), max_size=8))
@settings(max_examples=150, deadline=None)
def test_word_tokenizer(parts):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    text = " ".join(parts).encode("utf-8", "replace").decode()
    t = _TOKENIZERS.setdefault("words", packing.WordTokenizer(path))
    whole = _TOKENIZERS.setdefault("whole", Tokenizer.from_file(path))
    words = text.encode().split()
    assert np.frombuffer(t.ids([words])[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


_TOKENIZERS: dict = {}


@given(st.dictionaries(st.integers(1, 2048), st.integers(1, 30), max_size=40))
@settings(max_examples=100, deadline=None)
def test_patterns(counts):
    placed = Counter()
    for lengths, n in packing.patterns(counts):
        assert sum(lengths) <= 2048 and n > 0
        for x in lengths:
            placed[x] += n
    assert placed == Counter(counts)


def test_sequences(docs):
    """Pieces packed with their ids give back the documents."""
    pieces = packing.tokenize(docs)
    packed = packing.pack(pieces).cache()
    for r in packing.sequences(packed).collect():
        assert len(r["ids"]) == 4 * r["n_ids"]
        assert r["n_padding"] == (0 if r["n_ids"] & (r["n_ids"] - 1) == 0 else 2048 - r["n_ids"])


def _language_slots(text):
    folded = [c if c >= 128 else c | 32 if chr(c).isalpha() else 32 for c in text.encode()]
    out = []
    for order in lang_id.ORDERS:
        for at in range(len(folded) - order + 1):
            h = order * 0x9E3779B1 % 2**32
            for c, factor in zip(folded[at:at + order], lang_id._MULTIPLIERS.tolist(), strict=False):
                h = (h + c) * factor % 2**32
                h ^= h >> 15
            out.append(h >> 32 - lang_id.HASH_BITS)
    return out


def test_language_against_plain_python(spark, docs):
    """Weights from counts of the first half of the learned rows, and the nearest
    codeword of every text, by loops over n-grams."""
    half = (F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 0).alias("half")
    rows = docs.select("doc_id", "text", "lang", half).collect()
    slots = [_language_slots(r["text"] or "") for r in rows]
    model = lang_id.fit(docs)
    assert model.languages == sorted({r["lang"] for r in rows if r["lang"] and zlib.crc32(str(r["doc_id"]).encode()) % 5})
    counts = np.full((len(model.languages), 1 << lang_id.HASH_BITS), 0.1)
    for r, own in zip(rows, slots, strict=True):
        if r["lang"] and r["half"] and zlib.crc32(str(r["doc_id"]).encode()) % 5:
            np.add.at(counts[model.languages.index(r["lang"])], own, 1)
    shares = counts / counts.sum(1, keepdims=True)
    for b, weights in enumerate(model.weights):
        odds = np.log(shares[model.code[:, b] > 0].mean(0) / shares[model.code[:, b] < 0].mean(0))
        assert np.allclose(weights, np.clip(odds, -3, 3), atol=1e-3)
    got = {r["doc_id"]: r for r in lang_id.identify(docs).collect()}
    assert len(got) == len(rows)
    for r, own in zip(rows, slots, strict=True):
        found = got[r["doc_id"]]
        assert found["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (found["lang_pred"], found["score"]) == ("und", 0.0)
            continue
        votes = [sum(float(w[x]) for x in own) / max(len(own), 1) for w in model.weights]
        losses = [sum(t * math.log1p(math.exp(-3 * c * v / s)) for t, c, v, s in zip(trust, code, votes, model.scale, strict=True))
                  for trust, code in zip(model.trust.tolist(), model.code.tolist(), strict=True)]
        weight = [math.exp(-4 * (x - min(losses))) for x in losses]
        assert found["lang_pred"] == model.languages[losses.index(min(losses))]
        assert found["score"] == pytest.approx(max(weight) / sum(weight), abs=1e-6)


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.1"
    df = table(spark, sf, "documents")
    got = lang_id.identify(df).where("held_out").join(df.select("doc_id", "lang"), "doc_id")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98


def test_codewords():
    for n in (2, 3, 4, 7, 8, 40, 150):
        code = lang_id.codewords(n).astype(int)
        assert len({tuple(r) for r in code}) == n and (np.abs(code) == 1).all()
        assert (np.abs(code.sum(0)) < n).all()


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = toxicity.assess(table(spark, sf, "documents"), table(spark, sf, "labels")) \
        .join(table(spark, sf, "labels"), "doc_id").where("held_out").toPandas()
    hit = got[got.toxic == 1].predicted.mean()
    assert hit > 0.85 and got[got.toxic == 0].predicted.mean() < 0.02


def test_grammar():
    m = toxicity.Model({"moron": 4.0, "vequ*": 3.0}, None)

    def clause(text):
        return m.features(text)[1]

    assert clause("the moron came") == 4.0
    assert clause("you moron") == 4.0 * toxicity.NEAR_TARGET
    assert clause("not a moron") == 4.0 * toxicity.NEGATED
    assert clause("she wrote that the moron came") < 4.0 * toxicity.NEAR_TARGET
    assert clause("moron. not here") == 4.0 and clause("not here. moron") == 4.0
    assert clause("i will kill you") == toxicity.THREAT_WEIGHT and clause("kill the process") == 0
    assert clause("une vequaire") == 3.0 and clause("") == 0


def test_latent_vectors_lie_row_after_row():
    project = np.asfortranarray(np.random.default_rng(1).standard_normal((50, 6)))
    index = decontam.Index([7], [np.arange(10, dtype=np.int32)], np.ones(50), project)
    assert index.project.flags.c_contiguous and index.project.shape == (51, 6)


def _clause_scores(model, text):
    """Every clause's score by the grammar's rules, from the places of its words;
    words, hits and tokens of the text."""
    tokens = toxicity._TOKENS.findall(text.lower())
    clauses = [[]]
    for w in tokens:
        if w in ".!?;\n":
            clauses.append([])
        else:
            clauses[-1].append(w)
    scores, hits = [], 0
    for words in clauses:
        kind, weight = [], []
        for w in words:
            learned = max((model.insults.get(t, 0.0) for t in [w] + [w[:k] + "*" for k in (4, 5, 6) if len(w) > k]))
            closed = [c for c, members in toxicity.CLOSED.items() if w in members]
            kind.append("hit" if learned else closed[0] if closed else None)
            weight.append(learned or toxicity.THREAT_WEIGHT)
        target, threat = -9, -9   # the last target, the last threat that waits for one
        for i, x in enumerate(list(kind)):
            if x == toxicity.THREAT:
                kind[i], threat = ("hit", -9) if i - target <= 4 else (None, i)
            elif x == toxicity.TARGET:
                kind[i] = "hit" if i - threat <= 4 else x
                target, threat = i, -9
        score = 0.0
        for i in [i for i, x in enumerate(kind) if x == "hit"]:
            hits += 1
            score += (weight[i] * (toxicity.NEAR_TARGET if toxicity.TARGET in kind[max(0, i - 4):i] else 1)
                      * (toxicity.NEGATED if toxicity.NEGATE in kind[max(0, i - 3):i] else 1)
                      * (toxicity.REPORTED if toxicity.REPORT in kind[:i] else 1))
        scores.append(score)
    return scores, hits, len(tokens)


def _brute_features(model, text):
    scores, hits, n = _clause_scores(model, text)
    return [1.0, max(scores), math.log1p(sum(scores)), math.log1p(100 * hits / n) if n else 0.0]


def test_toxicity_scores(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.fit(docs, labels)
    assert model.insults
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = toxicity.assess(docs, labels).collect()
    assert len(rows) == len(texts)
    for r in rows:
        x = _brute_features(model, texts[r["doc_id"]])
        assert r["clause_score"] == pytest.approx(x[1], abs=1e-9)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-float(np.dot(x, model.coefficients)))), abs=1e-9)
        assert r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_grammar_of_random_words(monkeypatch):
    rng = random.Random(4)
    model = toxicity.Model({"moron": 4.0, "vequ*": 3.0}, None)
    words = ["moron", "vequaire", "kill", "you", "not", "said", "a", "tree", "runs", ".", "them"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(1500)]
    whole = [model.features(t) for t in texts]
    for t, x in zip(texts, whole, strict=True):
        assert x == pytest.approx(_brute_features(model, t))
    # a clause goes on over the blocks of a long text
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    assert [model.features(t) for t in texts] == whole


def test_toxicity_learns_all_terms(spark):
    """21,000 different insults: none is left out."""
    rng = random.Random(3)
    spelled = ["".join("abcdefghij"[int(c)] for c in f"{i:05d}") for i in range(21_000)]
    toxic = [" ".join(rng.sample(group, len(group))) for group in ([f"q{w}" for w in spelled[k::100]] for k in range(100))
             for _ in range(36)]
    clean = [" ".join(f"z{w}" for w in rng.sample(spelled, 40)) for _ in toxic]
    rows = [(2 * i + kind, text) for kind, texts in enumerate((clean, toxic)) for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, docs.selectExpr("doc_id", "int(doc_id % 2) AS toxic"))
    learned = {w for w in model.insults if not w.endswith("*")}
    assert len(learned) > 20_500 and learned <= {f"q{w}" for w in spelled}


def test_urls_nested(spark):
    rng = random.Random(5)
    labels = ["a", "b", "ab", "c"]
    hosts = [".".join(rng.choice(labels) for _ in range(rng.randint(1, 4))) for _ in range(60)]
    paths = ["/" + "/".join(rng.choice(labels) for _ in range(rng.randint(0, 3))) for _ in range(60)]
    rules = {rng.choice(hosts) + rng.choice(["", *paths]): rng.choice(["allow", "block"]) for _ in range(80)}
    pages = [(i, f"http://{rng.choice(hosts)}{rng.choice(paths)}") for i in range(800)]
    got = url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string"),
                                spark.createDataFrame(list(rules.items()), "rule string, verdict string"))
    for r in got.collect():
        fits = [k for k in rules for h, _, p in [k.partition("/")]
                if (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith("/" + p if "/" in k else "")]
        best = max(fits, key=lambda k: (len(k), k), default=None)
        assert (r["rule"], r["verdict"]) == (best, rules.get(best, "allow"))


def test_lm_words_out_of_the_head(docs, monkeypatch):
    """Without a head all words are joined: the scores are those with a head; the
    log-odds are broadcast first and then a file."""
    whole = {r["doc_id"]: r["score"] for r in lm_score.score_documents(docs).collect()}
    monkeypatch.setattr(lm_score, "HEAD", 0)
    monkeypatch.setattr(lm_score, "MAPPED", 0)
    joined = {r["doc_id"]: r["score"] for r in lm_score.score_documents(docs).collect()}
    assert whole.keys() == joined.keys()
    assert all(math.isclose(whole[k], joined[k], rel_tol=1e-5) for k in whole)


def test_lm_slots_follow_the_corpus(docs, monkeypatch):
    assert lm_score.slot_bits(0) == lm_score.SLOT_BITS
    sizes = [sum(1 << b for b in lm_score.slot_bits(lm_score.SLOT_TEXT << k)) for k in range(12)]
    assert all(1.5 * a < b for a, b in zip(sizes, sizes[1:]))
    monkeypatch.setattr(lm_score, "SLOT_BITS", (6, 6, 6))
    few = {r["doc_id"]: r["bits_per_byte"] for r in lm_score.score_documents(docs).collect()}
    monkeypatch.setattr(lm_score, "SLOT_TEXT", 1 << 14)
    more = [r for r in lm_score.score_documents(docs).collect() if r["held_out"] and r["n_tokens"] > 50]
    assert np.mean([r["bits_per_byte"] for r in more]) < np.mean([few[r["doc_id"]] for r in more])


def test_lm_mixer_rows_follow_the_corpus(docs, monkeypatch):
    """A share of the rows, and these are not in the counts that they are mixed by."""
    seen = []

    def learn(sample, tables, words, whole, learn=lm_score._learn_mixer):
        seen.append((sample.count(), words.agg(F.sum("n")).first()[0],
                     sum(len(r["text"].encode().split()) + 1 for r in sample.collect())))
        learn(sample, tables, words, whole)

    monkeypatch.setattr(lm_score, "_learn_mixer", learn)
    for copies in (1, 4):
        more = docs.crossJoin(docs.sparkSession.range(copies)).selectExpr("doc_id * 10 + id AS doc_id", "text")
        n_train = lm_score.score_documents(more, mix_rows=1, mix_share=0.2).first()["train_tokens"]
        assert seen[-1][1] + seen[-1][2] == n_train
    assert seen[1][0] > 2.5 * seen[0][0] > 0


def test_lm_mixer_learns_from_every_row(docs, monkeypatch):
    """In two parts, each mixed by the counts of the other; words coded once stand for all."""
    seen = []

    def learn(parts, learn=lm_score._learn):
        seen.extend((rows.count(), words.agg(F.sum("n")).first()[0],
                     sum(len((r["text"] or "").encode().split()) + 1 for r in rows.collect())) for rows, _, words, _ in parts)
        learn(parts)

    monkeypatch.setattr(lm_score, "_learn", learn)
    rows = lm_score.score_documents(docs).collect()
    assert sum(n for n, *_ in seen) == sum(not r["held_out"] for r in rows)
    assert len(seen) == 2 and (seen[0][1], seen[1][1]) == (seen[1][2], seen[0][2])
    assert {a + b for _, a, b in seen} == {rows[0]["train_tokens"]}


def test_lm_words_coded_once():
    """The bytes that stand for others give each word the cost of all its own bytes."""
    rng = random.Random(3)
    texts = [["".join(rng.choices("abc", k=rng.choice([1, 2, 3, 4, 9, 50]))).encode() for _ in range(rng.randrange(30))]
             for _ in range(60)]
    stream = np.frombuffer(lm_score.AFTER_TEXT.join(map(b" ".join, texts)) + lm_score.AFTER_TEXT, np.uint8)
    key, _ = lm_score._hashed(texts, lm_score.WordHashes())
    once = lm_score.Once.of(stream, key)
    end = np.flatnonzero((stream == 32) | (stream == lm_score.END))
    start = np.concatenate([[0], end[:-1] + 1])
    cost, contexts = np.zeros(len(stream)), {}
    for s, e in zip(start, end, strict=True):
        s += 3 * (stream[s] == lm_score.BEFORE)
        for at in range(s, e + 1):
            near = bytes([lm_score.BEFORE] * 3 + stream[:at].tolist())[-3:]
            cost[at] = contexts.setdefault((near, bytes(stream[max(s, at - 32):at + 1])), rng.random())
    assert np.allclose(once.sums(np.where(once.times > 0, cost, 0)), np.add.reduceat(cost, start))
    assert once.times.sum() == (stream != lm_score.BEFORE).sum() and (once.times > 1).any()
    assert math.isclose(once.times @ cost, cost.sum())


def test_packed_documents_make_padded_sequences(spark, docs, texts):
    """What the pipeline's last stage returns has the ids of every document, and
    whole sequences come from it."""
    expected = Counter(r["ids"] for r in packing.tokenize(docs).collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).cache()
    assert Counter(r["ids"] for r in packed.collect()) == expected
    for r in packing.sequences(packed).collect():
        assert len(r["padded_ids"]) == 4 * (r["n_ids"] + r["n_padding"])
        assert r["padded_ids"] == r["ids"] + packing.PAD_ID.to_bytes(4, "little") * r["n_padding"]


def test_line_links(spark, docs, texts, variants):
    """Every link of different sets, at both ends; and classes of documents."""
    w = [f"v{i}" for i in range(30)]
    chain = [(k, " ".join(w[k:k + 20])) for k in range(0, 6, 2)]     # 0 ~ 2 ~ 4, but not 0 ~ 4
    three = [(10 + k, " ".join([*[f"u{i}" for i in range(12)], f"x{k}"])) for k in range(4)]
    small = spark.createDataFrame([*chain, *three, (20, three[0][1]), (21, "alone here"), (22, None)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_links"], r["class_id"]) for r in line_dedup.count_lines(small).collect()}
    assert got == {0: (1, 0), 2: (2, 0), 4: (1, 0), **{k: (3, 10) for k in range(10, 14)}, 20: (1, 10), 21: (0, 21), 22: (0, 22)}
    for df, own in ((docs, texts), (variants, _texts(variants))):
        first, lines = {}, defaultdict(list)
        for k in sorted(own):
            for line in own[k].split("\n"):
                if s := frozenset(line.encode().split()):
                    lines[k].append((s, first.setdefault(s, k) == k and all(s != x for x, _ in lines[k])))
        sets, where = list(first), defaultdict(list)
        for j, s in enumerate(sets):
            for x in s:
                where[x].append(j)
        degree, parent = Counter(), {k: k for k in own}

        def root(k):
            while parent[k] != k:
                k = parent[k]
            return k

        for j, s in enumerate(sets):
            for i, n in Counter(i for x in s for i in where[x] if i < j).items():
                if 5 * n >= 4 * (len(s) + len(sets[i]) - n):
                    degree[s] += 1
                    degree[sets[i]] += 1
                    a, b = sorted((root(first[s]), root(first[sets[i]])))
                    parent[b] = a
        for k in own:
            for s, _ in lines[k]:
                a, b = sorted((root(k), root(first[s])))
                parent[b] = a
        got = {r["doc_id"]: (r["n_links"], r["class_id"]) for r in line_dedup.count_lines(df).collect()}
        assert got == {k: (sum(degree[s] if new else 1 for s, new in lines[k]), root(k)) for k in own}


def test_every_language_is_learned(spark):
    """More languages than a table of a fixed size would hold, one of them of many rows."""
    rng = random.Random(12)
    def word():
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    vocab = {f"l{k:03d}": [word() for _ in range(15)] for k in range(150)}
    rows, n = [], 0
    for lang, words in vocab.items():
        for _ in range(60 if lang == "l000" else 10):
            rows.append((n, " ".join(rng.choice(words) for _ in range(40)), lang))
            n += 1
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = lang_id.identify(df).join(df.select("doc_id", "lang"), "doc_id").collect()
    assert len({r["lang_pred"] for r in got}) == 150
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    # without a label every text with a letter stays
    blank = df.withColumn("lang", F.lit(None).cast("string")).union(spark.createDataFrame([(-1, "12 34", None)], df.schema))
    assert lang_id.keep_identified(blank).count() == len(rows)
    assert {r["lang_pred"] for r in lang_id.identify(blank).collect()} == {"und"}


def test_texts_travel_in_small_batches(spark, docs, monkeypatch):
    """The jobs that send whole texts to Python send TEXT_ROWS rows at a time, and the
    session is as it was afterwards."""
    seen = {}

    def noted(module, name):
        def call(*args, was=getattr(module, name), **more):
            seen[f"{module.__name__}.{name}"] = int(spark.conf.get(common.ARROW_ROWS))
            return was(*args, **more)

        monkeypatch.setattr(module, name, call)

    spark.conf.set(common.ARROW_ROWS, "10000")
    try:
        for module, name in ((decontam, "randomised_svd"), (lm_score, "_learn"), (packing, "written")):
            noted(module, name)
        few = docs.limit(40)
        decontam.contaminated(few, table(spark, SF, "benchmark")).collect()
        lm_score.score_documents(few).collect()
        packing.pack_documents(few).collect()
        assert list(seen.values()) == [common.TEXT_ROWS] * 3
        assert spark.conf.get(common.ARROW_ROWS) == "10000"
        spark.conf.set(common.ARROW_ROWS, "7")
        with common.text_batches(spark):
            assert spark.conf.get(common.ARROW_ROWS) == "7"
        corpus_pipeline.language(spark, few, "")
        assert spark.conf.get(common.ARROW_ROWS) == "7"
        spark.conf.set(common.ARROW_ROWS, "10000")
        corpus_pipeline.language(spark, few, "")
        assert int(spark.conf.get(common.ARROW_ROWS)) == common.TEXT_ROWS
    finally:
        spark.conf.unset(common.ARROW_ROWS)


def test_model_memory_of_a_stream():
    """What one stream of texts takes, with the sums over its words, per byte of it."""
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 123, 5).tolist()) for _ in range(5_000)]
    texts = [[words[k] for k in rng.integers(0, len(words), 400)] for _ in range(400)]
    stream = np.frombuffer(lm_score.AFTER_TEXT.join([*map(b" ".join, texts), b""]), np.uint8)
    key, _ = lm_score._hashed(texts, lm_score.WordHashes())
    cost = rng.random(len(stream)).astype(np.float32)
    tracemalloc.start()
    try:
        once = lm_score.Once.of(stream, key)
        sums = once.sums(cost)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(sums) == len(key) and np.isfinite(sums).all()
    assert most < 34 * len(stream)


def test_words_stay_known():
    """More words than 150,000 are learned once; how many are remembered never
    changes the ids."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    many = packing.WordTokenizer(path)
    texts = [[b"w%d" % k for k in range(at, at + 20_000)] for at in range(0, 180_000, 20_000)]
    first = [many.ids([t])[0] for t in texts]
    many._learn = None  # nothing is left to learn
    assert [many.ids([t])[0] for t in texts] == first
    few = packing.WordTokenizer(path, 100)
    odd = [[b"Word", b"word,", b"WORD", b"\xc3\x89t\xc3\xa9,", b"a1b", b"don't", b"x", b"x;", b"-;", b";"] * 3] + [t[:300] for t in texts[:3]]
    assert few.ids(odd) == packing.WordTokenizer(path).ids(odd)
    assert few.ids(odd[:1])[0] == np.array(few.tokenizer.encode(b" ".join(odd[0]).decode(), add_special_tokens=False).ids, "<u4").tobytes()


def test_marks_are_tokenized_once():
    """A word with a mark after it costs one lookup of its letters; words that are
    remembered from before are not tokenized again."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    t = packing.WordTokenizer(path, 100)
    asked, part = [], t._part
    t._part = lambda x: asked.append(x) or part(x)
    words = [b"".join((bytes([97 + k % 26]) * (1 + k // 26), b".,;:!?"[k % 6:k % 6 + 1])) for k in range(90)]
    first = t.ids([words])
    assert len(asked) == len(words)
    assert t.ids([words[:50], words[50:], [b"New", b"words", *[b"q%d" % k for k in range(40)]], words])[3] == first[0]
    assert not {x for x in asked[len(words):] if x.isalpha()} - {"new", "words", "q"}


def test_line_sets_are_made_once(docs):
    """The plan makes the ordered set of a line once, and asks for words before that."""
    plan = line_dedup._sets(docs, line_dedup._bin_levels(docs))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array") == plan.count("array_distinct") == 1


def test_rare_words_lead(spark):
    """Lines of rare words and of frequent ones, 4,000 of these, share no prefix words."""
    rng = random.Random(2)
    rows = [(k, " ".join([*[f"w{8 * k + j}" for j in range(8)], *[f"often{j}" for j in rng.sample(range(4_000), 20)]]))
            for k in range(5_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prefixes = line_dedup._prefix_rows(line_dedup._sets(docs, line_dedup._bin_levels(docs)))
    assert prefixes.groupBy("word").count().where("count > 1").count() < 50
