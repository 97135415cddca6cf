"""Every operator and stage on nulls, empty and long texts, ties, repeated rows,
empty tables and clashing names."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripmart.llm import (decontam, lang_id, line_dedup, lm_score, near_dup, packing, quality, substrings, toxicity,
                          url_filter)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0), (1, 0), (2, 1), (9, 0), (None, 1), (6, None), (77, 1)],
                                 "doc_id long, toxic int").withColumn("text", F.lit("a clash"))


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(
        [(1, "Another line follows it, with other words."), (2, None), (3, ""), (4, "two words"),
         (1, "Another line follows it, with other words."), (None, "nobody wrote these five words")],
        "item_id long, text string").withColumn("doc_id", F.lit(5))


def test_language(odd_docs, no_docs):
    rows = lang_id.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r["doc_id"]: r["lang_pred"] for r in rows if r["doc_id"] in (3, 4, 5, 8)} == dict.fromkeys((3, 4, 5, 8), "und")
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert lang_id.identify(no_docs).count() == 0
    kept = lang_id.keep_identified(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 4


def test_lines(odd_docs, no_docs):
    rows = line_dedup.count_lines(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append((r["n_lines"], r["n_copies"], r["n_similar"]))
    assert by_id[None] == [(2, 0, 0)]                 # null ids come first
    assert by_id[1] == [(2, 2, 0)] * 2 and by_id[2] == [(2, 2, 0)]
    assert by_id[3] == by_id[4] == by_id[5] == [(0, 0, 0)]
    kept = line_dedup.dedup_lines(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "4", "5", "6", "6", "7", "8", "9", "None"]
    assert line_dedup.count_lines(no_docs).count() == 0 and line_dedup.dedup_lines(no_docs).count() == 0


def test_near_duplicates(odd_docs, no_docs):
    rows = {(r["doc_id"], r["class_size"]): r for r in near_dup.classify(odd_docs).collect()}
    assert rows[(1, 3)]["class_id"] == rows[(2, 3)]["class_id"] == rows[(None, 3)]["class_id"] == 1
    assert rows[(3, 1)]["class_id"] == 3 and rows[(4, 1)]["class_id"] == 4
    kept = near_dup.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5, 6, 6, 7, 8, 9]
    assert near_dup.classify(no_docs).count() == 0 and near_dup.keep_first(no_docs).count() == 0


def test_quality(odd_docs, no_docs):
    rows = quality.judge(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    empty = [r for r in rows if r["doc_id"] in (3, 4, 5)]
    assert all(r["n_words"] == r["word_chars"] == 0 and r["base_failed"] and not r["kept"] for r in empty)
    assert {r["n_words"] for r in rows if r["doc_id"] == 6} == {60_000, 5}
    assert quality.judge(no_docs).count() == 0


def test_toxicity(odd_docs, no_docs, labels):
    rows = toxicity.assess(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.assess(odd_docs, labels.limit(0)).agg(F.max("score")).first()[0] == 0
    assert toxicity.assess(no_docs, labels).count() == 0


def test_substrings(odd_docs, no_docs):
    rows = substrings.digest(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    of = {}
    for r in rows:
        of.setdefault(r["doc_id"], []).append(r)
    assert of[None][0]["n_removed"] == 0              # null ids come first
    assert all(r["n_removed"] == r["n_bytes"] > 0 and r["n_spans"] == 1 for r in of[1] + of[2])
    assert all(of[k][0]["kept_sha256"] == hashlib.sha256(b"").hexdigest() for k in (1, 3, 4))
    assert substrings.digest(no_docs).count() == 0


def test_decontamination(odd_docs, no_docs, benchmark):
    rows = decontam.contaminated(odd_docs, benchmark).collect()
    assert sorted((str(r["doc_id"]), r["item_id"]) for r in rows) == [("1", 1), ("1", 1), ("2", 1), ("None", 1)]
    assert decontam.contaminated(no_docs, benchmark).count() == 0
    assert decontam.contaminated(odd_docs, benchmark.limit(0)).count() == 0


def test_lm(odd_docs, no_docs):
    rows = lm_score.score_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r["score"] < 0 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (3, 4, 5)} == {1}
    assert lm_score.score_documents(no_docs).count() == 0


def test_packing(odd_docs, no_docs):
    rows = packing.pack_documents(odd_docs).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] in (3, 4, 5)) == 3
    seen = {}
    for r in rows:
        seen.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in seen.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE
    assert packing.pack_documents(no_docs).count() == 0


def test_urls(spark):
    pages = spark.createDataFrame(
        [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.NET/en/x?y"), (4, "http://A.Example.NET/en/x?y"),
         (5, "https://net/"), (6, "https://net"), (7, "x://notnet/"), (None, "http://b.org/fr/"), (8, "http://b.org/fr"),
         (9, "http://example.com.evil.net/de/#a://b/c")], "page_id long, url string").withColumn("host", F.lit("clash"))
    got = sorted((str(r["page_id"]), r["host"], r["path"], str(r["rule"]), r["verdict"])
                 for r in url_filter.judge_urls(pages, url_filter.default_rules(spark)).collect())
    assert got == sorted([
        ("1", "", "", "None", "allow"), ("2", "", "", "None", "allow"), ("3", "", "", "None", "allow"),
        *[("4", "a.example.net", "/en/x", "example.net/en/", "allow")] * 2, ("5", "net", "/", "net/", "block"),
        ("6", "net", "", "None", "allow"), ("7", "notnet", "/", "None", "allow"), ("None", "b.org", "/fr/", "org/fr/", "allow"),
        ("8", "b.org", "/fr", "None", "allow"), ("9", "example.com.evil.net", "/de/", "net/", "block")])
    assert url_filter.judge_urls(pages.limit(0), url_filter.default_rules(spark)).count() == 0
    rules = url_filter.default_rules(spark).limit(0)
    assert {r["verdict"] for r in url_filter.judge_urls(pages, rules).collect()} == {"allow"}


def test_stages(spark, odd_docs, no_docs, benchmark, tmp_path):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count()
