"""Plain rules and the hashed likelihood ratio, against a plain version."""

import math
import re
from collections import Counter

import pytest
import xxhash

from pyspark.sql import functions as F

from salesmill.llm import quality
from salesmill.llm.quality import BUCKETS, SCALE, THRESHOLD, judge_quality
from salesmill.llm.queries import op6_quality

from .conftest import SMALL, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text):
    words = WORD.findall(text or "")
    found = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    found += [
        xxhash.xxh64_intdigest(b.encode(), xxhash.xxh64_intdigest(a.encode(), 42)) for a, b in zip(words, words[1:])
    ]
    return [h % BUCKETS if h < 1 << 63 else (h - (1 << 64)) % BUCKETS for h in found]


def plain(docs, labels):
    """Rows by (doc_id, text)."""
    trusted_ids = {d for d, q in labels if q == 1 and d is not None}
    raw, trusted = Counter(), Counter()
    for doc_id, text in docs:
        raw.update(grams(text))
        if doc_id in trusted_ids:
            trusted.update(grams(text))
    n_raw, n_trusted = sum(raw.values()), sum(trusted.values())

    def weight(b):
        if not n_trusted:
            return 0
        ratio = (trusted[b] + 1) / (n_trusted + BUCKETS) / ((raw[b] + 1) / (n_raw + BUCKETS))
        return math.floor(abs(math.log(ratio) * SCALE) + 0.5) * (1 if ratio > 1 else -1)

    out = []
    for doc_id, text in docs:
        text = text or ""
        words = WORD.findall(text)
        windows = list(zip(words, words[1:], words[2:]))
        count = Counter(windows)
        covered = {p for k, w in enumerate(windows) if count[w] > 1 for p in (k, k + 1, k + 2)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        own = grams(text)
        total = sum(map(weight, own))
        out.append((
            doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), failed,
            not failed and total >= len(own) * round(THRESHOLD * SCALE),
        ))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r)[:8] for r in df.collect()), key=repr)


def test_query_against_plain_version(spark, small):
    labels = [(x["doc_id"], x["quality"]) for x in small("labels")]
    docs = [(d["doc_id"], d["text"]) for d in small("documents")]
    found = got(op6_quality(spark, SMALL))
    assert found == plain(docs, labels)
    given = dict(labels)
    good = [r[7] for r in found if given.get(r[0]) == 1 and not r[6]]
    assert all(good) and any(not r[7] for r in found if given.get(r[0]) == 0)


@pytest.mark.parametrize("labels", [[(9, 1), (10, 0), (None, 1), (9, 0), (9, 1)], []])
def test_odd_documents(spark, odd_docs, labels):
    given = spark.createDataFrame(labels, "doc_id bigint, quality int")
    assert got(judge_quality(odd_docs, given)) == plain(texts(), labels)


def test_no_documents(spark, no_docs):
    assert judge_quality(no_docs, spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")).count() == 0


@pytest.mark.parametrize("words, bits", [(16, 1), (1, 10)])
def test_a_filter_that_lets_others_through_changes_nothing(spark, small, monkeypatch, words, bits):
    """Few bits for many ids: documents that pass by mistake are taken off again."""
    monkeypatch.setattr(quality, "FILTER_WORDS", words)
    monkeypatch.setattr(quality, "FILTER_BITS", bits)
    monkeypatch.setattr(quality, "LEAST_FILTER_WORDS", 1)
    labels = [(x["doc_id"], x["quality"]) for x in small("labels")]
    docs = [(d["doc_id"], d["text"]) for d in small("documents")] + [(None, "no id"), (-3, "a b a b")]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    given = spark.createDataFrame(labels, "doc_id bigint, quality int")
    trusted = given.where("quality = 1").select(given.doc_id.alias("id")).distinct()
    passed = table.crossJoin(quality.id_filter(trusted)).where(quality.may_be_in(F.col("doc_id"), F.col("bits")))
    assert passed.count() > trusted.count() and trusted.join(passed, trusted.id == passed.doc_id, "left_anti").count() <= sum(
        d not in {i for i, _ in docs} for d, q in labels if q == 1
    )
    assert got(judge_quality(table, given)) == plain(docs, labels)


def test_texts_are_not_shuffled_to_find_the_trusted(spark, tmp_path):
    spark.range(2000).selectExpr("id as doc_id", "repeat(concat('w', id, ' '), 50) as text").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    labels = spark.range(1000).selectExpr("id as doc_id", "1 as quality")
    counted = quality.gram_counts(docs, labels.selectExpr("doc_id as id"), 64)
    assert counted.selectExpr("sum(raw)", "sum(trusted)").first() == (2000 * 99, 1000 * 99)
    passed = docs.crossJoin(quality.id_filter(labels.selectExpr("doc_id as id"))).where(
        quality.may_be_in(F.col("doc_id"), F.col("bits"))
    )
    assert 1000 <= passed.count() < 1100
