"""Shards hold every row once, in counts that differ by one, in no order of the input."""

import zlib

import pytest

from salesmill.llm.queries import op5_shuffled_shards
from salesmill.llm.shards import shard_digest, write_shards

from .conftest import SMALL, texts


def check(rows, shards):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
    for slots in by_shard.values():
        assert sorted(slots) == list(range(len(slots)))
    counts = [len(by_shard.get(s, [])) for s in range(shards)]
    assert set(by_shard) <= set(range(shards)) and max(counts) - min(counts) <= 1
    assert {(r.law, r.grown_shard) for r in rows} <= {("rows", None)}


def test_query(spark, small):
    rows = op5_shuffled_shards(spark, SMALL).collect()
    check(rows, 40)
    want = {d["doc_id"]: (len(d["text"].encode()) + 16, zlib.crc32(d["text"].encode())) for d in small("documents")}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == want and len(rows) == len(want)
    ordered = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    followers = sum(b == a + 1 for a, b in zip(ordered, ordered[1:]))
    assert followers < 0.1 * len(ordered)


@pytest.mark.parametrize("shards", [1, 3, 7, 50])
def test_odd_documents(stored_odd_docs, shards):
    rows = shard_digest(stored_odd_docs, shards).collect()
    check(rows, shards)
    want = sorted(((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in texts()), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=repr) == want


def test_all_columns_are_written(spark, stored_odd_docs, tmp_path):
    write_shards(stored_odd_docs, str(tmp_path / "shards"), 4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.select("record.*").columns == stored_odd_docs.columns


def test_another_seed_is_another_order(stored_odd_docs):
    one, other = (
        [(r.doc_id, r.size) for r in shard_digest(stored_odd_docs, 2, seed).orderBy("shard", "slot").collect()]
        for seed in (1, 2)
    )
    assert one != other and sorted(one, key=repr) == sorted(other, key=repr)


def test_every_place_is_as_likely(spark, tmp_path):
    spark.range(40).selectExpr("id as doc_id", "'t' as text").coalesce(1).write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    first = [0] * 4
    for seed in range(12):
        for r in shard_digest(docs, 4, seed).where("doc_id < 10").collect():
            first[r.shard] += 1
    assert min(first) > 12   # 30 expected in each


def test_no_documents(spark, no_docs, tmp_path):
    no_docs.write.parquet(str(tmp_path / "none"))
    assert shard_digest(spark.read.schema(no_docs.schema).parquet(str(tmp_path / "none"))).count() == 0


def test_same_rows_and_seed_are_the_same_shards(spark, odd_docs, tmp_path):
    """Whatever files the rows lie in and however many tasks read and shuffle them; copies of whole rows included."""
    docs = odd_docs.union(odd_docs).union(odd_docs.limit(3))
    found = []
    for parts, shuffled in ((1, 2), (7, 5)):
        docs.repartition(parts).write.parquet(f"{tmp_path}/{parts}")
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", shuffled)
        rows = shard_digest(spark.read.parquet(f"{tmp_path}/{parts}"), 5).collect()
        spark.conf.set("spark.sql.shuffle.partitions", before)
        check(rows, 5)
        found.append(sorted(((r.shard, r.slot, r.doc_id, r.text_crc32) for r in rows), key=repr))
    assert found[0] == found[1]


def test_texts_longer_than_a_bucket(spark, stored_odd_docs, tmp_path):
    """Buckets of 64 bytes: nearly every text is longer than one."""
    write_shards(stored_odd_docs, str(tmp_path / "shards"), 3, bucket_bytes=64)
    back = spark.read.parquet(str(tmp_path / "shards"))
    rows = back.select("shard", "slot", "record.doc_id", "record.text").collect()
    by_shard = [sorted(r.slot for r in rows if r.shard == s) for s in range(3)]
    assert all(slots == list(range(len(slots))) for slots in by_shard)
    assert max(map(len, by_shard)) - min(map(len, by_shard)) <= 1
    assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == sorted(texts(), key=repr)


def test_copies_of_one_row_spread(spark, tmp_path):
    spark.range(3000).selectExpr("7L as doc_id", "'same' as text").write.parquet(str(tmp_path / "t"))
    rows = shard_digest(spark.read.parquet(str(tmp_path / "t")), 4).collect()
    check(rows, 4)
    assert len(rows) == 3000


def test_a_bucket_is_a_task(spark, stored_odd_docs, tmp_path, monkeypatch):
    """The shuffle has as many partitions as there are buckets, and no other exchange of records follows."""
    from salesmill.llm import shards

    asked = []
    original = type(stored_odd_docs).repartitionById
    monkeypatch.setattr(
        type(stored_odd_docs), "repartitionById", lambda self, n, by: asked.append(n) or original(self, n, by)
    )
    shards.write_shards(stored_odd_docs, str(tmp_path / "s"), 3, bucket_bytes=1000)
    size = sum(len((t or "").encode()) + 16 for _, t in texts())
    assert asked == [-(-size // 1000)]
