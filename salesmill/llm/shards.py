"""Sharding by a two-pass external shuffle, with SQL functions only.

Pass one scatters the records uniformly into buckets that fit in memory, by a seeded hash;
pass two shuffles each bucket (Fisher-Yates, Spark's ``shuffle``) and writes it. The buckets
one after another are a random order of all records, and that order, cut into equal parts,
gives the shards: their counts differ by one at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import scratch_folder, stage
from .ranks import ranked

SHARDS = 40
SEED = 42
BUCKET_BYTES = 32 << 20
RECORD_BYTES = 16   # of a record besides its text


def record_size(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + RECORD_BYTES).cast("bigint")


def _numbered(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows as ``record`` with a hash of what they hold (``a, b``) and a number among equal rows (``nth``);
    and the bytes of all.

    Only rows that come more than once are ranked, over as many tasks as they need.
    """
    hashable = [c for c, kind in docs.dtypes if "map<" not in kind]
    values = [part for c in hashable for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    rows = docs.select(
        F.struct("*").alias("record"), *[F.xxhash64(F.lit(k), *values).alias(name) for k, name in enumerate("ab")]
    )
    prints = stage(
        rows.groupBy("a", "b").agg(F.count("*").alias("copies"), F.sum(record_size("record.text")).alias("bytes")),
        "shard-prints",
    )
    total = prints.agg(F.sum("bytes")).first()[0] or 0
    repeated = prints.where("copies > 1").select("a", "b")
    first = F.lit(0).cast("bigint").alias("nth")
    if repeated.isEmpty():
        return rows.select("record", "a", "b", first), total
    alone = rows.join(repeated, ["a", "b"], "left_anti").select("record", "a", "b", first)
    several = rows.join(repeated, ["a", "b"], "left_semi").withColumn("key", F.concat_ws(":", "a", "b"))
    copies = ranked(several, "key", [], "shard-copies").select("record", "a", "b", F.col("pos").alias("nth"))
    return alone.unionByName(copies), total


def write_shards(
    docs: DataFrame,
    folder: str,
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> None:
    """Write every row of ``docs`` below ``folder``, as ``shard=.../`` files of rows
    ``record`` (all columns of ``docs``) and ``slot`` (its place in the shard, from 0).

    Where a row goes follows from what it holds, from its number among rows that are equal to it in
    everything, and from the seed: the same rows and seed give the same shards, however
    many tasks read them, and lost tasks may run again. Equal texts, repeated rows and null ids spread like all
    others; no bucket can fill up with copies. A longer text than a bucket makes its bucket that
    much larger. An empty table writes no row.

    Each bucket is one task of the shuffle, so none holds more than one in memory. Their counts are one row
    each, ordered by a window in one task.
    """
    rows, total = _numbered(docs)
    buckets = max(shards, -(-total // bucket_bytes))
    bucket = F.pmod(F.xxhash64("a", "b", "nth", F.lit(seed)), F.lit(buckets)).cast("int")
    scattered = rows.withColumn("bucket", bucket)
    # Place of each bucket in the order: one row per bucket.
    counts = scattered.groupBy("bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    places = stage(
        counts.select("bucket", "n", F.coalesce(before, F.lit(0)).alias("before")), "shard-buckets"
    )
    n = places.agg(F.sum("n")).first()[0] or 0

    # The order in which records reach a bucket must not tell: sorted first, then shuffled.
    gathered = scattered.select("bucket", F.struct("a", "b", "nth", "record").alias("r")).repartitionById(
        buckets, F.col("bucket")
    ).groupBy("bucket").agg(F.sort_array(F.collect_list("r")).alias("records"))
    shuffled = gathered.join(places.select("bucket", "before"), "bucket").select(
        "before", F.posexplode(F.shuffle("records", seed)).alias("place", "r")
    )
    # Whole numbers: the first place of a shard is the least that divides into it.
    shard = F.expr(f"(before + place) * {shards}L div {max(n, 1)}L").cast("int")
    first = F.expr(f"(shard * {n}L + {shards - 1}L) div {shards}L")
    (
        shuffled.withColumn("shard", shard)
        .select("r.record", (F.col("before") + F.col("place") - first).alias("slot"), "shard")
        .write.partitionBy("shard").parquet(folder)
    )


def shard_digest(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Write the shards to the shared scratch folder, and from them per row: ``doc_id, size,
    text_crc32, law, shard, slot, grown_shard``. A null text has no bytes and crc 0."""
    spark = docs.sparkSession
    folder = scratch_folder(spark, "shards")
    write_shards(docs, folder, shards, seed)
    layout = f"record {docs.select(F.struct('*').alias('r')).schema['r'].dataType.simpleString()}, slot bigint, shard int"
    written = spark.read.schema(layout).parquet(folder)
    return written.select(
        F.col("record.doc_id").cast("bigint").alias("doc_id"),
        record_size("record.text").alias("size"),
        F.crc32(F.coalesce(F.col("record.text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
