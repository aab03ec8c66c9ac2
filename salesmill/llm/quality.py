"""Quality rules, with SQL functions only.

Plain rules count words, symbols, repeated lines and repeated word windows. The verdict is a
log-likelihood ratio (as in DSIR, Xie et al., 2023): words and pairs of neighbouring words
are hashed into buckets; two multinomials over the buckets are counted, one from all
documents, one from those trusted; a document scores the mean, over its n-grams, of the
logarithm of trusted over raw probability, and is kept from a fixed threshold on.

The logarithms are rounded to whole numbers (``SCALE`` to one) before they are added, so a
score is exact and the same for any order of work.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

BUCKETS = 1 << 16
SCALE = 1 << 16
SMOOTHING = 1.0          # added to the count of every bucket
THRESHOLD = -0.25        # mean log ratio, natural logarithm
SPACE = " \t\n\x0b\x0c\r"
LEAST_WORDS = 50
MOST_REPEATED = 50       # percent of words in repeated windows
REPEAT_WINDOW = 3
FILTER_WORDS = 1 << 19   # of 64 bits: 4 MB
LEAST_FILTER_WORDS = 1 << 10
FILTER_BITS = 10         # for an id
FILTER_HASHES = 4


def words_of(text: str = "text") -> Column:
    """The words of a text, as an array; none for a null text."""
    inner = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(SPACE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often its lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def grams(words: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of all words and of all pairs of neighbouring words."""
    def hashed(*parts: Column) -> Column:
        return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")

    return _bound(words, lambda w: F.concat(
        F.transform(w, lambda x: hashed(x)),
        F.transform(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: hashed(x, F.get(w, i + 1))),
    ))


def repeated_words(words: Column) -> Column:
    """Words in windows of three that the text holds more than once, the first included."""
    def windows(w: Column) -> Column:
        return F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - (REPEAT_WINDOW - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)),
        )

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = _bound(placed, lambda s: F.filter(
            s, lambda x, k: x["h"].eqNullSafe(F.get(s, k - 1)["h"]) | x["h"].eqNullSafe(F.get(s, k + 1)["h"])
        ))
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            F.sort_array(F.transform(twice, lambda x: x["i"])),
            start,
            lambda a, i: F.struct(
                (a["n"] + i + REPEAT_WINDOW - F.greatest(i, a["end"])).alias("n"), (i + REPEAT_WINDOW).alias("end")
            ),
            lambda a: a["n"],
        )

    hashes = _bound(words, windows)
    return _bound(
        hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))
    ).cast("bigint")


def id_filter(ids: DataFrame) -> DataFrame:
    """One row, ``bits``: a Bloom filter of ``ids(id)`` in words of 64 bits, of ``FILTER_WORDS`` at most.

    Beyond that it lets more through, which costs work and changes no result.
    """
    words = LEAST_FILTER_WORDS
    while words < min(FILTER_WORDS, ids.count() * FILTER_BITS // 64):
        words *= 2
    at = F.explode(F.array(*_cells(F.col("id"), words))).alias("at")
    set_bits = ids.select(at).groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("b")
    )
    all_words = ids.sparkSession.range(words).select(F.col("id").alias("word"))
    dense = all_words.join(set_bits, "word", "left").select("word", F.coalesce("b", F.lit(0).cast("bigint")).alias("b"))
    return dense.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "b"))), lambda x: x["b"]).alias("bits"))


def _cells(value: Column, words: Column | int) -> list[Column]:
    words = F.lit(words) if isinstance(words, int) else words
    return [F.pmod(F.xxhash64(value, F.lit(seed)), words.cast("bigint") * 64) for seed in range(FILTER_HASHES)]


def may_be_in(value: Column, bits: Column) -> Column:
    """False only for what is not among the ids of the filter."""
    found = [
        F.getbit(F.get(bits, F.shiftright(cell, 6).cast("int")), cell.bitwiseAND(63).cast("int")) == 1
        for cell in _cells(value, F.size(bits))
    ]
    return value.isNotNull() & reduce(Column.__and__, found)


def gram_counts(docs: DataFrame, trusted: DataFrame, buckets: int) -> DataFrame:
    """``bucket, raw, trusted``: n-grams of all documents, and of those whose id is among ``trusted(id)``.

    One pass counts all, and apart from them those that a filter of the trusted ids lets through. Of
    these the few that are not trusted after all are counted in a second pass and taken off: they
    are the only texts that are shuffled. Counts are reduced within tasks to at most one row per
    bucket before they are.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text")
    bits = stage(id_filter(trusted), "trusted-filter").scalar()
    let_in = may_be_in(F.col("id"), F.col("bits"))
    passed = rows.withColumn("bits", bits).withColumn("passed", let_in).drop("bits")
    counted = stage(
        passed.select(F.when(F.col("passed"), 1).alias("passed"), F.explode(grams(words_of(), buckets)).alias("bucket"))
        .groupBy("bucket").agg(F.count("*").alias("raw"), F.count("passed").alias("trusted")),
        "gram-counts",
    )
    mistaken = stage(
        passed.where("passed").select("id").distinct().join(trusted, "id", "left_anti"), "trusted-by-mistake"
    )
    if mistaken.isEmpty():
        return counted
    again = stage(id_filter(mistaken), "mistaken-filter").scalar()
    few = passed.where("passed").drop("passed").withColumn("bits", again).where(may_be_in(F.col("id"), F.col("bits")))
    # Ids that are taken for trusted grow with the documents, so both sides are shuffled.
    off = (
        few.drop("bits").join(mistaken.hint("merge"), "id", "left_semi")
        .select(F.explode(grams(words_of(), buckets)).alias("bucket"))
        .groupBy("bucket").agg(F.count("*").alias("off"))
    )
    exact = F.col("trusted") - F.coalesce("off", F.lit(0))
    return stage(counted.join(off, "bucket", "left").select("bucket", "raw", exact.alias("trusted")), "gram-counts")


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row, ``weights``: for each bucket the rounded log of trusted over raw probability.

    All documents are counted, those labelled of quality 1 as trusted too. Without trusted
    documents every weight is 0.
    """
    trusted = stage(
        labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("bigint").alias("id")).distinct(),
        "trusted-ids",
    )
    counted = gram_counts(docs, trusted, buckets)
    total = counted.agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted")).first()
    if not total.trusted:
        return docs.sparkSession.range(1).select(F.array_repeat(F.lit(0), buckets).alias("weights"))

    def share(count: str, of: int) -> Column:
        return (F.coalesce(F.col(count), F.lit(0)) + SMOOTHING) / (of + SMOOTHING * buckets)

    all_buckets = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    ratio = F.round(F.log(share("trusted", total.trusted) / share("raw", total.raw)) * SCALE).cast("int")
    return all_buckets.join(counted, "bucket", "left").select("bucket", ratio.alias("w")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("bucket", "w"))), lambda x: x["w"]).alias("weights")
    )


def judge_quality(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS
) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, log_ratio``.

    Null and empty texts have no words, fail the plain rules and have log ratio 0. Repeated
    rows count as often as they come; rows with a null doc_id are never trusted. Labels that
    contradict each other trust the document. Other columns are not read.
    """
    weights = stage(log_ratios(docs, labels, buckets), "gram-weights")
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    measured = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", words_of().alias("words")).select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]", ""))).cast("bigint").alias("n_symbols"),
        _bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        # One row of a fixed number of whole numbers: a scalar to every task.
        F.struct(weights.scalar().alias("w"), grams(F.col("words"), buckets).alias("g")).alias("x"),
    )
    summed = F.aggregate("x.g", F.lit(0).cast("bigint"), lambda a, g: a + F.get(F.col("x.w"), g))
    return measured.select(
        "*", summed.alias("summed"), F.size("x.g").cast("bigint").alias("n_grams")
    ).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
        .alias("base_failed"),
        "summed", "n_grams",
    ).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("summed") >= F.col("n_grams") * round(threshold * SCALE))).alias("kept"),
        (F.col("summed") / SCALE / F.greatest("n_grams", F.lit(1))).alias("log_ratio"),
    )
