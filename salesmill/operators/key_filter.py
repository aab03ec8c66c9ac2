"""Rows divided by a set of keys, of which only rows that may have such a key are shuffled."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import quoted, stage

# Fewer keys are joined as they are: Spark broadcasts them, or the join is small.
FILTER_FROM = 100_000
BITS_PER_KEY, HASHES = 10, 3
# Words of 64 bits. A filter is 16 MB at most; beyond that it lets more through, which costs work and changes no result.
LEAST_WORDS, MOST_WORDS = 1 << 10, 1 << 21
BITS, ZERO = "__key_bits", "__zero"


def divide_by_keys(rows: DataFrame, held: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose key is among ``held``, and the others; a null key is among none.

    ``held`` has each key once and should be a written table. Of many keys a Bloom filter is made first: a row that it
    does not let through has no such key and stays where it is. Of those that it lets through, keys alone tell which
    are mistakes; rows are then shuffled only if they may have one of these. Runs jobs.
    """
    keys = list(keys)
    held, names = held.select(*map(quoted, keys)), [quoted(c) for c in rows.columns]
    count = held.count()
    if count < FILTER_FROM:
        return rows.join(held, keys, "left_semi").select(*names), rows.join(held, keys, "left_anti").select(*names)
    let_through, stopped = divide_by_filter(rows, held, keys, count)
    missed = stage(let_through.select(*map(quoted, keys)).join(held, keys, "left_anti").distinct(), "keys-let-through")
    mistaken = missed.count()
    if mistaken < FILTER_FROM:
        kept = let_through.join(missed, keys, "left_semi")
    else:
        kept = divide_by_filter(let_through, missed, keys, mistaken)[0].join(held, keys, "left_anti")
    return let_through.join(held, keys, "left_semi").select(*names), stopped.unionByName(kept.select(*names))


def rows_with_keys(rows: DataFrame, held: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The first of what ``divide_by_keys`` returns, without the work that tells the others."""
    held, names = held.select(*map(quoted, keys)), [quoted(c) for c in rows.columns]
    count = held.count()
    if count >= FILTER_FROM:
        rows = divide_by_filter(rows, held, keys, count)[0]
    return rows.join(held, list(keys), "left_semi").select(*names)


def fits_filter(count: int) -> bool:
    """Whether a filter of so many keys is worth its making, and lets little through by mistake."""
    return FILTER_FROM <= count <= MOST_WORDS * 64 // BITS_PER_KEY


def divide_by_filter(rows: DataFrame, held: DataFrame, keys: Sequence[str], count: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` that may have one of the keys of ``held``, which has ``count`` rows, and those that surely have none: all that
    have one are among the first, and few others. A null key is among none; a key may be there several times. Runs a job.

    The filter is a table of one row that is broadcast. As a value within a plan it would be held by the driver once for each
    place it stands in, and sent anew with each stage.
    """
    words = LEAST_WORDS
    while words < min(MOST_WORDS, count * BITS_PER_KEY // 64):
        words *= 2
    bits = F.broadcast(stage(_key_filter(held.select(*map(quoted, keys)), words).withColumn(ZERO, F.lit(0).cast("bigint")), "key-filter"))
    complete = reduce(Column.__and__, [F.col(quoted(key)).isNotNull() for key in keys])
    may_hold = complete & _may_hold(F.col(BITS), keys, words)
    # Semi-joins, as an inner one might copy the filter to each row.
    met = F.pmod(F.xxhash64(*map(quoted, keys)), F.lit(1).cast("bigint")) == F.col(ZERO)   # always
    return rows.join(bits, met & may_hold, "left_semi"), rows.join(bits, met & ~may_hold, "left_semi")


def _cells(keys: Sequence[str], words: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed), *map(quoted, keys)), F.lit(words * 64)) for seed in range(HASHES)]


def _key_filter(held: DataFrame, words: int) -> DataFrame:
    """One row, ``BITS``."""
    at = F.explode(F.array(*_cells(held.columns, words))).alias("at")
    set_bits = held.select(at).groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("b")
    )
    all_words = held.sparkSession.range(words).select(F.col("id").alias("word"))
    dense = all_words.join(set_bits, "word", "left").select("word", F.coalesce("b", F.lit(0).cast("bigint")).alias("b"))
    return dense.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "b"))), lambda x: x["b"]).alias(BITS))


def _may_hold(bits: Column, keys: Sequence[str], words: int) -> Column:
    found = [
        F.getbit(F.get(bits, F.shiftright(cell, 6).cast("int")), cell.bitwiseAND(63).cast("int")) == 1
        for cell in _cells(keys, words)
    ]
    return reduce(Column.__and__, found)
