"""Row and key level set operators."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..session import quoted, stage
from . import key_filter


def distinct_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, of the named columns or of all."""
    return (df.select(*columns) if columns else df).distinct()


def row_fingerprint(columns: Sequence[Column]) -> list[Column]:
    """128 bits of the columns' values, as two numbers; null counts as a value."""
    values = [part for c in columns for part in (c.isNull(), c)]
    return [F.xxhash64(F.lit(seed), *values) for seed in (1, 2)]


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole rows, once each, for wide tables of mostly distinct rows.

    Fingerprints are shuffled in place of rows; a row whose fingerprint no other has is distinct
    and stays where it is. Only rows that a filter of the fingerprints that repeat lets through are shuffled and compared
    whole, so fingerprints that only happen to be equal lose no row. Runs a job; ``df`` is
    read three times: it should be a stored table.
    """
    names = [quoted(c) for c in df.columns]
    # As in distinct(), zero has no sign.
    fractions = {f.name: F.col(quoted(f.name)) + F.lit(0).cast(f.dataType) for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    df = df.withColumns(fractions) if fractions else df
    marked = df.withColumn("__print", row_fingerprint([F.col(c) for c in names])[0])
    counted = marked.groupBy("__print").agg(F.count(F.lit(1)).alias("n"))
    repeated = stage(counted.where("n > 1").select("__print"), "rows-repeated")
    count = repeated.count()
    if not count:
        return df
    several, alone = key_filter.divide_by_filter(marked, repeated, ["__print"], count)
    return alone.select(*names).unionByName(several.select(*names).distinct())


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_as: str = "copies") -> DataFrame:
    """Keys held by more than one row, and by how many; null counts as a value."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as)).where(F.col(count_as) > 1)


def common_values(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in both inputs, once each.

    Each side is made distinct before they meet: ``intersect`` alone would shuffle every
    repetition of a value first and drop it after.
    """
    return left.distinct().intersect(right.distinct())


def keep_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order_by`` values, null being least.

    Remaining columns break ties, so the same row wins on every run. This is a maximum
    and no window: each task keeps one row per key before the shuffle, so a key holding a third of all rows
    costs one row per task. Rows with a null in the key match nothing and are all kept.

    Runs jobs: ``df`` is computed once and written to the scratch folder. Of many rows, fingerprints of the keys tell which
    repeat, and only rows that a filter of these lets through are shuffled; a key without another row has its latest
    row already.
    """
    rows = stage(df, "latest-rows")
    if rows.count() < key_filter.FILTER_FROM:
        return _latest_of_all(rows, keys, order_by)
    key = [F.col(quoted(key)) for key in keys]
    complete = reduce(Column.__and__, [k.isNotNull() for k in key])
    marked = rows.withColumn("__print", F.when(complete, row_fingerprint(key)[0]))
    counted = marked.where("__print IS NOT NULL").groupBy("__print").agg(F.count(F.lit(1)).alias("n"))
    repeated = stage(counted.where("n > 1").select("__print"), "keys-repeated")
    count = repeated.count()
    if not count:
        return rows
    several, alone = key_filter.divide_by_filter(marked, repeated, ["__print"], count)
    names = [quoted(c) for c in rows.columns]
    return alone.select(*names).unionByName(_latest_of_all(several.select(*names), keys, order_by))


def _latest_of_all(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Each row with a null in the key has a number of its own in place of a key, so the input is read once."""
    complete = reduce(Column.__and__, [F.col(quoted(key)).isNotNull() for key in keys])
    alone = F.when(~complete, F.monotonically_increasing_id())
    names = df.columns
    rest = [name for name in names if name not in order_by]
    row = F.struct(*[F.col(quoted(name)) for name in [*order_by, *rest]])
    held = [F.col(quoted(key)).alias(f"__key_{i}") for i, key in enumerate(keys)]
    best = df.groupBy(*held, alone.alias("__alone")).agg(F.max(row).alias("best"))
    return best.select([F.col("best")[name].alias(name) for name in names])


def best_of_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """``keep_latest`` for rows whose key has no null; lazy."""
    ranked = [name for name in order_by if name not in keys]
    rest = [name for name in df.columns if name not in keys and name not in ranked]
    best = df.groupBy(*keys).agg(F.max(F.struct(*ranked, *rest)).alias("best"))
    return best.select(*keys, "best.*").select(*df.columns)


def sample(df: DataFrame, columns: Iterable[str], order_by: Sequence[str], rows: int) -> DataFrame:
    """The first ``rows`` rows in a stated order, for display."""
    return df.select(*columns).orderBy(*order_by).limit(rows)


def in_partitions(rows: Sequence[Row], partition_by: Sequence[str]) -> Column:
    """Whether a row is of one of the given partitions: a filter that the scan can prune by, with
    one term for each value of the outer columns."""
    *outer, last = partition_by
    inner_values = defaultdict(list)
    for row in rows:
        inner_values[tuple(row[c] for c in outer)].append(row[last])
    terms = [F.lit(False)]
    for prefix, values in inner_values.items():
        term = F.col(quoted(last)).isin([v for v in values if v is not None])
        if None in values:
            term = term | F.col(quoted(last)).isNull()
        for name, value in zip(outer, prefix):
            term = F.col(quoted(name)).eqNullSafe(F.lit(value)) & term
        terms.append(term)
    return reduce(Column.__or__, terms[1:] or terms)
