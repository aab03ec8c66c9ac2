"""Upsert by key: update rows that match, insert rows that do not.

The result is that of ``MERGE ... WHEN MATCHED UPDATE SET * WHEN NOT MATCHED INSERT *``:

* keys compare with ``=``, so a null key never matches;
* every target row that matches takes the source row's values, also when several do;
* a source with two rows for one *matched* key is refused;
* source rows that match nothing are all inserted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import key_filter
from .key_filter import divide_by_filter, divide_by_keys, rows_with_keys
from .rows import best_of_key, in_partitions


class AmbiguousSourceError(ValueError):
    """Two source rows claim the same target row."""


@dataclass(frozen=True)
class StagedSource:
    """A source written out, and which of its keys the target holds.

    ``taken``: each key that the target holds, once, and in how many rows (``copies``). Only these can
    remove a row of it; for a source that mostly inserts they are few. A written table.
    ``places``: the ``location`` columns (its partitions, if any) of target rows with such a key, once each.
    """

    keys: tuple[str, ...]
    rows: DataFrame
    taken: DataFrame
    places: DataFrame | None = None

    def removed(self, target: DataFrame) -> DataFrame:
        """Rows of ``target`` that the source replaces."""
        return rows_with_keys(target, self.taken, self.keys)

    def merge_into(self, target: DataFrame) -> DataFrame:
        """``target`` with the source upserted; lazy.

        Both written sides of these joins hold a key once and come straight from a scan:
        neither can be skewed, and adaptive execution is free to split the target. Where keys are many, only
        rows that may have one of them are shuffled.
        """
        return self.untouched(target).unionByName(self.added(target))

    def untouched(self, target: DataFrame) -> DataFrame:
        """Rows of ``target`` that stay as they are."""
        if self.taken.isEmpty():
            return target
        return divide_by_keys(target, self.taken, self.keys)[1]

    def added(self, target: DataFrame) -> DataFrame:
        """Rows that the merge puts in: each source row, as often as ``target`` holds its key, once if it does not."""
        keys = list(self.keys)
        repeated = self.taken.where("copies > 1")
        if repeated.isEmpty():
            return self.rows.select(*target.columns)
        repeated_keys = stage(repeated.select(*keys), "repeated-keys")
        several, once = divide_by_keys(self.rows, repeated_keys, keys)
        several = stage(several, "repeated-rows")
        return once.select(*target.columns).unionByName(target.select(*keys).join(several, keys, "inner").select(*target.columns))


def stage_source(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    location: Sequence[str] = (),
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    co_located: Sequence[str] = (),
) -> StagedSource:
    """Write the source out and find what it touches, reading keys of the target only.

    The source is computed once, here; it is often a whole enrichment, and the merge
    looks at it several times. ``co_located`` are partition columns of the target that follow from
    the key, so that keys are looked for only where the source has rows.
    """
    keys = list(keys)
    if on_duplicate not in ("error", "latest"):
        raise ValueError(f"unknown on_duplicate: {on_duplicate}")
    if on_duplicate == "latest" and not order_by:
        raise ValueError('on_duplicate="latest" needs order_by')

    rows = stage(_shape_like(target, source, order_by), "upsert-rows")
    if co_located:
        # As many values as the target has partitions, at most.
        target = target.where(in_partitions(rows.select(*co_located).distinct().collect(), co_located))
    tally = stage(_tally(target, rows, keys), "upsert-tally")
    if on_duplicate == "error":
        _refuse_ambiguous(tally, keys)
    else:
        rows = _reduce_to_latest(rows, tally, keys, order_by)
    taken, places = tally.where("copies > 0").select(*keys, "copies"), None
    if location:
        held = rows_with_keys(target.select(*dict.fromkeys([*keys, *location])), taken, keys)
        places = held.select(*location).distinct()
    return StagedSource(tuple(keys), rows, taken, places)


def _tally(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Each key of the source that the target holds too, or that several rows of the source have, once: ``claims`` rows
    of the source, ``copies`` of the target. Both sides meet in one shuffle of their keys, summed in each task first; of
    the target those that the source cannot have stay away."""
    claims, held = rows.select(*keys).dropna(), target.select(*keys)
    count = rows.count()
    if count < key_filter.FILTER_FROM:
        held = held.join(claims.distinct(), keys, "left_semi")
    elif key_filter.fits_filter(count):
        held = stage(divide_by_filter(held, claims, keys, count)[0], "keys-claimed")
    else:
        held = held.dropna()
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    met = claims.withColumns({"claims": one, "copies": none}).unionAll(held.withColumns({"claims": none, "copies": one}))
    counted = met.groupBy(*keys).agg(F.sum("claims").alias("claims"), F.sum("copies").alias("copies"))
    return counted.where("claims > 1 OR claims = 1 AND copies > 0")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Target rows with the source upserted.

    ``on_duplicate="latest"`` first reduces the source to the row of each key with the
    greatest ``order_by`` values. Runs jobs: the source and its keys are written to the shared
    scratch folder.
    """
    return stage_source(target, source, keys, (), on_duplicate, order_by).merge_into(target)


def _refuse_ambiguous(tally: DataFrame, keys: list[str]) -> None:
    examples = tally.where("claims > 1 AND copies > 0").select(*keys).head(5)
    if examples:
        raise AmbiguousSourceError(
            f"several source rows for one target row, e.g. {[tuple(row) for row in examples]}"
        )


def _reduce_to_latest(
    rows: DataFrame, tally: DataFrame, keys: list[str], order_by: Sequence[str]
) -> DataFrame:
    """One row per key; only rows that may have a key that occurs several times are moved to choose. Those that a filter
    lets through by mistake are the only ones of their key."""
    several = tally.where("claims > 1").select(*keys)
    count = several.count()
    if not count:
        return rows
    repeated, alone = divide_by_filter(rows, several, keys, count)
    return alone.unionByName(stage(best_of_key(repeated, keys, order_by), "upsert-latest"))


def _shape_like(target: DataFrame, source: DataFrame, also: Sequence[str]) -> DataFrame:
    """Source columns by name, in the target's order and types, and those to choose by."""
    missing = [name for name in target.columns if name not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns: {missing}")
    extra = [name for name in also if name not in target.columns]
    return source.select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target.schema.fields], *extra
    )
