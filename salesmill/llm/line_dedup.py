"""Repeated runs of lines, found by a suffix array and deleted but for the first.

Documents are sequences of line ids. Their suffixes are ranked by distributed prefix
doubling (Manber and Myers, 1990): rank ``k`` orders suffixes by their first ``2^k`` lines,
and follows from two ranks ``k - 1``. Suffixes alone in their rank repeat nothing and leave;
the rest shrinks from round to round. Suffixes whose first ``m`` lines are equal, an interval
of the suffix array with a longest common prefix of ``m`` or more, are known by two ranks,
of their first and of their last ``2^k`` of these lines.

A run counts from ``min_words`` words on. Looked up are, for each line, the least run that
starts there and reaches this length, and the least one that ends there. Every line of a
maximal repeated run that is long enough lies in one of these (in the run that starts with
it, in that which ends there, or in that which ends with it), so all lines of the copies of
such runs are found, and no others.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage

MIN_WORDS = 50
DOC = ["doc_id", "tie"]   # tells documents apart: id and hash of the text


def _identity() -> list[Column]:
    return [F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tie")]


def _lines() -> Column:
    return F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)


def least_runs(places: np.ndarray, words: np.ndarray, min_words: int) -> set[tuple[int, int]]:
    """``(first line, lines)`` of the least runs of ``min_words`` that start or end at each of
    ``places``, ascending line numbers; runs have no gap."""
    if not len(places):
        return set()
    found = set()
    for part, count in zip(
        np.split(places, np.flatnonzero(np.diff(places) != 1) + 1),
        np.split(words, np.flatnonzero(np.diff(places) != 1) + 1),
    ):
        sums = np.concatenate(([0], np.cumsum(count)))
        first = int(part[0])
        ends = np.searchsorted(sums, sums[:-1] + min_words)          # from each start
        found |= {(first + s, int(e) - s) for s, e in enumerate(ends) if e < len(sums)}
        starts = np.searchsorted(sums, sums[1:] - min_words, "right") - 1   # to each end
        found |= {(first + int(s), e + 1 - int(s)) for e, s in enumerate(starts) if s >= 0}
    return found


def _ranked(classes: DataFrame, keys: list[str], purpose: str) -> DataFrame:
    """Number the classes in the order of their keys. Sorted by ranges, so the numbers rise
    from task to task; written at once, as they belong to this one sort."""
    return stage(classes.orderBy(*keys).withColumn("named", F.monotonically_increasing_id()), purpose)


def _doubled(ranks: DataFrame, step: int, level: int) -> DataFrame:
    """Ranks by twice as many lines, of suffixes not alone in theirs."""
    ahead = Window.partitionBy(*DOC).orderBy("idx").rangeBetween(step, step)
    pairs = ranks.withColumn("next", F.max("rank").over(ahead)).where("next is not null")
    classes = _ranked(
        pairs.groupBy("rank", "next").agg(F.count("*").alias("n")).where("n > 1").drop("n"),
        ["rank", "next"], "suffix-classes",
    )
    doubled = pairs.join(classes, ["rank", "next"]).select(*DOC, "idx", F.col("named").alias("rank"))
    return stage(doubled.withColumn("level", F.lit(level)), "suffix-ranks")


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, tie, gone``: for each document with lines that are to go, their numbers.

    Of equal runs the one in the smallest (doc_id, hash of the text, line) stays, null ids
    last; later ones go, in the same document too. Rows equal in id and text are one document.
    """
    def runs_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                lines = np.array([(x["idx"], x["words"]) for x in row["lines"]], np.int64)
                lines = lines[np.argsort(lines[:, 0])]
                runs = sorted(least_runs(lines[:, 0], lines[:, 1], min_words))
                rows += [(row["doc_id"], row["tie"], start, n) for start, n in runs]
            columns = list(zip(*rows)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32())],
                ["doc_id", "tie", "start", "n"],
            )

    line = F.col("line")
    lines = stage(
        docs.select(*_identity(), F.posexplode(_lines()).alias("idx", "line")).select(
            *DOC, "idx", F.xxhash64(line).alias("h"), F.hash(line).alias("h2"),
            F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
        ),
        "lines",
    )
    ids = _ranked(
        lines.groupBy("h", "h2").agg(F.count("*").alias("n")).where("n > 1").drop("n"), ["h", "h2"], "line-ids"
    )
    repeated = stage(
        lines.join(ids, ["h", "h2"]).select(*DOC, "idx", "words", F.col("named").alias("rank"))
        .dropDuplicates([*DOC, "idx"]),
        "repeated-lines",
    )
    runs = stage(
        repeated.groupBy(*DOC).agg(F.collect_list(F.struct("idx", "words")).alias("lines"))
        .mapInArrow(runs_of, "doc_id bigint, tie bigint, start int, n int")
        .withColumn("level", F.floor(F.log2("n") + 1e-9).cast("int")),
        "line-runs",
    )
    longest = runs.agg(F.max("level")).first()[0]
    ranks = repeated.select(*DOC, "idx", "rank", F.lit(0).alias("level"))
    levels = ranks
    for level in range(1, (longest or 0) + 1):
        ranks = _doubled(ranks, 1 << (level - 1), level)
        levels = levels.unionByName(ranks)

    def rank_at(name: str, at: Column) -> tuple[DataFrame, Column]:
        own = levels.alias(name)
        same = F.col("r.tie") == F.col(f"{name}.tie")
        same &= F.col("r.doc_id").eqNullSafe(F.col(f"{name}.doc_id"))
        return own, same & (F.col("r.level") == F.col(f"{name}.level")) & (at == F.col(f"{name}.idx"))

    first, at_first = rank_at("a", F.col("r.start"))
    last, at_last = rank_at("b", F.col("r.start") + F.col("r.n") - F.expr("shiftleft(1, r.level)"))
    place = F.struct(
        F.col("r.doc_id").isNull().alias("no_id"), F.col("r.doc_id").alias("doc_id"),
        F.col("r.tie").alias("tie"), F.col("r.start").alias("start"),
    )
    named = stage(
        runs.alias("r").join(first, at_first).join(last, at_last).select(
            place.alias("place"), F.col("r.n").alias("n"),
            F.col("a.rank").alias("first_rank"), F.col("b.rank").alias("last_rank"),
        ),
        "named-runs",
    )
    interval = ["n", "first_rank", "last_rank"]
    # Written, so that the runs of a very common line come to the join straight from their
    # shuffle and may be split there.
    kept = stage(
        named.groupBy(*interval).agg(F.min("place").alias("kept"), F.count("*").alias("copies")).where("copies > 1"),
        "kept-runs",
    )
    later = named.join(kept, interval).where("place > kept").select(
        "place.doc_id", "place.tie", F.explode(F.expr("sequence(place.start, place.start + n - 1)")).alias("idx")
    )
    return later.groupBy(*DOC).agg(F.sort_array(F.collect_set("idx")).alias("gone"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs``, with ``row`` (all their columns), ``kept_text``, ``n_lines`` and
    ``n_deleted``: the text without lines in later copies of runs of ``min_words`` or more.

    Lines are cut at ``\\n`` and compared whole. Texts without such lines, null and empty ones
    among them, stay as they are. Repeated rows all get the result of their document. An empty
    table gives no rows. ``docs`` may have any other columns. Documents with such lines grow
    with the table, so both sides of the last join are shuffled at every size.
    """
    gone = stage(
        repeated_lines(docs, min_words).select(F.col("doc_id").alias("id"), F.col("tie").alias("own"), "gone"),
        "deleted-lines",
    )
    doc_id, tie = _identity()
    rows = docs.select(F.struct("*").alias("row"), doc_id.alias("__id"), tie.alias("__tie"))
    same = F.col("__id").eqNullSafe(F.col("id")) & (F.col("__tie") == F.col("own"))
    text = F.col("row.text")
    lines = F.split(text, "\n", -1)
    stays = F.get(F.transform(F.array(lines), lambda x: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("gone")), lambda i: F.get(x, i)
    )), F.lit(0))
    return rows.join(gone.hint("merge"), same, "left").select(
        "row",
        F.when(F.col("gone").isNull(), text).otherwise(F.array_join(stays, "\n")).alias("kept_text"),
        F.size(F.split(F.coalesce(text, F.lit("")), "\n", -1)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_deleted"),
    )


def without_repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the kept text in ``text``, and its length in ``n_chars`` if there is such
    a column. Documents of which nothing is left go; those empty from the start stay."""
    kept = dedup_lines(docs, min_words).where("n_deleted < n_lines")

    def column(name: str) -> Column:
        if name == "text":
            return F.col("kept_text").alias("text")
        own = F.col("row")[name]
        if name == "n_chars":
            changed = F.length("kept_text").cast(docs.schema[name].dataType)
            return F.when(F.col("n_deleted") > 0, changed).otherwise(own).alias(name)
        return own.alias(name)

    return kept.select(*map(column, docs.columns))
