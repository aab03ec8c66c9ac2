"""Benchmark decontamination by greedy string tiling.

Documents that share a run of ``SEED`` words with a benchmark item are joined to it by the
hash of that run; pairs whose shared runs could not cover enough of the item are dropped.
What is left is tiled: the longest run that both still have unmarked is marked in both, then
the next longest, down to ``SEED`` words (Wise, 1993). Runs are found by Karp-Rabin hashes of
all lengths, taken from running sums, and compared word by word. As tiles may lie in any
order, a passage whose sentences were moved around is covered like one that was not.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stage, texts_of

SEED = 3             # words of the shortest tile
COVERAGE = 0.5       # share of an item's words that makes it leaked
WORD = re.compile(r"\w+")
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
CACHED_WORDS = 400_000


class WordHashes(defaultdict):
    """Word to 64-bit hash, forgotten at a bound."""

    def __missing__(self, word: str) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found

    def of(self, text: str) -> np.ndarray:
        return np.array(list(map(self.__getitem__, WORD.findall(text.lower()))), np.uint64)


class RunHashes:
    """Hashes of the runs of a sequence, of any length, from running sums."""

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        powers = np.full(n, BASE, np.uint64)
        inverses = np.full(n, INVERSE, np.uint64)
        powers[:1], inverses[:1] = 1, 1
        np.multiply.accumulate(powers, out=powers)
        np.multiply.accumulate(inverses, out=inverses)
        self.inverses = inverses
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * powers, dtype=np.uint64)))

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        return (self.sums[starts + length] - self.sums[starts]) * self.inverses[starts]


def seeds(words: np.ndarray, length: int = SEED) -> np.ndarray:
    """Hashes of all runs of ``length`` words, in order."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    return RunHashes(words).at(np.arange(len(words) - length + 1), length)


def tiles(document: np.ndarray, item: np.ndarray, shortest: int = SEED) -> list[tuple[int, int, int]]:
    """``(place in document, place in item, words)`` of the tiles, longest first; of equal
    ones that which comes first in the document, then in the item."""
    if min(len(document), len(item)) < shortest:
        return []
    in_document, in_item = RunHashes(document), RunHashes(item)
    free_document, free_item = np.ones(len(document), bool), np.ones(len(item), bool)
    own = np.arange(len(item) - shortest + 1)
    places = np.arange(len(document) - shortest + 1)
    places = places[np.isin(in_document.at(places, shortest), in_item.at(own, shortest))]
    found, length = [], len(item)
    while True:
        # Places where a run of the shortest length may still start, and how far such places
        # follow one another: no longer tile can be there.
        places = _open(places, free_document, shortest)
        if not len(places):
            break
        breaks = np.flatnonzero(np.diff(places) != 1)
        longest = int(np.diff(np.concatenate(([-1], breaks, [len(places) - 1]))).max()) + shortest - 1
        length = min(length, longest)
        if length < shortest:
            break
        by_hash = defaultdict(list)
        starts = _open(own[own <= len(item) - length], free_item, length)
        for start, value in zip(starts.tolist(), in_item.at(starts, length).tolist()):
            by_hash[value].append(start)
        at = _open(places[places <= len(document) - length], free_document, length)
        for place, value in zip(at.tolist(), in_document.at(at, length).tolist()):
            for start in by_hash.get(value, ()):
                if (
                    free_document[place:place + length].all()
                    and free_item[start:start + length].all()
                    and np.array_equal(document[place:place + length], item[start:start + length])
                ):
                    free_document[place:place + length] = False
                    free_item[start:start + length] = False
                    found.append((place, start, length))
                    break
        length -= 1
    return found


def _open(starts: np.ndarray, free: np.ndarray, length: int) -> np.ndarray:
    """Those of ``starts`` from which ``length`` words are unmarked."""
    taken = np.concatenate(([0], np.cumsum(~free)))
    return starts[taken[starts + length] == taken[starts]]


def find_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Rows of ``docs(doc_id, text)`` and items of ``benchmark(item_id, text)`` that they
    hold at least ``coverage`` of: ``doc_id, tie, item_id, item_words, covered, coverage, tiles``.

    Words are runs of letters and digits in lower case. Null and empty texts, and items of
    fewer than ``SEED`` words, are in no pair. Repeated documents or items give repeated
    pairs; null ids are kept as they are. Empty tables give no pairs. Other columns are not
    read. The joins name no side: Spark broadcasts the seeds or pairs if they are small by
    their written size, and otherwise shuffles and splits.
    """
    def item_seeds(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "text"):
            words = [hashes.of(t) for t in texts_of(batch.column("text"))]
            found = [np.unique(seeds(w), return_counts=True) for w in words]
            offsets = np.append(0, np.cumsum([len(v) for v, _ in found]))
            flat = np.concatenate([v for v, _ in found]).view(np.int64)
            times = np.concatenate([n for _, n in found]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item"),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(times)),
                ],
                ["item", "item_words", "seeds", "times"],
            )

    def document_seeds(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "text"):
            found = [np.unique(seeds(hashes.of(t))) for t in texts_of(batch.column("text"))]
            offsets = np.append(0, np.cumsum([len(v) for v in found]))
            flat = np.concatenate(found).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("tie"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))],
                ["tie", "seeds"],
            )

    def cover(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "text"):
            rows = zip(texts_of(batch.column("text")), texts_of(batch.column("item_text")))
            sets = [tiles(hashes.of(text), hashes.of(item)) for text, item in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "tie", "item_id", "item_words")),
                    pa.array([sum(t[2] for t in s) for s in sets], pa.int64()),
                    pa.array([[list(t) for t in s] for s in sets], pa.list_(pa.list_(pa.int64()))),
                ],
                ["doc_id", "tie", "item_id", "item_words", "covered", "tiles"],
            )

    # Items by a key of their own: their ids may be null or repeated.
    items = stage(
        benchmark.select(
            F.col("item_id").cast("bigint"), F.col("text").alias("item_text"), F.xxhash64("text").alias("item")
        ),
        "benchmark-items",
    )
    by_item = stage(
        items.select("item", F.col("item_text").alias("text")).distinct().mapInArrow(
            item_seeds, "item bigint, item_words bigint, seeds array<bigint>, times array<bigint>"
        ).select("item", "item_words", F.explode(F.arrays_zip("seeds", "times")).alias("s"))
        .select("item", "item_words", F.col("s.seeds").alias("seed"), F.col("s.times").alias("times")),
        "benchmark-seeds",
    )
    keyed = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("tie"))
    shared = (
        keyed.select("text", "tie").mapInArrow(document_seeds, "tie bigint, seeds array<bigint>")
        .select("tie", F.explode("seeds").alias("seed"))
        .join(by_item, "seed")
    )
    # Copies of a text are one here: a seed counts once for it.
    possible = (
        shared.groupBy("tie", "item", "item_words", "seed").agg(F.max("times").alias("times"))
        .groupBy("tie", "item", "item_words").agg(F.sum("times").alias("times"))
        .where(F.col("times") * SEED >= F.col("item_words") * coverage)
    )
    possible = stage(possible.select("tie", "item", "item_words"), "leak-candidates")
    pairs = keyed.join(possible, "tie").join(items, "item").select(
        "doc_id", "tie", "item_id", "item_words", "text", "item_text"
    )
    return pairs.mapInArrow(
        cover,
        "doc_id bigint, tie bigint, item_id bigint, item_words bigint, covered bigint,"
        " tiles array<array<bigint>>",
    ).where(F.col("covered") >= F.col("item_words") * coverage).select(
        "doc_id", "tie", "item_id", "item_words", "covered",
        (F.col("covered") / F.col("item_words")).alias("coverage"), "tiles",
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs``, all their columns (any names), that hold no item of the benchmark.

    Null and empty texts hold none; long ones count whole. Rows with a null doc_id are compared like any
    other. Repeated rows go or stay together; without items every row stays, no rows give none.
    """
    leaked = stage(
        find_leaks(docs, benchmark, coverage).select(
            F.col("doc_id").alias("id"), "tie"
        ).distinct(),
        "leaked-documents",
    )
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("own_id"),
        F.xxhash64("text").alias("own_tie"),
    )
    same = (F.col("own_tie") == F.col("tie")) & F.col("own_id").eqNullSafe(F.col("id"))
    return rows.join(leaked, same, "left_anti").select("row.*")
