"""Near duplicates by SimHash fingerprints, compared bit by bit in parallel.

Fingerprints within ``radius`` bits of each other are found exactly: cut into more blocks
than the radius, two such fingerprints agree in all but ``radius`` blocks at least, and every choice of so many
is a key. Fingerprints that share a key are compared in blocks of 64 whose bits are stored as planes, one 64-bit word
per bit position: one XOR compares a bit of 64 fingerprints at once, and their distances
are kept in bit-sliced counters fed by carry-save adders. A block is abandoned as soon as
all its distances exceed the radius.

Equal fingerprints are one node. Within a block of comparisons only links that join two
groups not joined before leave the task: they connect what all links would connect.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stage, texts_of
from .components import connected_components

WORDS = 4            # of a shingle
RADIUS = 4
BITS = 64
SEED = 42
TILE = 4096          # fingerprints of a key that are compared at once with as many others
GROUP = 256          # fingerprints that share a key, about, and that are compared together
MOST_AGREEING = 4    # blocks in a key
_VALUE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """A hash of each word shingle of ``text``, repeats included; a shorter text is one shingle."""
    from xxhash import xxh64_intdigest

    joined = b" ".join(text.encode("utf-8", "surrogatepass").lower().split())
    if not joined:
        return np.zeros(0, np.uint64)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.append(0, spaces + 1)
    ends = np.append(spaces, len(joined))
    width = min(words, len(starts))
    spans = zip(starts[: len(starts) - width + 1].tolist(), ends[width - 1:].tolist())
    return np.fromiter((xxh64_intdigest(joined[s:e], SEED) for s, e in spans), np.uint64)


def fingerprint(text: str, words: int = WORDS) -> int:
    """SimHash of the word shingles of ``text``, repeats included; 0 without words."""
    hashes = shingle_hashes(text, words)
    if not len(hashes):
        return 0
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _VALUE_BITS for k in range(8)])
    majority = 2 * ones > len(hashes)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def add_fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, tie, fp``: the fingerprint as a signed 64-bit number; ``tie`` hashes the text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fps = np.array([fingerprint(t, words) for t in texts_of(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tie"), pa.array(fps.view(np.int64))],
                ["doc_id", "tie", "fp"],
            )

    keyed = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("tie"))
    return keyed.mapInArrow(run, "doc_id bigint, tie bigint, fp bigint")


# ---------------------------------------------------------------- bit-sliced comparison

def bit_planes(fps: np.ndarray) -> np.ndarray:
    """64 rows: bit ``k % 64`` of word ``k // 64`` in row ``j`` is bit ``j`` of fingerprint ``k``."""
    padded = np.zeros(-(-len(fps) // 64) * 64, np.uint64)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return planes.view("<u8").astype(np.uint64)


def within_radius(planes: np.ndarray, queries: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each query and each fingerprint of ``planes``: a bit, 1 if they are that near.

    Four planes at a time go through carry-save adders into bit-sliced counters that stick
    once they pass 7. After each sixteen planes, words whose distances all exceed the radius
    are left out of what follows.
    """
    if not 0 <= radius <= 7:
        raise ValueError("radius: 0 to 7")
    n_words = planes.shape[1]
    out = np.zeros((len(queries), n_words), np.uint64)
    row, column = (x.ravel() for x in np.indices(out.shape))
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    flips = [np.where((queries >> np.uint64(j)) & np.uint64(1), full, np.uint64(0)) for j in range(BITS)]
    one = two = four = over = np.zeros(len(row), np.uint64)
    for start in range(0, BITS, 4):
        a, b, c, d = (planes[j][column] ^ flips[j][row] for j in range(start, start + 4))
        one, carry_a = _add(one, a, b)
        one, carry_b = _add(one, c, d)
        two, carry = _add(two, carry_a, carry_b)
        over = over | (four & carry)
        four = four ^ carry
        if start % 16 == 12:
            alive = np.flatnonzero(_beyond(one, two, four, over, radius) != full)
            if len(alive) < len(row):
                row, column = row[alive], column[alive]
                one, two, four, over = one[alive], two[alive], four[alive], over[alive]
            if not len(row):
                return out
    out[row, column] = ~_beyond(one, two, four, over, radius)
    return out


def _add(x: np.ndarray, y: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save adder: sum and carry of three bits, in 64 lanes."""
    half = x ^ y
    return half ^ z, (x & y) | (half & z)


def _beyond(one, two, four, over, radius):
    """Lanes whose counter exceeds the radius."""
    greater, equal = over, ~over
    for bit, lane in ((4, four), (2, two), (1, one)):
        if radius & bit:
            equal = equal & lane
        else:
            greater = greater | (equal & lane)
            equal = equal & ~lane
    return greater


def spanning_links(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Pairs within the radius that suffice to connect what all such pairs connect: among
    ``left``, or between ``left`` and ``right``."""
    other = left if right is None else right
    planes = bit_planes(other)
    group = np.arange(len(other) + (0 if right is None else len(left)))
    links = []
    for start in range(0, len(left), 256):
        near = within_radius(planes, left[start:start + 256], radius)
        lanes = np.unpackbits(np.ascontiguousarray(near, "<u8").view(np.uint8), axis=1, bitorder="little")[:, : len(other)]
        for k in np.flatnonzero(lanes.sum(axis=1) > (right is None)):
            own = start + k if right is None else len(other) + start + k
            found = np.flatnonzero(lanes[k])
            groups = group[found]
            apart = groups != group[own]
            if not apart.any():
                continue
            _, first = np.unique(groups[apart], return_index=True)
            links += [(int(left[start + k]), int(other[j])) for j in found[apart][first]]
            joined = np.append(groups[apart][first], group[own])
            group[np.isin(group, joined)] = joined.min()
    return links


# ---------------------------------------------------------------- links and groups

def blocks_for(fingerprints: int, radius: int = RADIUS) -> int:
    """How many blocks to cut fingerprints into, so that about ``GROUP`` of so many share a key.

    A key is all but ``radius`` of the blocks: the more blocks, the more keys a fingerprint has and the
    more bits are in each. Comparisons then grow with the number of fingerprints and not with its square.
    """
    blocks = radius + 1
    while blocks < radius + MOST_AGREEING and fingerprints >> BITS * (blocks - radius) // blocks > GROUP:
        blocks += 1
    return blocks


def add_keys(fps: DataFrame, radius: int, blocks: int) -> DataFrame:
    """``fp, key``: each fingerprint with all its keys. Keys that only share a hash are compared in vain, no more."""
    edges = [round(BITS * k / blocks) for k in range(blocks + 1)]
    parts = [
        F.shiftrightunsigned("fp", low).bitwiseAND((1 << (high - low)) - 1) if high - low < BITS else F.col("fp")
        for low, high in zip(edges, edges[1:])
    ]
    keys = [
        F.xxhash64(F.lit(k), *[parts[i] for i in chosen])
        for k, chosen in enumerate(combinations(range(blocks), blocks - radius))
    ]
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def near_links(fps: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """``a, b``: links between distinct fingerprints of ``fps(fp)``, as many as connect them.

    Of ``blocks`` blocks two such fingerprints differ in ``radius`` at most, so they agree in
    a key of the others whatever the number; it is chosen from how many fingerprints there are.
    A key that more than ``TILE`` share is dealt to several tasks: its fingerprints
    fall into chunks by their hash, and each pair of chunks is one piece of work.
    """
    keyed = add_keys(fps, radius, blocks or blocks_for(fps.count(), radius))
    hot = stage(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > TILE), "fingerprint-keys")
    dealt = (
        keyed.join(hot, "key", "left")
        .withColumn("chunks", F.coalesce(F.ceil(F.col("n") / TILE), F.lit(1)).cast("int"))
        .withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("fp", "key", "chunk", F.least("chunk", "with").alias("first"), F.greatest("chunk", "with").alias("second"))
    )

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in chain(batches, [None]):
            if batch is not None:
                rows = np.rec.fromarrays([c.to_numpy() for c in batch.columns], names=batch.schema.names)
                held = rows if held is None else np.concatenate([held, rows])
            if held is None or not len(held):
                continue
            new = np.any([held[c][1:] != held[c][:-1] for c in ("key", "first", "second")], axis=0)
            starts = np.append(0, np.flatnonzero(new) + 1)
            # The last piece may go on in the next batch.
            done = len(held) if batch is None else starts[-1]
            if done:
                links = _links_of_pieces(held[:done], starts[starts < done], radius)
                pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])
            held = held[done:]

    piece = ("key", "first", "second")
    return dealt.repartition(*piece).sortWithinPartitions(*piece).mapInArrow(compare, "a bigint, b bigint")


def _links_of_pieces(rows: np.ndarray, starts: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links within each piece of rows, which begin at ``starts``; small ones are compared together."""
    fp = rows["fp"].view(np.uint64)
    sizes = np.diff(np.append(starts, len(rows)))
    within = rows["first"][starts] == rows["second"][starts]
    links = []
    together = within & (sizes > 1)
    own, ends = fp[np.repeat(together, sizes)], np.cumsum(sizes[together])
    at = 0
    while at < len(own):
        end = int(ends[min(np.searchsorted(ends, at + GROUP), len(ends) - 1)])
        links += spanning_links(np.unique(own[at:end]), None, radius)
        at = end
    for k in np.flatnonzero(~within):
        part = slice(starts[k], starts[k] + sizes[k])
        first = rows["chunk"][part] == rows["first"][starts[k]]
        if first.any() and not first.all():
            links += spanning_links(fp[part][first], fp[part][~first], radius)
    return links


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, tie, fp, group, component_id``.

    ``group`` is the smallest fingerprint (as a signed number) of the group, ``component_id`` is the smallest doc_id among all documents reachable by links. Null or
    empty texts have fingerprint zero. Rows with a null doc_id take part; a group of such
    rows only has a null component_id. Repeated rows give repeated results. No documents:
    no rows. Other columns are not read.
    """
    prints = stage(add_fingerprints(docs, words), "fingerprints")
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-nodes")
    links = near_links(nodes.select("fp"), radius)
    roots = connected_components(links).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = stage(rooted, "fingerprint-roots")
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stage(
        rooted.join(groups, "root").select("fp", F.col("root").alias("group"), "component_id"), "fingerprint-groups"
    )
    return prints.join(named, "fp").select("doc_id", "tie", "fp", "group", "component_id")


def one_of_each_group(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, all their columns: of each group of near duplicates one.

    It is that with the smallest doc_id (null last), then the smallest hash of its text. Of
    repeated rows one stays. Texts without words are one group.
    """
    return one_of_each(docs, near_duplicates(docs, words, radius))


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row of ``docs`` for each group of ``found(doc_id, tie, group)``, as above."""
    chosen = stage(
        found.groupBy("group").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), "tie")).alias("kept")
        ).select("kept.id", "kept.tie"),
        "group-representatives",
    )
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("own_id"),
        F.xxhash64("text").alias("own_tie"),
    )
    same = (F.col("own_tie") == F.col("tie")) & F.col("own_id").eqNullSafe(F.col("id"))
    # Rows equal in id and text: any one of them, chosen within tasks first.
    return rows.join(chosen, same, "left_semi").groupBy("own_id", "own_tie").agg(
        F.first("row").alias("row")
    ).select("row.*")
