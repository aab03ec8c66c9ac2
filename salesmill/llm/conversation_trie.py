"""Prefix trie of conversations: which first turns many of them share.

A node is a distinct sequence of first turns. A prefix is told by a sum of digests, one for each
turn and its place, so that sums over blocks of a long conversation add up. A count-min sketch
of all prefixes never counts too few: where it says one, no other conversation has that prefix,
nor any longer one of the same conversation, and these tails become nodes where they are. Only the other
prefixes are shuffled and grouped exactly, so that the sketch decides what moves and never what results.

In a node of the trie the smallest conversation, its representative, stands for the node; a
conversation represents the nodes from some depth on, its chain. Sums over a subtree are
therefore sums over chains: the node's own from there on, and all that begin below it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.window import Window

from .common import stage
from .ranks import ranked

LANE = 1 << 60            # a prefix has two sums below this
BLOCK = 4096              # turns of one conversation that a window holds
HASHES = 4                # rows of the sketch
CELLS_PER_PREFIX = 4
LEAST_CELLS = 1 << 17
MOST_CELLS = 1 << 26      # in a row; all rows as bits are 32 MB, however many prefixes there are
SLICE = 1 << 13           # bytes of a sketch that travel together
CHUNK = 1 << 13           # characters of a list of ids that travel together

NODE = ("depth", "a", "b")
EMPTY = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- turns in their places

def number_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos`` (0 first), ``n`` (turns of the conversation), ``item`` (digest of role and text), ``size`` (code
    points of the text), for every row of ``conversations(conv_id, turn, role, text)`` with a conv_id.

    Turns are ordered by ``turn``, null first; equal ones by role, then text (by its first 64
    characters, then its digest). Null roles and texts become empty. Rows without a conv_id belong to no conversation. Repeated
    rows are turns of their own. Other columns are not read.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), role, text
    ).select(
        "conv_id", "turn", "role", F.substring("text", 1, 64).alias("head"), F.char_length("text").alias("size"),
        F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("item"),
    )
    order = [F.col(c) for c in ("turn", "role", "head", "item")]
    return ranked(turns, "conv_id", order, "trie-turns").select("conv_id", "pos", "n", "item", "size")


def lend_openings(turns: DataFrame, every: int = 100, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with the first turns of another; the result is ``trie``'s input.

    Conversation c gets the first h turns of c - c % ``every`` (all if there are fewer, none if there is no such
    conversation) and then its own turns after its first h; h = crc32(c in decimal) % (``most`` + 1).
    """
    turns = stage(turns, "trie-numbered")
    convs = turns.where("pos = 0").select("conv_id", "n")
    lenders = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") < most))
    lent = convs.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    h = (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).alias("h")
    shape = (
        convs.select("conv_id", "n", h, (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
        .join(lent, "base", "left")
        .select("*", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken"))
        .select(
            "conv_id", "base", "h", "taken",
            (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"),
        )
    )
    shape = stage(shape, "trie-shapes")
    openings = shape.where("taken > 0").join(
        lenders.select(F.col("conv_id").alias("base"), "pos", "item", "size"), "base"
    ).where("pos < taken").select("conv_id", (F.col("pos") + 1).alias("depth"), "n", "item", "size")
    own = turns.drop("n").where(F.col("pos") >= h).join(shape, "conv_id").select(
        "conv_id", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"), "n", "item", "size"
    )
    return openings.unionByName(own), shape.select("conv_id", "n")


def _before(rows: DataFrame, key: str, sums: list[str]) -> DataFrame:
    """``key, block`` and, for each block but the first, sums over the blocks before it."""
    totals = rows.groupBy(key, "block").agg(*[F.sum(s).alias(s) for s in sums])
    earlier = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(key, "block", *[F.sum(s).over(earlier).alias(f"{s}_before") for s in sums]).where("block > 0")


def _running(rows: DataFrame, key: str, order: str, sums: list[str], may_be_long: Column | None = None) -> DataFrame:
    """``rows`` with each of ``sums`` as the running sum by ``order`` within ``key``, in blocks of rows of like order.

    Only rows that ``may_be_long`` holds for, if given, are of keys with several blocks.
    """
    rows = rows.withColumn("block", F.expr(f"{order} div {BLOCK}"))
    within = Window.partitionBy(key, "block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    long = rows if may_be_long is None else rows.where(may_be_long)
    local = rows.select("*", *[F.sum(s).over(within).alias(f"{s}_local") for s in sums])
    found = local.join(_before(long, key, sums), [key, "block"], "left")
    so_far = {s: F.col(f"{s}_local") + F.coalesce(f"{s}_before", F.lit(0)) for s in sums}
    return found.withColumns({f"{s}_sum": c for s, c in so_far.items()}).drop(
        "block", *[f"{s}{end}" for s in sums for end in ("_local", "_before")]
    )


def _prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, n, size`` and the two sums of the turns up to this one."""
    digest = F.sha2(F.concat_ws(":", F.col("depth").cast("string"), "item"), 256)
    lanes = {
        lane: F.conv(F.substring("digest", at, 15), 16, 10).cast("decimal(20,0)") for lane, at in (("a", 1), ("b", 16))
    }
    rows = turns.withColumn("digest", digest).withColumns(lanes).drop("digest", "item")
    summed = _running(rows, "conv_id", "depth", ["a", "b"], F.col("n") >= BLOCK)
    return summed.select(
        "conv_id", "depth", "n", "size", *[(F.col(f"{lane}_sum") % LANE).cast("bigint").alias(lane) for lane in "ab"]
    )


# ---------------------------------------------------------------- the sketch

def _cells(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    """The cell of each prefix in each row of the sketch, the row's offset included."""
    a, b = (batch.column(c).to_numpy().astype(np.uint64) for c in "ab")
    for row in range(HASHES):
        mixed = (a + np.uint64(2 * row + 1) * b) * np.uint64(0x9E3779B97F4A7C15)
        yield (mixed >> np.uint64(20)).astype(np.int64) % width + row * width


def _sketch(prefixes: DataFrame, width: int) -> bytes:
    """For each cell a bit: whether two or more prefixes fell into it.

    Each task counts up to two in two planes of bits; slices of them are added up by Spark. What
    reaches the driver is ``HASHES * width`` bits.
    """
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = (np.zeros(HASHES * width // 8, np.uint8) for _ in range(2))
        for batch in batches:
            for cells in _cells(batch, width):
                cell, times = np.unique(cells, return_counts=True)
                byte, bit = cell >> 3, np.left_shift(1, cell & 7).astype(np.uint8)
                again = (times > 1) | (once[byte] & bit > 0)
                np.bitwise_or.at(twice, byte[again], bit[again])
                np.bitwise_or.at(once, byte, bit)
        size = min(SLICE, len(once))
        for at in range(0, len(once), size):
            if once[at:at + size].any():
                planes = [zlib.compress(p[at:at + size].tobytes(), 1) for p in (once, twice)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at], pa.int64()), *(pa.array([p], pa.binary()) for p in planes)], ["at", "once", "twice"]
                )

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, once, twice = None, 0, 0

        def told() -> pa.RecordBatch:
            plane = twice.to_bytes(SLICE, "little")
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([plane], pa.binary())], ["at", "twice"])

        for batch in batches:
            for where, *planes in zip(*(batch.column(c).to_pylist() for c in ("at", "once", "twice"))):
                first, second = (int.from_bytes(zlib.decompress(p), "little") for p in planes)
                if where != at:
                    if at is not None and twice:
                        yield told()
                    at, once, twice = where, 0, 0
                twice |= second | once & first
                once |= first
        if at is not None and twice:
            yield told()

    counted = prefixes.select("a", "b").mapInArrow(count, "at bigint, once binary, twice binary")
    added = counted.repartition("at").sortWithinPartitions("at").mapInArrow(add, "at bigint, twice binary")
    bits = bytearray(HASHES * width // 8)
    for row in added.collect():
        bits[row["at"]:row["at"] + SLICE] = row["twice"][:len(bits) - row["at"]]
    return bytes(bits)


CANDIDATE, TAIL_BEGINS, TAIL = 0, 1, 2


def _screened(prefixes: DataFrame, most_cells: int) -> DataFrame:
    """``prefixes`` with ``kind``: possibly shared, or in no other conversation (the first such that a task sees of a
    conversation, or one after it)."""
    width = LEAST_CELLS
    while width < min(most_cells, CELLS_PER_PREFIX * prefixes.count()):
        width *= 2
    sketch = prefixes.sparkSession.sparkContext.broadcast(_sketch(prefixes, width))

    def screen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(sketch.value, np.uint8)
        last, in_tail = None, False
        for batch in batches:
            if batch.num_rows == 0:
                continue
            alone = np.zeros(batch.num_rows, bool)
            for cells in _cells(batch, width):
                alone |= bits[cells >> 3] >> (cells & 7).astype(np.uint8) & 1 == 0
            conv, at = batch.column("conv_id").to_numpy(), np.arange(batch.num_rows)
            begins = np.append(True, conv[1:] != conv[:-1])
            starts = np.flatnonzero(begins)
            first = np.minimum.reduceat(np.where(alone, at, len(at)), starts)
            if in_tail and conv[0] == last:
                first[0] = -1
            first = first[np.cumsum(begins) - 1]
            kind = np.where(at > first, TAIL, np.where(at == first, TAIL_BEGINS, CANDIDATE)).astype(np.int32)
            last, in_tail = conv[-1], kind[-1] != CANDIDATE
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kind)], [*batch.schema.names, "kind"])

    ordered = prefixes.sortWithinPartitions("conv_id", "depth")
    return ordered.mapInArrow(screen, StructType([*prefixes.schema.fields, StructField("kind", IntegerType())]))


# ---------------------------------------------------------------- digests of lists of ids

def _lists(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids of each node's ``ends(depth, a, b, conv_id)``, ascending, with commas.

    Ranges of the sorted ids become pieces of text first, many tasks to a node. The digest of one
    list can only be taken from its start to its end, so the last step reads a node's pieces, a
    few kB each, in one task: one after another, none held longer.
    """
    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held, size, done = None, [], 0, []

        def close() -> None:
            done.append((*node, held[0], ",".join(map(str, held))))

        for batch in batches:
            for *key, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id"))):
                if held and (key != node or size >= CHUNK):
                    close()
                    held, size = [], 0
                node = key
                held.append(conv)
                size += len(str(conv)) + 1
                if len(done) >= 256:
                    yield as_batch(done)
                    done.clear()
        if held:
            close()
        if done:
            yield as_batch(done)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        *numbers, pieces = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in numbers), pa.array(pieces, pa.string())], [*NODE, "first", "piece"]
        )

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for *key, piece in zip(*(batch.column(c).to_pylist() for c in (*NODE, "piece"))):
                if key != node:
                    if node:
                        out.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
            if out:
                yield told(out)
        if node:
            yield told([(*node, state.hexdigest())])

    def told(rows: list[tuple]) -> pa.RecordBatch:
        *numbers, digests = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in numbers), pa.array(digests, pa.string())], [*NODE, "ends_sha256"]
        )

    key = ", ".join(f"{c} bigint" for c in NODE)
    pieces = ends.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id").mapInArrow(
        join, f"{key}, first bigint, piece string"
    )
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digest, f"{key}, ends_sha256 string")


# ---------------------------------------------------------------- the trie

def trie(turns: DataFrame, convs: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """Every node of the trie over ``turns(conv_id, depth, n, item, size)``.

    ``depth`` counts a conversation's turns from 1 without gaps, ``n`` is their number; ``convs(conv_id, n)`` has every
    conversation, those without turns too. Result: ``conv_id`` (the smallest member), ``depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``; ``saved_tokens`` sums, over the node's subtree, what its members but one
    need not store. The root has depth 0 and no parent. No conversations: no rows.
    """
    prefixes = stage(_prefixes(turns), "trie-prefixes")
    screened = stage(_screened(prefixes, most_cells), "trie-screened")
    zero = F.lit(0).cast("bigint")
    roots = convs.select(
        "conv_id", zero.alias("depth"), "n", zero.cast("int").alias("size"), zero.alias("a"), zero.alias("b")
    )
    shared = screened.where(F.col("kind") == CANDIDATE).drop("kind").unionByName(roots)
    tails = screened.where(F.col("kind") != CANDIDATE)

    ends_here = F.col("depth") == F.col("n")
    nodes = stage(shared.groupBy(*NODE).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("rep"), F.max("size").alias("size"),
        F.count(F.when(ends_here, 1)).alias("n_ends"), F.min(F.when(ends_here, F.col("conv_id"))).alias("first_end"),
    ).withColumn("saved", (F.col("n_convs") - 1) * F.col("size")), "trie-nodes")
    # Where each conversation's chain begins, what it saves, and whether a leaf ends it.
    is_leaf = (F.col("n_convs") == F.col("n_ends")).cast("bigint")
    chains = nodes.select(F.col("rep").alias("conv_id"), F.col("depth").alias("begins"), "saved", is_leaf.alias("leaf")).unionByName(
        tails.where(F.col("kind") == TAIL_BEGINS).select(
            "conv_id", F.col("depth").alias("begins"), zero.alias("saved"), F.lit(1).cast("bigint").alias("leaf")
        )
    )
    chains = stage(chains.groupBy("conv_id").agg(
        F.min("begins").alias("begins"), F.sum("saved").alias("chain_saved"), F.max("leaf").alias("leaf")
    ), "trie-chains")

    # A chain counts at every node above its beginning; copies of a whole path have none.
    above = stage(shared.select("conv_id", *NODE).join(chains, "conv_id").where("depth < begins"), "trie-above")
    begins_next = F.col("begins") == F.col("depth") + 1
    sums = above.groupBy(*NODE).agg(
        F.sum("chain_saved").alias("below_saved"), F.sum("leaf").alias("below_leaves"),
        F.count(F.when(begins_next, 1)).alias("below_children"),
    )
    parents = above.where(begins_next).select("conv_id", *NODE).join(nodes.select(*NODE, "rep"), list(NODE)).select(
        "conv_id", F.col("rep").alias("parent")
    )
    chains = stage(chains.join(parents, "conv_id", "left"), "trie-chain-parents")

    so_far = _running(nodes, "rep", "depth", ["saved"])
    exact = (
        so_far.join(chains.withColumnRenamed("conv_id", "rep"), "rep")
        .join(sums, list(NODE), "left")
        .join(_lists(shared.where(ends_here).select(*NODE, "conv_id")), list(NODE), "left")
        .select(
            F.col("rep").alias("conv_id"),
            "depth",
            F.when(F.col("depth") > F.col("begins"), F.col("rep")).otherwise(F.col("parent")).alias("parent_conv_id"),
            "n_convs",
            (F.coalesce("below_children", zero) + F.when(F.col("first_end") == F.col("rep"), 0).otherwise(1)).alias("n_children"),
            (F.coalesce("below_leaves", zero) + F.col("leaf")).alias("n_leaves"),
            (
                F.col("chain_saved") - F.col("saved_sum") + F.col("saved") + F.coalesce("below_saved", zero)
            ).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
        )
    )
    return exact.unionByName(
        _tail_nodes(tails.where(F.col("kind") == TAIL), F.col("conv_id"))
    ).unionByName(_tail_nodes(
        tails.where(F.col("kind") == TAIL_BEGINS).join(chains, "conv_id"),
        F.when(F.col("depth") > F.col("begins"), F.col("conv_id")).otherwise(F.col("parent")),
    ))


def _tail_nodes(rows: DataFrame, parent: Column) -> DataFrame:
    one, last = F.lit(1).cast("bigint"), F.col("depth") == F.col("n")
    return rows.select(
        "conv_id", "depth", parent.alias("parent_conv_id"), one.alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("bigint").alias("n_children"), one.alias("n_leaves"),
        F.lit(0).cast("bigint").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(EMPTY)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """``trie`` of ``conversations(conv_id, turn, role, text)`` as they are, with the turns in the places that
    ``number_turns`` gives them."""
    turns = stage(number_turns(conversations), "trie-numbered")
    return trie(
        turns.select("conv_id", (F.col("pos") + 1).alias("depth"), "n", "item", "size"),
        turns.where("pos = 0").select("conv_id", "n"),
    )


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """``trie`` of the conversations with openings lent by every hundredth."""
    return trie(*lend_openings(number_turns(conversations)))
