"""Merkle manifest: a hash tree over all rows, a proof for each, and their check.

A node is the SHA-256 of its children's hex digests. Trees are cut into blocks of the same
aligned span, so that all levels within a block are window functions over one sorted
partition: at each level a node stands on the row of its first leaf, its siblings are lag
and lead columns at fixed offsets, masked by its slot and by the length of its run, and first
children hash their parents. A tree's blocks are the leaves of the next tier, which is as
many times smaller, so that the largest group is split like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage
from .ranks import ranked

FANOUT = 2
BLOCK = 256   # leaves in a block, at most (a power of the fan-out)
DOCUMENT_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left: string, right: string>>"


def field_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of fields one after another: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    told = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in told
    ]), 256)


def _levels(fanout: int) -> int:
    """Levels of a block."""
    levels = 1
    while fanout ** (levels + 1) <= BLOCK:
        levels += 1
    return levels


def _blocks(span: int) -> Column:
    return F.expr(f"pos div {span}").alias("block")


def _with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """``grp, pos, n, digest`` of one tier's leaves, with the digest over each block (``top``, on its first row) and
    at each level the siblings before and after (``left0, right0, left1, ...``, on first rows of nodes)."""
    levels = _levels(fanout)
    within = Window.partitionBy("grp", "block").orderBy("pos")
    found = nodes.withColumn("block", _blocks(fanout ** levels)).withColumn("top", F.col("digest"))
    for level in range(levels):
        width = fanout ** level
        slot = F.expr(f"(pos div {width}) % {fanout}")
        # A level with one node is the root; a run at the end of a level may be short, even one node.
        is_node = (F.col("n") > width) & (F.col("pos") % width == 0)
        reach = range(1, fanout)
        found = found.select(
            "*",
            *[F.lag("top", j * width).over(within).alias(f"lag{j}") for j in reach],
            *[F.lead("top", j * width).over(within).alias(f"lead{j}") for j in reach],
        )
        before = [F.when(slot >= j, F.col(f"lag{j}")) for j in reversed(reach)]
        after = [F.when((slot + j < fanout) & (F.col("pos") + j * width < F.col("n")), F.col(f"lead{j}")) for j in reach]
        found = found.withColumns({
            f"left{level}": F.when(is_node, F.concat_ws("", *before)),
            f"right{level}": F.when(is_node, F.concat_ws("", *after)),
        }).withColumn(
            "top",
            F.when(F.col("n") <= width, F.col("top")).when(
                is_node & (slot == 0), F.sha2(F.concat("top", f"right{level}"), 256)
            ),
        ).drop(*[f"lag{j}" for j in reach], *[f"lead{j}" for j in reach])
    return found


def _with_paths(tier: DataFrame, above: DataFrame, fanout: int) -> DataFrame:
    """The tier's rows with ``path``: siblings at each level up to the end of ``above``'s paths.

    ``above(grp, pos, path, ...)`` has a row for each block. A row's ancestor in the block stands
    on the last row, up to its own, that has siblings at that level.
    """
    levels = _levels(fanout)
    so_far = Window.partitionBy("grp", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    steps = [
        F.when(F.col("n") > fanout ** level, F.struct(
            F.last(f"left{level}", ignorenulls=True).over(so_far).alias("left"),
            F.last(f"right{level}", ignorenulls=True).over(so_far).alias("right"),
        ))
        for level in range(levels)
    ]
    own = tier.withColumn("own_path", F.filter(F.array(*steps), lambda s: s.isNotNull()))
    return own.join(above.withColumnRenamed("pos", "block"), ["grp", "block"]).withColumn(
        "path", F.concat("own_path", "path")
    ).drop("own_path", "block", "top", *[f"{side}{level}" for level in range(levels) for side in ("left", "right")])


def _tiers(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """Each tier with siblings, written; and ``grp, top`` of every group."""
    span = fanout ** _levels(fanout)
    tiers = []
    while True:
        tier = stage(_with_siblings(nodes, fanout), f"merkle-tier{len(tiers)}")
        tiers.append(tier)
        largest = tier.agg(F.max("n")).first()[0] or 0
        nodes = tier.where(F.col("pos") % span == 0).select(
            "grp", F.expr(f"pos div {span}").alias("pos"), F.expr(f"(n + {span - 1}) div {span}").alias("n"),
            F.col("top").alias("digest"),
        )
        if largest <= span:
            return tiers, nodes.select("grp", F.col("digest").alias("top"))


def build_manifest(leaves: DataFrame, group: str, order: Sequence[str], leaf: str, fanout: int = FANOUT) -> DataFrame:
    """``leaves`` with ``subroot``, ``root`` and ``path`` (from the leaf up to the root: what stands left and
    right of the node in its run).

    The leaves of a group, in the order of ``order`` and then of their digests, make one tree; while it has several
    nodes, every ``fanout`` consecutive ones (the last run: what is left, even one) become their
    parent. The groups' roots, null first, then by their UTF-8 bytes, make the tree above.

    Null values of ``order`` come first. Repeated rows are leaves of their own. No rows: no rows.
    ``leaf`` must not be null; all columns of ``leaves`` are kept, whatever their names, but
    ``subroot``, ``root`` and ``path`` should not be among them.
    """
    rows = leaves.select(
        # Null before any text, the empty one included.
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"),
        F.col(leaf).alias("digest"), F.struct(*leaves.columns).alias("row"),
    )
    placed = ranked(rows, "grp", [F.col("row")[c] for c in order] + [F.col("digest")], "merkle-leaves")
    tiers, subroots = _tiers(placed, fanout)
    subroots = stage(subroots, "merkle-subroots")

    whole = ranked(subroots.select(F.lit("").alias("grp"), "top", F.col("grp").alias("of")), "grp", [F.col("of")], "merkle-groups")
    upper, root = _tiers(whole.select("grp", "pos", "n", F.col("top").alias("digest"), "of"), fanout)
    above = root.select("grp", F.lit(0).cast("bigint").alias("pos"), F.col("top").alias("root"), F.array().cast(PATH).alias("path"))
    for tier in reversed(upper):
        above = _with_paths(tier, above, fanout).drop("n", "digest")
    above = above.drop("grp").withColumnRenamed("of", "grp").join(
        subroots.withColumnRenamed("top", "subroot"), "grp"
    ).withColumn("pos", F.lit(0).cast("bigint"))
    for tier in reversed(tiers[1:]):
        above = stage(_with_paths(tier, above, fanout).drop("n", "digest"), "merkle-paths")
    return _with_paths(tiers[0], above, fanout).select("row.*", "subroot", "root", "path")


def proof_digest(path: str = "path") -> Column:
    """SHA-256 of all siblings on the way to the root, from left to right at each level."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))), 256)


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf's digest and its siblings make."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def document_manifest(docs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Manifest of ``doc_id, source, lang, n_chars, text`` by language, for every row of ``docs``: ``doc_id, leaf, subroot,
    root, path`` and ``tampered``, the leaf that the row has after a false count of characters
    (one more; null where the count is null or the row is not one of those tampered with).

    Nulls are told from empty texts. Rows with equal ids are ordered by their leaves; texts count whole.
    Other columns are not read.
    """
    fields = {c: F.col(c) for c in DOCUMENT_FIELDS}
    false_count = fields | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    hit = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    leaves = docs.select(
        "doc_id", "lang", field_digest(list(fields.values())).alias("leaf"),
        F.when(hit, field_digest(list(false_count.values()))).alias("tampered"),
    )
    return build_manifest(leaves, "lang", ["doc_id"], "leaf", fanout)


def manifest_digest(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` its leaf, roots, the digest of its proof, and whether the leaf that is found (tampered with or
    not) folds to the root."""
    again = folded(F.coalesce("tampered", "leaf"))
    return document_manifest(docs).select(
        "doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), again.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
