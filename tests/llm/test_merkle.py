"""Merkle manifest against a tree built level by level."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from salesmill.llm import merkle
from salesmill.llm.queries import op12_merkle_manifest

from .conftest import SMALL

LAYOUT = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, more=0):
    count = None if row["n_chars"] is None else row["n_chars"] + more
    values = (row["doc_id"], row["source"], row["lang"], count, row["text"])
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves, fanout):
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for path, k in zip(paths, at):
            run = k // fanout * fanout
            path.append(("".join(level[run:k]), "".join(level[k + 1:run + fanout])))
        level = [digest("".join(level[k:k + fanout])) for k in range(0, len(level), fanout)]
        at = [k // fanout for k in at]
    return level[0], paths


def plain(rows, fanout=2):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append((row, leaf_of(row)))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        groups[lang].sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
    trees = [tree([leaf for _, leaf in groups[lang]], fanout) for lang in langs]
    root, tops = tree([t[0] for t in trees], fanout) if trees else (None, [])
    out = []
    for lang, (subroot, paths), top in zip(langs, trees, tops):
        for (row, leaf), path in zip(groups[lang], paths):
            hit = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            node = leaf_of(row, 1) if hit else leaf
            for left, right in path + top:
                node = digest(left + node + right)
            proof = digest("".join(left + right for left, right in path + top))
            out.append((row["doc_id"], leaf, subroot, root, proof, node, node == root))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_against_plain(spark, small):
    got = op12_merkle_manifest(spark, SMALL)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = plain(small("documents"))
    assert rows_of(got) == want
    assert 0 < sum(not r[-1] for r in want) < len(want) / 3


def odd_rows():
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (None, "s", "", 3, "a"), (0, "", "", 0, ""),
        (1, "s", "é", 5, "ñ🙂"), (1, "s", "é", 5, "ñ🙂"), (1, "s", "é", 6, "ñ"), (-7, None, "z", None, "t"),
        (7, "lone", "only one", 2**63 - 1, "x" * 50_000), (2**63 - 1, "s", "z", 1, "-"),
    ]
    rows += [(k, "hot", "de", k % 50 or None, f"text {k}") for k in range(700)]
    rows += [(k, "hot", f"lang{k % 37}", k, "same") for k in range(1000, 1100)]
    return [dict(zip(("doc_id", "source", "lang", "n_chars", "text"), row)) for row in rows]


@pytest.mark.parametrize("fanout, block", [(2, 256), (2, 4), (3, 9), (5, 25)])
def test_odd_rows_and_fan_outs(spark, monkeypatch, fanout, block):
    """A group over several blocks and tiers, groups of one, null and empty ones, equal rows."""
    monkeypatch.setattr(merkle, "BLOCK", block)
    rows = odd_rows()
    clash = ", grp string, pos string, n string, digest int, top int, `row` string, left0 string, block int, tampered int"
    df = spark.createDataFrame(
        [(*r.values(), *[None] * clash.count(",")) for r in rows], LAYOUT + clash
    ).repartition(4)
    found = merkle.document_manifest(df, fanout)
    again = merkle.folded(merkle.F.coalesce("tampered", "leaf"))
    got = found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(), again, again == merkle.F.col("root"))
    assert rows_of(got) == plain(rows, fanout)


def test_all_columns_come_back(spark):
    leaves = spark.createDataFrame([("b", 2, "y", "d2"), ("b", 1, "x", "d1")], "grp string, pos int, note string, digest string")
    rows = merkle.build_manifest(leaves, "grp", ["pos"], "digest").orderBy("pos").collect()
    assert [(r.pos, r.note) for r in rows] == [(1, "x"), (2, "y")]
    assert {r.root for r in rows} == {digest("d1d2")} and [tuple(s) for s in rows[0].path] == [("", "d2")]


@pytest.mark.parametrize("rows", [0, 1])
def test_no_row_and_one(spark, rows):
    df = spark.createDataFrame([(3, "s", "en", 1, "t")][:rows], LAYOUT)
    found = merkle.manifest_digest(df).collect()
    assert [r.root == r.leaf == r.subroot and r.proof_sha256 == digest("") and r.verified for r in found] == [True] * rows
