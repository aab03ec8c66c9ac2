"""Greedy string tiling against a plain version, and leaks in small tables."""

import random
import re

import numpy as np

from salesmill.llm.queries import op7_decontaminate
from salesmill.llm.tiling import SEED, find_leaks, tiles, without_leaks

from .conftest import SMALL


def plain_tiles(document, item, shortest=SEED):
    free_d, free_i, found = [True] * len(document), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for d in range(len(document)):
            for i in range(len(item)):
                n = 0
                while (d + n < len(document) and i + n < len(item) and document[d + n] == item[i + n]
                       and free_d[d + n] and free_i[i + n]):
                    n += 1
                if n > best[2]:
                    best = (d, i, n)
        d, i, n = best
        if n < shortest:
            return found
        found.append(best)
        free_d[d:d + n] = free_i[i:i + n] = [False] * n


def test_tiles_like_plain_ones():
    r = random.Random(3)
    for _ in range(400):
        few = r.choice([2, 3, 6])
        a, b = ([r.randrange(few) for _ in range(r.randrange(n))] for n in (40, 20))
        assert tiles(np.array(a, np.uint64), np.array(b, np.uint64)) == plain_tiles(a, b)


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def test_query_against_plain_tiles(spark, small):
    got = {(r.doc_id, r.item_id): (r.item_words, r.covered, r.n_tiles) for r in op7_decontaminate(spark, SMALL).collect()}
    want = {}
    for d in small("documents"):
        runs = set(zip(*[words(d["text"])[k:] for k in range(SEED)]))
        for b in small("benchmark"):
            item = words(b["text"])
            if any(tuple(item[k:k + SEED]) in runs for k in range(len(item) - SEED + 1)):
                # Only words of the item matter to plain tiling; others break runs.
                known = {w: k for k, w in enumerate(dict.fromkeys(item))}
                found = tiles(
                    np.array([known.get(w, 10**6) for w in words(d["text"])], np.uint64),
                    np.array([known[w] for w in item], np.uint64),
                )
                covered = sum(t[2] for t in found)
                if 2 * covered >= len(item):
                    want[d["doc_id"], b["item_id"]] = (len(item), covered, len(found))
    assert got == want and want


ITEM = "one small step for a man is one giant leap for all of us who came after him in peace"


def tables(spark):
    parts = ["one giant leap for all of us", "who came after him in peace", "one small step for a man is"]
    docs = [
        (1, f"before it {ITEM} and after it"), (2, ". ".join(p.title() for p in parts)), (3, "one small step for a man"),
        (4, None), (5, ""), (None, ITEM), (6, "x " * 20_000 + ITEM), (1, f"before it {ITEM} and after it"),
        (7, "for a man of us who"),
    ]
    items = [(10, ITEM, 0), (None, ITEM, 0), (11, None, 0), (12, "too short", 0), (13, "", 0)]
    return (
        spark.createDataFrame([(*d, 0, "k") for d in docs], "doc_id bigint, text string, tie int, item string"),
        spark.createDataFrame(items, "item_id bigint, text string, seed int"),
    )


def test_passages_moved_around_and_odd_rows(spark):
    docs, items = tables(spark)
    found = sorted(((r.doc_id, r.item_id) for r in find_leaks(docs, items).collect()), key=repr)
    hit = [1, 1, 2, 6, None]
    assert found == sorted([(d, i) for d in hit for i in (10, None)], key=repr)
    kept = without_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 7]


def test_empty_tables(spark):
    docs, items = tables(spark)
    assert find_leaks(docs.limit(0), items).count() == 0
    assert find_leaks(docs, items.limit(0)).count() == 0
    assert without_leaks(docs, items.limit(0)).count() == docs.count()
