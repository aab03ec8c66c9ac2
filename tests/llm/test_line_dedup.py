"""Line dedup against the longest earlier match of every line."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from salesmill.llm.line_dedup import MIN_WORDS, dedup_lines, least_runs, without_repeated_runs
from salesmill.llm.queries import op10_line_dedup

from .conftest import PASSAGE, SMALL, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(docs, min_words=MIN_WORDS):
    """Kept text and deleted lines of distinct (id, text), the ids in order."""
    cut = [(text or "").split("\n") for _, text in docs]
    places = defaultdict(list)
    for d, lines in enumerate(cut):
        for k, line in enumerate(lines):
            places[line].append((d, k))
    out = []
    for d, lines in enumerate(cut):
        gone = set()
        for k, line in enumerate(lines):
            longest = 0
            for e, j in places[line]:
                if (e, j) >= (d, k):
                    break
                n = 0
                while k + n < len(lines) and j + n < len(cut[e]) and lines[k + n] == cut[e][j + n]:
                    n += 1
                longest = max(longest, n)
            if sum(len(WORD.findall(x)) for x in lines[k:k + longest]) >= min_words:
                gone.update(range(k, k + longest))
        kept = "\n".join(x for k, x in enumerate(lines) if k not in gone)
        out.append((docs[d][0], kept if docs[d][1] is not None else None, len(lines), len(gone)))
    return out


def rows(df):
    return sorted(map(tuple, df.select("row.doc_id", "kept_text", "n_lines", "n_deleted").collect()), key=repr)


@pytest.mark.parametrize("min_words", [1, 3, 7])
def test_any_documents(spark, min_words):
    r = random.Random(min_words)
    lines = ["a", "b c", "", "d e f", "g"]
    docs = [(k, "\n".join(r.choice(lines) for _ in range(r.randrange(1, 14)))) for k in range(60)]
    docs = [(k, t) for k, t in docs if t != ""]
    got = rows(dedup_lines(spark.createDataFrame(docs, "doc_id bigint, text string"), min_words))
    # Texts equal to another document's tie by id, so the order is that of the list.
    assert got == sorted(plain(docs, min_words), key=repr)


def test_least_runs_cover_every_long_enough_run():
    r = random.Random(2)
    for _ in range(300):
        words = np.array([r.choice([0, 1, 2, 5, 9]) for _ in range(r.randrange(1, 12))])
        found = least_runs(np.arange(len(words)), words, 10)
        for s in range(len(words)):
            for e in range(s + 1, len(words) + 1):
                if words[s:e].sum() >= 10:
                    inside = [set(range(a, a + n)) for a, n in found if s <= a and a + n <= e]
                    assert set().union(*inside) == set(range(s, e))


def test_query_against_plain_version(spark, small):
    docs = [(d["doc_id"], d["text"]) for d in sorted(small("documents"), key=lambda d: d["doc_id"])]
    got = sorted(map(tuple, op10_line_dedup(spark, SMALL).collect()))
    assert got == sorted(plain(docs)) and any(r[3] for r in got)


def test_odd_documents(odd_docs):
    got = defaultdict(list)
    for doc_id, text, _, deleted in rows(dedup_lines(odd_docs)):
        got[doc_id].append((text, deleted))
    given = defaultdict(list)
    for doc_id, text in texts():
        given[doc_id].append(text)
    assert got[11] == [("own end", 4)] and got[10][0][1] == 0 and PASSAGE in got[10][0][0]
    assert got[8] == [("", 1)] and got[7][0][1] == 0
    # Fifty lines of one word make a run; it goes wherever it comes again, and one copy stays.
    assert got[12][0][1] > 0 and "same" in got[12][0][0]
    # Rows equal in id and text are one document, also without an id.
    for doc_id in (1, 2, 3, 4, 9, 13, 14, 15, None):
        assert sorted(map(repr, given[doc_id])) == sorted(repr(t) for t, _ in got[doc_id])


def test_rows_keep_their_columns_and_empty_ones_go(spark, odd_docs):
    kept = without_repeated_runs(odd_docs.withColumn("n_chars", odd_docs.doc_id))
    assert kept.columns == odd_docs.columns
    found = {r.doc_id: r for r in kept.where("doc_id is not null").collect()}
    assert 8 not in found and found[11].text == "own end" and found[11].n_chars == len("own end")
    assert found[2].text == "" and found[1].text is None and found[10].n_chars == 10


def test_no_documents(no_docs):
    assert dedup_lines(no_docs).count() == 0
