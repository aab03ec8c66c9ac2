"""Odd documents: null and empty values, long texts, ties, repeated rows, names that clash."""

from __future__ import annotations

import random

import pyarrow.parquet as pq
import pytest

SMALL = "/root/testdata/sf0.001"
# Names that operators use themselves.
CLASHING = (
    "lang string, source string, n_chars bigint, tie bigint, fp bigint, row string, record string, score double,"
    " bucket int, shard int, slot bigint, words string, level int, key string, kept_text string, ids string,"
    " id bigint, own_id bigint, own_tie bigint, idx int, n bigint, host string, item string, component_id bigint"
)
LONG = " ".join(f"long{k % 977}ish{k % 31}" for k in range(30_000))
PASSAGE = "\n".join(" ".join(f"p{r}w{k}" for k in range(20)) for r in range(4))


def texts() -> list[tuple[int | None, str | None]]:
    r = random.Random(11)
    prose = [" ".join(r.choice(["alpha", "beta", "gamma", "delta", "eta"]) for _ in range(80)) for _ in range(3)]
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "ONE"), (6, "one two three"), (7, LONG), (8, LONG),
        (9, prose[0]), (9, prose[0]), (9, prose[1]), (None, prose[2]), (None, None), (None, prose[2]),
        (10, f"intro line\n{PASSAGE}\noutro"), (11, f"{PASSAGE}\nown end"), (12, "same\nsame\nsame\n" * 40),
        (13, "é ñ ß 日本語 🙂 <|endoftext|> ▁ \x00  end  "), (14, "x" * 5000), (15, "\n\n\n"),
    ]


@pytest.fixture
def odd_docs(spark):
    names = [c.split()[0] for c in CLASHING.split(", ")]
    rows = [(i, t, *[None] * len(names)) for i, t in texts()]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, {CLASHING}").repartition(3)


@pytest.fixture
def stored_odd_docs(spark, odd_docs, tmp_path):
    odd_docs.write.parquet(str(tmp_path / "odd"))
    return spark.read.parquet(str(tmp_path / "odd"))


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], f"doc_id bigint, text string, {CLASHING}")


@pytest.fixture(scope="session")
def small():
    """Tables of the smallest size as lists of dictionaries."""
    return lambda name: pq.read_table(f"{SMALL}/{name}.parquet").to_pylist()


def by_id(df, *columns):
    """Rows by document id, sorted where an id comes more than once."""
    found = {}
    for row in df.select("doc_id", *columns).collect():
        found.setdefault(row[0], []).append(tuple(row[1:]))
    return {k: sorted(v, key=repr) for k, v in found.items()}
