"""The upsert against the definition of MERGE, written out row by row."""

import random

import pytest

from pyspark.sql import functions as F

import salesmill as sm
from salesmill.operators.key_filter import divide_by_filter, divide_by_keys, rows_with_keys
from salesmill.operators.upsert import _tally, stage_source

COLUMNS = "k1 string, k2 int, v string"


class Refused(Exception):
    pass


def merge_by_hand(target, source):
    """Rows of the target after MERGE ... UPDATE SET * / INSERT *; keys are the first two."""

    def matches(t, s):
        return None not in t[:2] and None not in s[:2] and t[:2] == s[:2]

    result, used = [], set()
    for t in target:
        hits = [i for i, s in enumerate(source) if matches(t, s)]
        if len(hits) > 1:
            raise Refused
        result.append(source[hits[0]] if hits else t)
        used.update(hits)
    return result + [s for i, s in enumerate(source) if i not in used]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def random_rows(rng, count, label, keys):
    return [
        (rng.choice([None, "a", "b", "c"]), rng.choice([None, *range(keys)]), f"{label}{rng.randrange(3)}")
        for _ in range(count)
    ]


@pytest.mark.parametrize("seed", range(12))
def test_agrees_with_merge(spark, seed):
    rng = random.Random(seed)
    keys = rng.choice([3, 12])
    target = random_rows(rng, rng.randrange(0, 14), "t", keys)
    source = random_rows(rng, rng.randrange(0, 8), "s", keys)
    t, s = spark.createDataFrame(target, COLUMNS), spark.createDataFrame(source, COLUMNS)
    try:
        want = sorted(merge_by_hand(target, source), key=repr)
    except Refused:
        with pytest.raises(sm.AmbiguousSourceError):
            sm.upsert(t, s, ["k1", "k2"])
        return
    assert rows(sm.upsert(t, s, ["k1", "k2"])) == want


def test_every_matching_target_row_is_updated(spark):
    t = spark.createDataFrame([("a", 1, "old1"), ("a", 1, "old2"), ("b", 1, "other")], COLUMNS)
    s = spark.createDataFrame([("a", 1, "new"), ("c", 1, "added"), ("c", 1, "added too")], COLUMNS)
    assert rows(sm.upsert(t, s, ["k1", "k2"])) == sorted([
        ("a", 1, "new"), ("a", 1, "new"), ("b", 1, "other"), ("c", 1, "added"), ("c", 1, "added too")
    ], key=repr)


def test_null_keys_never_match(spark):
    t = spark.createDataFrame([(None, 1, "kept")], COLUMNS)
    s = spark.createDataFrame([(None, 1, "added"), (None, 1, "added")], COLUMNS)
    for mode in ({}, {"on_duplicate": "latest", "order_by": ["v"]}):
        assert rows(sm.upsert(t, s, ["k1", "k2"], **mode)) == [
            (None, 1, "added"), (None, 1, "added"), (None, 1, "kept")
        ]


def test_two_source_rows_for_one_target_row_are_refused_or_reduced(spark):
    t = spark.createDataFrame([("a", 1, "old")], COLUMNS)
    s = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y")], COLUMNS)
    with pytest.raises(sm.AmbiguousSourceError, match="'a', 1"):
        sm.upsert(t, s, ["k1", "k2"])
    assert rows(sm.upsert(t, s, ["k1", "k2"], "latest", ["v"])) == [("a", 1, "y")]


def test_again_changes_nothing(spark):
    t = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], COLUMNS)
    s = spark.createDataFrame([("a", 1, "new"), ("z", 1, "new")], COLUMNS)
    once = sm.upsert(t, s, ["k1", "k2"])
    assert rows(sm.upsert(once, s, ["k1", "k2"])) == rows(once)


def test_columns_go_by_name(spark):
    t = spark.createDataFrame([("a", 1, "old")], COLUMNS)
    s = spark.createDataFrame([("extra", "new", 1, "a")], "more string, v string, k2 bigint, k1 string")
    merged = sm.upsert(t, s, ["k1", "k2"])
    assert merged.dtypes == t.dtypes and rows(merged) == [("a", 1, "new")]
    with pytest.raises(ValueError, match="v"):
        sm.upsert(t, s.drop("v"), ["k1", "k2"])


def test_bad_options_are_refused(spark):
    t = spark.createDataFrame([("a", 1, "old")], COLUMNS)
    with pytest.raises(ValueError, match="order_by"):
        sm.upsert(t, t, ["k1"], "latest")
    with pytest.raises(ValueError, match="first"):
        sm.upsert(t, t, ["k1"], "first")


def test_latest_may_be_chosen_by_a_column_the_target_lacks(spark):
    t = spark.createDataFrame([("a", 1, "old"), ("b", 1, "old")], COLUMNS)
    s = spark.createDataFrame(
        [("a", 1, "x", 2), ("a", 1, "y", 1), ("c", 1, "p", 1), ("c", 1, "q", 5)], COLUMNS + ", seen int"
    )
    merged = sm.upsert(t, s, ["k1", "k2"], "latest", ["seen"])
    assert merged.columns == t.columns
    assert rows(merged) == [("a", 1, "x"), ("b", 1, "old"), ("c", 1, "q")]


@pytest.fixture
def filtered(monkeypatch):
    """Keys are looked for by a filter, however few they are."""
    monkeypatch.setattr("salesmill.operators.key_filter.FILTER_FROM", 1)
    monkeypatch.setattr("salesmill.operators.key_filter.LEAST_WORDS", 4)


def test_rows_divided_by_a_filter_of_keys(spark, filtered):
    rows = spark.range(4000).selectExpr(
        "CASE WHEN id % 50 = 0 THEN NULL ELSE concat('k', id % 3000) END AS `a key`", "cast(id % 3 AS int) AS part", "id AS v"
    )
    held = sm.stage(rows.where("v % 7 = 0").select("`a key`", "part").dropna().distinct(), "held")
    inside, others = divide_by_keys(rows, held, ["a key", "part"])
    assert sorted(inside.collect()) == sorted(
        rows.join(held, ["a key", "part"], "left_semi").select("`a key`", "part", "v").collect()
    )
    plain = rows.join(held, ["a key", "part"], "left_anti").select("`a key`", "part", "v")
    assert inside.count() + others.count() == 4000
    assert others.subtract(plain).isEmpty() and others.count() == plain.count()
    # Most of the others do not meet the keys at all.
    met = others._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in met and met.count("LeftAnti") == 1


def test_upserts_by_a_filter_are_the_same(spark, filtered, monkeypatch):
    target = sm.stage(spark.range(600).selectExpr("CASE WHEN id % 90 <> 0 THEN id % 500 END AS k", "'old' AS v", "id AS n"), "target")
    source = sm.stage(
        spark.range(700).selectExpr("CASE WHEN id % 80 <> 0 THEN id % 300 + 250 END AS k", "'new' AS v", "id AS n"), "source"
    )
    by_filter = sorted(map(str, sm.upsert(target, source, ["k"], "latest", ["n"]).collect()))
    monkeypatch.setattr("salesmill.operators.key_filter.FILTER_FROM", 10**9)
    assert by_filter == sorted(map(str, sm.upsert(target, source, ["k"], "latest", ["n"]).collect()))


def test_keys_of_both_sides_meet_once(spark, filtered):
    target = sm.stage(spark.range(3000).selectExpr("concat('k', id % 2500) AS k", "'old' AS v", "id % 7 AS part"), "target")
    source = sm.stage(
        spark.range(400).selectExpr("CASE WHEN id % 50 <> 0 THEN concat('k', 2300 + id % 300) END AS k", "'new' AS v", "id % 7 AS part"),
        "source",
    )
    claims, held = source.select("k").dropna(), target.select("k")
    tally = _tally(target, source, ["k"])
    expected = claims.groupBy("k").count().join(held.groupBy("k").agg(F.count("*").alias("copies")), "k", "left").fillna(0)
    expected = expected.where("`count` > 1 OR copies > 0")
    assert sorted(tally.collect()) == sorted(expected.collect()) != []
    assert "Join" not in tally._jdf.queryExecution().optimizedPlan().toString()
    staged = stage_source(target, source, ["k"], ["part"], "latest", ["v"])
    assert sorted(staged.places.collect()) == sorted(target.join(claims, "k", "left_semi").select("part").distinct().collect())


def test_rows_with_keys_are_those_of_the_division(spark, filtered):
    rows = spark.range(900).selectExpr("CASE WHEN id % 9 <> 0 THEN concat('k', id % 300) END AS `a key`", "id AS v")
    held = sm.stage(rows.where("v % 7 = 0").select("`a key`").dropna().distinct(), "held")
    found = rows_with_keys(rows, held, ["a key"])
    assert sorted(found.collect()) == sorted(divide_by_keys(rows, held, ["a key"])[0].collect()) != []


def test_a_merge_looks_for_partitions_among_rows_that_a_filter_lets_through(spark, filtered, layers, monkeypatch):
    from salesmill.sinks import merge

    asked = []
    monkeypatch.setattr(merge, "rows_with_keys", lambda rows, *rest: asked.append(rows.columns) or rows_with_keys(rows, *rest))
    table = f"{layers.silver}.by_part"
    source = spark.range(80).selectExpr("concat('k', id) AS k", "'old' AS v", "cast(id % 4 AS int) AS part")
    sm.merge_table(spark, source, table, ["k"], ["part"])
    moved = spark.range(60, 100).selectExpr("concat('k', id) AS k", "'new' AS v", "cast(id % 3 AS int) AS part")
    sm.merge_table(spark, moved, table, ["k"], ["part"])
    stored = {(r.k, r.v, r.part) for r in spark.table(table).collect()}
    assert asked == [["k", "part"]]
    assert stored == {(f"k{i}", "old", i % 4) for i in range(60)} | {(f"k{i}", "new", i % 3) for i in range(60, 100)}


def test_a_filter_of_keys_is_no_value_within_a_plan(spark, filtered):
    rows = spark.range(900).selectExpr("CASE WHEN id % 9 <> 0 THEN concat('k', id % 300) END AS `a key`", "id AS v")
    held = sm.stage(rows.where("v % 7 = 0").select("`a key`").dropna(), "held")
    among, others = divide_by_filter(rows, held, ["a key"], held.count())
    assert among.columns == others.columns == rows.columns
    assert among.intersectAll(others).isEmpty() and among.count() + others.count() == 900
    assert others.join(held, "a key", "left_semi").isEmpty() and not others.where("`a key` IS NULL").isEmpty()
    target = sm.stage(rows, "target")
    merged = sm.upsert(target, target.where("v > 500"), ["a key"], "latest", ["v"])
    for df in (among, others, merged):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "subquery" not in plan.lower() and "BroadcastHashJoin" in plan
