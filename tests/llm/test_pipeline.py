"""The pipeline's stages, each against a plain version on its own input."""

import re

import pytest

import corpus_pipeline
from salesmill.llm.common import read_table
from salesmill.llm.toxicity import score_toxicity, fit

from .conftest import SMALL
from .test_line_dedup import plain as plain_lines
from .test_simhash import plain_groups


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage, as written."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = read_table(spark, SMALL, "documents"), {}
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, SMALL).write.parquet(f"{folder}/{k}")
        after = spark.read.parquet(f"{folder}/{k}")
        out[name] = (docs, after)
        docs = after
    return out


def pairs(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_stages_return_documents(stages):
    columns = stages["toxicity"][0].columns
    assert list(stages) == ["toxicity", "line_dedup", "near_dedup", "decontamination", "sentence_pieces"]
    assert all(after.columns == columns for name, (_, after) in stages.items() if name != "sentence_pieces")


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    net = fit(before, read_table(spark, SMALL, "labels"))
    clean = [r.doc_id for r in score_toxicity(before, net).where("predicted = 0").collect()]
    assert sorted(clean) == [i for i, _ in pairs(after)]


def test_repeated_lines_go(stages):
    before, after = stages["line_dedup"]
    want = [(i, t) for i, t, n, gone in plain_lines(pairs(before)) if gone < n]
    assert pairs(after) == want


def test_one_of_each_group_stays(stages):
    before, after = stages["near_dedup"]
    want = sorted({component for _, _, component in plain_groups(pairs(before))})
    assert [i for i, _ in pairs(after)] == want


def test_leaks_go(stages, small):
    before, after = stages["decontamination"]
    words = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = [words(b["text"]) for b in small("benchmark")]
    leaked = {i for i, t in pairs(before) if any(item in words(t) for item in items)}
    gone = {i for i, _ in pairs(before)} - {i for i, _ in pairs(after)}
    assert leaked <= gone and len(gone - leaked) <= 2


def test_pieces_decode_to_the_texts(stages):
    before, after = stages["sentence_pieces"]
    assert after.count() == before.count() and after.where("not round_trip").count() == 0


def test_run_is_all_stages(spark, stages):
    got = corpus_pipeline.run(spark, SMALL)
    after = stages["sentence_pieces"][1]
    assert sorted(map(tuple, got.select("doc_id", "ids_crc32").collect())) == sorted(
        map(tuple, after.select("doc_id", "ids_crc32").collect())
    )


@pytest.fixture(params=["odd", "none"])
def odd_folder(request, spark, odd_docs, no_docs, tmp_path):
    """Tables of odd documents or none, no labels, and benchmark items of which one is null and one empty."""
    docs = odd_docs if request.param == "odd" else no_docs
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    items = [(1, None), (2, ""), (3, " ".join(f"p2w{k}" for k in range(20)))]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_odd_documents_through_all_stages(spark, odd_folder, tmp_path):
    """Names that clash come through all stages but the last; what each removes is what it states."""
    docs = read_table(spark, odd_folder, "documents")
    columns, kept = docs.columns, {}
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, odd_folder).write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        kept[name] = [(r.doc_id, r.text) for r in docs.collect()] if name != "sentence_pieces" else docs.count()
        assert name == "sentence_pieces" or docs.columns == columns
    if not kept["toxicity"]:
        assert not any(kept.values())
        return
    source = [(r.doc_id, r.text) for r in read_table(spark, odd_folder, "documents").collect()]
    assert sorted(kept["toxicity"], key=repr) == sorted(source, key=repr)   # no labels: nothing is toxic
    assert sum(not (t or "").split() for _, t in kept["near_dedup"]) == 1   # texts without words are one group
    assert len(set(kept["near_dedup"])) == len(kept["near_dedup"])
    assert [i for i, t in kept["near_dedup"] if "p2w3" in (t or "")] == [10]
    assert not any("p2w3" in (t or "") for _, t in kept["decontamination"])
    assert kept["sentence_pieces"] == len(kept["decontamination"])
    assert corpus_pipeline.run(spark, odd_folder).count() == kept["sentence_pieces"]
