"""The pipeline's stages take effect, one after another, on what the predecessor kept."""

import pytest

import __spark_entry__
import corpus_pipeline
from tallystar.llm import op07_noisy_channel, op09_templates, op10_signature_tree
from tallystar.llm.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], SF).write.parquet(f"{root}/{name}")
        kept.append(spark.read.parquet(f"{root}/{name}"))
    return kept


def names(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns_and_shrink(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "decontamination", "packing"]
    for before, after in zip(steps[:4], steps[1:5]):
        assert after.columns == steps[0].columns and names(after) <= names(before)


def test_each_stage_decides_on_its_own_input(spark, steps):
    toxic = {r["doc_id"] for r in op07_noisy_channel.toxicity(steps[0], spark.read.parquet(f"{SF}/labels.parquet")).filter("predicted = 1").collect()}
    assert names(steps[1]) == names(steps[0]) - toxic
    assert names(steps[2]) == names(steps[1])
    lines = [x for r in steps[2].collect() for x in r["text"].split("\n") if x.strip()]
    assert len(lines) == len(set(lines))
    heads = {r["component_id"] for r in op10_signature_tree.jaccard_components(steps[2]).collect()}
    assert names(steps[3]) == heads
    leaked = {r["doc_id"] for r in op09_templates.contaminated(steps[3], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert names(steps[4]) == names(steps[3]) - leaked
    assert names(steps[5]) == names(steps[4])


def odd_documents(spark, docs):
    """Null and repeated ids, repeated rows, and near copies of a document among them."""
    text = docs.filter("length(text) > 800").orderBy("doc_id").first()["text"]
    words = text.split(" ")
    near = " ".join([*words[:-1], "changed"])
    rows = [(None, text), (None, "quite another text of its own, with some more words"), (None, None), (None, ""), (7, near), (7, near), (7, near), (5, ""), (5, "")]
    full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    return spark.createDataFrame(full, docs.schema).repartition(3), text, near


def test_one_row_of_a_component_stays_whatever_its_id(spark, steps):
    odd, text, near = odd_documents(spark, steps[0])
    kept = sorted(((r["doc_id"], r["text"]) for r in op10_signature_tree.keep_one(spark, odd, SF).collect()), key=str)
    assert kept == sorted([(7, near), (None, "quite another text of its own, with some more words"), (None, None), (None, ""), (5, ""), (5, "")], key=str)


def test_all_stages_take_odd_rows_and_an_empty_table(spark, steps, tmp_path):
    odd, _, _ = odd_documents(spark, steps[0])
    for name, docs in (("odd", odd), ("empty", odd.limit(0))):
        for stage, function in corpus_pipeline.STAGES:
            before = docs
            function(spark, before, SF).write.parquet(f"{tmp_path}/{name}/{stage}")
            docs = spark.read.parquet(f"{tmp_path}/{name}/{stage}")
            if stage != "packing":
                assert docs.columns == odd.columns and docs.count() <= before.count()
        assert (docs.count() == 0) == (name == "empty")


def test_run_gives_the_rows_of_the_last_stage(spark, steps):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF).select(columns).collect()} == {tuple(r) for r in steps[5].select(columns).collect()}


def test_queries_are_registered():
    known = __spark_entry__.queries()
    assert "pipeline" in known and set(QUERIES) <= set(known) and set(SQL) <= set(QUERIES)
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14))
