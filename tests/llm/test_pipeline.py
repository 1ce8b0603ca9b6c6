"""Every registered text query runs; the pipeline keeps what plain stages keep."""

import compare
import inputs
import pytest

import __spark_entry__ as driver
import corpus_pipeline
import test_bagminhash
import test_decontam
from ledgerloom.llm import line_rules, queries
from ledgerloom.llm.common import table


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, name):
    same, line = compare.compare(spark, compare.duck(inputs.SF_DIR), name, queries.QUERIES[name],
                                 queries.ORACLES[name], inputs.SF_DIR)
    assert same, line


def test_registered():
    names = driver.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} >= set(range(1, 11)) and "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "decontamination", "private_data", "pack"]


def test_stages_keep_what_plain_ones_keep(spark):
    docs = table(spark, inputs.SF_DIR, "documents")
    items = [(r.item_id, r.text) for r in table(spark, inputs.SF_DIR, "benchmark").collect()]
    judged = {r.doc_id: line_rules.judge(r.text) for r in docs.collect()}
    texts = {i: j["clean_text"] for i, j in judged.items() if j["kept"]}
    classes = test_bagminhash.brute_classes(sorted(texts.items()))
    texts = {i: t for i, t in texts.items() if classes[i] == i}
    leaking = {d for d, _ in test_decontam.brute(list(texts.items()), items)}
    want = {i for i in texts if i not in leaking}

    step = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, inputs.SF_DIR)
        assert step.columns == docs.columns
    assert {r.doc_id for r in step.select("doc_id").collect()} == want
    packed = corpus_pipeline.run(spark, inputs.SF_DIR)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == want
