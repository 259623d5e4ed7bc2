"""What the operators shuffle and keep on the way."""

import pytest

from tallymark.llm import bpe, common, decontam, rans
from tallymark.llm.lm import scored


@pytest.fixture(autouse=True)
def shipped(spark):
    common.ship(spark)


def test_blocks_of_the_model_are_not_shuffled(spark):
    docs = spark.createDataFrame(
        [(i, f"red blue word{i % 7} green blue", i % 4 == 0) for i in range(40)],
        "doc_id long, text string, held_out boolean")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    tables = {t.name for t in spark.catalog.listTables()}
    spark.conf.set(threshold, "-1")
    try:
        found = scored(docs)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 40
    finally:
        spark.conf.set(threshold, before)
    # Answers are shuffled to the blocks, twice; the blocks with their words never are.
    assert plan.count("Exchange hashpartitioning(block") == 2
    assert "Bucketed: true" in plan
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_a_worker_forgets_what_other_operators_kept():
    kept = (bpe._codecs, decontam._finders, rans._tokenizers)
    for own in kept:
        own["x"] = None
    common.forget()
    assert not any(kept)
