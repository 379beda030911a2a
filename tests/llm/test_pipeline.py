"""The corpus pipeline's stages on the smallest tables."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import corpus_pipeline
from staylake.llm import common, toxicity
from tests.llm.data import edge_rows, no_docs
from tests.llm.test_operators import _brute_components, _brute_overlaps

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = common.table(spark, SF, "documents")
    item = [(r.item_id, r.text) for r in common.table(spark, SF, "benchmark").collect()]
    before, rows = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = common.saved(stage(spark, before, SF), name)
        assert after.columns == docs.columns
        rows[name] = ([(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()], {r.doc_id for r in after.select("doc_id").collect()})
        before = after
    given, kept = rows["toxicity"]
    labels = {r.doc_id: r.toxic for r in common.table(spark, SF, "labels").filter(~toxicity.held_out()).collect()}
    assert kept >= {d for d, _ in given if labels.get(d) == 0}
    given, kept = rows["exact_dedup"]
    last = {}
    for d, t in sorted(given):
        last[t.lower()] = d
    assert kept == set(last.values())
    given, kept = rows["near_dedup"]
    assert kept == {d for d, (_, c) in _brute_components(given).items() if c == d}
    given, kept = rows["decontamination"]
    assert kept == {d for d, _ in given} - {d for d, _ in _brute_overlaps(given, item)}
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == kept
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


def test_stages_leave_columns_and_texts_alone(spark):
    """Edge rows, repeated ids with other texts, columns named like the operators' own."""
    item = common.table(spark, SF, "benchmark").first().text
    rows = [r[:5] for r in edge_rows()] + [(2, "a text of its own " * 9, "en", "s", 1), (2, "say " + item + " now", None, None, None), (1, item, None, None, None)]
    names = ["_node", "score", "predicted", "_file", "_row", "file", "row", "place", "number", "_raw", "_words", "_x", "_p", "_score", "node", "found"]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = docs.withColumns({c: F.lit("mine") for c in names}).repartition(3)
    before, left = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = common.saved(stage(spark, before, SF), name)
        assert before.columns == docs.columns and before.count() == before.filter(" AND ".join(f"`{c}` = 'mine'" for c in names)).count()
        left[name] = [(r.doc_id, r.text) for r in before.collect()]
    assert (2, "a text of its own " * 9) in left["decontamination"]
    assert not any(item in (t or "") for _, t in left["decontamination"]) and sum(item in (t or "") for _, t in left["near_dedup"]) == 1
    assert len(left["exact_dedup"]) == len({(t or "").lower() for _, t in left["toxicity"]})
    assert corpus_pipeline.STAGES[-1][1](spark, before, SF).agg(F.countDistinct("sequence_id")).first()[0] > 0
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert no_docs(spark).columns[:5] == docs.columns[:5]


@pytest.mark.parametrize("limit", [corpus_pipeline.BROADCAST_NUMBERS, 0])
def test_texts_are_not_moved_to_drop_rows(spark, monkeypatch, limit):
    """What goes is named by number and broadcast, also where Spark itself would not; beyond the limit rows are shuffled."""
    monkeypatch.setattr(corpus_pipeline, "BROADCAST_NUMBERS", limit)
    item = common.table(spark, SF, "benchmark").first().text
    own = " ".join(f"word{i}" for i in range(30))
    docs = spark.createDataFrame([(1, own), (2, own + " more"), (2, item), (None, own), (None, None), (3, item + " end"), (4, "")],
                                 "doc_id bigint, text string").repartition(3)
    docs = common.saved(docs, "dropping")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for stage, left in ((corpus_pipeline.drop_near_copies, [(1, own), (2, item), (None, None), (4, "")]),
                            (corpus_pipeline.drop_contaminated, [(1, own), (2, own + " more"), (None, own), (None, None), (4, "")])):
            kept = stage(spark, docs, SF)
            plan = kept._jdf.queryExecution().executedPlan().toString()
            assert ("Exchange hashpartitioning" in plan) == (limit == 0) and ("BroadcastHashJoin" in plan) == (limit > 0)
            assert sorted(map(repr, kept.collect())) == sorted(repr(Row(doc_id=d, text=t)) for d, t in left)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
