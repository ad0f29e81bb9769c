"""The stages one after the other: each keeps a part of what it got, and nothing that it must reject."""
import corpus_pipeline
from veilnote.llm.chosen_path import near_duplicates
from veilnote.llm.common import table, written
from veilnote.llm.decontamination import decontaminate


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    columns, counts, stages = docs.columns, [docs.count()], {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stages[name] = written(stage(spark, docs, sf), name)
        counts.append(docs.count())
    assert [s.columns for s in stages.values()] == [columns] * 4 + [[*columns, "slot", "shard"]]
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] > 0 and counts[4] == counts[5]
    assert near_duplicates(stages["near_dedup"]).where("not kept").isEmpty()
    assert decontaminate(stages["decontamination"], table(spark, sf, "benchmark")).where("contaminated").isEmpty()
    ids = {r.doc_id for r in stages["decontamination"].collect()}
    assert {r.doc_id for r in stages["mixing"].collect()} <= ids
