"""Each stage of the pipeline on rows with nulls, empty and long texts, repeated ids and columns of clashing names."""
import hashlib
import os
import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from test_documents import lower, plain_components, texts
from veilnote.llm import mixing, stages, toxicity

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, copy string, rank_ int, size string, pool_ string, "
          "taken long, copies int, code_ string, others string, row string, slot string, shard string, kept string, component_id string, score string")


def rows():
    docs = texts(5, 50) + [(300, "bad " * 30 + "tail"), (301, "bad " * 30 + "tail"), (302, " ".join(f"b{k}" for k in range(15)))]
    docs += [(9, texts(5, 50)[12][1]), (None, ""), (None, None)]
    draw = random.Random(2)
    return [(i, t, "en", draw.choice(["s1", "s1", "s2", None]), len(t or ""), f"copy {k}", k, "z", "=s1", 5, 2, "x", "o", "r", "s", "h", "k", "c", "q")
            for k, (i, t) in enumerate(docs)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    labels = [(r[0], 0, int("bad" in (r[1] or ""))) for r in rows() if r[0] is not None] + [(None, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [(1, " ".join(f"b{k}" for k in range(12))), (2, None), (3, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(rows(), SCHEMA).write.parquet(f"{path}/documents.parquet")
    return path


def result(spark, folder, stage, given):
    got = stage(spark, spark.createDataFrame(given, SCHEMA).repartition(3), folder)
    assert got.columns[:len(SCHEMA.split(", "))] == [c.split()[0] for c in SCHEMA.split(", ")] or stage is stages.shard
    return Counter(tuple(r) for r in got.collect())


def test_clean(spark, folder):
    frame = spark.createDataFrame(rows(), SCHEMA)
    model = toxicity.train(frame, spark.read.parquet(f"{folder}/labels.parquet"))
    scores = {r.text: float(s) for r, s in zip(frame.collect(), model.score(frame.toArrow()["text"].combine_chunks()), strict=True)}
    assert result(spark, folder, stages.clean, rows()) == Counter(r for r in rows() if scores[r[1]] < 0.7)


def test_deduplicate(spark, folder):
    found = plain_components([(r[0], r[1]) for r in {r[0]: r for r in reversed(rows()) if r[0] not in (None, 8, 9)}.values()], 5)
    given = [r for r in rows() if r[0] not in (8, 9)] + [rows()[9]] * 2
    got = result(spark, folder, stages.deduplicate, given)
    kept = {i for i, (_, c) in found.items() if c == i}
    assert {r[0] for r in got if r[0] is not None} - {rows()[9][0]} == kept - {rows()[9][0]}
    assert max(Counter(r[0] for r in got.elements() if r[0] is not None).values()) == 1
    assert sum(r[0] is None for r in got.elements()) == sum(r[0] is None for r in given) and got <= Counter(given)
    twice = [r for r in rows() if r[0] == 9]
    assert len(twice) == 2 and result(spark, folder, stages.deduplicate, twice) == result(spark, folder, stages.deduplicate, twice[::-1])


def test_decontaminate(spark, folder):
    item = [f"b{k}" for k in range(12)]
    windows = {tuple(item[k:k + 10]) for k in range(3)}

    def hit(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        return any(tuple(w[k:k + 10]) in windows for k in range(len(w)))

    kept = Counter(r for r in rows() if not hit(r[1]))
    assert result(spark, folder, stages.decontaminate, rows()) == kept and sum(kept.values()) < len(rows())


def test_mix(spark, folder):
    plain = spark.createDataFrame([(r[0], r[1], r[3], r[6]) for r in rows()], "doc_id long, text string, source string, k int")
    copies = {r.k: r.copies for r in mixing.mix(plain).collect()}
    # rows that agree in id, text and source may change places, so they are counted together
    key = lambda r: (r[0], r[1], r[3])
    got = result(spark, folder, stages.mix, rows())
    expected = Counter()
    for r in rows():
        expected[key(r)] += copies[r[6]]
    assert Counter(key(r) for r in got.elements()) == +expected and set(got) <= set(rows()) and max(got.values()) == 2


def test_shard(spark, folder):
    got = result(spark, folder, stages.shard, rows())
    assert sum(got.values()) == len(rows())
    for r in got:
        assert r[-2] == int(hashlib.md5(str(r[0] if r[0] is not None else "").encode()).hexdigest()[:8], 16) % 4099 and 0 <= r[-1] < 64


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_empty(spark, folder, name, stage):
    assert not result(spark, folder, stage, [])


def test_all_stages(spark, folder):
    """The pipeline is its stages in turn, and leaves no table behind but the last one that it reads."""
    out = corpus_pipeline.run(spark, folder)
    kept = {r.doc_id for r in out.select("doc_id").collect()}
    assert kept and not kept & {302}
    left = [f for f in os.listdir(f"{spark.conf.get('spark.checkpoint.dir')}/llm") if re.match("(toxicity|near_dedup|decontamination)-", f)]
    assert not left
