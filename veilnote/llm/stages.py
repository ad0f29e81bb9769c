"""The operators as stages over rows of `documents`; all but the last return the columns that they got."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilnote.llm import decontamination, mixing, sharding, toxicity
from veilnote.llm.chosen_path import near_duplicates
from veilnote.llm.common import table, written


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    return toxicity.accepted(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (five words, 0.8): that with the smallest doc_id, and one row of it
    if it is repeated, the same one in each run. Rows without doc_id stay."""
    kept = written(near_duplicates(docs, n=5, least=80).where("kept and doc_id is not null").select("doc_id").distinct(), "kept")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    one = docs.join(kept, "doc_id", "left_semi").select(*columns).groupBy("doc_id").agg(
        F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("first")).select("first.*")
    return one.unionByName(docs.where("doc_id is null")).select(*columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a hit word."""
    return decontamination.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, with all its columns, whatever their names."""
    used = ["doc_id", "text", "source"]
    others = F.struct(F.lit(0).alias("none"), *(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns) if c not in used))
    mixed = mixing.mix(docs.select(*used, others.alias("others")))
    row = F.struct(*((F.col(c) if c in used else F.col(f"others.c{k}")).alias(c) for k, c in enumerate(docs.columns)))
    return mixed.select(row.alias("row"), F.expr("explode(array_repeat(0, int(copies)))").alias("copy")).select("row.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row with its slot and shard."""
    return sharding.place(docs)
