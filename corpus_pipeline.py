"""Five stages over `documents`; each one works on what the one before it kept."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from veilnote.llm.common import Scratch
from veilnote.llm.stages import clean, decontaminate, deduplicate, mix, shard

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", clean),
    ("near_dedup", deduplicate),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: SQL can't express a trained classifier or a set similarity join on whole tables; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn; what a stage returns is written as Parquet and read again by the next one, then removed."""
    docs, tables, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark), ()
    for name, stage in STAGES[:-1]:
        docs = tables.put(stage(spark, docs, sf_dir), name)
        tables.drop(*before)
        before = (name,)
    return STAGES[-1][1](spark, docs, sf_dir)
