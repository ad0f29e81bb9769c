"""The registered queries of this subpackage and their comparison SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from veilnote.llm import divergence, lexical_search, mixing, sharding, warc
from veilnote.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {"op2_sharding": sharding.SQL, "op3_warc": warc.SQL, "op8_mixing": mixing.SQL,
                      "op12_divergence": divergence.SQL, "op13_ranked_search": lexical_search.SQL}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near copies among all documents."""
    from veilnote.llm.chosen_path import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), n=4, least=80)


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that lie in 10-word windows of benchmark items."""
    from veilnote.llm.decontamination import decontaminate

    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10).drop("items", "spans")


@query
def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents in strings of 200 bytes that occur elsewhere too."""
    from veilnote.llm.repeats import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), size=200).drop("kept")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score of each document, by a model trained from the labels that aren't held out."""
    from veilnote.llm.toxicity import judge

    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all documents takes of each."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of each document."""
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id", "n_chars"))


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all pages, written to archives and read back."""
    return warc.archive_round_trip(spark, table(spark, sf_dir, "pages"))


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of the URL of each page."""
    from veilnote.llm.url_filter import judge

    return judge(table(spark, sf_dir, "pages"))


@query
def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of each query vector."""
    from veilnote.llm.stable_search import nearest

    return nearest(table(spark, sf_dir, "embeddings"), every=100, k=10)


@query
def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page."""
    from veilnote.llm.main_text import extract

    return extract(table(spark, sf_dir, "pages"))


@query
def op11_class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of each document under a class-based model of those that aren't held out."""
    from veilnote.llm.class_model import score

    return score(table(spark, sf_dir, "documents"))


@query
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences between the sources of each language, and the terms that make them."""
    return divergence.audit(table(spark, sf_dir, "documents"))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents for each benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)
