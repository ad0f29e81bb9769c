"""Landed API pages: JSON payloads with an item list and paging facts."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

META = "struct<total_count:bigint,per_page:bigint,current_page:bigint>"


def parse_pages(pages: DataFrame, entity: str, item: str, payload: str = "payload") -> DataFrame:
    """Pages of one entity with typed items and paging facts."""
    schema = f"struct<{entity}:array<{item}>,meta:{META}>"
    return pages.where(F.col("entity") == entity).select("page", F.from_json(payload, schema).alias("p")).select(
        "page", F.coalesce(F.col(f"p.{entity}"), F.array().cast(f"array<{item}>")).alias("items"), "p.meta")


def explode_api_pages(parsed: DataFrame) -> DataFrame:
    """All items in page order."""
    return parsed.select("page", F.posexplode("items").alias("pos", "item")).select("page", "pos", "item.*")


def last_by_id(items: DataFrame, key: str = "id") -> DataFrame:
    """Items keyed by id, the last one wins; aggregated on the map side."""
    cols = [c for c in items.columns if c not in ("page", "pos")]
    return items.groupBy(key).agg(
        F.max_by(F.struct(*[c for c in cols if c != key]), F.struct("page", "pos")).alias("r")).select(key, "r.*")


def date_range_filter(items: DataFrame, column: str, start, end) -> DataFrame:
    """Rows from start to end, both included."""
    return items.where(F.col(column).between(start, end))


def page_completeness(parsed: DataFrame, per_page: int = 100) -> DataFrame:
    """Whether the landed pages reach the announced total."""
    size: Column = F.coalesce(F.col("meta.per_page"), F.lit(per_page).cast("long"))
    current = F.coalesce(F.col("meta.current_page"), F.col("page").cast("long"))
    return parsed.agg(
        F.count("*").alias("pages"), F.sum(F.size("items").cast("long")).alias("items"),
        F.max(F.coalesce(F.col("meta.total_count"), F.lit(0).cast("long"))).alias("total_count"),
        F.bool_or(F.col("meta").isNull() | (current * size >= F.coalesce(F.col("meta.total_count"), F.lit(0)))
                  ).alias("complete"))
