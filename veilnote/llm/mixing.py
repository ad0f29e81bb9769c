"""Mixing sources to target weights by systematic sampling, with DataFrame functions only."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veilnote.llm.common import written

#: Weights of the sources in order, repeating; the whole mix and a source's limit as multiples of the input's size.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Hex digits of an id's hash that split documents of one source and size into groups that are ranked apart.
DIGITS = 3


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(pool, source_size, target) from sizes(pool, source_size), a row for each source.

    Filling by weight until none is above its limit gives each source the smaller of its limit and level * weight. With
    sources by limit / weight, the level is the largest of (what the sources before leave) / (weights of the others).
    """
    order = W.orderBy("pool")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS))) + 1)
    whole = W.partitionBy()
    by_limit = W.orderBy(F.col("limit") / F.col("weight"), "pool").rowsBetween(W.unboundedPreceding, -1)
    ready = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * MOST)
    left = F.sum("source_size").over(whole) * SHARE - F.coalesce(F.sum("limit").over(by_limit), F.lit(0))
    rest = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(by_limit), F.lit(0))
    level = ready.withColumn("level", left / rest).withColumn("level", F.max("level").over(whole))
    return level.select("pool", "source_size", F.least(F.col("limit").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def mix(docs: DataFrame) -> DataFrame:
    """The rows of docs(doc_id, text, source, ...) with size, source_size, target, copies and taken = copies * size.

    A document's expected copies are its source's target / source_size. Documents are ordered by size, then by a hash
    of the id, within their source; prefix sums of the expected copies and one offset of the source are taken, and a
    document is emitted once for each whole number crossed: at most twice, never more than the next whole number.
    Ordering by size keeps the words taken close to the target. Results depend on the rows only, so reruns agree.

    A source may hold most rows, so no window spans one: a rank is the number of smaller sizes' documents, plus those
    of smaller hash groups of the same size, plus the place within the group. Null source is a source, ordered last;
    null texts have size 0; null ids are ordered first. A source without words has target 0. Extra columns are kept;
    those named like the results are replaced.
    """
    docs = docs.drop("size", "source_size", "target", "copies", "taken")
    pool = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))
    code = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    ready = docs.withColumns({"pool_": pool, "size": word_count(), "code_": code}).withColumn("group_", F.substring("code_", 1, DIGITS))
    counts = written(ready.groupBy("pool_", "size", "group_").agg(F.count("*").alias("n")), "counts")

    before = W.orderBy("size").partitionBy("pool_").rowsBetween(W.unboundedPreceding, -1)
    smaller = counts.groupBy("pool_", "size").agg(F.sum("n").alias("n")).withColumn(
        "smaller", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    among = W.partitionBy("pool_", "size").orderBy("group_").rowsBetween(W.unboundedPreceding, -1)
    goals = targets(counts.groupBy(F.col("pool_").alias("pool")).agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    start = F.conv(F.substring(F.md5(F.concat(F.lit("offset "), "pool_").cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    # Written, as the joins above leave it dealt by source and size, and a hot size must be dealt by its hash groups.
    places = written(counts.withColumn("among", F.coalesce(F.sum("n").over(among), F.lit(0))).join(smaller, ["pool_", "size"]).join(
        goals.withColumnRenamed("pool", "pool_"), "pool_").select(
        "pool_", "size", "group_", (F.col("smaller") + F.col("among")).alias("rank_"), "source_size", "target", start.alias("start_")), "places")

    own = W.partitionBy("pool_", "size", "group_").orderBy("code_", "tie_")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    ranked = ready.withColumn("tie_", F.xxhash64("text")).join(places, ["pool_", "size", "group_"]).withColumn(
        "rank_", F.col("rank_") + F.row_number().over(own))
    crossed = F.floor(F.col("start_") + rate * F.col("rank_")) - F.floor(F.col("start_") + rate * (F.col("rank_") - 1))
    return ranked.withColumn("copies", crossed.cast("long")).withColumn("taken", F.col("copies") * F.col("size")).select(
        *docs.columns, "size", "source_size", "target", "copies", "taken")


SQL = r"""
WITH ready AS (
  SELECT doc_id, coalesce('=' || source, 'null') AS pool, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS code,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT pool, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY pool) - 1) % 3] AS weight
  FROM ready GROUP BY pool),
levels AS (
  SELECT pool, source_size, weight,
         (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER before, 0))
           / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM sources
  WINDOW before AS (ORDER BY CAST(2 * source_size AS DOUBLE) / weight, pool ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
  SELECT pool, source_size, least(2.0::DOUBLE * source_size, max(level) OVER () * weight) AS target,
         CAST(('0x' || substr(md5('offset ' || pool), 1, 8)) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE AS start
  FROM levels),
ranked AS (
  SELECT r.doc_id, r.size, g.source_size, g.target, g.start, row_number() OVER (PARTITION BY r.pool ORDER BY r.size, r.code) AS place,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate
  FROM ready r JOIN goals g USING (pool))
SELECT doc_id, size, source_size, target,
       CAST(floor(start + rate * place) - floor(start + rate * (place - 1)) AS BIGINT) * size AS taken
FROM ranked
"""
