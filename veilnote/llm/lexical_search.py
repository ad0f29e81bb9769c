"""Ranked lexical search, term at a time with limited accumulators.

The terms of an item are taken rarest first, in waves by document frequency. A wave adds to the accumulators (partial
scores by item and document) of its items and makes new ones. After a wave, R is the most that the item's remaining terms
can give any document (each term's largest impact in the whole table) and P its k-th best partial score. If R < P, no
document without accumulator can come among the k best: the item makes no more of them, and the remaining, most frequent
terms only update the survivors exactly, along the documents that survive. An accumulator whose partial score and R stay
below P is dropped, since its final score can't reach the k-th best; so every score that is returned is exact.
"""
from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilnote.llm.bytewords import LETTERS, LOWER
from veilnote.llm.common import Scratch, map_batches, written

#: Most of all documents that a term of each wave is in, rarest first; the last wave has the rest.
WAVES = (1 / 512, 1 / 64, 1 / 8)
#: Slots of the filter that keeps other terms out of the postings, whatever the number of items' terms.
SLOTS = 1 << 20
#: Terms of items that are broadcast, at most, and their bytes; if more, they are joined by shuffling.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20

#: Every byte but digits, letters and those of characters beyond ASCII becomes a blank; A-Z are lower-cased.
_TO_TERMS = bytes(int(LOWER[b]) if LETTERS[LOWER[b]] else 32 for b in range(256))


def counted(frame: DataFrame, ids: str, slots: np.ndarray | None = None) -> DataFrame:
    """(row, id, n, terms, times): number of terms of a text, and its different terms with their occurrences, only those
    whose slot is taken if slots are given."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, terms, times = [], [], []
        for text in batch.column(2).to_pylist():
            words = (text or "").encode().translate(_TO_TERMS).split()
            own = Counter(words)
            if slots is not None:
                own = {t: c for t, c in own.items() if slots[zlib.crc32(t) % SLOTS]}
            sizes.append(len(words))
            terms.append([t.decode(errors="replace") for t in own])
            times.append(list(own.values()))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64()))],
            ["row", "id", "n", "terms", "times"])

    kind = frame.schema[ids].dataType.simpleString()
    return map_batches(frame.select(F.monotonically_increasing_id().alias("row"), F.col(ids).alias("id"), F.col("text").cast("string").alias("text")),
                       count, f"row long, id {kind}, n long, terms array<string>, times array<long>")


def exploded(counts: DataFrame, *columns: str) -> DataFrame:
    """A row for each term of a text, with its occurrences `tf`."""
    pair = F.explode(F.arrays_zip("terms", "times")).alias("pair")
    return counts.select(*columns, pair).select(*columns, F.col("pair.terms").alias("term"), F.col("pair.times").alias("tf"))


def impact(tf: Column, n: Column, docs: int, length: int) -> Column:
    """What an occurrence count gives in a document of n terms, before the term's weight."""
    m = F.call_function("div", F.lit(25) * n * F.lit(docs), F.lit(max(length, 1))) + 75
    return F.call_function("div", F.lit(10**9) * tf, F.lit(1000) * tf + F.lit(12) * m)


def best(scores: DataFrame, k: int, *ties: str) -> DataFrame:
    """The k rows of each item with the highest scores and their rank; Spark limits groups before it shuffles them."""
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), *ties))
    return scores.withColumn("rank", rank).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k best documents, of docs(doc_id, text), for each row of items(item_id, text).

    Equal scores are ordered by doc_id (null first); documents without score above 0 are left out. Null and empty texts
    have no terms: such an item has no rows, such a document isn't counted. A document row that repeats an id is a document
    of its own, an item row that repeats one an item of its own. Without documents or items there are no rows. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    asked = scratch.put(counted(items, "item_id"), "asked")
    asked_terms = exploded(asked, "row").withColumnRenamed("row", "item")
    slots = np.zeros(SLOTS, bool)
    taken = asked_terms.select((F.crc32(F.col("term").cast("binary")) % SLOTS).alias("slot")).distinct().collect()  # SLOTS rows at most
    slots[[r.slot for r in taken]] = True
    held = scratch.put(counted(docs, "doc_id", slots), "postings")
    count, length = (x or 0 for x in held.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first())

    given = impact(F.col("tf"), F.col("n"), count, length).alias("impact")
    postings = exploded(held, "row", "id", "n").select("row", "id", "term", given)
    stats = postings.groupBy("term").agg(F.count("*").alias("df"), F.max("impact").alias("most"))
    weight = F.floor(1000 * F.log((2 * F.lit(count) + 2).cast("double") / (2 * F.col("df") + 1))).cast("long")
    wave = sum((F.when(F.col("df") > share * count, 1).otherwise(0) for share in WAVES), F.lit(0))
    terms = scratch.put(asked_terms.join(stats, "term").select(
        "item", "term", (weight * F.col("tf")).alias("weight"), (weight * F.col("tf") * F.col("most")).alias("bound"), wave.alias("wave")), "terms")
    rows, size = terms.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term") + 32), F.lit(0))).first()
    small = F.broadcast if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else lambda frame: frame

    open_ = scratch.put(terms.groupBy("item").agg(F.lit(0).cast("long").alias("kth")), "open")
    scores, closed = spark.createDataFrame([], "item long, row long, id " + held.schema["id"].dataType.simpleString() + ", score long"), []
    for now in range(len(WAVES) + 1):
        left = terms.where(F.col("wave") > now).groupBy("item").agg(F.sum("bound").alias("rest"))
        making = terms.where(F.col("wave") == now).join(small(open_.select("item")), "item", "left_semi")
        added = postings.join(small(making.select("item", "term", "weight")), "term").select(
            "item", "row", "id", (F.col("weight") * F.col("impact")).alias("score"))
        partial = scratch.put(scores.unionByName(added).groupBy("item", "row", "id").agg(F.sum("score").alias("score")), f"partial {now}")
        kth = best(partial, k).groupBy("item").agg(F.min("score").alias("kth"), F.count("*").alias("have")).where(F.col("have") == k).select("item", "kth")
        state = scratch.put(open_.select("item").join(kth, "item", "left").join(left, "item", "left").na.fill(0, ["kth", "rest"]), "state")
        reach = partial.join(small(state), "item").where(F.col("score") + F.col("rest") >= F.col("kth"))
        closes = (F.col("rest") < F.col("kth")) | (F.col("rest") == 0)
        closed.append(scratch.put(reach.where(closes).select("item", "row", "id", "score", F.lit(now).alias("after")), f"closed {now}"))
        scores = scratch.put(reach.where(~closes).select("item", "row", "id", "score"), "scores")
        open_ = scratch.put(state.where(~closes), "open")
        scratch.drop(f"partial {now}")
        if open_.isEmpty():
            break
    survivors = closed[0]
    for more in closed[1:]:
        survivors = survivors.unionByName(more)
    later = terms.where("wave > 0").select("item", "term", "weight", "wave")
    found = survivors.select("item", "row", "after").join(held.select("row", "n", "terms", "times"), "row")
    updates = exploded(found, "item", "row", "after", "n").join(small(later), ["item", "term"]).where("wave > after").select(
        "item", "row", (F.col("weight") * impact(F.col("tf"), F.col("n"), count, length)).alias("more")).groupBy("item", "row").agg(F.sum("more").alias("more"))
    final = survivors.join(updates, ["item", "row"], "left").select(
        "item", "id", "row", (F.col("score") + F.coalesce("more", F.lit(0).cast("long"))).alias("score")).where("score > 0")
    names = asked.select(F.col("row").alias("item"), F.col("id").alias("item_id"))
    out = written(best(final, k, "id", "row").join(names, "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score"), "found")
    scratch.drop(*list(scratch.paths))
    return out


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
items AS (
  SELECT row_number() OVER () AS item, item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM benchmark),
totals AS (SELECT count(*) AS n, CAST(sum(len(terms)) AS BIGINT) AS l FROM docs WHERE len(terms) > 0),
postings AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs) GROUP BY row, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM postings, totals GROUP BY term, n),
sizes AS (SELECT row, doc_id, 100 - 25 + ((25 * len(terms)::BIGINT * n) // l) AS m FROM docs, totals),
asked AS (
  SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(terms) AS term FROM items) GROUP BY ALL),
scores AS (
  SELECT item, any_value(item_id) AS item_id, p.row, any_value(doc_id) AS doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN postings p USING (term) JOIN weights USING (term) JOIN sizes s ON s.row = p.row GROUP BY item, p.row)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST, row) AS INTEGER) AS rank
  FROM scores WHERE score > 0)
WHERE rank <= 20
"""
