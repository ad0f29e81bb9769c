"""How far the sources of a language diverge in their terms, after identical texts are collapsed.

Equal texts of a language become one row with the number of copies in each source (found by SHA-256), so each different
text is moved and tokenized once. Its terms are added to the counts of every source by its multiplicity. The sum of
differences over all kept terms of two sources is then put together sparsely: a term that one of them lacks has there
the share p0 of a count of 0, so with X(a, b) = sum of |p_a - p0_b| over the terms of a,

    f(a, b) = X(a, b) + X(b, a) + (V - n_a - n_b) * |p0_a - p0_b| + corrections of the terms that both have.

X depends on counts only and is taken from a histogram of counts; corrections are summed by task for the pairs that
occur in a term's sources, so no row is made for a term and a pair.
"""
from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilnote.llm.bytewords import LOWER
from veilnote.llm.common import TEXT_ROWS, written

#: Documents of a language that a kept term is in, at least; terms reported of a source.
LEAST_DOCS, TOP = 30, 50
#: Entries of one task's counters before they are handed on.
HELD = 500_000

#: Every byte but letters and those of characters beyond ASCII becomes a blank; A-Z are lower-cased.
_TO_TERMS = bytes(int(LOWER[b]) if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def collapsed(docs: DataFrame) -> DataFrame:
    """(lang, text, copies) of each different text of a language: copies has (source, n) for each of its sources."""
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source"))).withColumn(
        "digest", F.unhex(F.sha2("text", 256)))
    copies = named.groupBy("lang", "digest", "source").agg(F.count("*").alias("n")).groupBy("lang", "digest").agg(
        F.collect_list(F.struct("source", "n")).alias("copies"))
    return named.groupBy("lang", "digest").agg(F.first("text").alias("text")).join(copies, ["lang", "digest"]).select("lang", "text", "copies")


def term_counts(texts: DataFrame) -> DataFrame:
    """(lang, term, of): for each source that has the term, `of` holds (source, n, docs), its occurrences and documents.

    Each task hands on one row for a term and language, with all its sources, so a term is moved once a task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, within = defaultdict(Counter), defaultdict(Counter)

        def rows() -> Iterator[pa.RecordBatch]:
            by_lang = defaultdict(list)
            for lang, source in terms:
                by_lang[lang].append(source)
            for lang, sources in by_lang.items():
                own = [terms[lang, s] for s in sources]
                found = pa.array([t for c in own for t in c], pa.binary()).dictionary_encode()
                at = found.indices.to_numpy()
                order = np.argsort(at, kind="stable")
                ends = np.searchsorted(at[order], np.arange(len(found.dictionary) + 1)).astype(np.int32)
                names = pa.array(sources, pa.string()).take(pa.array(np.repeat(np.arange(len(own)), [len(c) for c in own])[order]))
                n = np.array([n for c in own for n in c.values()], np.int64)[order]
                docs = np.array([within[lang, s][t] for s, c in zip(sources, own, strict=True) for t in c], np.int64)[order]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * (len(ends) - 1), pa.string()), found.dictionary.cast(pa.string()),
                     *(pa.ListArray.from_arrays(pa.array(ends), x) for x in (names, pa.array(n), pa.array(docs)))], ["lang", "term", "sources", "n", "docs"])
            terms.clear()
            within.clear()

        for batch in batches:
            for lang, text, copies in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                words = text.encode().translate(_TO_TERMS).split()
                if not words:
                    continue
                own = None
                for copy in copies:
                    key, n = (lang, copy["source"]), copy["n"]
                    if n == 1:
                        terms[key].update(words)
                        within[key].update(set(words))
                    else:
                        own = own or Counter(words)
                        for term, times in own.items():
                            terms[key][term] += n * times
                            within[key][term] += n
            if sum(map(len, terms.values())) > HELD:
                yield from rows()
        yield from rows()

    spark = texts.sparkSession
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(size) == "10000":
        spark.conf.set(size, str(TEXT_ROWS))
    found = texts.mapInArrow(count, "lang string, term string, sources array<string>, n array<long>, docs array<long>")
    each = found.repartition("lang", "term").select("lang", "term", F.explode(F.arrays_zip("sources", "n", "docs")).alias("o")).groupBy(
        "lang", "term", "o.sources").agg(F.sum("o.n").alias("n"), F.sum("o.docs").alias("docs"))
    return each.groupBy("lang", "term").agg(F.collect_list(F.struct(F.col("sources").alias("source"), "n", "docs")).alias("of"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """p = 1 + floor(10^9 (count + 5) / (total + 5 terms)), exactly."""
    return F.call_function("div", F.lit(10**9).cast("decimal(10,0)") * (count + 5).cast("decimal(20,0)"),
                           (total + 5 * terms).cast("decimal(20,0)")) + 1


def corrections(terms: DataFrame) -> DataFrame:
    """(lang, a, b, shared) for each two sources that share terms(lang, term, source, p, p0)."""

    def correct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: dict[tuple[str, str], int] = {}
        keys, values, held = [], [], 0
        for batch in batches:
            for lang, sources, p, p0 in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                at, p, p0 = np.array([index.setdefault((lang, s), len(index)) for s in sources]), np.array(p), np.array(p0)
                both = np.abs(p[:, None] - p) - np.abs(p[:, None] - p0) - np.abs(p0[:, None] - p) + np.abs(p0[:, None] - p0)
                keys.append(((at[:, None] << 32) | at).ravel())
                values.append(both.ravel())
                held += both.size
                if held > HELD:
                    keys, values = summed(keys, values)
                    if len(keys[0]) > HELD // 2:
                        yield rows(index, keys[0], values[0])
                        keys, values = [], []
                    held = sum(map(len, keys))
        if keys:
            keys, values = summed(keys, values)
            yield rows(index, keys[0], values[0])

    def summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        key, value = np.concatenate(keys), np.concatenate(values)
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        return [key[first]], [np.add.reduceat(value, first)]

    def rows(index: dict[tuple[str, str], int], key: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        a, b = key >> 32, key & 0xFFFFFFFF
        apart = a != b
        names = list(index)
        lang, source = (pa.array([x[k] for x in names], pa.string()) for k in range(2))
        a, b = pa.array(a[apart]), pa.array(b[apart])
        return pa.RecordBatch.from_arrays([lang.take(a), source.take(a), source.take(b), pa.array(value[apart])], ["lang", "a", "b", "shared"])

    held = F.collect_list(F.struct("source", "p", "p0")).alias("s")
    lists = terms.groupBy("lang", "term").agg(held).where("size(s) > 1").select("lang", "s.source", "s.p", "s.p0")
    return lists.mapInArrow(correct, "lang string, a string, b string, shared long").groupBy("lang", "a", "b").agg(F.sum("shared").alias("shared"))


def audit(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank) of docs(text, lang, source).

    Part `pair`: the other sources of the language by sum of differences of the shares p of all kept terms, all ranks.
    Part `term`: the terms that a source has more of than its language, by that difference, ranks to TOP.

    Null text, lang and source are read as ''; a source without terms has p0 everywhere and takes part in pairs; a
    language without kept terms has values 0; a language of one source has no pairs. Ties are ordered by item, in UTF-8
    order. Repeated rows count as often as they occur, no table rows give no rows, other columns are ignored.
    """
    add = lambda name: F.aggregate(F.col("of")[name], F.lit(0).cast("long"), lambda x, y: x + y)
    kept = written(term_counts(collapsed(docs)).where(add("docs") >= LEAST_DOCS).select("lang", "term", add("n").alias("total"), "of"), "kept terms")

    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    counts = kept.select("lang", "term", "total", F.explode("of").alias("o")).select("lang", "term", "total", "o.source", F.col("o.n").alias("n"))
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("source_n"), F.count("*").alias("own"))
    nothing = F.lit(0).cast("long")
    groups = written(
        docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
        .join(sums, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["source_n", "own", "v", "lang_n"])
        .withColumn("p0", F.when(F.col("v") > 0, share(nothing, F.col("source_n"), F.col("v"))).otherwise(nothing)), "groups")

    known = written(counts.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("source_n"), F.col("v"))).withColumn(
        "q", share(F.col("total"), F.col("lang_n"), F.col("v"))).select("lang", "source", "term", "p", "p0", "q"), "shares")

    histogram = known.groupBy("lang", "source", "p").agg(F.count("*").alias("m"))
    others = groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("p0_b"))
    apart = histogram.withColumnRenamed("source", "a").join(others, "lang").where("a <> b").groupBy("lang", "a", "b").agg(
        F.sum(F.col("m") * F.abs(F.col("p") - F.col("p0_b"))).alias("x"))
    one, other = (groups.select("lang", F.col("source").alias(x), F.col("p0").alias(f"p0_{x}"), F.col("own").alias(f"own_{x}"), *more)
                  for x, more in (("a", ["v"]), ("b", [])))
    value = (F.coalesce("x", nothing) + F.coalesce("y", nothing) + F.coalesce("shared", nothing)
             + (F.col("v") - F.col("own_a") - F.col("own_b")) * F.abs(F.col("p0_a") - F.col("p0_b")))
    pairs = one.join(other, "lang").where("a <> b").join(apart, ["lang", "a", "b"], "left").join(
        apart.select("lang", F.col("a").alias("b"), F.col("b").alias("a"), F.col("x").alias("y")), ["lang", "a", "b"], "left").join(
        corrections(known), ["lang", "a", "b"], "left").select(
        "lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), value.alias("value"))
    more = known.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    return pairs.select("*", rank).unionByName(more.select("*", rank).where(F.col("rank") <= TOP))


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
occurring AS (SELECT row, lang, source, unnest(terms) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS total FROM occurring GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(total) AS lang_n FROM kept GROUP BY lang),
groups AS (
  SELECT lang, source, coalesce(v, 0) AS v, coalesce(lang_n, 0) AS lang_n
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN langs USING (lang)),
found AS (SELECT lang, source, term, count(*) AS n FROM occurring JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT lang, source, sum(n) AS source_n FROM found GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(f.n, 0) + 5)) // (coalesce(s.source_n, 0) + 5 * g.v)::HUGEINT AS p,
         1 + (1000000000::HUGEINT * (k.total + 5)) // (g.lang_n + 5 * g.v)::HUGEINT AS q
  FROM groups g JOIN kept k USING (lang) LEFT JOIN found f USING (lang, source, term) LEFT JOIN sums s USING (lang, source)),
apart AS (
  SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
  FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
parts AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(a.value, 0) AS BIGINT) AS value
  FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN apart a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM shares WHERE n > 0 AND p > q)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts)
WHERE part = 'pair' OR rank <= 50
"""
