"""Benchmark decontamination: documents against a broadcast set of normalised test n-grams."""
from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilnote.llm.bytewords import LETTERS, LOWER, hash_grams, hash_words, slices, utf8, words
from veilnote.llm.common import map_batches, written

#: Bytes of benchmark text that one pass over the documents takes: what is broadcast is a few times as large. A larger
#: benchmark is matched in several passes, so nothing that is broadcast grows with the data.
BLOCK_BYTES = 1 << 20


def item_words(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, list[bytes]]]:
    """(row, word hashes, words) of each text."""
    data, offsets = utf8(texts)
    low = LOWER[data]
    starts, ends, doc = words(low, offsets, LETTERS)
    hashes, view = hash_words(low, starts, ends), low.tobytes()
    for row in range(len(offsets) - 1):
        lo, hi = np.searchsorted(doc, [row, row + 1])
        yield row, hashes[lo:hi], [view[a:b] for a, b in zip(starts[lo:hi], ends[lo:hi], strict=True)]


def windows_of(items: list[tuple[str, str]], size: int) -> dict[int, dict[int, list[tuple[bytes, list[str]]]]]:
    """By number of words and hash: the words, joined, of each window and the items that have it."""
    found: dict[int, dict[int, dict[bytes, set[str]]]] = defaultdict(lambda: defaultdict(lambda: defaultdict(set)))
    for row, hashes, own in item_words(pa.array([text for _, text in items], pa.string())):
        n = min(size, len(own))
        if n:
            first, grams = hash_grams(hashes, np.zeros(len(own), np.int64), n)
            for at, gram in zip(first.tolist(), grams.tolist(), strict=True):
                found[n][gram][b" ".join(own[at:at + n])].add(items[row][0])
    return {n: {g: [(w, sorted(i)) for w, i in x.items()] for g, x in grams.items()} for n, grams in found.items()}


def benchmark_blocks(items: DataFrame) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of about BLOCK_BYTES; an item is in one block."""
    sized = written(items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
                    .where("item_id is not null and text is not null"), "items")
    total = sized.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = total // BLOCK_BYTES + 1
    for k in range(blocks):
        rows = sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        if rows:
            yield [(r.item_id, r.text) for r in rows]


def broadcast_windows(spark: SparkSession, items: list[tuple[str, str]], size: int) -> Broadcast:
    """By number of words: the sorted hashes of the windows, and the windows themselves."""
    windows = windows_of(items, size)
    return spark.sparkContext.broadcast({n: (np.sort(np.fromiter(grams, np.uint64, len(grams))), grams) for n, grams in windows.items()})


def matches(texts: pa.Array, windows: dict[int, tuple[np.ndarray, dict]]) -> tuple[np.ndarray, list[list[dict[str, int]]], list[list[str]]]:
    """Number of words of each text, its hit runs of words [first, stop) with their bytes [from, to), and the items found."""
    data, offsets = utf8(texts)
    count = np.zeros(len(texts), np.int64)
    spans: list[list[dict[str, int]]] = [[] for _ in range(len(texts))]
    names: list[list[str]] = [[] for _ in range(len(texts))]
    for lo, hi in slices(offsets):
        low = LOWER[data[offsets[lo]:offsets[hi]]]
        own = offsets[lo:hi + 1] - offsets[lo]
        starts, ends, doc = words(low, own, LETTERS)
        count[lo:hi] = np.bincount(doc, minlength=hi - lo)
        hashes = hash_words(low, starts, ends)
        hit = np.zeros(len(starts) + 1, np.int64)
        items_of: dict[int, set[str]] = defaultdict(set)
        for n, (known, grams) in windows.items():
            first, found = hash_grams(hashes, doc, n)
            at = np.minimum(np.searchsorted(known, found), len(known) - 1)
            for k in np.flatnonzero(known[at] == found).tolist():
                w = int(first[k])
                text = b" ".join(low[a:b].tobytes() for a, b in zip(starts[w:w + n], ends[w:w + n], strict=True))
                for words_, ids in grams[int(found[k])]:
                    if words_ == text:
                        hit[w] += 1
                        hit[w + n] -= 1
                        items_of[int(doc[w])].update(ids)
        covered = np.cumsum(hit)[:-1] > 0
        parts = doc[1:] != doc[:-1]
        first = np.flatnonzero(covered & np.append(True, ~covered[:-1] | parts)[:len(covered)])
        last = np.flatnonzero(covered & np.append(~covered[1:] | parts, True)[:len(covered)])
        base = np.searchsorted(doc, doc[first])
        for a, b, d, zero in zip(first.tolist(), last.tolist(), doc[first].tolist(), base.tolist(), strict=True):
            spans[lo + d].append({"first": a - zero, "stop": b + 1 - zero, "from": int(starts[a] - own[d]), "to": int(ends[b] - own[d])})
        for d, ids in items_of.items():
            names[lo + d] = sorted(ids)
    return count, spans, names


def scan(docs: DataFrame, items: list[tuple[str, str]], size: int) -> DataFrame:
    """(id, key, doc_id, n_words, spans, items) of docs(id, key, doc_id, text)."""
    windows = broadcast_windows(docs.sparkSession, items, size)
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("first", "stop", "from", "to")]))

    def match(batch: pa.RecordBatch) -> pa.RecordBatch:
        count, spans, names = matches(batch.column(3), windows.value)
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(count), pa.array(spans, kind), pa.array(names, pa.list_(pa.string()))],
            ["id", "key", "doc_id", "n_words", "spans", "items"])

    return map_batches(docs.select("id", "key", "doc_id", "text"), match,
                       "id long, key long, doc_id long, n_words long, spans array<struct<first:long,stop:long,from:long,to:long>>, items array<string>")


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, spans) of each row of docs(doc_id, text).

    A-Z are lower-cased; words are runs of digits, letters and characters beyond ASCII. `size` consecutive words of an
    item are a window; an item of fewer words is one window, one without words none. Each document word in any
    occurrence of a window is hit; hashes only propose, the words themselves are compared. spans are the hit runs with
    their bytes, which may be cut out of the text. Null texts have no words; items without an id or a text are left
    out, equal ids count once; null and repeated document ids are rows like any other; extra columns are ignored.
    """
    # A row is known by its id and a hash of its text, so only texts of one id (or without id) could ever be confused.
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.xxhash64("doc_id", "text").alias("key"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = None
    for k, block in enumerate(benchmark_blocks(items)):
        now = scan(keyed, block, size)
        if k == 0:
            found = now
            continue
        # Further blocks: only documents with hits travel; spans and items are united.
        now = written(now.where("size(spans) > 0").select("id", "key", F.col("spans").alias("more"), F.col("items").alias("names")).dropDuplicates(["id", "key"]), "hits")
        found = written(found, "scanned").join(now, ["id", "key"], "left").select(
            "id", "key", "doc_id", "n_words", F.concat("spans", F.coalesce("more", F.expr("slice(spans, 1, 0)"))).alias("spans"),
            F.array_sort(F.array_union("items", F.coalesce("names", F.expr("slice(items, 1, 0)")))).alias("items"))
    if found is None:
        found = scan(keyed, [], size)
    return finished(found)


def uncontaminated(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """The rows of docs without a hit word, as they are. A benchmark of several blocks takes several passes, and each
    pass works on the rows that the one before it kept."""
    for block in benchmark_blocks(items):
        windows = broadcast_windows(docs.sparkSession, block, size)
        at = docs.columns.index("text")

        def keep(batch: pa.RecordBatch, shared: Broadcast = windows, at: int = at) -> pa.RecordBatch:
            _, spans, _ = matches(batch.column(at), shared.value)
            return batch.filter(pa.array([not s for s in spans]))

        docs = map_batches(docs, keep, docs.schema)
    return docs


def finished(found: DataFrame) -> DataFrame:
    """Counts and digests of what the scan found. Spans of one block don't overlap; those of several may."""
    ordered = F.array_sort("spans")
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("reach"))
    hit = F.aggregate(ordered, start, lambda s, x: F.struct(
        (s["total"] + F.greatest(F.lit(0), x["stop"] - F.greatest(s["reach"], x["first"]))).alias("total"),
        F.greatest(s["reach"], x["stop"]).alias("reach")))["total"]
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
        "items", ordered.alias("spans"))
