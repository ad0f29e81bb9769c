"""Removal of byte strings that occur more than once in a corpus, by suffix arrays of shards.

No task could sort the suffixes of a whole corpus, so equal strings are first brought together:

1. The windows of `size` bytes that start in a document are cut into runs with the same anchor, the smallest hash of
   GRAM bytes in the window. Equal windows have equal anchors. Runs with an anchor that occurs once in the corpus are
   done, if they hold it once too: none of their windows is repeated.
2. Runs of the same bytes are counted with map-side combine, and one of each goes on as a piece. Where all runs with
   an anchor are copies of one piece, all of its windows are repeated and nothing needs sorting. Other anchors are dealt to
   shards of about SHARD bytes; each shard is sorted by induced sorting (suffix_sort.py) and its permuted common
   prefixes tell which windows occur twice. All windows of all documents are judged, none from a sample.
3. An anchor whose different pieces have more than HOT bytes (a passage that very many documents hold between
   different neighbours) would make a shard too large. Its windows are counted by a 128-bit hash with map-side combine.
4. What was found is mapped back to every occurrence, and each document drops the covered bytes.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilnote.llm.bytewords import mix, slices, utf8
from veilnote.llm.common import map_batches, new_path, remove, written
from veilnote.llm.suffix_sort import repeated_starts

#: Bytes of an anchor, bytes of a shard, bytes of pieces of one anchor that a shard takes (at least those of the longest
#: piece), bytes worked on at a time.
GRAM, SHARD, HOT, PIECE = 32, 2 << 20, 3 << 20, 1 << 21

_TURN = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on."""
    n = max(0, len(data) - GRAM + 1)
    eights = np.ndarray((max(0, len(data) - 7),), np.dtype("<u8"), np.ascontiguousarray(data), 0, (1,)) if len(data) > 7 else np.zeros(0, np.uint64)
    out = np.full(n, GRAM, np.uint64)
    for k in range(0, GRAM, 8):
        out = mix(out ^ eights[k:k + n])
    return out


def smallest_ahead(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` values in a row, by running minima from both ends of blocks."""
    n = len(values) - width + 1
    blocks = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:len(values)] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def window_runs(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Anchor, hash of the bytes, document, first window, number of windows of each run; whether it holds its anchor
    more than once."""
    grams = gram_hashes(data)
    width = size - GRAM + 1
    if len(grams) < width:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, bool))
    anchor = smallest_ahead(grams, width)
    n = len(anchor)
    doc = np.searchsorted(offsets, np.arange(n), "right") - 1
    fits = np.arange(n) + size <= offsets[doc + 1]
    new = fits.copy()
    new[1:] &= ~fits[:-1] | (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    stop = np.append(first[1:], n)
    bad = np.append(np.flatnonzero(~fits), n)
    stop = np.minimum(stop, bad[np.searchsorted(bad, first)])
    # Places of anchors: no window that covers them has a smaller hash, and some window has theirs.
    around = np.zeros(n + 2 * (width - 1), np.uint64)
    around[width - 1:width - 1 + n] = anchor
    places = np.flatnonzero(grams == ~smallest_ahead(~around, width))
    lo, hi = np.searchsorted(places, first), np.searchsorted(places, stop + width - 1)
    run = np.repeat(np.arange(len(first)), hi - lo)
    near = places[np.arange(len(run)) - np.repeat(np.cumsum(hi - lo) - hi, hi - lo)]
    twice = np.bincount(run[grams[near] == anchor[first][run]], minlength=len(first)) > 1
    inverse = np.uint64(pow(int(_TURN[0]), -1, 1 << 64))
    sums = np.append(np.uint64(0), np.cumsum(grams * _powers(len(grams), _TURN[0])))
    print_ = (sums[stop + width - 1] - sums[first]) * _powers(n, inverse)[first]
    return anchor[first], mix(print_ + (stop - first).astype(np.uint64)), doc[first], first - offsets[doc[first]], stop - first, twice


def pieces_of(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of documents as (first document, byte of it at which the bytes start, bytes, offsets). A document beyond
    PIECE bytes comes in parts that overlap, so that each window is in one part."""
    for lo, hi in slices(offsets, PIECE):
        part = data[offsets[lo]:offsets[hi]]
        if len(part) <= PIECE:
            yield lo, 0, part, offsets[lo:hi + 1] - offsets[lo]
        else:
            for at in range(0, max(1, len(part) - size + 1), PIECE):
                piece = part[at:at + PIECE + size - 1]
                yield lo, at, piece, np.array([0, len(piece)])


def runs(docs: DataFrame, size: int) -> DataFrame:
    """(anchor, print, id, key, start, windows, twice) of docs(id, key, text)."""

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, keys, found = np.asarray(batch.column(0)), np.asarray(batch.column(1)), [[] for _ in range(7)]
        data, offsets = utf8(batch.column(2))
        for lo, at, part, own in pieces_of(data, offsets, size):
            anchor, print_, doc, start, windows, twice = window_runs(part, own, size)
            for out, x in zip(found, (anchor.view(np.int64), print_.view(np.int64), ids[doc + lo], keys[doc + lo], start + at, windows, twice), strict=True):
                out.append(x)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in found],
                                          ["anchor", "print", "id", "key", "start", "windows", "twice"])

    return map_batches(docs, find, "anchor long, print long, id long, key long, start long, windows long, twice boolean")


def cut(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The bytes of the wanted runs (id, key, anchor, print, copies, hot, start, windows)."""
    lists = wanted.groupBy("id", "key").agg(F.collect_list(F.struct("anchor", "print", "copies", "hot", "start", "windows")).alias("runs"))

    def take(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = utf8(batch.column(0))
        owner = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(batch.column(1).offsets)))
        fields = {f.name: x for f, x in zip(batch.column(1).type.value_type, batch.column(1).flatten().flatten(), strict=True)}
        start = np.asarray(fields["start"]) + offsets[owner]
        stop = start + np.asarray(fields["windows"]) + size - 1
        view = memoryview(np.ascontiguousarray(data))
        return pa.RecordBatch.from_arrays(
            [*(fields[c] for c in ("anchor", "print", "copies", "hot")),
             pa.array([bytes(view[a:b]) for a, b in zip(start.tolist(), stop.tolist(), strict=True)], pa.binary())],
            ["anchor", "print", "copies", "hot", "bytes"])

    return map_batches(docs.join(lists, ["id", "key"]).select("text", "runs"), take,
                       "anchor long, print long, copies long, hot boolean, bytes binary")


def as_ranges(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive places."""
    cuts = np.flatnonzero(np.diff(places) > 1)
    return places[np.append(0, cuts + 1)], places[np.append(cuts, len(places) - 1)]


def sorted_shards(pieces: DataFrame, shards: int, size: int) -> DataFrame:
    """(anchor, print, first, last): windows of pieces that occur twice, from the suffix array of each shard."""

    def sort(shard: pd.DataFrame) -> pd.DataFrame:
        found = repeated_starts([np.frombuffer(x, np.uint8) for x in shard["bytes"]], size)
        out = []
        for anchor, print_, copies, piece, places in zip(shard["anchor"], shard["print"], shard["copies"], shard["bytes"], found, strict=True):
            if copies > 1:
                out.append((anchor, print_, 0, len(piece) - size))
            elif len(places):
                out += [(anchor, print_, a, b) for a, b in zip(*as_ranges(places), strict=True)]
        return pd.DataFrame(out, columns=["anchor", "print", "first", "last"], dtype="int64")

    return pieces.withColumn("shard", F.pmod("anchor", F.lit(shards))).groupBy("shard").applyInPandas(
        sort, "anchor long, print long, first long, last long")


def counted_windows(pieces: DataFrame, size: int) -> DataFrame:
    """The same for the pieces of hot anchors, by counting windows."""

    def windows(batch: pa.RecordBatch) -> pa.RecordBatch:
        anchor, print_, copies = (np.asarray(batch.column(k)) for k in range(3))
        out: list[list[np.ndarray]] = [[] for _ in range(6)]
        for row, piece in enumerate(batch.column(3)):
            grams = gram_hashes(np.frombuffer(piece.as_py(), np.uint8))
            n, width = len(grams) - (size - GRAM), size - GRAM + 1
            at = np.arange(n)
            hashes = []
            for turn in _TURN:
                sums = np.append(np.uint64(0), np.cumsum(grams * _powers(len(grams), turn)))
                hashes.append(mix((sums[at + width] - sums[at]) * _powers(n, np.uint64(pow(int(turn), -1, 1 << 64)))).view(np.int64))
            for column, x in zip(out, (*hashes, *(np.full(n, c[row]) for c in (anchor, print_, copies)), at), strict=True):
                column.append(x)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["w1", "w2", "anchor", "print", "copies", "first"])

    rows = map_batches(pieces.select("anchor", "print", "copies", "bytes"), windows,
                       "w1 long, w2 long, anchor long, print long, copies long, first long")
    twice = rows.groupBy("w1", "w2").agg(F.sum("copies").alias("n")).where("n > 1")
    return rows.join(twice, ["w1", "w2"], "left_semi").select("anchor", "print", "first", F.col("first").alias("last"))


def remove_repeats(docs: DataFrame, size: int = 200) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of each row of docs(doc_id, text).

    Removes each byte covered by a string of `size` bytes (at least GRAM) that starts anywhere else too, in the same
    document or another row; matches don't cross documents, and all is judged on the input. kept holds the remaining
    bytes. Null and empty texts have no bytes; null and repeated ids are rows like any other; extra columns are ignored.
    """
    spark = docs.sparkSession
    # A row is known by its id and a hash of its text, so only texts of one id (or without id) could ever be confused.
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.xxhash64("doc_id", "text").alias("key"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    path = new_path(spark, "runs")
    runs(keyed.select("id", "key", "text"), size).write.parquet(path)
    every = spark.read.parquet(path)
    again = every.groupBy("anchor").agg(F.count("*").alias("n"), F.max("twice").alias("twice")).where(
        "n > 1 or twice").select("anchor")
    places = written(every.drop("twice").join(again, "anchor"), "places")
    remove(spark, path)

    one = F.min(F.struct("id", "key", "start", "windows")).alias("one")
    distinct = written(places.groupBy("anchor", "print").agg(F.count("*").alias("copies"), one).select("anchor", "print", "copies", "one.*"), "pieces")
    of_anchor = distinct.groupBy("anchor").agg(F.count("*").alias("n"), F.sum(F.col("windows") + size).alias("size"))
    marked = written(distinct.join(of_anchor, "anchor").withColumn("alone", F.expr("n = 1 and copies > 1")).withColumn(
        "hot", ~F.col("alone") & (F.col("size") > HOT)).drop("n", "size"), "marked")
    wanted, alone = marked.where("not alone"), marked.where("alone")
    total = wanted.agg(F.coalesce(F.sum(F.col("windows") + size), F.lit(0))).first()[0]
    pieces = written(cut(keyed.select("id", "key", "text"), wanted, size), "bytes")
    found = sorted_shards(pieces.where("not hot"), total // SHARD + 1, size)
    if not wanted.where("hot").isEmpty():
        found = found.union(counted_windows(pieces.where("hot"), size))
    found = found.union(alone.select("anchor", "print", F.lit(0).cast("long").alias("first"), (F.col("windows") - 1).alias("last")))
    spans = places.join(written(found, "found"), ["anchor", "print"]).groupBy("id", "key").agg(
        F.collect_list(F.struct((F.col("start") + F.col("first")).alias("first"), (F.col("start") + F.col("last") + size).alias("stop"))).alias("spans"))

    def drop(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = utf8(batch.column(1))
        lists = batch.column(2)
        ends = np.asarray(lists.offsets)
        first, stop = (np.asarray(x) for x in lists.flatten().flatten())
        rows: list[tuple[int, int, int, str, bytes]] = []
        ends = ends - ends[0]
        for k in range(batch.num_rows):
            text = data[offsets[k]:offsets[k + 1]]
            gone = np.zeros(len(text) + 1, np.int32)
            if lists[k].is_valid:
                np.add.at(gone, first[ends[k]:ends[k + 1]], 1)
                np.add.at(gone, stop[ends[k]:ends[k + 1]], -1)
            gone = np.cumsum(gone)[:-1] > 0
            kept = text[~gone].tobytes()
            begins = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
            rows.append((len(text), int(gone.sum()), begins, hashlib.sha256(kept).hexdigest(), kept))
        n_bytes, removed, n_spans, digest, kept = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()),
             pa.array(digest), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return map_batches(keyed.join(spans, ["id", "key"], "left").select("doc_id", "text", "spans"), drop,
                       "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
