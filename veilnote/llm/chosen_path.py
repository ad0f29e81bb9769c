"""MinHash near-duplicates by a chosen-path set similarity join.

Each distinct shingle set gets minwise tokens, one for each of TOKENS permutations. A tree branches all sets at once: at
a node one position is drawn, a second one in a quarter of the nodes, so 1.25 = 1 / 0.8 on average, and the sets go to a
child for each drawn position and token. A pair of similarity s meets in s of the drawn children. Unlike sets part at
once. Nodes of few sets are compared exhaustively, larger ones branch on. Independent trees are repeated to reach the
recall. By the branching process of a pair's common nodes, the chance that TREES trees all miss a pair of similarity 0.8
is 2e-7 at depth two, 6e-5 two narrow levels below that, 3e-4 after four and 9e-4 after eight; for 0.85 it stays below
1e-6. A set is only lost if all its links are.

Links are found in two passes, so that a group of n near copies needs some n comparisons, not n * n. The first compares
every set with two leaders of each of its nodes, the smallest id and one drawn by hash. The second looks only at nodes
that still hold several components: pairs within one component need no comparison, as only the components are returned.
A large one that is mostly one component, or any of bounded size below the first narrow level, is finished at once, on full sets: its sets are dealt over parts
of bounded size, the strays go to each of them, and a part's task counts common shingles by an index of its own sets. It
returns one link for a stray and a component, so neither rows nor confirmations are made for the pairs of a large group.
Below BRANCHING levels the other large ones have a child for each tuple of tokens at NARROW positions, of DRAWS independent
draws of positions, so that a node of many sets that are almost alike comes down to LEAF in few levels and a pair of
similarity 0.8 still meets in 3 * 0.8^4 = 1.23 children. Every link is confirmed on the full sets.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilnote.llm.common import Scratch, map_batches, written
from veilnote.llm.components import components
from veilnote.llm.shingles import each_set, shingle_sets

#: Minwise tokens of a set, independent trees, sets of a node that is compared exhaustively by pairs, levels with 1.25
#: children, and below them positions that are drawn at once and draws of a node.
TOKENS, TREES, LEAF, BRANCHING, NARROW, DRAWS = 128, 12, 32, 2, 4, 3
#: Shingles of all strays of a node that is finished at once, and of the sets of each of its parts (a longer set is a part's only one).
STRAYS, PART = 1 << 20, 1 << 20
#: Rows that are broadcast, at most, to leave documents in no pair where they are.
SLOTS = 1 << 20
#: Pairs with fewer equal tokens aren't confirmed: a pair of similarity 0.8 has fewer with a chance of 8e-9.
LEAST_EQUAL = 75

_seeds = np.random.default_rng(20250115)
_FLIP = _seeds.integers(0, 2**63, TOKENS, dtype=np.uint64)
_TURN = _seeds.integers(0, 2**63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, n_shingles, fp1, fp2, tokens, sketch): size, 128-bit fingerprint and minwise tokens of each text's set;
    sketch has the lowest byte of each token, eight in a number."""

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = batch.num_rows
        sizes, prints = np.zeros(rows, np.int64), np.zeros((2, rows), np.uint64)
        tokens = np.zeros((rows, TOKENS), np.int32)
        for lo, hi, owner, grams in shingle_sets(batch.column(1), n):
            sizes[lo:hi] = np.bincount(owner, minlength=hi - lo)
            filled = np.flatnonzero(sizes[lo:hi]) + lo
            if not len(filled):
                continue
            at = np.searchsorted(owner, filled - lo)
            prints[0, filled] = np.add.reduceat(grams, at)
            prints[1, filled] = np.add.reduceat((grams ^ (grams >> np.uint64(31))) * _TURN[0], at)
            for k in range(TOKENS):
                least = np.minimum.reduceat((grams ^ _FLIP[k]) * _TURN[k], at)
                tokens[filled, k] = (least >> np.uint64(32)).astype(np.uint32).view(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * TOKENS), pa.array(tokens.ravel()))
        low = np.ascontiguousarray(tokens.view(np.uint32).astype(np.uint8)).view(np.int64)
        sketch = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * (TOKENS // 8)), pa.array(low.ravel()))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes), *(pa.array(p.view(np.int64)) for p in prints), lists, sketch],
            ["doc_id", "n_shingles", "fp1", "fp2", "tokens", "sketch"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), sign,
                       "doc_id long, n_shingles long, fp1 long, fp2 long, tokens array<int>, sketch array<long>")


def children(parent: Column, tokens: Column) -> Column:
    """The nodes that a set goes to from a node: one for a drawn position, or two."""
    one, two = positions(parent, 2)
    return F.when(F.pmod(F.xxhash64(parent, F.lit(0)), F.lit(4)) == 0, F.array(child(parent, tokens, one), child(parent, tokens, two))).otherwise(
        F.array(child(parent, tokens, one)))


def narrow_children(parent: Column, tokens: Column) -> Column:
    """The nodes that a set goes to by its tokens at NARROW positions, one for each of DRAWS draws."""
    draws = (positions(F.xxhash64(parent, F.lit(100 + k)), NARROW) for k in range(DRAWS))
    return F.array_distinct(F.array(*(child(parent, tokens, *at) for at in draws)))


def positions(parent: Column, count: int) -> list[Column]:
    """Positions of a node, each in another part of the tokens."""
    part = TOKENS // count
    turn = F.xxhash64(parent, F.lit(9))
    return [F.pmod(F.pmod(F.xxhash64(parent, F.lit(k)), F.lit(part)) + part * k + turn, F.lit(TOKENS)) for k in range(count)]


def child(parent: Column, tokens: Column, *at: Column) -> Column:
    return F.xxhash64(parent, *at, *(F.element_at(tokens, (p + 1).cast("int")) for p in at))


def confirmed(pairs: DataFrame, docs: DataFrame, n: int, least: int) -> DataFrame:
    """The pairs (a, b) of document ids whose full sets have 100 * intersection >= least * union."""
    scratch = Scratch(docs.sparkSession)
    pairs = scratch.put(pairs.select("a", "b"), "pairs")
    ids = scratch.put(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    texts = texts_of(docs, ids)
    with_a = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = with_a.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    def confirm(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(each_set(batch.column(2), n), each_set(batch.column(3), n), strict=True):
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(common > 0 and 100 * common >= least * (len(x) + len(y) - common))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))

    links = written(map_batches(both.select("a", "b", "text_a", "text_b"), confirm, "a long, b long").distinct(), "links")
    scratch.drop("pairs", "ids")
    return links


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of some documents. Few are in a pair: the others mostly share no slot with one that is, and aren't shuffled."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).cast("int").alias("slot")
    near = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("slot", slot).join(
        F.broadcast(ids.select(slot).distinct()), "slot", "left_semi").drop("slot")
    return near.join(ids, "doc_id", "left_semi")


def near_duplicates(docs: DataFrame, n: int = 5, least: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of docs(doc_id, text).

    Texts are linked if their sets of n-word shingles have 100 * intersection >= least * union; component_id is the
    smallest doc_id that can be reached by links. Null and empty texts have no shingles and are linked with nothing.
    A row without doc_id takes no part: component_id null, kept. Rows that repeat a doc_id should repeat the text too:
    if not, a link of any of its texts links the id. Extra columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    signed = scratch.put(signatures(docs, n).withColumn("row", F.monotonically_increasing_id()), "signatures")
    alike = ["fp1", "fp2", "n_shingles"]
    everything = written(signed.select("doc_id", "row", *alike), "sets")
    classes = written(everything.where("n_shingles > 0 and doc_id is not null").groupBy(*alike).agg(
        F.min(F.struct("doc_id", "row")).alias("first")).select(*alike, F.col("first.doc_id").alias("rep"), "first.row"), "classes")
    reps = scratch.put(signed.join(classes.select("row", "rep"), "row").select("rep", "n_shingles", "tokens", "sketch"), "reps")
    scratch.drop("signatures")

    # Most nodes hold one set. They are found by a narrow count and left out before anything else moves.
    roots = F.array(*(F.lit(f"tree {k}") for k in range(TREES)))
    nodes = reps.select("rep", "n_shingles", F.explode(F.flatten(F.transform(roots, lambda t: children(t, F.col("tokens"))))).alias("node"))
    shared = scratch.put(nodes.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node"), "shared")
    nodes = scratch.put(nodes.join(shared, "node", "left_semi").select("rep", "n_shingles", "node"), "nodes")

    smallest, drawn = F.struct("rep", "n_shingles"), F.struct(F.xxhash64("node", "rep"), "rep", "n_shingles")
    leaders = nodes.groupBy("node").agg(F.min(smallest).alias("x"), F.min(drawn).alias("y"))
    met = nodes.join(leaders, "node").select("rep", "n_shingles", F.explode(F.array("x", F.struct("y.rep", "y.n_shingles"))).alias("leader")).where(
        (F.col("rep") != F.col("leader.rep")) & near_sizes(F.col("n_shingles"), F.col("leader.n_shingles"), least)).select(
        F.least("rep", "leader.rep").alias("a"), F.greatest("rep", "leader.rep").alias("b")).distinct()
    first = scratch.put(agreeing(met, reps), "met")
    links = confirmed(first, docs, n, least)
    roots_of = components(links)

    pairs, depth, finished = None, 1, []
    while True:
        known = scratch.put(nodes.join(roots_of.withColumnRenamed("node", "rep"), "rep", "left").select(
            "node", "rep", "n_shingles", F.coalesce("root", "rep").alias("root")), "known")
        mixed = known.groupBy("node").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"), F.min("root").alias("x"), F.max("root").alias("y")).where(
            "x <> y").select("node", "n", "size")
        open_ = scratch.put(known.join(mixed, "node"), "mixed")
        a, b = (open_.where(F.col("n") <= LEAF).select("node", *(F.col(c).alias(f"{c}_{x}") for c in ("rep", "root", "n_shingles"))) for x in "ab")
        close = a.join(b, "node").where("rep_a < rep_b and root_a <> root_b")
        large = open_.where(F.col("n") > LEAF)
        last = large.isEmpty()
        if not last:
            most = large.groupBy("node", "root").agg(F.sum("n_shingles").alias("m")).groupBy("node").agg(F.max(F.struct("m", "root")).alias("most"))
            large = scratch.put(large.join(most, "node"), "large")
            few = (F.lit(depth > BRANCHING) | (2 * F.col("most.m") >= F.col("size"))) & (F.col("size") - F.col("most.m") <= STRAYS)
            finished.append(written(stray_links(large.where(few), docs, n, least), "stray links"))
            large = large.where(~few)
            last = large.isEmpty()
        close = close.where(near_sizes(F.col("n_shingles_a"), F.col("n_shingles_b"), least)).select(
            F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b"))
        found = scratch.put(agreeing(close.distinct(), reps), f"found {depth}")
        pairs = found if pairs is None else pairs.union(found)
        if last:
            break
        branch = children if depth < BRANCHING else narrow_children
        nodes = scratch.put(large.join(reps.select("rep", "tokens"), "rep").select("rep", "n_shingles", F.explode(branch(F.col("node"), F.col("tokens"))).alias("node")), "nodes")
        depth += 1
    scratch.drop("reps", "nodes", "shared", "known", "mixed", "large")
    pairs = pairs.distinct().join(first, ["a", "b"], "left_anti")
    links = links.union(confirmed(pairs, docs, n, least))
    for more in finished:
        links = links.union(more)
    roots_of = components(links)
    scratch.drop("met", *(f"found {k}" for k in range(1, depth + 1)))

    member = classes.join(roots_of.withColumnRenamed("node", "rep"), "rep", "left").select(
        *alike, F.coalesce("root", "rep").alias("root"))
    return everything.select("doc_id", *alike).join(member, alike, "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def stray_links(large: DataFrame, docs: DataFrame, n: int, least: int) -> DataFrame:
    """Links (a, b) between sets outside of their node's largest component and sets of other components: for each stray
    and component one of a part's links, if there is any, found on full sets."""
    parts = F.floor(F.col("size") / PART).cast("long")
    dealt = large.select("node", F.pmod(F.xxhash64("rep"), parts + 1).alias("part"), "rep", "root", F.lit(False).alias("stray"))
    strays = large.where(F.col("root") != F.col("most.root")).select(
        "node", F.explode(F.sequence(F.lit(0).cast("long"), parts)).alias("part"), "rep", "root", F.lit(True).alias("stray"))
    texts = texts_of(docs, large.select(F.col("rep").alias("doc_id")).distinct()).withColumnRenamed("doc_id", "rep")

    def find(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        reps, roots, stray = (rows.column(c).to_numpy() for c in ("rep", "root", "stray"))
        sets = each_set(pa.concat_arrays(rows.column("text").chunks), n)
        own = np.flatnonzero(~stray)
        sizes = np.array([len(sets[k]) for k in own])
        grams, owner = np.concatenate([sets[k] for k in own] or [np.zeros(0, np.uint64)]), np.repeat(np.arange(len(own)), sizes)
        order = np.argsort(grams, kind="stable")
        grams, owner = grams[order], owner[order]
        links = []
        for k in np.flatnonzero(stray):
            lo, hi = np.searchsorted(grams, sets[k], "left"), np.searchsorted(grams, sets[k], "right")
            reach = hi - lo
            at = np.repeat(lo - np.append(0, np.cumsum(reach)[:-1]), reach) + np.arange(reach.sum())
            common = np.bincount(owner[at], minlength=len(own))
            near = own[(common > 0) & (100 * common >= least * (sizes + len(sets[k]) - common))]
            first = np.unique(roots[near], return_index=True)[1]
            links += [(min(reps[k], x), max(reps[k], x)) for x, root in zip(reps[near][first], roots[near][first], strict=True) if root != roots[k]]
        a, b = zip(*links, strict=True) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.unionByName(strays).join(texts, "rep").groupBy("node", "part").applyInArrow(find, "a long, b long").distinct()


def near_sizes(x: Column, y: Column, least: int) -> Column:
    """Sets of other sizes can't be similar enough."""
    return F.lit(100) * F.least(x, y) >= F.lit(least) * F.greatest(x, y)


def agreeing(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) with enough equal minwise tokens, by the sketches."""
    for x in "ab":
        pairs = pairs.join(reps.select(F.col("rep").alias(x), F.col("sketch").alias(f"sketch_{x}")), x)

    def unlike(x: Column, y: Column) -> Column:
        """Number of bytes that differ: the lowest bit of each byte takes up all its bits."""
        bits = x.bitwiseXOR(y)
        for by in (4, 2, 1):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, by))
        return F.bit_count(bits.bitwiseAND(F.lit(0x0101010101010101)))

    differ = F.aggregate(F.zip_with("sketch_a", "sketch_b", unlike), F.lit(0), lambda s, x: s + x)
    return pairs.where(differ <= TOKENS - LEAST_EQUAL).select("a", "b")
