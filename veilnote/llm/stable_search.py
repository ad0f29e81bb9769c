"""Nearest neighbours by low-dimensional stable projections and kd-trees.

Vectors are projected by M Gaussian directions, so (projected distance / distance)**2 is chi-square distributed with M
degrees of freedom. A kd-tree, fitted on a bounded sample, deals all vectors to blocks; each block has a kd-tree of its
own. A query goes through a block's leaves in order of their projected distance and verifies the vectors in them. It
stops as soon as the chi-square test holds: a vector nearer than the k-th found would have a projection as far as this
with a chance of at most 1 - SURE. The k-th distance in a query's own block then tells which other blocks it needs.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veilnote.llm.common import map_batches, written

#: Projections, quantile of the stopping test for M = 6 at 0.99 (SURE), vectors of a kd-leaf, leaves verified at a time.
M, STOP, LEAF, STEP = 6, 16.812, 64, 4
#: Vectors of a block, at least and at most; vectors that the block tree is fitted on; queries that meet a block in one
#: task, and results of a query.
LEAST, MOST, SAMPLE, QUERIES = 1024, 65_536, 50_000, 20_000


def projections(x: np.ndarray) -> np.ndarray:
    """Equal sizes of vectors have equal directions in every task."""
    return x @ np.random.default_rng(7 + x.shape[1]).standard_normal((x.shape[1], M))


def kd_order(points: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the points in which each kd-leaf is a run, and where each leaf starts (and the end)."""
    order, cuts, todo = np.arange(len(points)), [], [(0, len(points))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo <= leaf:
            cuts.append(lo)
            continue
        part = order[lo:hi]
        axis = int(np.argmax(np.ptp(points[part], axis=0)))
        mid = (hi - lo) // 2
        order[lo:hi] = part[np.argpartition(points[part, axis], mid)]
        todo += [(lo, lo + mid), (lo + mid, hi)]
    return order, np.array(sorted(cuts) + [len(points)])


def fit_blocks(sample: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Axis and limit of each inner node of a kd-tree of at least `blocks` leaves, in heap order; axis -1: all go left."""
    depth = max(0, int(np.ceil(np.log2(max(1, blocks)))))
    axis, limit = np.full(2**depth - 1, -1), np.zeros(2**depth - 1)
    parts = {0: sample}
    for node in range(2**depth - 1):
        part = parts.pop(node, sample[:0])
        if len(part) > 1:
            axis[node] = int(np.argmax(np.ptp(part, axis=0)))
            limit[node] = np.median(part[:, axis[node]])
        right = part[:, axis[node]] > limit[node] if len(part) > 1 else np.zeros(len(part), bool)
        parts[2 * node + 1], parts[2 * node + 2] = part[~right], part[right]
    return axis, limit


def block_of(points: np.ndarray, axis: np.ndarray, limit: np.ndarray) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    while len(axis) and node.min(initial=len(axis)) < len(axis):
        node = 2 * node + 1 + (points[np.arange(len(points)), axis[node]] > limit[node]) * (axis[node] >= 0)
    return node


def box_distances(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of a projection to each box."""
    return (np.maximum(0, np.maximum(low - q, q - high)) ** 2).sum(1)


def search_block(points: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """(query_id, vec_id, score) candidates of one block: those that may be among the k nearest."""
    columns = ["query_id", "vec_id", "score"]
    if not len(points) or not len(queries):
        return pd.DataFrame({c: pd.Series(dtype="float64" if c == "score" else "int64") for c in columns})
    x, p = np.stack(points["vector"]).astype(float), np.stack(points["projection"])
    order, cuts = kd_order(p, LEAF)
    low = np.minimum.reduceat(p[order], cuts[:-1])
    high = np.maximum.reduceat(p[order], cuts[:-1])
    ids = points["ids"].to_numpy()
    out: list[tuple[int, int, float]] = []
    for query, vector, q, bound in zip(queries["query_id"], queries["vector"], queries["projection"], queries["bound"], strict=True):
        vector = np.asarray(vector, float)
        far = box_distances(np.asarray(q), low, high)
        leaves = np.argsort(far, kind="stable")
        best: list[tuple[float, int]] = []
        for lo in range(0, len(leaves), STEP):
            if far[leaves[lo]] > STOP * bound * bound:
                break
            rows = np.concatenate([order[cuts[leaf]:cuts[leaf + 1]] for leaf in leaves[lo:lo + STEP]])
            score = np.sqrt(((x[rows] - vector) ** 2).sum(1))
            near = np.flatnonzero(score <= bound)
            if len(near) > k:                                   # each row has at least one id besides the query's own
                near = near[score[near] <= np.partition(score[near], k)[k]]
            best += [(float(score[r]), int(i)) for r in near for i in ids[rows[r]] if i != query]
            best.sort()
            del best[k:]
            if len(best) == k:
                bound = min(bound, best[-1][0])
        out += [(query, i, s) for s, i in best]
    return pd.DataFrame(out, columns=columns).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def nearest(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each row of vectors(vec_id, embedding) whose id is divisible by
    `every`, by Euclidean distance in double precision, ties to the smaller id.

    All rows but the query's own are candidates. Vectors that are null, empty, zero or hold null or non-finite
    components take no part, nor do rows without id; only vectors of the query's length are its candidates. Equal rows
    count once. Equal vectors are indexed once, with their k + 1 smallest ids, so a vector that very many rows share
    costs no more. Extra columns are ignored.
    """
    spark = vectors.sparkSession
    vector = F.col("embedding").cast("array<double>")
    fine = vectors.select(F.col("vec_id").cast("long"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists("vector", lambda v: v != 0)).withColumn("vector", F.transform("vector", lambda v: v + F.lit(0.0)))
    place = F.dense_rank().over(W.partitionBy("vector").orderBy("vec_id"))
    alike = fine.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("vector").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))

    def project(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index("vector")
        lists, made = batch.column(at).to_pylist(), [None] * batch.num_rows
        sizes = np.array([len(v) for v in lists])
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            for r, p in zip(rows.tolist(), projections(np.array([lists[r] for r in rows.tolist()])).tolist(), strict=True):
                made[r] = p
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.list_(pa.float64()))], [*batch.schema.names, "projection"])

    points = written(map_batches(alike.select("vector", "ids"), project, "vector array<double>, ids array<long>, projection array<double>"), "points")
    queries = map_batches(fine.where(F.col("vec_id") % every == 0).distinct().select(F.col("vec_id").alias("query_id"), "vector"), project,
                          "query_id long, vector array<double>, projection array<double>")

    total = points.count()
    blocks = -(-total // int(np.clip(total // 64, LEAST, MOST)))
    sample = points.select("projection").orderBy(F.xxhash64("projection")).limit(SAMPLE).collect()
    axis, limit = fit_blocks(np.array([r.projection for r in sample]).reshape(-1, M), blocks)

    def with_block(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = np.array(batch.column(batch.schema.get_field_index("projection")).to_pylist()).reshape(-1, M)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(block_of(p, axis, limit))], [*batch.schema.names, "block"])

    size = F.size("vector").alias("dims")
    dealt = written(map_batches(points, with_block, "vector array<double>, ids array<long>, projection array<double>, block long").select("*", size), "blocks")
    asked = written(map_batches(queries, with_block, "query_id long, vector array<double>, projection array<double>, block long").select("*", size), "queries")

    def searched(probes: DataFrame) -> DataFrame:
        """Only the blocks that some query meets are gathered, and only those that more than QUERIES meet are copied."""
        meets = probes.groupBy("dims", "block").agg(F.count("*").alias("n"))
        split = written(meets.select("dims", "block", F.floor((F.col("n") - 1) / QUERIES).cast("int").alias("last")), "split")
        held = dealt.join(split, ["dims", "block"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("last"))))
        own = probes.join(split, ["dims", "block"]).withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("last") + 1).cast("int"))
        keys = ("dims", "block", "part")
        return held.drop("last").groupBy(*keys).cogroup(own.drop("last").groupBy(*keys)).applyInPandas(
            lambda a, b: search_block(a, b, k), "query_id long, vec_id long, score double")

    home = written(searched(asked.withColumn("bound", F.lit(float("inf")))), "home")
    bounds = home.groupBy("query_id").agg(F.when(F.count("*") >= k, F.max("score")).otherwise(float("inf")).alias("bound"))
    boxes = dealt.groupBy("dims", "block").agg(*(f(F.col("projection")[j]).alias(f"{n}{j}") for j in range(M) for n, f in (("low", F.min), ("high", F.max))))
    known: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    rows = boxes.collect()                                      # a row for each block
    for dims in {r.dims for r in rows}:
        own = [r for r in rows if r.dims == dims]
        known[dims] = (np.array([r.block for r in own]), *(np.array([[r[f"{n}{j}"] for j in range(M)] for r in own]) for n in ("low", "high")))

    def other_blocks(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        columns = {n: c.to_pylist() for n, c in zip(batch.schema.names, batch.columns, strict=True)}
        take, block = [], []
        for r in range(batch.num_rows):
            names, low, high = known.get(columns["dims"][r], (np.zeros(0, int), np.zeros((0, M)), np.zeros((0, M))))
            near = names[box_distances(np.array(columns["projection"][r]), low, high) <= STOP * columns["bound"][r] ** 2]
            near = near[near != columns["block"][r]]
            take += [r] * len(near)
            block += near.tolist()
        if not take:
            return None
        probe = batch.take(pa.array(take))
        return pa.RecordBatch.from_arrays([pa.array(block, pa.int64()) if n == "block" else c for n, c in zip(probe.schema.names, probe.columns, strict=True)],
                                          probe.schema.names)

    bounded = asked.join(bounds, "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    probes = written(map_batches(bounded.select("query_id", "vector", "projection", "block", "dims", "bound"), other_blocks,
                                 "query_id long, vector array<double>, projection array<double>, block long, dims int, bound double"), "probes")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return home.union(searched(probes)).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
