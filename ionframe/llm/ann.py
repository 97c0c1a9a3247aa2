"""Approximate nearest neighbours: low-dimensional stable projections in a kd-tree, searched
in order of projected distance until a chi-square stopping test holds."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored
from .vectors import block, unit, usable

#: Projected dimensions.
DIMS = 8
#: The search of a query stops when a nearer vector would have been met with this chance.
CONFIDENCE = 0.97
#: Rows from which the upper kd-tree is fitted, on average; every row is indexed.
FIT_ROWS = 20_000
#: Vectors a cell is meant for, and cells at most; a cell of more is cut into chunks with a tree each.
CELL_ROWS = 8192
MOST_CELLS = 4096
#: Queries that meet a chunk in one task.
QUERY_ROWS = 2048
LEAF = 64


def chi2_cdf(x: float, m: int) -> float:
    """Chi-square distribution with an even number m of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, m // 2):
        term *= half / i
        total += term
    return 1 - math.exp(-half) * total


def chi2_quantile(p: float, m: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, m) < p else (lo, mid)
    return hi


def projection(dim: int, dims: int, seed: int) -> np.ndarray:
    """Standard normal (2-stable) directions: a difference's squared projected length
    over its squared length is chi-square with ``dims`` degrees of freedom."""
    return np.random.default_rng([seed, dim]).standard_normal((dim, dims))


class KdSplits:
    """Upper kd-tree: inner nodes split the axis of largest spread at the median."""

    def __init__(self, points: np.ndarray, depth: int):
        self.axis, self.at, self.depth = np.zeros(2 ** depth, dtype=np.int64), np.zeros(2 ** depth), depth
        self._fit(points, 1, depth)

    def _fit(self, p: np.ndarray, node: int, depth: int) -> None:
        if depth == 0:
            return
        if len(p):
            self.axis[node] = int(np.argmax(np.ptp(p, axis=0)))
            self.at[node] = np.median(p[:, self.axis[node]])
        side = p[:, self.axis[node]] > self.at[node] if len(p) else np.zeros(0, dtype=bool)
        self._fit(p[~side], 2 * node, depth - 1)
        self._fit(p[side], 2 * node + 1, depth - 1)

    def cell(self, p: np.ndarray) -> np.ndarray:
        node = np.ones(len(p), dtype=np.int64)
        for _ in range(self.depth):
            node = 2 * node + (p[np.arange(len(p)), self.axis[node]] > self.at[node])
        return node - 2 ** self.depth


def kd_leaves(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the points by kd-tree leaf, and where the leaves start (LEAF points at most)."""
    order, starts, work = [], [], [np.arange(len(p))]
    at = 0
    while work:
        i = work.pop()
        if len(i) <= LEAF:
            order.append(i)
            starts.append(at)
            at += len(i)
            continue
        axis = int(np.argmax(np.ptp(p[i], axis=0)))
        i = i[np.argpartition(p[i, axis], len(i) // 2)]
        work += [i[len(i) // 2:], i[:len(i) // 2]]
    return np.concatenate(order), np.array(starts)


def box_distance2(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distances (queries x boxes)."""
    d = np.maximum(lo[None] - q[:, None], 0) + np.maximum(q[:, None] - hi[None], 0)
    return (d * d).sum(axis=2)


def reach(cosine):
    """Squared distance of unit vectors with this cosine, with room for rounding."""
    return np.maximum(2 - 2 * cosine, 0) + 1e-9


def search(qv: np.ndarray, qp: np.ndarray, qid: np.ndarray, bound: np.ndarray, xv: np.ndarray, xp: np.ndarray, xid: np.ndarray,
           k: int, limit: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query (ids and cosines of) its nearest k of one chunk, nearest first.

    Leaves are taken in order of projected distance, their vectors verified by exact
    cosine, until the next leaf's squared projected distance passes
    ``limit`` times the squared distance of the k-th best so far (``bound``: k-th best cosine known before).
    """
    order, starts = kd_leaves(xp)
    xv, xp, xid = xv[order], xp[order], xid[order]
    stops = np.r_[starts[1:], len(order)]
    lo, hi = np.minimum.reduceat(xp, starts), np.maximum.reduceat(xp, starts)
    out = []
    for at in range(0, len(qv), 256):
        dist = box_distance2(qp[at:at + 256], lo, hi)
        ranks = np.argsort(dist, axis=1)
        for j in range(len(dist)):
            q, leaves = at + j, ranks[j]
            d2 = dist[j][leaves]
            score, ids, worst, done = np.zeros(0), np.zeros(0, dtype=np.int64), bound[q], 0
            step = 4
            while done < len(leaves) and d2[done] <= limit * reach(worst):
                stop = min(len(leaves), done + step)
                stop = done + max(1, int(np.searchsorted(d2[done:stop], limit * reach(worst), side="right")))
                rows = np.concatenate([np.arange(starts[i], stops[i]) for i in leaves[done:stop]])
                rows = rows[xid[rows] != qid[q]]
                score, ids = np.r_[score, xv[rows] @ qv[q]], np.r_[ids, xid[rows]]
                if len(score) > k:
                    best = np.lexsort((ids, -score))[:k]
                    score, ids = score[best], ids[best]
                if len(score) >= k:
                    worst = max(worst, score.min())
                done, step = stop, step * 2
            best = np.lexsort((ids, -score))
            out.append((ids[best], score[best]))
    return out


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", vec: str = "embedding", dims: int = DIMS,
            confidence: float = CONFIDENCE, seed: int = 11, cell_rows: int = CELL_ROWS, fit_rows: int = FIT_ROWS,
            query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors of largest cosine found for each row of ``queries``.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do
    null ids; a query meets vectors of its own length. A query's own row (any row of its vec_id) is
    no candidate; ties go to the smaller vec_id; with fewer than k candidates all come. Rows
    that repeat an id and vector count once; of several vectors of one query id the least is the query. Empty tables give empty results.

    Vectors are scaled to length 1 and projected to ``dims`` normal directions. Of equal vectors
    only the k + 1 smallest ids can be results and are kept. A kd-tree
    fitted on about fit_rows rows cuts all rows into cells, cells of over cell_rows into
    chunks. A query first searches its own cell; its k-th best cosine there bounds the projected
    distance at which the stopping test holds, and it goes on to the cells whose
    boxes are not farther. A vector nearer than the final k-th best is missed with a chance
    of at most 1 - confidence.
    """
    limit = chi2_quantile(confidence, dims)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def project(vs: pa.Array) -> pa.Array:
        out: list = [None] * len(vs)
        lengths = np.diff(vs.offsets.to_numpy())
        for dim in np.unique(lengths):
            where = np.flatnonzero(lengths == dim)
            x = np.stack([vs[int(i)].values.to_numpy(zero_copy_only=False) for i in where])
            for i, p in zip(where, unit(x) @ projection(int(dim), dims, seed)):
                out[i] = p
        return pa.array(out, pa.list_(pa.float64()))

    def prepared(df: DataFrame) -> DataFrame:
        return (df.select(F.col(vec_id).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("v"))
                .where(F.col("id").isNotNull() & usable("v") & (F.size("v") > 0)))

    same = Window.partitionBy("h", "v").orderBy("id")
    x = (prepared(vectors).distinct().withColumn("h", F.xxhash64("v")).withColumn("_r", F.row_number().over(same))
         .where(F.col("_r") <= k + 1).select("id", "v"))
    x = stored(x.withColumn("p", project("v")).withColumn("dim", F.size("v")), "ann-rows")
    q = stored(prepared(queries).groupBy("id").agg(F.min("v").alias("v")).withColumn("p", project("v")).withColumn("dim", F.size("v")), "ann-queries")
    n = x.count()
    depth = min(int(math.log2(MOST_CELLS)), max(0, math.ceil(math.log2(max(1, n) / cell_rows))))
    some = x.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < max(1, int(1e6 * min(1.0, fit_rows / max(1, n))))).select("p")
    fit = some.toPandas()
    splits = KdSplits(block(fit["p"], dims), depth)

    @F.arrow_udf(T.LongType())
    def cell_of(ps: pa.Array) -> pa.Array:
        return pa.array(splits.cell(ps.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)))

    x = x.withColumn("cell", cell_of("p"))
    edges = [f(F.element_at("p", i + 1)) for f in (F.min, F.max) for i in range(dims)]
    cells = x.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("m"), F.array(*edges).alias("box")).collect()  # 2 * dims numbers for each of MOST_CELLS at most (and length)
    boxes = {}
    for c in cells:
        boxes.setdefault(c["dim"], []).append(c)
    for d, cs in boxes.items():
        b = np.array([c["box"] for c in cs]).reshape(-1, 2, dims)
        boxes[d] = (np.array([c["cell"] for c in cs]), -(-np.array([c["m"] for c in cs]) // cell_rows), b[:, 0], b[:, 1])

    spec = "id long, v array<double>, p array<double>, dim int, cell long, chunk int, bound double"

    def route(first: bool):
        def run(batches):
            for pdf in batches:
                out = []
                for d, own in pdf.groupby("dim"):
                    if d not in boxes:
                        continue
                    ids, chunks, lo, hi = boxes[d]
                    for at in range(0, len(own), 512):
                        some = own.iloc[at:at + 512]
                        d2 = box_distance2(block(some["p"], dims), lo, hi)
                        home = d2.argmin(axis=1)
                        goes = np.zeros(d2.shape, dtype=bool)
                        goes[np.arange(len(some)), home] = True
                        if not first:
                            goes = ~goes & (d2 <= limit * reach(some["bound"].to_numpy())[:, None])
                        r, c = np.nonzero(goes)
                        r, c = np.repeat(r, chunks[c]), np.repeat(c, chunks[c])
                        part = some.iloc[r].assign(cell=ids[c])
                        part["chunk"] = part.groupby(["id", "cell"]).cumcount()
                        out.append(part)
                if out:
                    yield pd.concat(out)[["id", "v", "p", "dim", "cell", "chunk", "bound"]]

        return run

    table = x.sparkSession.createDataFrame([(int(d), int(i), int(c)) for d, (ids, cs, _, _) in boxes.items() for i, c in zip(ids, cs)],
                                           "dim int, cell long, chunks int")
    x = x.join(F.broadcast(table), on=["dim", "cell"])
    x = x.withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))

    result = "query_id long, vec_id long, score double"

    def run(key, qs: pd.DataFrame, xs: pd.DataFrame) -> pd.DataFrame:
        if not len(qs) or not len(xs):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        got = search(unit(block(qs["v"], 0)), block(qs["p"], dims), qs["id"].to_numpy(), qs["bound"].to_numpy(),
                     unit(block(xs["v"], 0)), block(xs["p"], dims), xs["id"].to_numpy(), k, limit)
        return pd.DataFrame({"query_id": np.repeat(qs["id"].to_numpy(), [len(i) for i, _ in got]),
                             "vec_id": np.concatenate([i for i, _ in got]), "score": np.concatenate([s for _, s in got])})

    def meet(routed: DataFrame) -> DataFrame:
        """Search the routed queries in blocks of about query_rows a chunk."""
        load = routed.groupBy("dim", "cell", "chunk").agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("blocks"))
        load = stored(load, "ann-load")
        on = ["dim", "cell", "chunk"]
        qs = routed.join(load, on=on).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        xs = x.join(load, on=on).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        keys = [*on, "block"]
        return (qs.select(*keys, "id", "v", "p", "bound").groupBy(*keys)
                .cogroup(xs.select(*keys, "id", "v", "p").groupBy(*keys)).applyInPandas(run, result))

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def top(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    start = q.withColumn("bound", F.lit(-1.0)).withColumn("cell", F.lit(0).cast("long")).withColumn("chunk", F.lit(0))
    first = stored(top(meet(start.mapInPandas(route(True), spec))).drop("rank"), "ann-first")
    kth = first.groupBy("query_id").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("have"))
    bounded = q.join(kth, on=q.id == kth.query_id, how="left").select(
        "id", "v", "p", "dim", F.lit(0).cast("long").alias("cell"), F.lit(0).alias("chunk"),
        F.when(F.col("have") >= k, F.col("kth")).otherwise(F.lit(-1.0)).alias("bound"))
    rest = meet(stored(bounded.mapInPandas(route(False), spec), "ann-routed"))
    return top(first.unionByName(rest)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
