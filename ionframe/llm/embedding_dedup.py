"""Embedding near-dedup: random-hyperplane signs in several tables, exact cosines, components."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ionframe.operators.components import star_components

from .common import attach, stored
from .vectors import block, unit, usable

#: Chance, at most, that a pair exactly at the threshold shares no bucket.
MISS = 1e-7
#: Vectors a bucket is meant for; bits grow with the table.
BUCKET = 256
#: Vectors of a bucket that one task compares; larger buckets go to tasks by pairs of chunks.
CHUNK = 4096
UNIT_ROWS = 16_384


def plan_tables(n: int, threshold: float, miss: float = MISS, bucket: int = BUCKET) -> tuple[int, int]:
    """(bits of a table, tables): bits so that n vectors make buckets of about ``bucket``,
    tables so that a pair at the threshold misses all of them with a chance of at most ``miss``."""
    bits = max(6, math.ceil(math.log2(max(1.0, n / bucket))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log(1 - same)))


def _signs(dim: int, bits: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))


def _keys(x: np.ndarray, planes: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Table keys (rows x tables) of the signs."""
    signs = (x @ planes >= 0).reshape(len(x), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def _compare(rows: np.ndarray, other: np.ndarray | None, x: np.ndarray, keys: np.ndarray, table: int, weight: np.ndarray,
             threshold: float, count: np.ndarray, label: np.ndarray) -> None:
    """Count links of ``rows`` among themselves (or with ``other``) and join their sets. A pair
    belongs to the first table in which its keys agree; others pass it over."""
    cols = rows if other is None else other
    for at in range(0, len(rows), 512):
        r = rows[at:at + 512]
        near = x[r] @ x[cols].T >= threshold
        if other is None:
            near &= np.arange(len(cols))[None, :] > (at + np.arange(len(r)))[:, None]
        i, j = np.nonzero(near)
        i, j = r[i], cols[j]
        for t in range(table):
            m = keys[i, t] != keys[j, t]
            i, j = i[m], j[m]
        np.add.at(count, i, weight[j])
        np.add.at(count, j, weight[i])
        if len(i):
            _join(label, i, j)


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while len(a):
        la, lb = label[a], label[b]
        m = la != lb
        a, b, la, lb = a[m], b[m], la[m], lb[m]
        if not len(a):
            return
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(up := label[label], label):
            label[:] = up


def near_vectors(vectors: DataFrame, threshold: float = 0.98, vec_id: str = "vec_id", vec: str = "embedding",
                 label: str | None = "label", seed: int = 7, miss: float = MISS, bucket: int = BUCKET, chunk: int = CHUNK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Two vectors link if their labels are equal and not null (label None: all are
    compared), their cosine in double precision is at least ``threshold``, and both
    are usable: null, zero, non-finite vectors and those of another length link
    with nothing. n_links: other rows linked directly. component_id: smallest vec_id
    reachable. kept: vec_id = component_id.

    Equal vectors of a label are one class, compared once and counted as often as it has rows.
    Classes are hashed by hyperplane signs into tables; each bucket compares
    its classes exactly, and a pair is counted in the first table that has it together, so no
    pair leaves its task: per bucket only counts and a spanning set of links do. A bucket of over
    ``chunk`` classes is split into chunks, and each pair of chunks is a task of its own.
    Rows that repeat a vec_id with the same vector are linked as other
    rows. A null vec_id counts as a link and names no component. Empty tables give empty results.
    """
    lab = F.col(label).cast("string") if label else F.lit("all")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).cast("array<double>").alias("v"), lab.alias("label"))
    rows = rows.withColumn("ok", usable("v") & F.col("label").isNotNull())
    rows = rows.withColumn("cls", F.when(F.col("ok"), F.md5(F.to_json(F.struct("label", "v")).cast("binary"))))
    rows = stored(rows, "emb-rows")
    good = rows.where("ok")
    classes = good.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"),
                                      F.first("label").alias("label"), F.first("v").alias("v")).where(F.size("v") > 0)
    classes = stored(classes.withColumn("node", F.col("cls")), "emb-classes")
    n, total = classes.agg(F.count(F.lit(1)), F.sum("n")).first()
    total = total or 0
    bits, tables = plan_tables(n, threshold, miss, bucket)

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def keys_of(vs: pa.Array) -> pa.Array:
        out: list = [None] * len(vs)
        lengths = np.diff(vs.offsets.to_numpy())
        for dim in np.unique(lengths):
            where = np.flatnonzero(lengths == dim)
            x = np.stack([vs[int(i)].values.to_numpy(zero_copy_only=False) for i in where]).astype(np.float64)
            for i, k in zip(where, _keys(unit(x), _signs(int(dim), bits, tables, seed), bits, tables)):
                out[i] = k
        return pa.array(out, pa.list_(pa.int64()))

    keyed = stored(classes.select("node", "n", "label", "v", keys_of("v").alias("keys")), "emb-keys")
    home = (F.posexplode("keys").alias("t", "key"))
    thin = keyed.select("label", F.size("v").alias("dim"), home)
    sizes = thin.groupBy("label", "dim", "t", "key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    big = stored(sizes.where(F.col("m") > chunk).withColumn("c", F.ceil(F.col("m") / chunk).cast("int")).drop("m"), "emb-big")
    spread_out = keyed.withColumn("dim", F.size("v")).select("*", home)
    on = ["label", "dim", "t", "key"]
    own = spread_out.join(big, on=on, how="left").withColumn("c", F.coalesce("c", F.lit(1)))
    own = own.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("c")).cast("int"))
    tasks = own.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
    tasks = tasks.withColumn("task", F.xxhash64("label", "dim", "t", "key", F.least("mine", "with"), F.greatest("mine", "with")))
    units = max(1, n * tables // UNIT_ROWS)
    tasks = tasks.select("task", "t", "dim", "mine", "with", "node", "n", "v", "keys").withColumn("unit", F.pmod(F.xxhash64("task"), F.lit(units)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["task", "mine"], kind="stable", ignore_index=True)
        task, node = pdf["task"].to_numpy(), pdf["node"].to_numpy()
        weight = pdf["n"].to_numpy().astype(np.int64)
        mine, both, table = pdf["mine"].to_numpy(), pdf["with"].to_numpy(), pdf["t"].to_numpy()
        x, k = unit(block(pdf["v"], 0)), np.stack(pdf["keys"].to_list())
        count, sets = np.zeros(len(pdf), dtype=np.int64), np.arange(len(pdf))
        first = np.flatnonzero(np.r_[True, task[1:] != task[:-1]])
        for a, b in zip(first, np.r_[first[1:], len(pdf)]):
            if b - a < 2:
                continue
            r = np.arange(a, b)
            cross = (mine[a:b] != both[a:b]).any()
            if not cross:
                _compare(r, None, x, k, int(table[a]), weight, threshold, count, sets)
            else:
                low = mine[a:b] < both[a:b]
                _compare(r[low], r[~low], x, k, int(table[a]), weight, threshold, count, sets)
        got = (count > 0) | (sets != np.arange(len(pdf)))
        return pd.DataFrame({"node": node[got], "links": count[got], "to": node[sets[got]]})

    found = stored(tasks.groupBy("unit", "dim").applyInPandas(run, "node string, links long, to string"), "emb-found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    comp = star_components(found.where("node <> to"), "node", "to")
    named = (classes.select("cls", "node", "n", "least").join(links, on="node", how="left").join(comp, on="node", how="left")
             .withColumn("root", F.coalesce("component", "node")))
    named = stored(named.select("cls", "n", "least", "root", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "emb-roots")
    least = stored(named.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("m")), "emb-least")
    named = stored(attach(named.drop("least"), least, "root", "m", total).select("cls", "n", "n_links", "component_id"), "emb-named")
    out = attach(good.select("vec_id", "cls"), named, "cls", "n", total).select("vec_id", "n_links", "component_id")
    alone = rows.where("not ok or size(v) = 0").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
