"""Sharding by Karmarkar-Karp differencing: shards of near-equal bytes."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, numbered, spread, stored, utf8_bytes

#: Groups that one task differences at a time.
CELL_ROWS = 20_000
#: Parts a cell is differenced into; the next level moves each part as one piece.
CELL_PARTS = 384
#: Single groups kept back, on average, for the last level, where they even out the parts.
LOOSE = 4_000


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """Assign items to k subsets with near-equal sums.

    Every item starts as a partial partition (its size, 0, ..., 0). The two
    partial partitions with the largest spread are combined, the largest subset of
    one with the smallest of the other, until one is left. Merges keep only the
    new order of subsets; assignments are read back from the last merge to the first.
    """
    n = len(sizes)
    if n == 0:
        return np.zeros(0, dtype=np.int32)
    vec: list = [None] * (2 * n - 1)
    heap = []
    for i, s in enumerate(sizes.tolist()):
        v = np.zeros(k, dtype=np.int64)
        v[0] = s
        vec[i] = v
        heap.append((-s, i))
    heapq.heapify(heap)
    order = np.zeros((n - 1, k), dtype=np.int16)
    left, right = np.zeros(n - 1, dtype=np.int64), np.zeros(n - 1, dtype=np.int64)
    for m in range(n - 1):
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        v = vec[a] + vec[b][::-1]
        o = np.argsort(-v, kind="stable")
        v = v[o]
        v -= v[-1]
        vec[a] = vec[b] = None
        order[m], left[m], right[m], vec[n + m] = o, a, b, v
        heapq.heappush(heap, (-int(v[0]), n + m))
    place: list = [None] * (2 * n - 1)
    place[-1] = np.arange(k, dtype=np.int32)
    for m in range(n - 2, -1, -1):
        p, o = place[n + m], order[m]
        for child, slots in ((left[m], o), (right[m], k - 1 - o)):
            q = np.empty(k, dtype=np.int32)
            q[slots] = p
            place[child] = q
        place[n + m] = None
    return np.fromiter((place[i][0] for i in range(n)), dtype=np.int32, count=n)


def _difference(parts: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "item"], ascending=[False, True], kind="stable")
        part = differencing(pdf["bytes"].to_numpy(), parts)
        return pd.DataFrame({"item": pdf["item"], "part": pdf["cell"].to_numpy() * parts + part})

    return run


def assign_groups(groups: DataFrame, n_shards: int, cell_rows: int = CELL_ROWS, cell_parts: int = CELL_PARTS,
                  loose: int = LOOSE) -> DataFrame:
    """(key, shard) for ``groups`` (key string, bytes long), a stored table with a row a group.

    The last level differences at most about cell_rows pieces into the shards
    in one task. Below it, hash cells of about cell_rows pieces are
    differenced into cell_parts parts each, and the parts are the next level's
    pieces, until few enough are left. Groups of at least 4 / cell_rows of
    all bytes (so at most a quarter of cell_rows) and about ``loose`` others, drawn by hash, go to
    the last level singly: giants get shards that take little else, and the loose ones
    even out what is left.
    """
    total, n = groups.agg(F.sum("bytes"), F.count(F.lit(1))).first()
    pieces = groups.select(F.col("key").alias("item"), "bytes")
    if n <= cell_rows:
        top, chain = pieces, None
    else:
        heavy = F.col("bytes") * cell_rows >= F.lit(4 * int(total))
        keep = heavy | (spread(F.col("item"), n) < loose)
        top = pieces.where(keep)
        chain, level, left = None, 0, n
        rest = pieces.where(~keep)
        while level == 0 or left > cell_rows // 2:
            cells = -(-left // cell_rows)
            celled = rest.withColumn("cell", spread(F.concat(F.lit(f"{level}:"), F.col("item")), cells))
            got = celled.groupBy("cell").applyInPandas(_difference(cell_parts), "item string, part long")
            got = stored(got.select("item", F.concat(F.lit(f"{level}/"), F.col("part").cast("string")).alias("piece")), "shard-level")
            rest = stored(rest.join(got, on="item").groupBy("piece").agg(F.sum("bytes").alias("bytes"))
                          .withColumnRenamed("piece", "item"), "shard-pieces")
            chain = got if chain is None else chain.join(got.select(F.col("item").alias("piece"), F.col("piece").alias("_up")),
                                                         on="piece").select("item", F.col("_up").alias("piece"))
            left, level = rest.count(), level + 1
        top = top.unionByName(rest)
    last = stored(top.withColumn("cell", F.lit(0).cast("long")).groupBy("cell")
                  .applyInPandas(_difference(n_shards), "item string, part long"), "shard-top")
    direct = last.select(F.col("item").alias("key"), F.col("part").cast("int").alias("shard"))
    if chain is None:
        return direct
    below = chain.join(last.withColumnRenamed("item", "piece"), on="piece").select(
        F.col("item").alias("key"), F.col("part").cast("int").alias("shard"))
    return below.unionByName(direct.where(~F.col("key").contains("/")))


def shard_by_bytes(docs: DataFrame, n_shards: int = 24, doc_id: str = "doc_id", text: str = "text",
                   cell_rows: int = CELL_ROWS, cell_parts: int = CELL_PARTS, loose: int = LOOSE) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row of ``docs``.

    Documents with equal texts form a group and share a shard; null counts as the
    empty text. size: UTF-8 bytes plus 8. Shards have near-equal bytes: apart from groups
    that alone outweigh an even share, they differ by about one small group. slot:
    gapless from 0 within a shard. Repeated rows are kept, an empty table gives
    an empty result, other columns are not looked at.
    """
    filled = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = stored(docs.select(F.col(doc_id).cast("long").alias("doc_id"), (utf8_bytes(text) + 8).alias("size"),
                              F.crc32(filled).alias("text_crc32"), F.md5(filled).alias("key")), "shard-rows")
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard-groups")
    total = groups.agg(F.sum("n")).first()[0] or 0
    if total == 0:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    shards = assign_groups(groups.drop("n"), n_shards, cell_rows, cell_parts, loose)
    shards = stored(shards.join(groups.select("key", "n"), on="key"), "shard-of")
    placed = stored(attach(rows, shards, "key", "n", total).drop("key"), "shard-placed")
    buckets = 64 + total // (n_shards * 100_000)
    return numbered(placed, "shard", spread(F.col("doc_id"), buckets), ["doc_id", "text_crc32", "size"], "slot", buckets)


def write_shards(docs: DataFrame, placed: DataFrame, path: str, doc_id: str = "doc_id") -> None:
    """Write the documents as a folder a shard, ordered by slot within the files.
    Needs unique doc_ids. Rows go to (shard, slot range) files, not a task a shard."""
    out = docs.join(placed.select(F.col("doc_id").alias(doc_id), "shard", "slot"), on=doc_id)
    out = out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    out.write.partitionBy("shard").parquet(path)
