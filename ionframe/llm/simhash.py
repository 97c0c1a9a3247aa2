"""SimHash near-dedup: exact Hamming links from a Gray-order hierarchical index."""

from __future__ import annotations

from itertools import accumulate, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ionframe.operators.components import star_components

from .common import attach, named, stored, unlike

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Fingerprints that share a masked pattern and still go to one task; more are split by further masks.
GROUP_ROWS = 100_000
#: Fingerprints a unit of work is meant for.
UNIT_ROWS = 8192
FANOUT = 16
#: (query, node) pairs held at a time.
FRONTIER = 1_000_000
QUERY_BLOCK = 4096


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a UTF-8 text, as a signed long: bit i is set if it is set in
    over half the XXH64 values of the text's shingles (``width`` lower-case
    words joined by spaces, repeats included; fewer words: one shingle of all; none: 0)."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    n = max(1, len(words) - width + 1)
    starts = [0, *ends[:n - 1]]
    stops = [e - 1 for e in ends[min(width, len(words)) - 1:]]
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 65536):
        some = slice(at, at + 65536)
        shingles = [joined[i:j] for i, j in zip(starts[some], stops[some])]
        h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), dtype="<u8", count=len(shingles))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", width: int = 3, seed: int = 42, out: str = "fp") -> DataFrame:
    """Add the fingerprint of each whole text; null texts have fingerprint 0."""
    @F.arrow_udf(T.LongType())
    def fp(texts: pa.Array) -> pa.Array:
        return pa.array((fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", width, seed) for t in texts), pa.int64())

    return docs.withColumn(out, fp(F.col(text)))


# ------------------------------------------------------------- index of a unit

def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each word in the sequence of Gray codes."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each the smallest position of its set) after joining the sets of a[i] and b[i]."""
    while True:
        la, lb = label[a], label[b]
        lo, hi = np.minimum(la, lb), np.maximum(la, lb)
        m = lo < hi
        if not m.any():
            return label
        a, b = a[m], b[m]
        np.minimum.at(label, hi[m], lo[m])
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up


class GrayIndex:
    """Fingerprints sorted by (group, Gray rank), ``FANOUT`` to a leaf node, nodes
    likewise to upper nodes, up to a root for each group. A node has the mask of
    bits equal in all it holds and their pattern; below its parent only the
    bits new in its mask are compared, and differences add up on the way down."""

    def __init__(self, fp: np.ndarray, group: np.ndarray):
        self.fp, self.group = fp, group
        self.levels: list[dict] = []
        ones, zeros, grp = fp, ~fp, group
        lo = np.arange(len(fp))
        hi = lo + 1
        while True:
            first = np.flatnonzero(np.r_[True, grp[1:] != grp[:-1]])
            within = np.arange(len(grp)) - np.repeat(first, np.diff(np.r_[first, len(grp)]))
            start = np.flatnonzero(within % FANOUT == 0)
            stop = np.r_[start[1:], len(grp)]
            ones, zeros, grp = np.bitwise_and.reduceat(ones, start), np.bitwise_and.reduceat(zeros, start), grp[start]
            lo, hi = lo[start], hi[stop - 1]
            self.levels.append({"start": start, "stop": stop, "mask": ones | zeros, "bits": ones, "lo": lo, "hi": hi})
            if len(start) == len(first):
                return

    def links(self, q: np.ndarray, label: np.ndarray, k: int):
        """Pairs (query, entry), entry behind the query, that differ in at most k bits and
        aren't in one set yet; nodes with a single set are skipped for queries of that set."""
        ends = [(np.minimum.reduceat(label, lv["lo"]), np.maximum.reduceat(label, lv["lo"])) for lv in self.levels]
        top = len(self.levels) - 1
        root = np.cumsum(np.r_[True, self.group[1:] != self.group[:-1]])[q] - 1
        work = [(top, q, root, np.zeros(len(q), dtype=np.uint8), np.zeros(len(q), dtype=np.uint64))]
        found = []
        while work:
            lv, q, node, acc, seen = work.pop()
            at = self.levels[lv]
            new = at["mask"][node] & ~seen
            acc = acc + np.bitwise_count((self.fp[q] ^ at["bits"][node]) & new)
            small, large = ends[lv][0][node], ends[lv][1][node]
            keep = (acc <= k) & (at["hi"][node] > q + 1) & ~((small == large) & (small == label[q]))
            q, node, acc = q[keep], node[keep], acc[keep]
            start = at["start"][node]
            n = at["stop"][node] - start
            for part in np.array_split(np.arange(len(q)), max(1, int(n.sum()) // FRONTIER + 1)):
                if not len(part):
                    continue
                c = n[part]
                pick = np.repeat(part, c)
                child = np.repeat(start[part] - np.r_[0, np.cumsum(c)[:-1]], c) + np.arange(c.sum())
                if lv:
                    work.append((lv - 1, q[pick], child, acc[pick], at["mask"][node[pick]]))
                    continue
                m = (child > q[pick]) & (label[child] != label[q[pick]])
                i, child = pick[m], child[m]
                m = acc[i] + np.bitwise_count((self.fp[q[i]] ^ self.fp[child]) & ~at["mask"][node[i]]) <= k
                found.append((q[i[m]], child[m]))
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def link_sets(fp: np.ndarray, group: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(fp, smaller-placed fp of its set) for fingerprints linked within their group, in spanning form."""
    g = gray_rank(fp)
    o = np.lexsort((g, group))
    fp, group = fp[o], group[o]
    label = np.arange(len(fp))
    for d in (1, 2):
        if len(fp) > d:
            m = (group[d:] == group[:-d]) & (np.bitwise_count(fp[d:] ^ fp[:-d]) <= k)
            i = np.flatnonzero(m)
            label = _unite(label, i, i + d)
    index = GrayIndex(fp, group)
    for at in range(0, len(fp), QUERY_BLOCK):
        a, b = index.links(np.arange(at, min(len(fp), at + QUERY_BLOCK)), label, k)
        if len(a):
            label = _unite(label, a, b)
    m = label != np.arange(len(label))
    return fp[m], fp[label[m]]


# ------------------------------------------------------------------ self-join

def _children(mask: int, parts: int) -> list[int]:
    """Split the bits that ``mask`` leaves open into ``parts`` runs; each run with mask is a child."""
    free = [b for b in range(64) if not mask >> b & 1]
    runs = [free[i * len(free) // parts:(i + 1) * len(free) // parts] for i in range(parts)]
    return [mask | sum(1 << b for b in run) for run in runs]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def hamming_links(fps: DataFrame, max_bits: int = 3, group_rows: int = GROUP_ROWS, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """Edges (a, b) that connect every two rows of ``fps`` (distinct longs ``fp``, stored)
    with at most ``max_bits`` differing bits, as a spanning set: each link joins
    two that end up connected, and only those are.

    Two such fingerprints agree in one of max_bits + 1 runs of bits, so the upper nodes
    of the index are the groups that share the pattern under one run's mask. A
    group of over group_rows is split again: two of it agree in one of
    max_bits + 1 runs of the bits left open. Masks leave 64, 48, 36, 27, 20
    bits (max_bits 3), so a group four splits deep has at most 2^20 rows. Groups are
    dealt to units of about unit_rows, in which the lower nodes are built and searched.
    """
    masks = {m: m for m in _children(0, max_bits + 1)}
    n = fps.count()
    units = max(1, n * len(masks) // unit_rows)
    base = fps.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    cur, done = base.withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))), []
    for _ in range(4):
        big = cur.groupBy("mask", "key").count().where(F.col("count") > group_rows).select("mask", "key")
        if n <= group_rows or big.isEmpty():
            break
        big = stored(big, "simhash-big")
        done.append(cur.join(big, on=["mask", "key"], how="left_anti"))
        below = {m: _children(m, max_bits + 1) for m in masks}
        masks = {c: c for cs in below.values() for c in cs}
        table = F.create_map(*[x for m, cs in below.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(c)) for c in cs]))])
        cur = stored(cur.join(big, on=["mask", "key"], how="left_semi")
                     .select("fp", F.explode(table[F.col("mask")]).alias("mask")).distinct()
                     .withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))), "simhash-split")
    for d in done:
        cur = cur.unionByName(d)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        group = pdf.groupby(["mask", "key"], sort=False).ngroup().to_numpy()
        a, b = link_sets(pdf["fp"].to_numpy().view(np.uint64), group, max_bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)}).drop_duplicates()

    unit = F.pmod(F.xxhash64("mask", "key"), F.lit(units)).alias("unit")
    return cur.select("fp", "mask", "key", unit).groupBy("unit").applyInPandas(run, "a long, b long")


def _with_least(rows: DataFrame, least: Column, max_bits: int, group_rows: int, unit_rows: int) -> DataFrame:
    """``rows`` (stored, with fingerprint ``fp``) with the smallest ``least`` of each row's component in component_id."""
    own = stored(rows.groupBy("fp").agg(F.min(least).alias("least"), F.count(F.lit(1)).alias("n")), "simhash-own")
    total = own.agg(F.sum("n")).first()[0] or 0
    comp = star_components(hamming_links(own.select("fp"), max_bits, group_rows, unit_rows), "a", "b")
    in_comp = stored(own.join(comp.withColumnRenamed("node", "fp"), on="fp", how="left")
                     .withColumn("root", F.coalesce("component", "fp")).drop("component"), "simhash-roots")
    of_root = in_comp.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("m"))
    named = stored(attach(in_comp.drop("least"), stored(of_root, "simhash-least"), "root", "m", total).drop("root"), "simhash-named")
    return attach(rows, named, "fp", "n", total)


def simhash_components(docs: DataFrame, max_bits: int = 3, width: int = 3, seed: int = 42, doc_id: str = "doc_id",
                       text: str = "text", group_rows: int = GROUP_ROWS, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    fingerprint: 16 lower-case hex digits. component_id: the smallest doc_id among all
    documents reachable over links of at most max_bits bits; exact. Null and
    wordless texts have fingerprint 0 and link like any other. A null doc_id
    links but never names a component, unless all of it are null. Repeated rows
    are kept; an empty table gives an empty result; other columns aren't read.
    """
    rows = stored(fingerprints(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_t")), "_t", width, seed)
                  .drop("_t"), "simhash-rows")
    out = _with_least(rows, F.col("doc_id"), max_bits, group_rows, unit_rows)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, max_bits: int = 3, width: int = 3, seed: int = 42, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of ``docs``: the one with the smallest doc_id, then the smallest
    text hash. A row is told by doc_id and text, so different texts of one id are decided apart; rows without a
    doc_id come last in their component. Which of the rows that repeat both stays is not defined. Columns are those of docs."""
    from pyspark.sql import Window

    own = unlike(docs, "_keep_")
    on = [own + k for k in ("null", "id", "hash")]

    def keys(df: DataFrame, i: Column, t: Column) -> DataFrame:
        return df.withColumns(dict(zip(on, (i.isNull(), F.coalesce(i, F.lit(0).cast("long")), F.xxhash64(t)))))

    rows = fingerprints(docs.select(named(doc_id).cast("long").alias("i"), named(text).alias("t")), "t", width, seed)
    rows = stored(keys(rows, F.col("i"), F.col("t")).select(*on, "fp"), "simhash-rows")
    of_rows = _with_least(rows, F.struct(*on), max_bits, GROUP_ROWS, UNIT_ROWS)
    gone = of_rows.where(F.struct(*on) != F.col("component_id")).select(*on).distinct()
    kept = keys(docs, named(doc_id).cast("long"), named(text)).join(gone, on=on, how="left_anti")
    one = Window.partitionBy(*on).orderBy(F.lit(1))
    return kept.withColumn(own + "one", F.row_number().over(one)).where(F.col(own + "one") == 1).select(*[named(c) for c in docs.columns])
