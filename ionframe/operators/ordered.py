"""Order-dependent aggregates without a single-partition window.

A plain ``Window.orderBy(x)`` (no partition key) or a window partitioned by a
hot key sends a whole group to one task. The helpers here range-partition the rows by
(group, order, tie-break, place in the stored input), so that a partition
holds a run of one or more groups whatever the types, and equal
values spread like others. Spark sizes the ranges from a sample of the data. Totals per (group, partition) are a small
table; their exclusive prefix is added to a window over (group, partition). The result
equals the single-window result exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop_stored, materialize, materialize_at
from .common import join_on_keys

BUCKET = "_ord_bucket"
_PLACE = "_ord_place"
_FNS = {"sum": F.sum, "min": F.min, "max": F.max}


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucketed(df: DataFrame, order: str | Column, partition_by: Sequence[str] = (),
             tiebreak: Sequence[str | Column] = (), descending: bool = False) -> DataFrame:
    """``df`` stored in range partitions of (group, order, tie-break), with the partition's number in
    ``BUCKET`` and the place that decides between rows equal in all of these. Nulls come first, last if descending."""
    key = _as_col(order)
    d, at = materialize_at(df.withColumns({"_ord_key": key, **{f"_ord_t{i}": _as_col(t) for i, t in enumerate(tiebreak)}}), "ord-in")
    # part and row of the stored input: the same however its files are listed and split, and in a rerun
    part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    d = d.withColumn(_PLACE, F.shiftleft(part, 40) + F.col("_metadata.row_index"))
    d = d.repartitionByRange(*[F.col(p) for p in partition_by], *_sort(len(tiebreak), descending))
    out = materialize(d.withColumn(BUCKET, F.spark_partition_id()), "ord-ranges")
    drop_stored(df.sparkSession, at)
    return out


def _sort(ties: int, descending: bool) -> list[Column]:
    return [F.col("_ord_key").desc() if descending else F.col("_ord_key").asc(),
            *[F.col(f"_ord_t{i}").asc() for i in range(ties)], F.col(_PLACE).asc()]


def running(b: DataFrame, aggs: dict[str, tuple[str, Column]], partition_by: Sequence[str] = (),
            descending: bool = False, backwards: bool = False, inclusive: bool = True) -> DataFrame:
    """Running aggregates over a `bucketed` table, along its order or ``backwards``. Keeps its helper columns."""
    bad = [fn for fn, _ in aggs.values() if fn not in _FNS]
    if bad:
        raise ValueError(f"running_agg supports sum / min / max, not {bad}")
    parts = list(partition_by)
    b = b.withColumns({f"_v_{n}": c for n, (_, c) in aggs.items()})
    tot = b.groupBy(*parts, BUCKET).agg(*[_FNS[fn](F.col(f"_v_{n}")).alias(f"_t_{n}") for n, (fn, _) in aggs.items()])
    along = F.col(BUCKET).desc() if backwards else F.col(BUCKET).asc()
    # one row per (group, range) at most
    wb = Window.partitionBy(*parts).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*[F.col(p).alias(f"_k_{i}") for i, p in enumerate(parts)], F.col(BUCKET).alias("_k_b"),
                     *[_FNS[fn](F.col(f"_t_{n}")).over(wb).alias(f"_o_{n}") for n, (fn, _) in aggs.items()])
    ties = sum(c.startswith("_ord_t") for c in b.columns)
    ob = _sort(ties, descending)
    if backwards:
        names = ["_ord_key", *[f"_ord_t{i}" for i in range(ties)], _PLACE]
        ob = [F.col(n).asc() if descending and n == "_ord_key" else F.col(n).desc() for n in names]
    w = Window.partitionBy(*parts, BUCKET).orderBy(*ob).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    # null-safe on the group keys: a null group is a group, as in groupBy
    cond = [F.col(p).eqNullSafe(F.col(f"_k_{i}")) for i, p in enumerate(parts)] + [F.col(BUCKET) == F.col("_k_b")]
    b = b.join(off, on=cond, how="inner").drop(*[f"_k_{i}" for i in range(len(parts))], "_k_b")
    outs = {}
    for n, (fn, _) in aggs.items():
        inner, o = _FNS[fn](F.col(f"_v_{n}")).over(w), F.col(f"_o_{n}")
        if fn == "sum":
            outs[n] = F.coalesce(inner, F.lit(0)) + F.coalesce(o, F.lit(0))
        else:
            outs[n] = (F.least if fn == "min" else F.greatest)(inner, o)
    return b.withColumns(outs).drop(*[f"_v_{n}" for n in aggs], *[f"_o_{n}" for n in aggs])


def plain(b: DataFrame) -> DataFrame:
    """Without the helper columns of `bucketed`."""
    return b.drop(*[c for c in b.columns if c.startswith("_ord_")])


def running_agg(df: DataFrame, order: str | Column, aggs: dict[str, tuple[str, Column]],
                partition_by: Sequence[str] = (), tiebreak: Sequence[str | Column] = (),
                descending: bool = False, inclusive: bool = True) -> DataFrame:
    """Add running aggregates over rows ordered by ``order`` (then ``tiebreak``).

    ``aggs`` maps output name -> (fn, column) with fn in sum / min / max
    (a running count is the sum of 1). With ``inclusive`` the current row is
    included (ROWS frame), else the frame ends at the previous row.
    Equal to ``fn(col).over(Window.partitionBy(*partition_by).orderBy(...)
    .rowsBetween(unboundedPreceding, 0))`` without its single-task bottleneck.
    Any sortable type orders; equal rows keep their stored order.
    """
    b = bucketed(df, order, partition_by, tiebreak, descending)
    return plain(running(b, aggs, partition_by, descending, inclusive=inclusive))


def row_number(df: DataFrame, order: str | Column, partition_by: Sequence[str] = (),
               tiebreak: Sequence[str | Column] = (), descending: bool = False, name: str = "rn") -> DataFrame:
    """1-based row number per group, skew-safe (see module doc)."""
    out = running_agg(df, order, {name: ("sum", F.lit(1))}, partition_by, tiebreak, descending)
    return out.withColumn(name, F.col(name).cast("long"))


def exact_quantile(df: DataFrame, keys: Sequence[str], value: str, q: float = 0.5,
                   name: str = "quantile") -> DataFrame:
    """Exact interpolated quantile per group (as ``percentile``/``median``).

    Row numbers come from the bucketed helper, so a hot group never has to
    fit one task's hash map; only the two rows around the quantile position
    per group survive the filter.
    """
    v = df.select(*keys, value).where(F.col(value).isNotNull())
    n = v.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    ranked = row_number(v, value, keys, name="_rn")
    pos = (F.col("_n") - 1) * F.lit(q)
    lo = F.floor(pos) + 1
    hi = F.ceil(pos) + 1
    j = join_on_keys(ranked, n, keys).where((F.col("_rn") == lo) | (F.col("_rn") == hi))
    frac = pos - F.floor(pos)
    agg = j.groupBy(*keys).agg(
        F.max(F.when(F.col("_rn") == lo, F.col(value))).alias("_lo"),
        F.max(F.when(F.col("_rn") == hi, F.col(value))).alias("_hi"),
        F.first(frac).alias("_f"), F.first("_n").alias("_n"))
    return agg.select(*keys, (F.col("_lo") + F.col("_f") * (F.col("_hi") - F.col("_lo"))).alias(name),
                      F.col("_n").alias("n"))


#: Rows of a group that one task of `contracted` takes at once.
CHUNK_ROWS = 1 << 18


def contracted(df: DataFrame, order: str | Column, partition_by: Sequence[str], shrink: Callable[[pd.DataFrame], pd.DataFrame],
               reach: int, descending: bool = False, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``df`` after ``shrink`` has nothing left to merge in any group's order (``order`` is unique within a group).

    ``shrink`` gets consecutive rows of a group, in order, and returns fewer of the same columns: it merges or removes runs of up
    to ``reach`` neighbours by a rule that looks at no other rows and whose end result does not depend on the sequence of its
    steps. Then a long group can be cut into chunks of ``chunk_rows`` (2 * ``reach`` at least) that are shrunk on their own. The
    next round numbers what is left and cuts half a chunk further, so each run of neighbours lies within a chunk of
    one of two rounds; two rounds that change nothing end it. Groups of one chunk take one round. The driver sees counts only."""
    if chunk_rows < 2 * reach:
        raise ValueError(f"chunks of {chunk_rows} rows don't hold twice the {reach} rows of a rule")
    parts, names, spark = list(partition_by), df.columns, df.sparkSession

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return shrink(pdf.sort_values("_cn").drop(columns=["_cn", "_chunk"]).reset_index(drop=True))

    df, at = materialize_at(df, "contract")
    rows_before, unchanged, shift = -1, 0, 0
    while True:
        rows, most = df.groupBy(*parts).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
        unchanged = unchanged + 1 if rows == rows_before else 0
        if not rows or unchanged == 2:
            return df
        whole = most <= chunk_rows
        numbered = row_number(df, order, parts, descending=descending, name="_cn")
        cut = F.lit(0).cast("long") if whole else F.floor((F.col("_cn") - 1 + shift) / chunk_rows)
        out, new = materialize_at(numbered.select(*names, "_cn", cut.alias("_chunk")).groupBy(*parts, "_chunk")
                                  .applyInPandas(run, df.schema), "contract")
        drop_stored(spark, at)
        if whole:
            return out
        df, at, rows_before, shift = out, new, rows, chunk_rows // 2 - shift
