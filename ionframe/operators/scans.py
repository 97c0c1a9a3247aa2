"""Scan and chromatogram quantification on peak tables.

Peaks are long rows ``(dataset, scan, ..., mz, intensity)``; every operator takes
the column names, so the same code runs on any table of that shape.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import ordered
from .common import is_number, join_on_keys
from .rangejoin import Tol, range_join


def reporter_ions(peaks: DataFrame, channels: DataFrame, keys: Sequence[str], mz: str = "mz",
                  intensity: str = "intensity", tol_da: float = 0.003,
                  channel_col: str = "channel", channel_mz: str = "channel_mz") -> DataFrame:
    """per scan and channel, the most intense peak within +-tol of the
    channel m/z. ``channels`` is a caller list (10-18 rows): broadcast."""
    j = range_join(peaks, channels, [Tol(mz, channel_mz, tol_da)], small=True)
    # ties: the peak nearest to the channel, then the smaller m/z
    best = F.max(F.struct(F.col(intensity), (-F.abs(F.col(mz) - F.col(channel_mz))).alias("_near"), (-F.col(mz)).alias("_low")))
    return (j.groupBy(*keys, channel_col).agg(best.alias("_b"))
             .select(*keys, channel_col, F.col("_b")[intensity].alias("intensity"),
                     (-F.col("_b")["_low"]).alias("observed_mz")))


def correct_impurity(ri: DataFrame, matrix: DataFrame, keys: Sequence[str],
                     channel: str = "channel", intensity: str = "intensity") -> DataFrame:
    """corrected = sum_j W[i, j] * raw_j with W the inverted impurity matrix
    ``(channel, source_channel, weight)``; clipped at 0, raw kept beside it. A channel
    that the matrix doesn't name keeps its raw value."""
    m = matrix.select(F.col("channel").alias("_target"), "source_channel", "weight")
    j = ri.join(m, ri[channel] == F.col("source_channel"))
    corr = j.groupBy(*keys, "_target").agg(F.sum(F.col("weight") * F.col(intensity)).alias("_c"))
    out = join_on_keys(ri, corr.withColumnRenamed("_target", channel), [*keys, channel], how="left")
    named = m.select(F.col("_target").alias("_named")).distinct()
    out = out.join(named, out[channel] == F.col("_named"), how="left")
    return out.withColumn("corrected_intensity", F.when(F.col("_named").isNull(), F.col(intensity)).otherwise(
        F.greatest(F.coalesce("_c", F.lit(0.0)), F.lit(0.0)))).drop("_c", "_named")


def promote_ms3(ri: DataFrame, scans: DataFrame, keys: Sequence[str] = ("dataset", "scan"),
                parent: str = "parent_scan", level: str = "ms_level") -> DataFrame:
    """reporter ions of an MS3 scan are reported on its parent MS2 scan."""
    s = scans.select(*keys, parent, level)
    j = ri.join(s, on=list(keys), how="left")
    k = keys[-1]
    return j.withColumn(k, F.when(F.col(level) == 3, F.coalesce(F.col(parent), F.col(k))).otherwise(F.col(k))) \
            .drop(parent, level)


def observation_rate(ri: DataFrame, channel: str, intensity: str, abundance: str,
                     top_fraction: float = 0.8, order_tiebreak: Sequence[str] = ()) -> DataFrame:
    """per channel the share of rows with intensity > 0 (null: not), over all rows and
    over the top ``top_fraction`` of rows by ``abundance`` (percent rank over all rows, ties share the
    rank of their first; a null abundance ranks last). Ranks come from the distinct abundances with their
    counts, so equal values are one row, and only the abundance at the cut is joined back."""
    counts = ri.groupBy(abundance).agg(F.count(F.lit(1)).alias("_n"))
    n = ri.count()
    r = ordered.running_agg(counts, abundance, {"_before": ("sum", F.col("_n"))}, descending=True, inclusive=False)
    cut = r.where(F.col("_before") / F.lit(max(n - 1, 1)) <= F.lit(top_fraction)).agg(
        F.min(abundance).alias("_cut"), F.max(F.col(abundance).isNull()).alias("_nulls")).first()
    top = F.lit(False) if cut["_cut"] is None else F.coalesce(F.col(abundance) >= F.lit(cut["_cut"]), F.lit(False))
    if cut["_nulls"]:
        top = top | F.col(abundance).isNull()
    obs = F.coalesce((F.col(intensity) > 0).cast("double"), F.lit(0.0))
    return ri.groupBy(channel).agg(
        F.avg(obs).alias("observation_rate"), F.avg(F.when(top, obs)).alias("observation_rate_top"),
        F.count(F.lit(1)).alias("n"))


def reporter_stats(ri: DataFrame, channel: str, intensity: str, digits: int = 6) -> DataFrame:
    """Count, mean, min, max, sample standard deviation."""
    r = lambda c: F.round(c, digits)
    return ri.groupBy(channel).agg(
        F.count(F.lit(1)).alias("n"), r(F.avg(intensity)).alias("mean_value"),
        F.min(intensity).alias("min_value"), F.max(intensity).alias("max_value"),
        r(F.stddev_samp(intensity)).alias("std_value"))


def extract_sic(peaks: DataFrame, parents: DataFrame, peak_mz: str, peak_rt: str,
                parent_mz: str, parent_rt: str, ppm: float | None = 10.0, da: float | None = None,
                rt_window: float = 5.0, on: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Points of each parent ion's chromatogram: peaks within the m/z
    tolerance (ppm of the parent, or Da) and within +-rt_window of the parent.
    Two-dimensional bucketed range join."""
    mzdim = Tol(peak_mz, parent_mz, ppm, ppm=True) if ppm is not None else Tol(peak_mz, parent_mz, da)
    return range_join(peaks, parents, [mzdim, Tol(peak_rt, parent_rt, rt_window)], on=on)


def sic_noise(sic: DataFrame, parent: Sequence[str], order: str, intensity: str,
              low_fraction: float = 0.75, min_fraction_of_max: float = 0.01) -> DataFrame:
    """Noise level = mean of the lowest ``low_fraction`` of points
    (by percent rank; ties share the rank of their first); points under ``min_fraction_of_max`` of the
    maximum are dropped. Adds ``noise`` and ``sn``. Ranks come from the distinct intensities with
    their counts, so a group's equal values are one row of the ordering."""
    del order  # equal points share a rank whatever their order
    counts = sic.groupBy(*parent, intensity).agg(F.count(F.lit(1)).alias("_c"))
    n = counts.groupBy(*parent).agg(F.sum("_c").alias("_n"), F.max(intensity).alias("_max"))
    r = ordered.running_agg(counts, intensity, {"_before": ("sum", F.col("_c"))}, parent, inclusive=False)
    r = join_on_keys(r, n, parent)
    low = F.when(F.col("_n") > 1, F.col("_before") / (F.col("_n") - 1)).otherwise(F.lit(0.0)) <= F.lit(low_fraction)
    level = r.where(low & F.col(intensity).isNotNull()).groupBy(*parent).agg(
        (F.sum(F.col(intensity) * F.col("_c")) / F.sum("_c")).alias("noise"))
    out = join_on_keys(sic, join_on_keys(n, level, parent, how="left"), parent)
    out = out.where(F.col(intensity) >= F.col("_max") * F.lit(min_fraction_of_max))
    return out.withColumn("sn", F.when(F.col("noise") > 0, F.col(intensity) / F.col("noise"))) \
              .drop("_n", "_max")


def _neighbours(df: DataFrame, parent: Sequence[str], order: str | Column, tiebreak: Sequence[str],
                offsets: Sequence[int], cols: Sequence[str]) -> DataFrame:
    """Rows with, for each offset k and column c, the value ``_n{k}_{c}`` of the row k places on in the
    group's order. The table is range-partitioned once; the rows at either end of a range are copied into
    the next (``_edge``), so a window over (group, range) sees all neighbours within reach."""
    b = ordered.bucketed(df, order, parent, tiebreak)
    w = Window.partitionBy(*parent, ordered.BUCKET).orderBy("_ord_key", *[f"_ord_t{i}" for i in range(len(tiebreak))], "_ord_place")
    reach = max(abs(k) for k in offsets)
    back = Window.partitionBy(*parent, ordered.BUCKET).orderBy(F.col("_ord_key").desc(), *[F.col(f"_ord_t{i}").desc() for i in range(len(tiebreak))],
                                                              F.col("_ord_place").desc())
    ends = b.withColumns({"_f": F.row_number().over(w), "_l": F.row_number().over(back)})
    first = ends.where(F.col("_f") <= reach)
    last = ends.where(F.col("_l") <= reach)
    # ranges of a group follow each other; a short one passes on what it got, so go on for up to `reach` ranges
    ranges = b.select(*parent, ordered.BUCKET).distinct()
    num = ranges.withColumn("_r", F.row_number().over(Window.partitionBy(*parent).orderBy(ordered.BUCKET)))
    num = materialize(num, "ranges")

    def copied(rows: DataFrame, sign: int) -> DataFrame:
        x = join_on_keys(rows, num, [*parent, ordered.BUCKET]).drop(ordered.BUCKET, "_f", "_l")
        x = x.withColumn("_step", F.explode(F.sequence(F.lit(1), F.lit(reach)))).withColumn("_r", F.col("_r") + sign * F.col("_step"))
        return join_on_keys(x, num, [*parent, "_r"]).drop("_step", "_r")

    extra = copied(last, 1).unionByName(copied(first, -1)).withColumn("_edge", F.lit(True))
    every = b.withColumn("_edge", F.lit(False)).unionByName(extra.select(*b.columns, "_edge"))
    vals = {f"_n{k}_{c}": (F.lag(c, -k) if k < 0 else F.lead(c, k)).over(w) for k in offsets if k for c in cols}
    vals |= {f"_n{k}_{c}": F.col(c) for k in offsets if not k for c in cols}
    return ordered.plain(every.withColumns(vals).where(~F.col("_edge")).drop("_edge"))


def smooth(sic: DataFrame, parent: Sequence[str], order: str, value: str, half_width: int = 2,
           key: Sequence[str] = (), name: str = "smoothed") -> DataFrame:
    """F8: centred moving mean over 2*half_width+1 points (fewer at the ends). Every point keeps its row
    (``key`` or ``order`` with the group); points at one ``order`` value stay apart."""
    keys = list(key) or [order]
    offsets = list(range(-half_width, half_width + 1))
    n = _neighbours(sic, parent, order, keys, offsets, [value])
    near = F.filter(F.array(*[F.col(f"_n{k}_{value}").cast("double") for k in offsets]), lambda x: x.isNotNull())
    mean = F.when(F.size(near) > 0, F.aggregate(near, F.lit(0.0), lambda a, x: a + x) / F.size(near))
    return n.select(*parent, *[k for k in keys if k not in parent], mean.alias(name))


def trapezoid_area(sic: DataFrame, parent: Sequence[str], x: str, y: str,
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """area under y(x) by the trapezoid rule, plus apex and point count."""
    n = _neighbours(sic, parent, x, tiebreak, [-1], [x, y])
    seg = (F.col(x) - F.col(f"_n-1_{x}")) * (F.col(y) + F.col(f"_n-1_{y}")) / 2
    return n.groupBy(*parent).agg(F.sum(seg).alias("area"), F.count(F.lit(1)).alias("n_points"),
                                  F.max(y).alias("apex"))


def peak_bounds(sic: DataFrame, parent: Sequence[str], x: str, y: str) -> DataFrame:
    """the highest point (ties: the later one) and its peak: full width at half maximum and area
    (trapezoid rule) between the crossings of half the apex on either side of it, found by linear
    interpolation between the first point below and its inner neighbour; where no point is below, the
    peak ends at the trace's end. Points of one x count as one, with their largest y. Columns: parent, apex_x, apex_y, left_x,
    right_x, fwhm, area."""
    pts = sic.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*parent, x).agg(F.max(y).alias(y))
    top = F.max(F.struct(F.col(y).alias("y"), F.col(x).alias("x")))
    apex = pts.groupBy(*parent).agg(top["x"].alias("apex_x"), top["y"].alias("apex_y"))
    j = join_on_keys(pts, apex, parent)
    low = F.col(y) < F.col("apex_y") / 2
    side = j.groupBy(*parent, "apex_x", "apex_y").agg(
        F.max(F.when(low & (F.col(x) < F.col("apex_x")), F.struct(F.col(x).alias("x"), F.col(y).alias("y")))).alias("_lo"),
        F.min(F.when(low & (F.col(x) > F.col("apex_x")), F.struct(F.col(x).alias("x"), F.col(y).alias("y")))).alias("_hi"))
    inner = join_on_keys(pts, side, parent).where(
        (F.col("_lo").isNull() | (F.col(x) > F.col("_lo.x"))) & (F.col("_hi").isNull() | (F.col(x) < F.col("_hi.x"))))
    first = F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ends = inner.groupBy(*parent, "apex_x", "apex_y", "_lo", "_hi").agg(F.min(first).alias("_a"), F.max(first).alias("_b"))
    half = F.col("apex_y") / 2

    def crossing(out: str, at: str):
        step = (half - F.col(f"{out}.y")) / (F.col(f"{at}.y") - F.col(f"{out}.y"))
        return F.when(F.col(out).isNull(), F.col(f"{at}.x")).otherwise(F.col(f"{out}.x") + step * (F.col(f"{at}.x") - F.col(f"{out}.x")))

    ends = ends.withColumns({"left_x": crossing("_lo", "_a"), "right_x": crossing("_hi", "_b")})
    ends = ends.withColumn("_ends", ((F.col("_a.x") - F.col("left_x")) * (half + F.col("_a.y"))
                                     + (F.col("right_x") - F.col("_b.x")) * (half + F.col("_b.y"))) / 2)
    body = trapezoid_area(inner.select(*parent, x, y), parent, x, y).select(*parent, F.coalesce("area", F.lit(0.0)).alias("_body"))
    return join_on_keys(ends, body, parent).select(
        *parent, "apex_x", "apex_y", "left_x", "right_x", (F.col("right_x") - F.col("left_x")).alias("fwhm"),
        (F.col("_body") + F.col("_ends")).alias("area"))


def find_peaks(sic: DataFrame, parent: Sequence[str], x: str, y: str, valley: float = 0.5, low_fraction: float = 0.75,
               chunk_rows: int = ordered.CHUNK_ROWS) -> DataFrame:
    """all peaks of each trace. Two neighbouring peaks are told apart where the lowest point between them is below ``valley``
    times the lower apex; else the lower one is a shoulder of the higher. A peak reaches from the lowest point before it to
    the lowest after it (or the trace's ends), both included. Columns: parent, peak (from 1, along x), apex_x, apex_y, left_x,
    right_x, area (trapezoid rule), n_points, sn (apex over `sic_noise`'s level; null without noise).

    Points of one x count as one, with their largest y; of equal y the later is the higher; null and NaN points are left out,
    values below zero count as zero, and a trace without a positive value has no peak. Shoulders are removed by a rule on four consecutive
    extremes (the inner two go if the outer two enclose them), so `ordered.contracted` takes long traces in chunks."""
    if not 0 <= valley < 1:
        raise ValueError(f"valley is a share of the apex from 0 to below 1, not {valley}")
    height = F.greatest(F.col(y).cast("double"), F.lit(0.0))
    pts = materialize(sic.where(is_number(sic, x) & is_number(sic, y)).groupBy(*parent, F.col(x).alias("_x")).agg(F.max(height).alias("_y")), "trace")
    # a trace lies between two points below all others
    low = pts.groupBy(*parent).agg(F.min("_x").alias("a"), F.max("_x").alias("b"))
    ends = low.select(*parent, F.explode(F.array(F.struct(F.lit(0).alias("s"), F.col("a").alias("x")), F.struct(F.lit(2).alias("s"), F.col("b").alias("x")))).alias("_at"),
                      F.lit(float("-inf")).alias("_y"))
    rows = pts.select(*parent, F.lit(1).alias("_s"), "_x", "_y").unionByName(ends.select(*parent, F.col("_at.s").alias("_s"), F.col("_at.x").alias("_x"), "_y"))
    along = F.struct("_s", "_x")

    def extremes(pdf: pd.DataFrame) -> pd.DataFrame:
        kept: list[tuple] = []  # (height, later place): no two are equal
        for p in zip(pdf["_y"].tolist(), range(len(pdf))):
            kept.append(p)
            while True:
                if len(kept) > 2 and (kept[-3] < kept[-2]) == (kept[-2] < kept[-1]):
                    del kept[-2]
                elif len(kept) > 3:
                    a, b, c, d = kept[-4:]
                    top, bottom, outer = (b, c, a <= c and d >= b) if b > c else (c, b, a >= c and d <= b)
                    if not (outer and bottom[0] >= valley * top[0]):
                        break
                    del kept[-3:-1]
                else:
                    break
        return pdf.iloc[[i for _, i in kept]]

    left = ordered.contracted(rows, along, parent, extremes, 4, chunk_rows=chunk_rows)
    n = _neighbours(left, parent, along, [], [-1, 1], ["_x", "_y"])
    peaks = n.where((F.col("_y") > F.col("_n-1__y")) & (F.col("_y") > 0) & (F.col("_y") >= F.col("_n1__y")))
    peaks = ordered.row_number(peaks.select(*parent, F.col("_x").alias("apex_x"), F.col("_y").alias("apex_y"),
                                            F.col("_n-1__x").alias("left_x"), F.col("_n1__x").alias("right_x")), "apex_x", parent, name="peak")
    peaks = materialize(peaks, "peaks")
    # the segment that ends at a point is the peak's whose left end is the last one before it
    starts = peaks.select(*parent, F.col("left_x").alias("_x"), F.lit(1).alias("_start"))
    seg = _neighbours(join_on_keys(pts, starts, [*parent, "_x"], how="left"), parent, "_x", [], [-1], ["_x", "_y"])
    part = (F.col("_x") - F.col("_n-1__x")) * (F.col("_y") + F.col("_n-1__y")) / 2
    seg = ordered.running_agg(seg.withColumn("_part", part), "_x", {"peak": ("sum", F.coalesce("_start", F.lit(0)))}, parent, inclusive=False)
    area = seg.where(F.col("peak") > 0).groupBy(*parent, F.col("peak").cast("long").alias("peak")).agg(F.sum("_part").alias("_area"), F.count(F.lit(1)).alias("_n"))
    noise = sic_noise(pts, parent, "_x", "_y", low_fraction, 0.0).groupBy(*parent).agg(F.first("noise").alias("_noise"))
    out = join_on_keys(join_on_keys(peaks, area, [*parent, "peak"], how="left"), noise, parent, how="left")
    return out.select(*parent, "peak", "apex_x", "apex_y", "left_x", "right_x", F.coalesce("_area", F.lit(0.0)).alias("area"),
                      (F.coalesce("_n", F.lit(0)) + 1).alias("n_points"), F.when(F.col("_noise") > 0, F.col("apex_y") / F.col("_noise")).alias("sn"))


def bin_spectra(peaks: DataFrame, keys: Sequence[str], mz: str, intensity: str,
                start: float = 50.0, end: float = 2000.0, size: float = 1.0) -> DataFrame:
    """fixed-width m/z bins in [start, end), summed intensity."""
    b = F.floor((F.col(mz) - F.lit(start)) / F.lit(size)).cast("long")
    p = peaks.where((F.col(mz) >= start) & (F.col(mz) < end))
    return p.groupBy(*keys, b.alias("bin")).agg(F.sum(intensity).alias("total"),
                                                  F.count(F.lit(1)).alias("n"))


def filter_noise(peaks: DataFrame, keys: Sequence[str], intensity: str, order: str,
                 low_fraction: float = 0.5, min_sn: float = 2.0) -> DataFrame:
    """keep peaks with intensity / noise >= min_sn, noise = mean of the
    lowest ``low_fraction`` of the spectrum's peaks."""
    out = sic_noise(peaks, keys, order, intensity, low_fraction, 0.0)
    return out.where(F.col("sn") >= F.lit(min_sn))


def scan_stats(spectra: DataFrame, mz: str = "mz", intensity: str = "intensity") -> DataFrame:
    """per spectrum TIC, base peak and peak count from the arrays."""
    pairs = F.arrays_zip(F.col(intensity).alias("i"), F.col(mz).alias("m"))
    return spectra.withColumns({
        "tic": F.aggregate(intensity, F.lit(0.0), lambda a, v: a + v),
        "base_peak_intensity": F.array_max(intensity),
        "base_peak_mz": F.array_max(pairs)["m"],
        "n_peaks": F.size(mz),
    })


def split_constant_columns(df: DataFrame, group: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """for each column, in how many groups it is constant (min = max,
    no nulls mixed in). One aggregation pass, then an unpivot."""
    aggs = []
    for c in cols:
        aggs.append(((F.min(c) == F.max(c)) & (F.count(c) == F.count(F.lit(1)))).alias(c))
    per = df.groupBy(*group).agg(*aggs)
    long = per.unpivot(list(group), list(cols), "column_name", "is_constant")
    return long.groupBy("column_name").agg(
        F.sum(F.col("is_constant").cast("long")).alias("n_constant_groups"),
        F.count(F.lit(1)).alias("n_groups"))


def split_tables(df: DataFrame, group: Sequence[str], cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """the two tables: columns of ``cols`` that are constant in every group, a row a group, and
    the rows with the group and the other columns. The counts of `split_constant_columns` (a row a column) decide."""
    counts = split_constant_columns(df, group, cols).collect()
    const = sorted((r["column_name"] for r in counts if r["n_constant_groups"] == r["n_groups"]), key=list(cols).index)
    one = df.groupBy(*group).agg(*[F.first(c).alias(c) for c in const]) if const else df.select(*group).distinct()
    return one, df.drop(*const)


def scan_list(spectra: DataFrame, level: int, columns: Sequence[str], ms_level: str = "ms_level") -> DataFrame:
    """the list of MS (level 1) or MS2 scans, by their own columns."""
    return spectra.where(F.col(ms_level) == level).select(*columns)


def dataset_info(spectra: DataFrame, dataset: str, scan: str, rt: str) -> DataFrame:
    """per dataset scan count and time range."""
    return spectra.groupBy(dataset).agg(F.count(scan).alias("n_scans"), F.min(rt).alias("rt_min"),
                                        F.max(rt).alias("rt_max"))


def histogram(df: DataFrame, col: str, n_bins: int = 40, group: Sequence[str] = ()) -> DataFrame:
    """F16 / E5: equal-width histogram between the column's min and max
    (one tiny aggregate for the range, then one grouped count)."""
    row = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = row["lo"], row["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin long, n long, bin_lo double")
    span = (hi - lo) or 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) * F.lit(n_bins) / F.lit(span)) + 1, F.lit(n_bins))
    out = df.where(F.col(col).isNotNull()).groupBy(*group, b.cast("long").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    return out.withColumn("bin_lo", F.lit(lo) + (F.col("bin") - 1) * F.lit(span) / F.lit(n_bins))


def compress_peaks(peaks: DataFrame, keys: Sequence[str], mz: str, intensity: str,
                   gap: float) -> DataFrame:
    """peaks closer than ``gap`` collapse into one (intensity-weighted
    m/z, summed intensity). Distinct m/z values are numbered (bucketed), the
    predecessor found by an equi-join, gap flags summed into a group id."""
    d = peaks.groupBy(*keys, mz).agg(F.sum(intensity).alias("_i"), F.count(F.lit(1)).alias("_c"))
    n = _neighbours(d, keys, mz, [], [-1], [mz])
    n = n.withColumn("_start", (F.col(f"_n-1_{mz}").isNull() |
                                ((F.col(mz) - F.col(f"_n-1_{mz}")) > F.lit(gap))).cast("long"))
    g = ordered.running_agg(n, mz, {"cluster_id": ("sum", F.col("_start"))}, partition_by=keys)
    return g.groupBy(*keys, "cluster_id").agg(
        F.try_divide(F.sum(F.col(mz) * F.col("_i")), F.sum("_i")).alias("center"),
        F.sum("_i").alias("total"), F.sum("_c").alias("n_peaks"),
        F.min(mz).alias("mz_min"), F.max(mz).alias("mz_max"))


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence, n: int, rank: bool = False) -> DataFrame:
    """Best ``n`` rows per key. ``row_number`` (or ``rank`` to
    keep ties) with a filter: Spark inserts a partial per-key limit before the
    shuffle, so a hot key ships at most n rows per map task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    f = F.rank() if rank else F.row_number()
    return df.withColumn("rn", f.over(w)).where(F.col("rn") <= n).withColumn("rn", F.col("rn").cast("long"))


def restrict_range(df: DataFrame, col: str, lo: float = 0, hi: float = 0) -> DataFrame:
    """keep lo <= col <= hi; 0 means open on that side (pushed to the scan)."""
    out = df
    if lo:
        out = out.where(F.col(col) >= lo)
    if hi:
        out = out.where(F.col(col) <= hi)
    return out


def replace_zeroes(sic: DataFrame, parent: Sequence[str], intensity: str) -> DataFrame:
    """zero (or null) points take the group's smallest positive value
    (group minimum by aggregation + equi-join, not a window)."""
    mins = sic.groupBy(*parent).agg(F.min(F.when(F.col(intensity) > 0, F.col(intensity))).alias("_minpos"))
    j = join_on_keys(sic, mins, parent, how="left")
    return j.withColumn(intensity, F.when(F.col(intensity) > 0, F.col(intensity))
                        .otherwise(F.col("_minpos"))).drop("_minpos")


def mrm_crosstab(peaks: DataFrame, transitions: DataFrame, keys: Sequence[str], mz: str,
                 intensity: str, tol_da: float, name_col: str = "transition",
                 tmz: str = "transition_mz") -> DataFrame:
    """scan x transition intensity table."""
    names = sorted(r[0] for r in transitions.select(name_col).distinct().collect())  # caller list
    j = range_join(peaks, transitions, [Tol(mz, tmz, tol_da)], small=True)
    return j.groupBy(*keys).pivot(name_col, names).agg(F.sum(intensity))


def top_ions(peaks: DataFrame, keys: Sequence[str], intensity: str, sn: str = "sn",
             n: int = 200, min_sn: float = 1.0, mz: str = "mz") -> DataFrame:
    """per scan the ``n`` most intense ions with S/N >= ``min_sn``; of equal intensities the smaller m/z, where there is one."""
    kept = peaks.where(F.col(sn) >= min_sn)
    return top_n(kept, keys, [F.col(intensity).desc(), *([F.col(mz).asc()] if mz in peaks.columns else [])], n)


def group_parent_ions(parents: DataFrame, binned: DataFrame, parent_id: str, mz: str, rt: str,
                      mz_tol: float = 0.05, rt_tol: float = 5.0, min_similarity: float = 0.8,
                      bin_col: str = "bin", value: str = "total", keys: Sequence[str] = ()) -> DataFrame:
    """parent ions of the same ``keys`` (the dataset) within +-mz_tol and +-rt_tol whose binned spectra
    (F11 output: keys, parent_id, bin, total) have cosine >= min_similarity are
    linked; groups are the connected components. Returns (keys, parent_id, group_id), group_id the smallest id
    of the group. An ion is (keys, parent_id): equal ids of two datasets are two ions.

    A spectrum travels with its ion as arrays, its bins from the rarest to the most frequent; equal ions (m/z, time and spectrum) are one
    point. Links come in two steps. First a point is compared with the one before it by m/z among those of its cell of time and direction
    (unit spectrum, rounded), in grids shifted by halves: where ions are dense this joins nearly all that belong together. Then every pair
    that the first step left in different components is compared, so no link is lost: in a bin of a two-dimensional range join, points of the bin's
    most frequent component meet the other points only. A spectrum's prefix is as many bins as leave less than min_similarity
    of its length in the rest: by Cauchy-Schwarz two spectra whose prefixes share no bin are less similar than that, so a prefix bin is a key too and
    a pair is taken at the first one they share. A spectrum of zeros is similar to nothing."""
    from .components import star_components

    keys = list(keys)
    if not (mz_tol > 0 and rt_tol > 0):
        raise ValueError(f"group_parent_ions needs positive tolerances: {mz_tol}, {rt_tol}")
    binned = materialize(binned, "spectra")
    often = binned.groupBy(bin_col).agg(F.count(F.lit(1)).alias("_f"))
    peaks = binned.join(often, on=bin_col).groupBy(*keys, parent_id).agg(
        F.array_sort(F.collect_list(F.struct("_f", F.col(bin_col).alias("b"), F.col(value).cast("double").alias("v")))).alias("_s"))
    norm2 = F.aggregate("_s", F.lit(0.0), lambda x, p: x + p["v"] * p["v"])
    peaks = peaks.withColumn("_n2", norm2).where("_n2 > 0")
    # a little longer than need be, so that rounding drops no pair at the threshold
    rest = F.lit(max(0.0, min_similarity) ** 2 * (1 - 1e-9)) * F.col("_n2")
    taken = F.aggregate("_s", F.struct(F.col("_n2").alias("left"), F.lit(0).alias("n")), lambda x, p: F.when(
        x["left"] >= rest, F.struct((x["left"] - p["v"] * p["v"]).alias("left"), (x["n"] + 1).alias("n"))).otherwise(x), lambda x: x["n"])
    # an id of its own where rounding keeps a spectrum from being similar to itself
    apart = F.when(F.col("_n2") / (F.sqrt("_n2") * F.sqrt("_n2")) < min_similarity, F.col(parent_id))
    peaks = peaks.select(*keys, parent_id, apart.alias("_apart"), F.sqrt("_n2").alias("_n"), F.col("_s.b").alias("_b"), F.col("_s.v").alias("_v"),
                         F.slice(F.col("_s.b"), F.lit(1), taken).alias("_pre"))
    # an ion that isn't near itself (no m/z, say) is near nothing
    near = (F.abs(F.col("_mz") - F.col("_mz")) <= mz_tol) & (F.abs(F.col("_rt") - F.col("_rt")) <= rt_tol)
    ions = parents.select(*keys, parent_id, F.col(mz).alias("_mz"), F.col(rt).alias("_rt")).distinct().where(near).join(peaks, on=[*keys, parent_id])
    ions = materialize(ions, "ion-spectra")
    # points by number: stored, so that a rerun numbers them alike
    same = [*keys, "_mz", "_rt", "_apart", "_n", "_b", "_v"]
    points = ions.groupBy(*same).agg(F.first("_pre").alias("_pre"))
    points = materialize(points.withColumn("_no", F.monotonically_increasing_id()), "ion-points")
    of = materialize(join_on_keys(ions.drop("_pre"), points.select(*same, "_no"), same).select(*keys, parent_id, "_no"), "ion-numbers")
    first = of.groupBy(*keys, parent_id).agg(F.min("_no").alias("_a"), F.max("_no").alias("_z")).where("_a < _z").drop("_z")
    joined = of.join(first, on=[*keys, parent_id]).select("_a", F.col("_no").alias("_b"))  # an id's points belong together

    def cosine(a: str, b: str, na: str, nb: str) -> Column:
        dot = F.aggregate(a, F.lit(0.0), lambda x, p: x + p["v"] * F.coalesce(F.col(b)[p["b"]], F.lit(0.0)))
        return dot / (F.col(na) * F.col(nb))

    pairs_of = F.arrays_zip(F.col("_b").alias("b"), F.col("_v").alias("v"))
    step = math.sqrt(max(0.0, 1 - min_similarity) / 2)  # four coordinates rounded alike are within the similarity
    for half in (0.0, 0.5):
        for turn in (0.25, 0.75):
            unit = F.transform(pairs_of, lambda p: F.struct(p["b"].alias("b"), F.floor(p["v"] / F.col("_n") / F.lit(max(step, 1e-6)) + turn).alias("r")))
            w = Window.partitionBy(*keys, "_cm", "_ct", "_cs").orderBy("_mz", "_no")
            cells = points.select(*keys, "_no", "_mz", "_rt", "_n", "_pre", pairs_of.alias("_p"), F.map_from_arrays("_b", "_v").alias("_m"),
                                  F.floor(F.col("_mz") / (32 * mz_tol) + half).alias("_cm"), F.floor(F.col("_rt") / rt_tol + half).alias("_ct"),
                                  F.xxhash64(F.array_sort(F.filter(unit, lambda u: u["r"] != 0))).alias("_cs"))
            before = cells.withColumns({f"_1{c}": F.lag(f"_{c}").over(w) for c in ("no", "mz", "rt", "n", "m", "pre")})
            ok = (F.abs(F.col("_mz") - F.col("_1mz")) <= mz_tol) & (F.abs(F.col("_rt") - F.col("_1rt")) <= rt_tol)
            links = before.where(ok & F.arrays_overlap("_pre", "_1pre")).where(cosine("_p", "_1m", "_n", "_1n") >= min_similarity).select(F.col("_1no").alias("_a"), F.col("_no").alias("_b"))
            joined = joined.unionByName(links)
    comp = star_components(joined, "_a", "_b").select(F.col("node").alias("_no"), F.col("component").alias("_group"))
    points = points.join(comp, on="_no", how="left").withColumn("_group", F.coalesce("_group", "_no"))
    points = materialize(points, "ion-groups")

    # bins that points or their tolerance reach, with the component that most of them have
    cell = [*keys, "_bm", "_bt"]
    bins = {"_bm": ("_mz", 2 * mz_tol), "_bt": ("_rt", 2 * rt_tol)}
    reach = points
    for b, (c, width) in bins.items():
        wide = width / 2 * (1 + 1e-9)
        reach = reach.withColumn(b, F.explode(F.sequence(F.floor((F.col(c) - wide) / width).cast("long"), F.floor((F.col(c) + wide) / width).cast("long"))))
    count = reach.groupBy(*cell, "_group").agg(F.count(F.lit(1)).alias("_c"))
    most = count.groupBy(*cell).agg(F.max(F.struct("_c", "_group"))["_group"].alias("_most"), F.count(F.lit(1)).alias("_many")).where("_many > 1").drop("_many")
    most = materialize(most, "ion-cells")  # cells of one component have nothing to compare

    def side(x: str, rows: DataFrame) -> DataFrame:
        spectrum = pairs_of if x == "a" else F.map_from_arrays("_b", "_v")
        j = join_on_keys(rows, most, cell)
        return j.select(*[F.col(k).alias(f"_k{x}{i}") for i, k in enumerate(cell)], F.col("_no").alias(f"_{x}"), F.col("_mz").alias(f"_{x}mz"), F.col("_rt").alias(f"_{x}rt"),
                        F.col("_n").alias(f"_n{x}"), F.col("_group").alias(f"_g{x}"), (F.col("_group") == F.col("_most")).alias(f"_o{x}"),
                        spectrum.alias(f"_s{x}"), F.col("_pre").alias(f"_pre{x}"), F.explode("_pre").alias(f"_d{x}"))

    at = points.withColumns({b: F.floor(F.col(c) / width).cast("long") for b, (c, width) in bins.items()})
    a, b = side("a", at), side("b", reach)
    on = [F.col(f"_ka{i}") == F.col(f"_kb{i}") for i in range(len(cell))] + [F.col("_da") == F.col("_db")]
    on += [F.col("_a") < F.col("_b"), F.col("_ga") != F.col("_gb"), F.abs(F.col("_amz") - F.col("_bmz")) <= mz_tol, F.abs(F.col("_art") - F.col("_brt")) <= rt_tol]
    pairs = a.where("_oa").join(b.where("NOT _ob").hint("merge"), on=on).unionByName(a.where("NOT _oa").join(b.hint("merge"), on=on))
    pairs = pairs.where(F.element_at(F.array_intersect("_prea", "_preb"), 1) == F.col("_da"))
    links = pairs.where(cosine("_sa", "_sb", "_na", "_nb") >= min_similarity).select("_ga", "_gb")
    more = star_components(links, "_ga", "_gb").select(F.col("node").alias("_group"), F.col("component").alias("_all"))
    whole = points.select("_no", "_group").join(more, on="_group", how="left").select("_no", F.coalesce("_all", "_group").alias("_group"))
    linked = materialize(of.join(whole, on="_no").groupBy(*keys, parent_id).agg(F.min("_group").alias("_group")), "ion-members")
    least = linked.groupBy("_group").agg(F.min(parent_id).alias("group_id"))
    out = linked.join(least, on="_group").select(*keys, parent_id, "group_id")
    alone = join_on_keys(parents.select(*keys, parent_id).distinct(), linked.select(*keys, parent_id), [*keys, parent_id], how="left_anti")
    return out.unionByName(alone.withColumn("group_id", F.col(parent_id)).select(*keys, parent_id, "group_id"))
