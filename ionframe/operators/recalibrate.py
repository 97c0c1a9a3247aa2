"""Mass recalibration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import ISOTOPE_SPACING, PROTON
from . import ordered
from .common import join_on_keys
from .scans import histogram


def mass_error_ppm(psm: DataFrame, precursor_mz: str = "precursor_mz", charge: str = "charge",
                   peptide_mass: str = "peptide_mass", name: str = "ppm_error") -> DataFrame:
    """Precursor mass error in ppm, corrected by the nearest isotope offset."""
    observed = (F.col(precursor_mz) - F.lit(PROTON)) * F.col(charge)
    diff = observed - F.col(peptide_mass)
    iso = F.round(diff / F.lit(ISOTOPE_SPACING))
    ppm = F.try_divide(diff - iso * F.lit(ISOTOPE_SPACING), F.col(peptide_mass)) * F.lit(1e6)
    return psm.withColumns({"isotope": iso.cast("int"), name: ppm})


def confident_psms(psm: DataFrame, group: Sequence[str], score: str, start: float = 1e-10,
                   factor: float = 10.0, steps: int = 2, min_rows: int = 10,
                   lower_is_better: bool = True) -> DataFrame:
    """Per group the first threshold (start, start*factor, ...) that keeps
    at least ``min_rows`` rows; the last one if none does. One aggregation
    with a conditional count per threshold; returns (group, threshold, n)."""
    ths = [float(f"{start * factor ** i:.12g}") for i in range(steps + 1)]
    passes = [(F.col(score) <= t) if lower_is_better else (F.col(score) >= t) for t in ths]
    counts = psm.groupBy(*group).agg(*[F.sum(p.cast("long")).alias(f"_n{i}") for i, p in enumerate(passes)])
    chosen_t, chosen_n = F.lit(ths[-1]), F.col(f"_n{len(ths) - 1}")
    for i in reversed(range(len(ths) - 1)):
        ok = F.col(f"_n{i}") >= min_rows
        chosen_t = F.when(ok, F.lit(ths[i])).otherwise(chosen_t)
        chosen_n = F.when(ok, F.col(f"_n{i}")).otherwise(chosen_n)
    return counts.select(*group, chosen_t.alias("threshold"), chosen_n.cast("long").alias("n_confident"))


def confident_subset(psm: DataFrame, group: Sequence[str], score: str, start: float = 1e-10, factor: float = 10.0,
                     steps: int = 2, min_rows: int = 10, lower_is_better: bool = True) -> DataFrame:
    """The matches themselves that pass their group's threshold of `confident_psms`, with it."""
    th = confident_psms(psm, group, score, start, factor, steps, min_rows, lower_is_better).drop("n_confident")
    j = join_on_keys(psm, th, group) if group else psm.join(th)
    return j.where(F.col(score) <= F.col("threshold") if lower_is_better else F.col(score) >= F.col("threshold"))


def fit_shift(psm: DataFrame, group: Sequence[str], error: str, min_rows: int = 1,
              name: str = "shift") -> DataFrame:
    """Median error per group (exact, skew-safe), groups with fewer than
    ``min_rows`` rows get no fit."""
    med = ordered.exact_quantile(psm, group, error, 0.5, name=name)
    return med.where(F.col("n") >= min_rows)


def apply_shift(df: DataFrame, shift: DataFrame, group: Sequence[str], value: str,
                name: str | None = None, ppm: bool = False, shift_col: str = "shift") -> DataFrame:
    """Subtract the group's shift (ppm: relative); pass through when the
    group has no fit. ``shift`` has one row per group."""
    j = df.join(shift.select(*group, shift_col), on=list(group), how="left")
    s = F.coalesce(F.col(shift_col), F.lit(0.0))
    out = F.col(value) * (1 - s * F.lit(1e-6)) if ppm else F.col(value) - s
    return j.withColumn(name or value, out).drop(shift_col)


def error_histogram(psm: DataFrame, error: str, score: str, max_score: float = 1e-10,
                    n_bins: int = 40) -> DataFrame:
    """E5: histogram of mass errors of confident matches."""
    return histogram(psm.where(F.col(score) <= max_score), error, n_bins)


def error_trend(psm: DataFrame, error: str, x: str, width: float, group: Sequence[str] = ()) -> DataFrame:
    """E5: median mass error (exact) and count along retention time or m/z, in bins of ``width`` of ``x``:
    (group, bin, x_lo, median_error, n)."""
    b = psm.where(F.col(x).isNotNull()).withColumn("bin", F.floor(F.col(x) / F.lit(width)).cast("long"))
    m = ordered.exact_quantile(b, [*group, "bin"], error, 0.5, name="median_error")
    return m.select(*group, "bin", (F.col("bin") * F.lit(width)).alias("x_lo"), "median_error", "n")


def apply_shift_to_spectra(spectra: DataFrame, shift: DataFrame, group: Sequence[str], mz: str = "mz",
                           precursor_mz: str = "precursor_mz", shift_col: str = "shift") -> DataFrame:
    """E4 on spectra: the group's ppm shift taken off the precursor m/z and every peak's m/z; spectra of
    groups without a fit pass through."""
    out = apply_shift(spectra, shift, group, precursor_mz, ppm=True, shift_col=shift_col)
    j = join_on_keys(out, shift.select(*group, F.col(shift_col).alias("_s")), group, how="left")
    scale = 1 - F.coalesce(F.col("_s"), F.lit(0.0)) * F.lit(1e-6)
    return j.withColumn(mz, F.transform(mz, lambda v: v * scale)).drop("_s")


def fit_trend(psm: DataFrame, group: Sequence[str], error: str, x: str, width: float, min_rows: int = 20,
              min_group: int = 20) -> tuple[DataFrame, DataFrame]:
    """E3 along retention time or m/z: (segments, groups) for `apply_trend`. A bin of ``width`` of ``x`` with ``min_rows``
    rows or more has a knot: its median error (exact), at its centre. segments: per group and stretch between two bin centres, from before the
    first knot to behind the last one, the knots on either side. groups: the range of a group's segments, and
    its median over all rows where it has ``min_group`` or more. Both have a row per bin or group, not per match."""
    keys = list(group)
    knots = error_trend(psm, error, x, width, keys).where(F.col("n") >= min_rows).select(
        *keys, "bin", F.struct(((F.col("bin") + 0.5) * F.lit(width)).alias("x"), F.col("median_error").alias("y")).alias("_knot"))
    ends = knots.groupBy(*keys).agg((F.min("bin") - 1).alias("_lo"), F.max("bin").alias("_hi"))
    dense = join_on_keys(ends.withColumn("bin", F.explode(F.sequence("_lo", "_hi"))).drop("_lo", "_hi"), knots, [*keys, "bin"], how="left")
    along = Window.partitionBy(*keys).orderBy("bin")
    segments = dense.select(*keys, F.col("bin").alias("_seg"),
                            F.last("_knot", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("_a"),
                            F.first("_knot", ignorenulls=True).over(along.rowsBetween(1, Window.unboundedFollowing)).alias("_b"))
    whole = fit_shift(psm, keys, error, min_group, name="_median").select(*keys, "_median")
    every = whole.select(*keys).unionByName(ends.select(*keys)).distinct()
    return segments, join_on_keys(join_on_keys(every, ends, keys, how="left"), whole, keys, how="left")


def apply_trend(df: DataFrame, fit: tuple[DataFrame, DataFrame], group: Sequence[str], x: str, value: str, width: float,
                name: str | None = None, ppm: bool = False) -> DataFrame:
    """E4 with a `fit_trend` of the same ``width``: ``value`` less the shift interpolated between the two knots around ``x`` (beyond the first or last knot,
    that knot's); the group's median where it has no knot or x is null; unchanged where it has neither. shift and
    shift_level (bin, group or none) tell which. The two knots of a row are found by an equi-join on its segment."""
    segments, groups = fit
    keys = list(group)
    j = join_on_keys(df, groups, keys, how="left")
    seg = F.floor(F.col(x) / F.lit(width) - 0.5).cast("long")
    j = j.withColumn("_seg", F.when(F.col(x).isNotNull() & F.col("_lo").isNotNull(), F.greatest("_lo", F.least("_hi", seg))))
    j = join_on_keys(j, segments, [*keys, "_seg"], how="left")
    a, b = F.col("_a"), F.col("_b")
    between = a["y"] + (b["y"] - a["y"]) * (F.col(x) - a["x"]) / (b["x"] - a["x"])
    own = F.when(a.isNull(), b["y"]).when(b.isNull(), a["y"]).otherwise(between)
    j = j.withColumns({"shift": F.coalesce(own, "_median"), "shift_level": F.when(own.isNotNull(), "bin").when(F.col("_median").isNotNull(), "group").otherwise("none")})
    s = F.coalesce("shift", F.lit(0.0))
    return j.withColumn(name or value, F.col(value) * (1 - s * F.lit(1e-6)) if ppm else F.col(value) - s).drop("_lo", "_hi", "_seg", "_a", "_b", "_median")
