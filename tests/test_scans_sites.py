"""Scan / chromatogram operators (SURVEY F) and site scoring (I)."""

import math

import pytest
from pyspark.sql import functions as F

from ionframe.operators import recalibrate, scans, sites


def test_reporter_ions_tolerance_edges(spark):
    ch = spark.createDataFrame([("126", 126.127726), ("127N", 127.124761)], "channel string, channel_mz double")
    peaks = spark.createDataFrame([
        (1, 126.127726 + 0.0029, 10.0), (1, 126.127726 - 0.0031, 99.0), (1, 127.124761, 5.0),
        (2, 126.127726 + 0.0031, 7.0), (2, 127.124761 - 0.001, 3.0), (2, 127.124761 + 0.002, 4.0)],
        "scan long, mz double, intensity double")
    got = sorted((r["scan"], r["channel"], r["intensity"]) for r in scans.reporter_ions(peaks, ch, ["scan"]).collect())
    assert got == [(1, "126", 10.0), (1, "127N", 5.0), (2, "127N", 4.0)]


def test_sic_trapezoid_and_bounds(spark):
    pts = [(1, float(t), v) for t, v in enumerate([0.0, 2.0, 4.0, 2.0, 0.0])]
    df = spark.createDataFrame(pts, "p long, rt double, i double")
    a = scans.trapezoid_area(df, ["p"], "rt", "i").first()
    assert a["area"] == pytest.approx(8.0) and a["apex"] == 4.0 and a["n_points"] == 5
    b = scans.peak_bounds(df, ["p"], "rt", "i").first()
    assert b["apex_x"] == 2.0 and b["fwhm"] == 2.0


def test_smooth_and_replace_zeroes(spark):
    df = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate([1, 2, 3, 4, 5])], "p long, t long, v double")
    got = sorted((r["t"], r["smoothed"]) for r in scans.smooth(df, ["p"], "t", "v", 1, key=["t"]).collect())
    assert got == [(0, 1.5), (1, 2.0), (2, 3.0), (3, 4.0), (4, 4.5)]
    z = spark.createDataFrame([(1, 0.0), (1, 3.0), (1, 2.0)], "p long, v double")
    assert sorted(r["v"] for r in scans.replace_zeroes(z, ["p"], "v").collect()) == [2.0, 2.0, 3.0]


def test_histogram_and_bins(spark):
    df = spark.createDataFrame([(float(x),) for x in range(10)], "x double")
    h = {r["bin"]: r["n"] for r in scans.histogram(df, "x", 3).collect()}
    assert h == {1: 3, 2: 3, 3: 4}
    b = {r["bin"]: r["total"] for r in scans.bin_spectra(df.withColumn("i", F.lit(1.0)), [], "x", "i", 0, 10, 5).collect()}
    assert b == {0: 5.0, 1: 5.0}


def test_compress_peaks(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.01, 1.0), (1.5, 2.0), (1.505, 2.0)], "mz double, i double")
    got = sorted((r["cluster_id"], round(r["center"], 4), r["total"]) for r in
                 scans.compress_peaks(df, [], "mz", "i", 0.05).collect())
    assert got == [(1, 1.005, 2.0), (2, 1.5025, 4.0)]


def test_observation_rate_and_constant_columns(spark):
    df = spark.createDataFrame([(i, "a", float(i), float(i % 2)) for i in range(11)], "id long, ch string, ab double, v double")
    r = scans.observation_rate(df, "ch", "v", "ab", 0.8, ["id"]).first()
    assert r["observation_rate"] == pytest.approx(5 / 11)
    c = {x["column_name"]: x["n_constant_groups"] for x in
         scans.split_constant_columns(df.withColumn("g", F.lit(1)), ["g"], ["ch", "v"]).collect()}
    assert c == {"ch": 1, "v": 0}


def test_shift_fit_and_apply(spark):
    df = spark.createDataFrame([("d1", 1.0), ("d1", 3.0), ("d1", 10.0), ("d2", 5.0)], "ds string, err double")
    fit = recalibrate.fit_shift(df, ["ds"], "err", min_rows=2)
    out = {r["ds"]: r["err"] for r in recalibrate.apply_shift(df, fit, ["ds"], "err").collect() if r["err"] != 0}
    assert out["d2"] == 5.0  # no fit: unchanged
    vals = sorted(r["err"] for r in recalibrate.apply_shift(df, fit, ["ds"], "err").where("ds = 'd1'").collect())
    assert vals == [-2.0, 0.0, 7.0]


def test_confident_threshold(spark):
    df = spark.createDataFrame([("a", 1e-11), ("a", 1e-11), ("b", 1e-11), ("b", 5e-10)], "g string, e double")
    got = {r["g"]: (r["threshold"], r["n_confident"]) for r in
           recalibrate.confident_psms(df, ["g"], "e", 1e-10, 10, 2, 2).collect()}
    assert got == {"a": (1e-10, 2), "b": (1e-9, 2)}


def test_binomial_score_exact(spark):
    df = spark.createDataFrame([(20, 7), (50, 0), (30, 30)], "n long, k long")
    got = [r["score"] for r in sites.peptide_score(df, "n", "k", 0.1).collect()]
    for (n, k), s in zip([(20, 7), (50, 0), (30, 30)], got):
        tail = sum(math.comb(n, j) * 0.1 ** j * 0.9 ** (n - j) for j in range(k, n + 1))
        assert s == pytest.approx(-10 * math.log10(tail), rel=1e-9, abs=1e-9)


def test_site_permutations_and_score(spark):
    df = spark.createDataFrame([(1, "ASTYK", 2)], "id long, seq string, k int")
    perms = sorted(tuple(r["sites"]) for r in sites.site_permutations(df, "seq", "STY", "k").collect())
    assert perms == [(2, 3), (2, 4), (3, 4)]
    scored = sites.site_permutations(df, "seq", "STY", "k").withColumn("score", F.size("sites").cast("double") +
                                                                        F.col("sites")[0].cast("double"))
    s = sites.site_score(scored, ["id"]).first()
    assert list(s["sites"]) == [3, 4] and s["ascore"] == pytest.approx(1.0)


def test_peak_depth(spark):
    df = spark.createDataFrame([(1, 10.0, 5.0), (1, 20.0, 9.0), (1, 150.0, 1.0)], "scan long, mz double, i double")
    got = sorted((r["mz"], r["depth"]) for r in sites.peak_depth(df, ["scan"], "mz", "i").collect())
    assert got == [(10.0, 2), (20.0, 1), (150.0, 1)]


def test_group_parent_ions(spark):
    parents = spark.createDataFrame([(1, 500.0, 10.0), (2, 500.03, 12.0), (3, 500.02, 40.0), (4, 700.0, 10.0),
                                     (5, 500.04, 13.0)], "pid long, mz double, rt double")
    binned = spark.createDataFrame([(1, 10, 1.0), (1, 11, 1.0), (2, 10, 1.0), (2, 11, 0.9), (3, 10, 1.0),
                                    (4, 10, 1.0), (5, 30, 1.0)], "pid long, bin long, total double")
    got = {r["pid"]: r["group_id"] for r in scans.group_parent_ions(parents, binned, "pid", "mz", "rt").collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}


def test_match_fragments_by_activation(spark):
    peaks = spark.createDataFrame([(1, "HCD", 100.04), (2, "CID", 100.4), (3, "HCD", 100.4)],
                                  "scan long, activation string, mz double")
    frags = spark.createDataFrame([(1, 100.0), (2, 100.0), (3, 100.0)], "scan long, fmz double")
    got = sorted(r["scan"] for r in sites.match_fragments(peaks, frags, ["scan"], "mz", "fmz").collect())
    assert got == [1, 2]


def test_top_ions(spark):
    df = spark.createDataFrame([(1, float(i), float(i % 3)) for i in range(10)], "scan long, i double, sn double")
    got = sorted(r["i"] for r in scans.top_ions(df, ["scan"], "i", n=3).collect())
    assert got == [5.0, 7.0, 8.0]
