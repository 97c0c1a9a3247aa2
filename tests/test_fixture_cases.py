"""Planted cases listed in FIXTURES.md."""

import pytest
from pyspark.sql import functions as F

from ionframe.operators import design, scans, search


def test_two_passes_with_a_shared_label(spark):
    a = spark.createDataFrame([("S1", "x", "x", "Ref_S1", 1), ("S1", "Ref_S1", None, "Ref_S1", 2)],
                              "PlexID string, ReporterAlias string, MeasurementName string, Reference string, o long")
    c = spark.createDataFrame([("S1", "x", "x", "(Ref_S1 + x)/2", 3)],
                              "PlexID string, ReporterAlias string, MeasurementName string, Reference string, o long")
    out = design.combine_designs({"1A": a, "1C": c}, ["o"]).orderBy("o").collect()
    assert [(r["PlexID"], r["ReporterAlias"], r["MeasurementName"], r["Reference"]) for r in out] == [
        ("S1_1A", "x_1A", "x_1A", "Ref_S1_1A"),
        ("S1_1A", "Ref_S1_1A", None, "Ref_S1_1A"),
        ("S1_1C", "x.1_1C", "x.1_1C", "(Ref_S1_1C+x_1C)/2")]


def test_min_peaks_and_empty_spectrum(spark):
    sp = spark.createDataFrame([(1, [100.0, 200.0, 300.0], [1.0, 2.0, 3.0]), (2, [100.0], [5.0]), (3, [], [])],
                               "scan long, mz array<double>, intensity array<double>")
    assert [r["scan"] for r in search.filter_min_peaks(sp, 2).collect()] == [1]
    st = {r["scan"]: (r["tic"], r["n_peaks"]) for r in scans.scan_stats(sp).collect()}
    assert st[3] == (0.0, 0) and st[1] == (6.0, 3)


def test_tied_target_and_decoy_share_a_q_value(spark):
    df = spark.createDataFrame([(10.0, False), (9.0, False), (9.0, True), (8.0, False)], "score double, d boolean")
    q = {r["score"]: (r["cum_target"], r["cum_decoy"], r["q_value"]) for r in
         search.target_decoy_fdr(df, "score", "d").collect()}
    assert q[9.0] == (2, 1, pytest.approx(1 / 3)) and q[10.0][2] == 0.0
    assert q[8.0] == (3, 1, pytest.approx(1 / 3))


def test_ppm_edges_for_sic(spark):
    mz = 1000.0
    peaks = spark.createDataFrame([(1, mz * (1 + 9.999e-6), 1.0), (2, mz * (1 + 10.001e-6), 1.0),
                                   (3, mz * (1 - 9.999e-6), 1.0)], "pk long, mz double, rt double")
    parents = spark.createDataFrame([(7, mz, 1.0)], "pid long, pmz double, prt double")
    got = sorted(r["pk"] for r in scans.extract_sic(peaks, parents, "mz", "rt", "pmz", "prt", ppm=10.0).collect())
    assert got == [1, 3]
