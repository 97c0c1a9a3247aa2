"""Remaining operators: hits, quant linking, impurity / MS3, SIC noise, MRM,
recalibration helpers, readers and writers."""

import os

import pytest
from pyspark.sql import functions as F

from ionframe.operators import hits, quant, recalibrate, scans
from ionframe.sources import readers, writers


def test_synopsis_first_hits_maps(spark):
    psm = spark.createDataFrame([
        ("d", 1, 2, "K.PEP*TIDE.R", "P1;P2", 1e-12, 0.01), ("d", 1, 2, "K.OTHER.R", "P3", 1e-5, 0.2),
        ("d", 2, 3, "R.AAA.-", "P1", 0.5, 0.9)],
        "dataset string, scan long, charge int, peptide string, protein string, spec_evalue double, prob double")
    syn = hits.synopsis(psm, "spec_evalue", "prob", 0.02, 0.05)
    assert syn.count() == 2
    fh = hits.first_hits(psm)
    assert sorted(r["peptide"] for r in fh.collect()) == ["K.PEP*TIDE.R", "R.AAA.-"]
    clean = [r[0] for r in psm.select(hits.clean_sequence(F.col("peptide"))).collect()]
    assert clean == ["PEPTIDE", "OTHER", "AAA"]
    s2p = sorted(r["protein"] for r in hits.seq_to_protein(psm).collect())
    assert s2p == ["P1", "P1", "P2", "P3"]
    assert hits.seq_info(psm).count() == 3


def test_mod_details_summary_protein_mods_and_tags(spark):
    df = spark.createDataFrame([(1, "PS*TM#K")], "id long, peptide string")
    defs = spark.createDataFrame([("*", "S", "Phospho", 79.966331), ("#", "M", "Oxidation", 15.994915),
                                  ("", "K", "TMT", 229.1629)], "symbol string, residue string, mod_name string, mass double")
    d = hits.mod_details(df, ["id", "peptide"], "peptide", defs)
    got = sorted((r["position"], r["mod_name"]) for r in d.collect())
    assert got == [(2, "Phospho"), (4, "Oxidation"), (5, "TMT")]
    assert {r["mod_name"]: r["n"] for r in hits.mod_summary(d, ["id"]).collect()} == \
        {"Phospho": 1, "Oxidation": 1, "TMT": 1}
    mapping = spark.createDataFrame([("PS*TM#K", "P1", 10)], "peptide string, protein string, start int")
    pm = sorted(r["protein_position"] for r in hits.protein_mods(d, mapping).collect())
    assert pm == [11, 13, 14]
    tags = spark.createDataFrame([("Phosph", 79.966331), ("Sulfo", 79.956815), ("Oxidation", 15.994915)],
                                 "tag string, tmass double")
    m = spark.createDataFrame([(1, 79.9663), (2, 15.99), (3, 50.0)], "k long, mass double")
    named = {r["k"]: r["tag"] for r in hits.name_masses(m, tags, ["k"], "mass", "tmass", "tag", 0.02).collect()}
    assert named == {1: "Phosph", 2: "Oxidation"}


def test_link_attach_ascore_annotate(spark):
    psm = spark.createDataFrame([("d1", 1, "PEP"), ("d2", 5, "AAA")], "dataset string, scan long, peptide string")
    ri = spark.createDataFrame([("d1", 1, "126", 10.0), ("d1", 1, "127N", 20.0), ("d2", 5, "126", 1.0)],
                               "dataset string, scan long, channel string, intensity double")
    fr = spark.createDataFrame([("d1", "S1"), ("d2", "S2")], "Dataset string, PlexID string")
    sm = spark.createDataFrame([("S1", "126", "a"), ("S1", "127N", "b"), ("S2", "126", "c")],
                               "PlexID string, ReporterName string, MeasurementName string")
    q = quant.attach_design(quant.link_quant(psm, ri), fr, sm)
    assert sorted(r["MeasurementName"] for r in q.collect()) == ["a", "b", "c"]
    asc = spark.createDataFrame([("d1", 1, "PEP", 30.0), ("d2", 5, "AAA", 5.0)],
                                "dataset string, scan long, peptide string, ascore double")
    assert [r["peptide"] for r in quant.filter_ascore(psm, asc, 17.0).collect()] == ["PEP"]
    ann = spark.createDataFrame([("PEP", "GENE1")], "pep string, gene string")
    a = quant.annotate(psm.withColumnRenamed("peptide", "pep"), ann, "pep", species="Rattus norvegicus")
    assert sorted((r["pep"], r["gene"]) for r in a.collect()) == [("AAA", None), ("PEP", "GENE1")]
    assert quant.feature_key("pr") is not None


def test_impurity_and_ms3(spark):
    ri = spark.createDataFrame([(1, "a", 100.0), (1, "b", 50.0)], "scan long, channel string, intensity double")
    # inverse matrix: a' = 1.1a - 0.1b, b' = -0.2a + 1.0b
    m = spark.createDataFrame([("a", "a", 1.1), ("a", "b", -0.1), ("b", "a", -0.2), ("b", "b", 1.0)],
                              "channel string, source_channel string, weight double")
    got = {r["channel"]: r["corrected_intensity"] for r in scans.correct_impurity(ri, m, ["scan"]).collect()}
    assert got == pytest.approx({"a": 105.0, "b": 30.0})
    scans_df = spark.createDataFrame([("d", 3, 3, 2), ("d", 2, 2, None)], "dataset string, scan long, ms_level int, parent_scan long")
    r3 = spark.createDataFrame([("d", 3, "a", 1.0)], "dataset string, scan long, channel string, intensity double")
    assert scans.promote_ms3(r3, scans_df).first()["scan"] == 2


def test_sic_extract_noise_filter(spark):
    peaks = spark.createDataFrame([(1, 500.0, 10.0, 5.0), (2, 500.004, 12.0, 100.0), (3, 500.02, 11.0, 7.0),
                                   (4, 500.0, 30.0, 9.0)], "pk long, mz double, rt double, i double")
    parents = spark.createDataFrame([(9, 500.0, 11.0)], "pid long, pmz double, prt double")
    sic = scans.extract_sic(peaks, parents, "mz", "rt", "pmz", "prt", ppm=10.0, rt_window=5.0)
    assert sorted(r["pk"] for r in sic.collect()) == [1, 2]
    pts = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate([1, 1, 1, 1, 10, 1, 1, 1, 1])],
                                "p long, t long, i double")
    kept = scans.filter_noise(pts, ["p"], "i", "t", 0.5, 2.0)
    assert [r["i"] for r in kept.collect()] == [10.0]
    assert scans.restrict_range(pts, "t", 2, 4).count() == 3
    assert scans.restrict_range(pts, "t", 0, 0).count() == 9


def test_mrm_and_scan_stats(spark):
    peaks = spark.createDataFrame([(1, 100.0, 5.0), (1, 200.001, 2.0), (2, 100.002, 1.0)],
                                  "scan long, mz double, intensity double")
    tr = spark.createDataFrame([("t1", 100.0), ("t2", 200.0)], "transition string, transition_mz double")
    ct = {r["scan"]: (r["t1"], r["t2"]) for r in scans.mrm_crosstab(peaks, tr, ["scan"], "mz", "intensity", 0.005).collect()}
    assert ct == {1: (5.0, 2.0), 2: (1.0, None)}
    sp = spark.createDataFrame([(1, [100.0, 200.0], [5.0, 7.0])], "scan long, mz array<double>, intensity array<double>")
    r = scans.scan_stats(sp).first()
    assert (r["tic"], r["base_peak_mz"], r["n_peaks"]) == (12.0, 200.0, 2)
    info = scans.dataset_info(spark.createDataFrame([("d", 1, 1.0), ("d", 2, 3.0)], "ds string, scan long, rt double"),
                              "ds", "scan", "rt").first()
    assert (info["n_scans"], info["rt_max"]) == (2, 3.0)


def test_mass_error_and_histogram(spark):
    df = spark.createDataFrame([(501.0072764668 + 1.00335483 / 2, 2, 1000.0, 1e-12)],
                               "precursor_mz double, charge int, peptide_mass double, e double")
    r = recalibrate.mass_error_ppm(df).first()
    assert r["isotope"] == 1 and abs(r["ppm_error"]) < 0.01
    h = recalibrate.error_histogram(recalibrate.mass_error_ppm(df), "ppm_error", "e", 1e-10, 4)
    assert h.count() == 1


def test_more_readers_and_writers(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "raw")
    for sub, name in [("01_a", "x1.raw"), ("01_a", "x2.RAW"), ("02_b", "y.raw"), ("02_b", "notes.txt")]:
        os.makedirs(os.path.join(root, sub), exist_ok=True)
        open(os.path.join(root, sub, name), "w").write("z")
    files = readers.list_files(spark, root, ".raw")
    assert files.count() == 3
    with pytest.raises(ValueError):
        readers.list_files(spark, root, ".mzML")
    man = os.path.join(tmpdir_path, "man")
    for i, names in enumerate([["f1.raw", "f2.raw"], ["g1.raw"]]):
        d = os.path.join(man, f"p{i}")
        os.makedirs(d)
        open(os.path.join(d, "raw_metadata_file.txt"), "w").write("file_name\tmd5\n" + "".join(f"{n}\tx\n" for n in names))
    got = sorted(tuple(r) for r in readers.read_manifests(spark, man).collect())
    assert got == [("f1.raw", "S1"), ("f2.raw", "S1"), ("g1.raw", "S2")]
    sd = os.path.join(tmpdir_path, "sd")
    os.makedirs(sd)
    open(os.path.join(sd, "samples.txt"), "w").write(
        "PlexID\tQuantBlock\tReporterName\tReporterAlias\tMeasurementName\nS1\t1\t126\tRef_S1\tNA\n")
    open(os.path.join(sd, "references.txt"), "w").write("PlexID\tQuantBlock\tReference\nS1\t1\tRef_S1\n")
    open(os.path.join(sd, "fractions.txt"), "w").write("Dataset\tPlexID\nf1\tS1\n")
    d = readers.read_design(spark, sd)
    assert d["samples"].first()["MeasurementName"] is None and d["references"].count() == 1
    prior = os.path.join(tmpdir_path, "ratio.txt")
    open(prior, "w").write("protein_id\tS1\nP1\t0.5\nP2\tNA\n")
    assert readers.read_prior(spark, "no-prior") is None
    assert sorted(r[0] for r in readers.read_prior(spark, prior).collect()) == ["P1", "P2"]
    tags = os.path.join(tmpdir_path, "tags.txt")
    open(tags, "w").write("Acetyl  \t42.010565\t-\nPhosph\t79.966331\t-\n")
    assert [r["tag"] for r in readers.read_mass_tags(spark, tags).orderBy("mass").collect()] == ["Acetyl", "Phosph"]
    mq = os.path.join(tmpdir_path, "combined", "txt")
    os.makedirs(mq)
    open(os.path.join(mq, "evidence.txt"), "w").write("Sequence\tIntensity\nAAA\t5\n")
    open(os.path.join(mq, "Phospho (STY)Sites.txt"), "w").write("Proteins\tPosition\nP1\t3\n")
    assert readers.read_maxquant(spark, mq, "evidence").count() == 1
    assert readers.read_maxquant(spark, mq, "sites").first()["source_file"] == "Phospho (STY)Sites.txt"
    rii = spark.createDataFrame([("P1", 1.0)], "feature string, a double")
    paths = writers.write_crosstabs(rii, rii, os.path.join(tmpdir_path, "out"), "X",
                                    long=rii.withColumn("PlexID", F.lit("S1")))
    assert spark.read.parquet(paths["long"]).count() == 1
    writers.write_manifest(spark.createDataFrame([("a", "b")], "file_name string, md5 string"),
                           os.path.join(tmpdir_path, "manifest"))


def test_shift_between_knots_and_fall_back(spark):
    from ionframe.operators import recalibrate

    fit = [("d", 5.0, 1.0), ("d", 6.0, 3.0), ("d", 35.0, 10.0), ("d", 34.0, 10.0), ("d", 15.0, 99.0), ("few", 1.0, 7.0), ("few", 1.0, 9.0), ("few", 50.0, 8.0), (None, 5.0, 4.0), (None, 5.0, 4.0)]
    psm = spark.createDataFrame(fit, "ds string, rt double, err double")
    rows = [("d", 5.0, 2.0), ("d", 0.0, 2.0), ("d", 20.0, 6.0), ("d", 500.0, 10.0), ("d", -500.0, 2.0), ("few", 3.0, 8.0), ("d", None, 10.0), ("new", 5.0, None), (None, 7.0, 4.0)]
    df = spark.createDataFrame([(i, d, x, 100.0) for i, (d, x, _) in enumerate(rows)], "id int, ds string, rt double, mz double")
    model = recalibrate.fit_trend(psm, ["ds"], "err", "rt", 10.0, 2, 3)
    # bins 0 and 3 of d have two rows, so knots at 5 and 35; few has a knot at 5 of its two equal times
    got = {r.id: r for r in recalibrate.apply_trend(df, model, ["ds"], "rt", "mz", 10.0).collect()}
    assert [got[i].shift for i in range(len(rows))] == [y for _, _, y in rows]
    assert [got[i].shift_level for i in range(len(rows))] == ["bin"] * 6 + ["group", "none", "bin"]
    assert [got[i].mz for i in range(len(rows))] == [100.0 - (y or 0.0) for _, _, y in rows]
