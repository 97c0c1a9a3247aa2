"""Synthetic end-to-end run with planted peptides (SURVEY §5 (4)):
proteins -> decoys -> digest -> masses -> precursor candidates -> best match
per scan -> q-values -> protein inference -> reporter ions -> design ->
reference ratios -> crosstab. The planted ratios must come back."""

import math

import pytest
from pyspark.sql import functions as F

from ionframe.functions.constants import PROTON, RESIDUE_MASS
from ionframe.operators import hits, inference, quant, scans, search

# tryptic pieces: A = MSEQLR|GHIDEVANTWK|AALLR, B = AGTEVNK|FLLSPDR, C = WWR|GHIDEVANTWK|YYYR
PROTEINS = [("PROT_A", "MSEQLRGHIDEVANTWKAALLR"), ("PROT_B", "AGTEVNKFLLSPDR"), ("PROT_C", "WWRGHIDEVANTWKYYYR")]
CHANNELS = [("126", 126.127726), ("127N", 127.124761)]


def _peptide_mass(seq):
    return sum(RESIDUE_MASS[a] for a in seq) + 18.0105646837


def test_planted_peptides_are_quantified(spark):
    prot = spark.createDataFrame(PROTEINS, "accession string, sequence string")
    db = search.add_decoys(prot)
    peps = search.digest(db, ["accession", "is_decoy"], "sequence", min_len=5, max_missed=0)
    peps = search.peptide_mass(peps, "peptide", RESIDUE_MASS, name="pmass")
    planted = {"GHIDEVANTWK": 2.0, "AGTEVNK": 0.5, "FLLSPDR": 1.0}  # peptide -> 127N / 126 ratio
    spectra, peaks = [], []
    for scan, (pep, ratio) in enumerate(sorted(planted.items()), start=1):
        mz = (_peptide_mass(pep) + 2 * PROTON) / 2 * (1 + 3e-6)
        spectra.append(("ds1", scan, mz, 2))
        peaks += [("ds1", scan, 126.127726 + 0.001, 1000.0), ("ds1", scan, 127.124761 - 0.001, 1000.0 * ratio),
                  ("ds1", scan, 300.0, 5.0)]
    spectra.append(("ds1", 99, 777.7, 2))  # nothing matches this one
    spec = spark.createDataFrame(spectra, "dataset string, scan long, precursor_mz double, charge int")
    cand = search.match_candidates(spec, peps.select("peptide", "accession", "is_decoy", "pmass"),
                                   "precursor_mz", "charge", "pmass", 20.0, isotopes=(0,))
    cand = cand.withColumn("score", -F.abs(F.col("_obs_mass") - F.col("pmass")))
    best = hits.first_hits(cand, ["dataset", "scan"], "score", lower_is_better=False, tiebreak=["accession"])
    q = search.target_decoy_fdr(best, "score", "is_decoy")
    psm = best.join(q.select("score", "q_value"), on="score").where((F.col("q_value") <= 0.01) & ~F.col("is_decoy"))
    assert sorted(r["peptide"] for r in psm.collect()) == sorted(planted)

    # protein inference on the identified peptides: PROT_A and PROT_C share GHIDEVANTWK
    edges = psm.select("peptide", F.col("accession").alias("protein"))
    edges = edges.join(peps.where(~F.col("is_decoy")).select("peptide", F.col("accession").alias("protein")),
                       on=["peptide", "protein"], how="full").join(psm.select("peptide").distinct(), on="peptide")
    cover = {r["peptide"]: r["protein"] for r in inference.greedy_cover(edges).collect()}
    assert cover == {"GHIDEVANTWK": "PROT_A", "AGTEVNK": "PROT_B", "FLLSPDR": "PROT_B"}

    # reporter ions, design, ratios
    pk = spark.createDataFrame(peaks, "dataset string, scan long, mz double, intensity double")
    ch = spark.createDataFrame(CHANNELS, "channel string, channel_mz double")
    ri = scans.reporter_ions(pk, ch, ["dataset", "scan"])
    linked = quant.link_quant(psm.select("dataset", "scan", "peptide"), ri)
    fractions = spark.createDataFrame([("ds1", "S1")], "Dataset string, PlexID string")
    samples = spark.createDataFrame([("S1", 1, "126", "Ref_S1", None), ("S1", 1, "127N", "sampleA", "sampleA")],
                                    "PlexID string, QuantBlock int, ReporterName string, ReporterAlias string, "
                                    "MeasurementName string")
    refs = spark.createDataFrame([("S1", 1, "Ref_S1")], "PlexID string, QuantBlock int, Reference string")
    q2 = quant.attach_design(linked, fractions, samples)
    long = quant.aggregate_intensity(q2, ["peptide"], "PlexID", "ReporterAlias", "intensity")
    ratios = quant.eval_reference(long, refs, ["peptide"], "PlexID", "ReporterAlias")
    ct = quant.ratio_crosstab(ratios, samples.withColumn("ReporterName", F.col("ReporterAlias")), ["peptide"],
                              "PlexID", "ReporterAlias", digits=6)
    got = {r["peptide"]: r["sampleA"] for r in ct.collect()}
    assert got == {p: pytest.approx(round(math.log2(v), 6)) for p, v in planted.items()}
