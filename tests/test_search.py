"""Search operators (SURVEY D)."""

import itertools
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ionframe.functions.constants import ELEMENT_MASS
from ionframe.operators import search


def test_composition_mass(spark):
    df = spark.createDataFrame([("C2H3N1O1",), ("H-1N-1O1",), ("HO3P",), ("79.966331",)], "c string")
    got = [r[0] for r in df.select(search.composition_mass(F.col("c"))).collect()]
    m = ELEMENT_MASS
    assert got[0] == pytest.approx(2 * m["C"] + 3 * m["H"] + m["N"] + m["O"])
    assert got[1] == pytest.approx(-m["H"] - m["N"] + m["O"])
    assert got[2] == pytest.approx(m["H"] + 3 * m["O"] + m["P"])
    assert got[3] == pytest.approx(79.966331)


def test_trypsin_digest(spark):
    df = spark.createDataFrame([("P1", "MAKPEPTIDERAAAAAAKLLLLLLR")], "acc string, seq string")
    got = sorted((r["start"], r["missed_cleavages"], r["peptide"])
                 for r in search.digest(df, ["acc"], "seq", min_len=6, max_len=50, max_missed=1).collect())
    # cuts after K/R not before P: MAKPEPTIDER | AAAAAAK | LLLLLLR
    assert got == [(1, 0, "MAKPEPTIDER"), (1, 1, "MAKPEPTIDERAAAAAAK"), (12, 0, "AAAAAAK"),
                   (12, 1, "AAAAAAKLLLLLLR"), (19, 0, "LLLLLLR")]


def test_decoys(spark):
    df = spark.createDataFrame([("P1", "ABC")], "accession string, sequence string")
    got = sorted(tuple(r) for r in search.add_decoys(df).collect())
    assert got == [("P1", "ABC", False), ("XXX_P1", "CBA", True)]


def test_expand_mods_counts(spark):
    df = spark.createDataFrame([("STSYK", 100.0)], "peptide string, mass double")
    out = search.expand_mods(df, "peptide", "STY", 79.966331, max_mods=2)
    # eligible 4 positions: 1 + 4 + 6 forms
    assert out.count() == 11
    assert search.expand_mods(df, "peptide", "STY", 79.966331, max_mods=3, max_forms=5).count() == 5


def test_target_decoy_q_values_against_pandas(spark):
    rnd = random.Random(3)
    rows = [(float(rnd.randint(0, 40)), rnd.random() < 0.3) for _ in range(500)]
    df = spark.createDataFrame(rows, "score double, is_decoy boolean")
    got = {r["score"]: r["q_value"] for r in search.target_decoy_fdr(df, "score", "is_decoy").collect()}
    p = pd.DataFrame(rows, columns=["score", "d"]).groupby("score")["d"].agg(["sum", "count"]).sort_index(ascending=False)
    cd = p["sum"].cumsum()
    ct = (p["count"] - p["sum"]).cumsum()
    fdr = cd / ct.clip(lower=1)
    q = fdr[::-1].cummin()[::-1]
    for s, v in q.items():
        assert got[s] == pytest.approx(v)
    qs = [got[s] for s in sorted(got, reverse=True)]
    assert all(a <= b + 1e-12 for a, b in zip(qs, qs[1:]))  # monotone


def test_fragments_and_match(spark):
    masses = {"A": 71.03711, "G": 57.02146}
    df = spark.createDataFrame([(1, "GAG")], "id long, seq string")
    fr = sorted((r["pos"], round(r["b_ion"], 5), round(r["y_ion"], 5))
                for r in search.theoretical_fragments(df, "seq", masses, ["id"]).collect())
    assert fr[0][0] == 1 and fr[0][1] == pytest.approx(57.02146 + 1.007276, abs=1e-4)
    assert len(fr) == 2


def test_match_candidates_isotope_and_charge(spark):
    pep_mass = 1000.0
    mz2 = pep_mass / 2 + 1.007276466812
    spec = spark.createDataFrame([(1, mz2, 2), (2, (pep_mass + 1.00335483) / 2 + 1.007276466812, None)],
                                 "scan long, precursor_mz double, charge int")
    peps = spark.createDataFrame([("PEP", pep_mass)], "peptide string, pmass double")
    got = sorted((r["scan"], r["_iso"], r["_z"]) for r in
                 search.match_candidates(spec, peps, "precursor_mz", "charge", "pmass", 20.0).collect())
    assert (1, 0, 2) in got and (2, 1, 2) in got


def test_binomial_log_choose():
    from ionframe.functions.stats import log_choose  # noqa: F401 (import check)
    assert math.comb(10, 3) == 120


def test_semi_specific_digest_against_python(spark):
    seq = "AAKPBBBBRCCCCCCKDDDDDDD"
    df = spark.createDataFrame([("P", seq)], "acc string, seq string")
    got = {(r["start"], r["peptide"], r["ntt"]) for r in
           search.digest_nonspecific(df, ["acc"], "seq", ntt=1, min_len=6, max_len=10).collect()}
    cuts = {0, len(seq)} | {i + 1 for i, c in enumerate(seq[:-1]) if c in "KR" and seq[i + 1] != "P"}
    exp = set()
    for b in range(len(seq)):
        for e in range(b + 6, min(b + 10, len(seq)) + 1):
            n = (b in cuts) + (e in cuts)
            if n >= 1:
                exp.add((b + 1, seq[b:e], n))
    assert got == exp
    full = {(r["start"], r["peptide"]) for r in search.digest(df, ["acc"], "seq", min_len=6, max_len=10,
                                                              max_missed=5).collect()}
    assert full == {(s, p) for s, p, n in exp if n == 2}


def test_semi_specific_digest_after_the_first_methionine(spark):
    seqs = {"P": "MAAKPBBBBRCCCCCCKDDDDDDD", "Q": "MKAAAAAAAR", "R": "AMAAAAAAK", "S": "M" * 9, "T": "M" + "AK" * 400 + "CCCCCCC"}
    df = spark.createDataFrame(list(seqs.items()), "acc string, seq string")
    for drop in (False, True):
        exp = set()
        for acc, seq in seqs.items():
            ends = {0, len(seq)} | {i + 1 for i, c in enumerate(seq[:-1]) if c in "KR" and seq[i + 1] != "P"}
            starts = ends | ({1} if drop and seq[0] == "M" else set())
            exp |= {(acc, b + 1, sum(b < x < e for x in ends), (b in starts) + (e in ends), seq[b:e]) for b in range(len(seq))
                    for e in range(b + 6, min(b + 10, len(seq)) + 1) if (b in starts) + (e in ends) >= 1}
        got = search.digest_nonspecific(df, ["acc"], "seq", 1, max_len=10, drop_first_met=drop)
        assert sorted(map(tuple, got.collect())) == sorted(exp)


def test_digest_over_many_runs(spark):
    rnd = random.Random(9)
    seqs = {f"P{n}": "".join(rnd.choice("AKRPCDE\U0001f600") for _ in range(n)) for n in (0, 1, 5, 6, 255, 256, 257, 300, 1500)}
    seqs["M"] = "M" + seqs["P300"]
    df = spark.createDataFrame([(a, s, 1) for a, s in seqs.items()], "acc string, seq string, start int")
    exp = []
    for acc, seq in seqs.items():
        cuts = sorted({0, len(seq)} | {i + 1 for i, c in enumerate(seq[:-1]) if c in "KR" and seq[i + 1] != "P"})
        for i, b in enumerate(cuts):
            for j, e in enumerate(cuts[i + 1:]):
                forms = [b] + ([1] if b == 0 and seq[0] == "M" else [])
                exp += [(acc, f + 1, j, seq[f:e]) for f in forms if 6 <= e - f <= 50 and j <= 4]
    assert sorted(map(tuple, search.digest(df, ["acc"], "seq", max_missed=4, drop_first_met=True).collect())) == sorted(exp)


def test_semi_specific_digest_short_sequences(spark):
    df = spark.createDataFrame([("P", "AAK"), ("Q", "")], "acc string, seq string")
    assert search.digest_nonspecific(df, ["acc"], "seq", ntt=0, min_len=6).count() == 0


def test_search_equals_matching_then_scoring(spark):
    rnd = random.Random(6)
    mass = {c: 50.0 + 7.013 * i for i, c in enumerate("ACDEFGHK")}
    seqs = sorted({"".join(rnd.choice("ACDEFGHK") for _ in range(7)) for _ in range(300)} | {"AACDEFK", "ACADEFK", "CAADEFK"})
    pep = search.peptide_mass(spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "pid long, peptide string"), "peptide", mass)
    masses = {r.pid: r.mass for r in pep.collect()}
    spectra = [(i, m / 2 + 1.007276466812 + rnd.uniform(-1, 1) * 1e-6 * m, 2 if i % 3 else None) for i, m in masses.items()]
    peaks = [(i, rnd.choice([50, 90, 140, 230, 300]) + rnd.random() * 60, float(rnd.randint(1, 50))) for i in masses for _ in range(25)]
    peaks += [(i, sum(mass[c] for c in seqs[i][:k]) + 1.0073, 30.0) for i in masses for k in range(1, 7)]
    sp = spark.createDataFrame(spectra, "scan long, precursor_mz double, charge int")
    pk = spark.createDataFrame(peaks, "scan long, mz double, intensity double")
    got = search.search_spectra(sp, pk, pep, ["scan"], ["pid"], "peptide", mass, 2, isotopes=(-1, 0, 1), charges=(1, 2), frag_tol=0.05, frag_charges=(1, 2))
    cand = search.match_candidates(sp, pep, "precursor_mz", "charge", "mass", 20.0, (-1, 0, 1), (1, 2)).select(
        "scan", F.col("_z").alias("z"), F.col("_iso").alias("iso"), "pid", "peptide")
    fr = search.theoretical_fragments(cand, "peptide", mass, ["scan", "z", "iso", "pid"], charges=(1, 2))
    fr = fr.select("scan", "z", "iso", "pid", F.explode(F.array("b_ion", "y_ion")).alias("frag"))
    cp = cand.select("scan", "z", "iso", "pid").join(pk, on="scan")
    scored = search.score_matches(cp, fr, ["scan", "z", "iso", "pid"], "mz", "intensity", "frag", 0.05).collect()
    want = {}
    for r in scored:
        want.setdefault(r.scan, []).append((-round(r.hyperscore, 9), abs(r.iso), r.iso, r.z, r.pid, r.n_matched, r.matched_intensity))
    want = sorted((s, i + 1, x[4], x[3], x[2], x[5], round(x[6], 6)) for s, xs in want.items() for i, x in enumerate(sorted(xs)[:2]))
    assert sorted((r.scan, r.rn, r.pid, r.charge, r.isotope, r.n_matched, round(r.matched_intensity, 6)) for r in got.collect()) == want
    assert sum(r.rn == 1 and r.pid == r.scan for r in got.collect()) > 0.8 * len(seqs)


def test_forms_of_many_sites(spark):
    df = spark.createDataFrame([("S" * 40 + "K", 1.0), ("AAA", 2.0), ("", 3.0)], "peptide string, mass double")
    out = search.expand_mods(df, "peptide", [("S", 80.0), ("SK", 1.0)], max_mods=3)
    # two kinds at each S, one at K: the sums of products over at most three positions
    ways = sum(sum(math.prod(c) for c in itertools.combinations([2] * 40 + [1], m)) for m in range(4))
    n = out.agg(F.count("*"), F.count_distinct("peptide", "sites", "site_deltas")).first()
    assert n[0] == n[1] == ways + 2
    assert out.where("size(sites) > 3 or mass <> 1 + aggregate(site_deltas, 0D, (a, x) -> a + x) and peptide like 'S%'").count() == 0
    few = search.expand_mods(df, "peptide", [("S", 80.0), ("SK", 1.0)], max_mods=2, max_forms=200)
    assert few.where("peptide like 'S%'").count() == 200
    want = out.where("size(sites) <= 2 and peptide like 'S%'").selectExpr("struct(size(sites) n, sites, site_deltas) f").orderBy("f").limit(200).collect()
    assert [tuple(r.f) for r in want] == sorted((len(r.sites), r.sites, r.site_deltas) for r in few.where("peptide like 'S%'").collect())
