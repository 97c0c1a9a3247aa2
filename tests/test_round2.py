"""Cases in which earlier versions gave wrong or incomplete results."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from ionframe.functions.constants import PROTON, RESIDUE_MASS, WATER
from ionframe.functions.presets import PRESETS
from ionframe.operators import hits, quant, runs, scans, search, sites
from ionframe.sources import readers


def pieces(seq):
    out, cur = [], ""
    for i, c in enumerate(seq):
        cur += c
        if c in "KR" and not (i + 1 < len(seq) and seq[i + 1] == "P") and i + 1 < len(seq):
            out.append(cur)
            cur = ""
    return out + [cur]


def brute_digest(seq, lo, hi, missed=None):
    p = pieces(seq)
    starts = [sum(map(len, p[:i])) + 1 for i in range(len(p))]
    return sorted((starts[i], j - i, "".join(p[i:j + 1])) for i in range(len(p)) for j in range(i, len(p))
                  if lo <= len("".join(p[i:j + 1])) <= hi and (missed is None or j - i <= missed))


def test_digest_has_no_limit_and_keeps_rows_apart(spark):
    rnd = random.Random(2)
    long = "".join(rnd.choice("AEGKLPRSTV") for _ in range(6000))
    seqs = ["AAAAAAKCCCCCCKDDDDDDKEEEEEEKFFFFFF", "AAAAAAKEEEEEEK", "GGGGGGKTTTTTTK", long, "", None, "K"]
    df = spark.createDataFrame([("P1", s) for s in seqs], "acc string, seq string")
    got = sorted((r.start, r.missed_cleavages, r.peptide) for r in search.digest(df, ["acc"], "seq", max_len=30).collect())
    assert got == sorted(x for s in seqs if s for x in brute_digest(s, 6, 30))
    two = sorted((r.start, r.missed_cleavages, r.peptide) for r in search.digest(df, ["acc"], "seq", max_missed=1).collect())
    assert two == sorted(x for s in seqs if s for x in brute_digest(s, 6, 50, 1))


def test_first_met_is_considered_both_ways(spark):
    df = spark.createDataFrame([("P", "MAAAAAKCCCCCCK")], "acc string, seq string")
    got = sorted((r.start, r.peptide) for r in search.digest(df, ["acc"], "seq", drop_first_met=True).collect())
    assert got == [(1, "MAAAAAK"), (1, "MAAAAAKCCCCCCK"), (2, "AAAAAK"), (2, "AAAAAKCCCCCCK"), (8, "CCCCCCK")]


def test_semi_specific_digest_over_chunks(spark):
    rnd = random.Random(3)
    seq = "".join(rnd.choice("AEGKLPRSTV") for _ in range(2300))
    cuts = {0, len(seq)}
    for p in itertools.accumulate(map(len, pieces(seq))):
        cuts.add(p)
    want = sorted((b + 1, sum(b < c < e for c in cuts), (b in cuts) + (e in cuts), seq[b:e])
                  for b in range(len(seq)) for e in range(b + 6, min(b + 9, len(seq)) + 1) if (b in cuts) + (e in cuts) >= 1)
    df = spark.createDataFrame([("P", seq)], "acc string, seq string")
    got = search.digest_nonspecific(df, ["acc"], "seq", 1, max_len=9).collect()
    assert sorted((r.start, r.missed_cleavages, r.ntt, r.peptide) for r in got) == want


def test_unknown_residues_have_no_mass(spark):
    df = spark.createDataFrame([("PEPXIDEK",), ("PEPTIDEK",)], "peptide string")
    got = {r.peptide: r.mass for r in search.peptide_mass(df, "peptide", RESIDUE_MASS).collect()}
    assert got["PEPXIDEK"] is None and got["PEPTIDEK"] == pytest.approx(sum(RESIDUE_MASS[c] for c in "PEPTIDEK") + WATER)
    fr = search.theoretical_fragments(df, "peptide", RESIDUE_MASS, ["peptide"]).collect()
    assert {r.peptide for r in fr} == {"PEPTIDEK"} and len(fr) == 7


def test_several_kinds_of_modification(spark):
    df = spark.createDataFrame([("MKNK", 0.0), ("MKNK", 0.0), ("", 0.0)], "peptide string, mass double")
    kinds = [("M", 16.0), ("K", 100.0), ("K", 200.0), ("N", 1.0)]
    got = sorted((tuple(r.sites), tuple(r.site_deltas), r.mass) for r in search.expand_mods(df, "peptide", kinds, max_mods=2).collect())
    options = [(i + 1, d) for i, c in enumerate("MKNK") for r, d in kinds if c in r]
    forms = [c for n in range(3) for c in itertools.combinations(options, n) if len({i for i, _ in c}) == n]
    want = sorted((tuple(i for i, _ in c), tuple(d for _, d in c), sum(d for _, d in c)) for c in forms for _ in range(2))
    assert got == sorted(want + [((), (), 0.0)])
    few = search.expand_mods(df.limit(2), "peptide", kinds, max_mods=2, max_forms=3).collect()
    assert len(few) == 6


def test_uneven_tolerances(spark):
    sp = spark.createDataFrame([(i, 500.0 + d + PROTON, 1) for i, d in enumerate((-0.6, -0.4, 1.9, 2.1))], "id long, mz double, z int")
    pep = spark.createDataFrame([("A", 500.0)], "p string, m double")
    got = search.match_candidates(sp, pep, "mz", "z", "m", (0.5, 2.0), (0,), ppm=False).collect()
    assert sorted(r.id for r in got) == [1, 2]
    got = search.match_candidates(sp, pep, "mz", "z", "m", (1000.0, 4000.0), (0,)).collect()
    assert sorted(r.id for r in got) == [1, 2]


def test_planted_phospho_site_is_found_from_a_preset(spark):
    """Protein to localized site, with a preset's modifications."""
    preset = PRESETS["ph-lf"]
    prot = spark.createDataFrame([("P1", "MAAGKLSVTEYAVPLKGGGGGGGR")], "accession string, sequence string")
    peps = search.preset_peptides(prot, preset, RESIDUE_MASS)
    seq, site, delta = "LSVTEYAVPLK", 4, dict([(preset.variable[0][0], preset.variable[0][1])])["STY"]
    mass = sum(RESIDUE_MASS[c] for c in seq) + WATER + delta
    spectra = spark.createDataFrame([("ds", 1, (mass + 2 * PROTON) / 2, 2)], "dataset string, scan long, precursor_mz double, charge int")
    found = search.preset_search(spectra, peps, preset)
    top = found.where(F.size("sites") == 1).select("dataset", "scan", "peptide", F.lit(1).alias("n_mods")).distinct()
    assert [r.peptide for r in top.collect()] == [seq]
    res = [RESIDUE_MASS[c] + (delta if i + 1 == site else 0) for i, c in enumerate(seq)]
    ions = [sum(res[:i]) + PROTON for i in range(1, len(seq))] + [sum(res[i:]) + WATER + PROTON for i in range(1, len(seq))]
    rnd = random.Random(1)
    peaks = [("ds", 1, mz + 0.002, 1000.0 + i) for i, mz in enumerate(ions)] + [("ds", 1, rnd.uniform(100, 1200), rnd.uniform(1, 50)) for _ in range(60)]
    pk = spark.createDataFrame([(*p, "HCD") for p in peaks], "dataset string, scan long, mz double, intensity double, activation string")
    loc = sites.localize(top.drop("dataset"), pk.drop("dataset"), ["scan"], "peptide", "STY", "n_mods", delta, RESIDUE_MASS)
    r = loc.first()
    assert r.sites == [site] and r.ascore > 19 and r.best_score > 50
    where = hits.protein_mods(loc.select("scan", F.lit(seq).alias("peptide"), F.col("sites")[0].alias("position")),
                              peps.where("size(sites) = 0").select("peptide", "accession", "start"))
    assert [x.protein_position for x in where.where(F.col("peptide") == seq).collect()] == [9]


def brute_tail(n, k, p):
    return -10 * math.log10(sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k, n + 1))) if k > 0 else 0.0


def test_localize_equals_brute_force(spark):
    rnd = random.Random(7)
    res = {"A": 71.0, "S": 87.0, "T": 101.0, "K": 128.0}
    rows, peaks = [], []
    for scan in range(6):
        seq = "".join(rnd.choice("AASTK") for _ in range(7)) + "S"
        rows.append((scan, seq, 1))
        for _ in range(40):
            peaks.append((scan, round(rnd.uniform(60, 900), 2), float(rnd.randint(1, 99)), rnd.choice(["CID", "HCD", None, "XYZ"][scan % 4:scan % 4 + 1])))
    df = spark.createDataFrame(rows, "scan long, pep string, n int")
    pk = spark.createDataFrame(peaks, "scan long, mz double, intensity double, activation string")
    got = {r.scan: r for r in sites.localize(df, pk, ["scan"], "pep", "ST", "n", 80.0, res).collect()}
    for scan, seq, _ in rows:
        own = [p for p in peaks if p[0] == scan]
        tol = 0.05 if own[0][3] == "HCD" else 0.5
        depth = {}
        for p in own:
            same = sorted((q for q in own if int(q[1] // 100) == int(p[1] // 100)), key=lambda q: (-q[2], q[1]))
            depth[p[1], p[2]] = same.index(p) + 1
        place = {}
        for i, c in enumerate(seq):
            if c in "ST":
                m = [res[x] + (80.0 if j == i else 0) for j, x in enumerate(seq)]
                ions = {("b", k): sum(m[:k]) + PROTON for k in range(1, len(seq))} | {("y", k): sum(m[k:]) + WATER + PROTON for k in range(1, len(seq))}
                place[i + 1] = {k: (v, min((depth[p[1], p[2]] for p in own if abs(p[1] - v) <= tol and depth[p[1], p[2]] <= 10), default=999)) for k, v in ions.items()}
        score = {s: [brute_tail(len(x), sum(d <= k for _, d in x.values()), min(2 * tol * k / 100, 0.999)) for k in range(1, 11)] for s, x in place.items()}
        mean = {s: sum(a * w for a, w in zip(v, sites.DEPTH_WEIGHTS)) / sum(sites.DEPTH_WEIGHTS) for s, v in score.items()}
        order = sorted(mean, key=lambda s: (-round(mean[s], 9), s))
        r = got[scan]
        assert r.sites == [order[0]] and r.best_score == pytest.approx(mean[order[0]], abs=1e-6)
        if len(order) > 1:
            a, b = order[:2]
            at = min(range(10), key=lambda k: (-round(score[a][k] - score[b][k], 9), k)) + 1
            own_ions = [k for k in place[a] if abs(place[a][k][0] - place[b][k][0]) > 1e-6]
            p = min(2 * tol * at / 100, 0.999)
            want = brute_tail(len(own_ions), sum(place[a][k][1] <= at for k in own_ions), p) - brute_tail(len(own_ions), sum(place[b][k][1] <= at for k in own_ions), p)
            assert r.depth == at and r.ascore == pytest.approx(want, abs=1e-6)


def test_peaks_of_any_activation_are_matched(spark):
    pk = spark.createDataFrame([(1, 100.3, None), (1, 100.3, "EThcD"), (1, 100.3, "HCD")], "k long, mz double, activation string")
    fr = spark.createDataFrame([(1, 100.0)], "k long, fmz double")
    got = sites.match_fragments(pk, fr, ["k"], "mz", "fmz").collect()
    assert sorted(str(r.activation) for r in got) == ["EThcD", "None"] and {r.tolerance for r in got} == {0.5}


def test_ions_of_two_datasets_stay_apart(spark):
    p = spark.createDataFrame([("ds1", 1, 500.0, 1.0), ("ds1", 2, 500.01, 1.0), ("ds2", 1, 500.0, 1.0), ("ds2", 3, 500.0, 1.0)], "ds string, id long, mz double, rt double")
    b = spark.createDataFrame([(d, i, k, 1.0 + k) for d, i in (("ds1", 1), ("ds1", 2), ("ds2", 1)) for k in range(3)] + [("ds2", 3, 9, 1.0)], "ds string, id long, bin long, total double")
    got = sorted(tuple(r) for r in scans.group_parent_ions(p, b, "id", "mz", "rt", keys=["ds"]).collect())
    assert got == [("ds1", 1, 1), ("ds1", 2, 1), ("ds2", 1, 1), ("ds2", 3, 3)]


def test_a_second_peak_does_not_widen_the_first(spark):
    pts = [(1, float(t), v) for t, v in enumerate([0.0, 0.0, 10.0, 0.0, 0.0, 0.0, 0.0, 0.0, 9.0, 0.0])]
    r = scans.peak_bounds(spark.createDataFrame(pts, "p long, x double, y double"), ["p"], "x", "y").first()
    assert (r.apex_x, r.left_x, r.right_x, r.fwhm) == (2.0, 1.5, 2.5, 1.0) and r.area == pytest.approx(7.5)


def test_channels_outside_the_matrix_keep_their_value(spark):
    ri = spark.createDataFrame([(1, "a", 5.0), (1, "z", 7.0), (None, "a", 2.0)], "k long, channel string, intensity double")
    m = spark.createDataFrame([("a", "a", 2.0)], "channel string, source_channel string, weight double")
    got = {(r.k, r.channel): r.corrected_intensity for r in scans.correct_impurity(ri, m, ["k"]).collect()}
    assert got == {(1, "a"): 10.0, (1, "z"): 7.0, (None, "a"): 4.0}


def test_null_abundances_count(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("a", 1.0, None), ("a", None, 1.0), ("a", None, None)], "ch string, v double, ab double")
    r = scans.observation_rate(df, "ch", "v", "ab").first()
    assert r.n == 4 and r.observation_rate == 0.5


def test_smoothing_keeps_points_of_one_time_apart(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 1, 4.0), (1, 2, 6.0)], "p long, t long, v double")
    assert sorted(r.smoothed for r in scans.smooth(df, ["p"], "t", "v", 1).collect()) == [3.0, 4.0, 5.0]


def test_neighbours_over_range_borders(spark):
    rows = [(g, i, float(i * i % 37)) for g in range(3) for i in range(120)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.g, r.t): r.smoothed for r in scans.smooth(spark.createDataFrame(rows, "g long, t long, v double"), ["g"], "t", "v", 3).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for g, t, _ in rows:
        near = [float(i * i % 37) for i in range(max(0, t - 3), min(119, t + 3) + 1)]
        assert got[g, t] == pytest.approx(sum(near) / len(near))


def test_two_references_of_a_plex_are_averaged(spark):
    long = spark.createDataFrame([("f", "S1", "a", 8.0), ("f", "S1", "r1", 2.0), ("f", "S1", "r2", 6.0)], "f string, plex string, ch string, intensity double")
    refs = spark.createDataFrame([("S1", "r1"), ("S1", "r2")], "PlexID string, Reference string")
    got = {r.ch: r.log2_ratio for r in quant.eval_reference(long, refs, ["f"], "plex", "ch").collect()}
    assert got == {"a": 1.0, "r1": -1.0, "r2": pytest.approx(math.log2(1.5))}


def test_headers_decide_columns(spark, tmp_path):
    (tmp_path / "x.txt").write_text("foo\tbar\n1\t2\n")
    with pytest.raises(ValueError, match="missing required"):
        readers.read_tsv(spark, str(tmp_path / "x.txt"), "a int, b int", ["a", "b"])
    (tmp_path / "y.txt").write_text("b\ta\n2\t1\nx\tNA\n")
    got = readers.read_tsv(spark, str(tmp_path / "y.txt"), "a int, b int", ["a", "b"]).collect()
    assert sorted(map(tuple, got), key=str) == [(1, 2), (None, None)]


def test_dead_runs_miss_their_outputs(spark):
    att = spark.createDataFrame([("r1", "t1", "Done", {"k": "f"}), ("r2", "t0", "Failed", {"k": "f"})], "id string, task string, status string, outputs map<string,string>")
    wanted = spark.createDataFrame([("t1", "k")], "task string, key string")
    listed = spark.createDataFrame([("r1",), ("r2",), ("r3",)], "id string")
    got = sorted((r.id, r.task, r.key, r.reason) for r in runs.missing_outputs(att, wanted, runs=listed).collect())
    assert got == [("r2", "t1", "k", "task not run"), ("r3", "t1", "k", "task not run")]


def test_substring_map_with_supplementary_characters(spark):
    seqs = {"a": "xx\U0001f600abc\U0001f600abcd", "b": "abcabcab", "c": "", "d": None}
    df = spark.createDataFrame(list(seqs.items()), "accession string, sequence string")
    peps = ["abc", "ab", "\U0001f600a", "abcd", "zzz"]
    got = sorted(tuple(r) for r in hits.map_peptides_substring(spark.createDataFrame([(p,) for p in peps], "peptide string"), df, k=3).collect())
    want = sorted((p, k, i + 1) for p in peps for k, s in seqs.items() if s for i in range(len(s)) if s[i:i + len(p)] == p)
    assert got == want
