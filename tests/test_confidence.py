"""Isotonic regression, error probabilities, competition and chromatogram peaks against sequential and brute-force versions."""

import random

import pytest
from pyspark.sql import functions as F

from ionframe.operators import confidence, ordered, scans


def plain_isotonic(points):
    """Largest over the starts of the smallest mean over the ends, for (order, sum, weight) in order."""
    def mean(a, b):
        return sum(p[1] for p in points[a:b + 1]) / sum(p[2] for p in points[a:b + 1])

    n = len(points)
    return [max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]


@pytest.mark.parametrize("chunk", [4, 7, 1000])
@pytest.mark.parametrize("descending", [False, True])
def test_isotonic_equals_max_min(spark, chunk, descending):
    rnd = random.Random(chunk)
    groups = {"falling": [(i, 60 - i, 60) for i in range(50)], "rising": [(i, i, 60) for i in range(40)],
              "noise": [(i, rnd.randint(0, 9), 9 + i % 3) for i in range(60)], "late": [(i, i, 1) for i in range(30)] + [(30, 0, 500)],
              None: [(3, 1, 2), (9, 1, 2)], "one": [(5, 0, 3)]}
    rows = [(g, x, y, w) for g, ps in groups.items() for x, y, w in ps]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x int, y long, w long").repartition(5)
    got = {(r.g, r.x): r.fit for r in confidence.isotonic(df, "x", "y", "w", ["g"], descending, chunk_rows=chunk).collect()}
    assert len(got) == len(rows)
    for g, ps in groups.items():
        ps = sorted(ps, reverse=descending)
        assert [got[g, p[0]] for p in ps] == plain_isotonic(ps)


def test_isotonic_without_place_or_rows(spark):
    df = spark.createDataFrame([(1.0, 1, 2), (1.0, 1, 2), (2.0, 0, 4), (None, 5, 5), (float("nan"), 5, 5)], "x double, y long, w long")
    got = confidence.isotonic(df, "x", "y", "w").select("x", "fit").collect()
    assert sorted((str(r.x), r.fit) for r in got) == [("1.0", 0.25), ("1.0", 0.25), ("2.0", 0.25), ("None", None), ("nan", None)]
    assert confidence.isotonic(df.limit(0), "x", "y", "w").count() == 0
    with pytest.raises(ValueError, match="twice"):
        confidence.isotonic(df, "x", "y", "w", chunk_rows=3)


def test_error_probability_rises_and_is_bounded(spark):
    rows = [(100 - i // 4, i % 7 == 0 or i > 150) for i in range(200)] + [(None, True), (50, None)]
    df = spark.createDataFrame(rows, "s int, d boolean")
    got = confidence.error_probability(df, "s", "d").orderBy(F.desc("s")).collect()
    assert sum(r.n_target + r.n_decoy for r in got) == 200
    ps = [r.error_probability for r in got]
    assert ps == sorted(ps) and ps[-1] == 1.0 and 0 <= ps[0] < 0.5
    low = confidence.error_probability(df.withColumn("s", -F.col("s")), "s", "d", higher_is_better=False)
    assert sorted(r.error_probability for r in low.collect()) == ps


def test_competition(spark):
    rows = [("A", 5.0, False), ("XXX_A", 4.0, True), ("B", 1.0, False), ("XXX_B", 2.0, True), ("C", 3.0, False), ("XXX_C", 3.0, True),
            ("D", 9.0, False), ("D", 7.0, False), ("XXX_E", 6.0, True), ("XXX_T", 8.0, False), (None, 9.0, False), ("F", None, False), ("G", float("nan"), False)]
    df = spark.createDataFrame(rows, "accession string, score double, is_decoy boolean")
    best = {r.accession: r.score for r in confidence.compete(df, "accession", "score", "is_decoy").collect()}
    assert best == {"A": 5.0, "XXX_B": 2.0, "XXX_C": 3.0, "D": 9.0, "XXX_E": 6.0, "XXX_T": 8.0}
    least = {r.accession: (r.score, r.is_decoy) for r in confidence.compete(df, "accession", "score", "is_decoy", higher_is_better=False).collect()}
    assert least == {"XXX_A": (4.0, True), "B": (1.0, False), "XXX_C": (3.0, True), "D": (7.0, False), "XXX_E": (6.0, True), "XXX_T": (8.0, False)}
    rates = {r.accession: (r.q_value, r.error_probability) for r in confidence.protein_confidence(df, "accession", "score", "is_decoy").collect()}
    assert rates["D"] == (0.0, 0.0) and rates["XXX_B"] == (1.0, 1.0) and set(rates) == set(best)
    assert confidence.protein_confidence(df.limit(0), "accession", "score", "is_decoy").count() == 0


def plain_peaks(trace, valley):
    """Peaks of [(x, y)] in order of x: (apex_x, apex_y, left_x, right_x)."""
    key = [(max(y, 0.0), i) for i, (_, y) in enumerate(trace)]
    out = []
    for i, k in enumerate(key):
        sides = [range(i - 1, -1, -1), range(i + 1, len(key))]
        ok = k[0] > 0
        for side in sides:
            low = k[0]
            for j in side:
                if key[j] > k:
                    ok &= low < valley * k[0]
                    break
                low = min(low, key[j][0])
        if ok:
            out.append(i)
    cuts = [0] + [min(range(a, b), key=lambda j: key[j]) for a, b in zip(out, out[1:])] + [len(key) - 1]
    return [(trace[i][0], key[i][0], trace[cuts[n]][0], trace[cuts[n + 1]][0]) for n, i in enumerate(out)]


@pytest.mark.parametrize("chunk", [8, 13, 1000])
@pytest.mark.parametrize("valley", [0.3, 0.8])
def test_peaks_equal_brute_force(spark, chunk, valley):
    rnd = random.Random(chunk)
    walk, traces = 50.0, {}
    traces["noise"] = [(i, float(rnd.randint(0, 6))) for i in range(120)]
    traces["walk"] = [(i, walk := max(-5.0, walk + rnd.uniform(-20, 20))) for i in range(150)]
    traces["up"] = [(i, float(i)) for i in range(60)]
    traces["saw"] = [(i, float(i % 2 * (100 - i)) + 1) for i in range(90)]
    traces["flat"] = [(i, 3.0) for i in range(30)]
    traces["none"] = [(i, 0.0) for i in range(20)]
    traces[None] = [(7, 2.0)]
    traces["two"] = [(i, float(y)) for i, y in enumerate([0, 2, 8, 2, 1, 3, 9, 4, 0])]
    rows = [(g, float(x), y) for g, t in traces.items() for x, y in t] + [("two", 2.0, 1.0), ("two", None, 99.0), ("two", 3.5, None), ("two", float("nan"), 9.0), ("two", 3.5, float("nan"))]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(4)
    got = scans.find_peaks(df, ["g"], "x", "y", valley, chunk_rows=chunk).orderBy("g", "peak").collect()
    for g, t in traces.items():
        mine = [r for r in got if r.g == g]
        assert [r.peak for r in mine] == list(range(1, len(mine) + 1))
        assert [(r.apex_x, r.apex_y, r.left_x, r.right_x) for r in mine] == plain_peaks(t, valley), g
        for r in mine:
            inside = [(x, max(y, 0.0)) for x, y in t if r.left_x <= x <= r.right_x]
            assert r.n_points == len(inside)
            assert r.area == pytest.approx(sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(inside, inside[1:])))
    two = [r for r in got if r.g == "two"]
    assert [r.apex_x for r in two] == [2.0, 6.0] and two[0].sn > 1


def test_peaks_of_nothing(spark):
    df = spark.createDataFrame([], "g string, x double, y double")
    assert scans.find_peaks(df, ["g"], "x", "y").count() == 0
    with pytest.raises(ValueError, match="below 1"):
        scans.find_peaks(df, ["g"], "x", "y", 1.0)


def test_contraction_stops_only_when_both_cuts_change_nothing(spark):
    """A rule that drops the first of two equal neighbours: a run of one value over many chunks ends as one row."""
    def shrink(pdf):
        return pdf[pdf.v != pdf.v.shift(-1)]

    df = spark.createDataFrame([(i, 1 if i < 500 else i) for i in range(600)], "i int, v int")
    got = ordered.contracted(df.withColumn("g", F.lit(1)), "i", ["g"], shrink, 2, chunk_rows=16)
    assert sorted(r.v for r in got.collect()) == [1] + list(range(500, 600))
