"""What large tables asked of the operators: no broadcasts by guessed bytes, few bytes before a join, whole greedy covers."""

from pyspark.sql import functions as F

from ionframe.operators import hits, scans, search, sites
from ionframe.operators.rangejoin import Tol, range_join


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_search_broadcasts_no_fragments(spark):
    pep = spark.createDataFrame([(1, "AB", 100.0), (2, "BA", 100.0)], "pid long, peptide string, mass double")
    spectra = spark.createDataFrame([(7, 51.0, 2)], "scan long, precursor_mz double, charge int")
    peaks = spark.createDataFrame([(7, 66.0, 1.0)], "scan long, mz double, intensity double")
    got = search.search_spectra(spectra, peaks, pep, ["scan"], ["pid"], "peptide", {"A": 65.0, "B": 66.0})
    assert "BroadcastHashJoin" not in _plan(got)


def test_modification_list_is_the_broadcast_side(spark, tmpdir_path):
    spark.createDataFrame([(1, "rat"), (2, "tree")], "id long, name string").write.parquet(f"{tmpdir_path}/p")
    defs = spark.createDataFrame([("", "r", "Di", 28.0), ("", "e", "Ox", 16.0)], "symbol string, residue string, mod_name string, mass double")
    d = hits.mod_details(spark.read.parquet(f"{tmpdir_path}/p"), ["id"], "name", defs, "a-z")
    assert "BuildRight" in _plan(d) and "BuildLeft" not in _plan(d)
    assert sorted((r.id, r.position, r.mod_name) for r in d.collect()) == [(1, 1, "Di"), (2, 2, "Di"), (2, 3, "Ox"), (2, 4, "Ox")]
    assert sorted((r.mod_name, r.n, r.n_items) for r in hits.mod_summary(d, ["id"]).collect()) == [("Di", 2, 2), ("Ox", 2, 1)]


def test_fragments_of_a_dense_range_are_spread(spark):
    peaks = spark.createDataFrame([(i, 100 + i / 100, "CID" if i % 2 else "HCD") for i in range(400)], "k long, mz double, activation string")
    frags = spark.createDataFrame([(i, 100 + i / 10) for i in range(40)], "f long, fmz double")
    got = sites.match_fragments(peaks, frags, [], "mz", "fmz")
    assert "REPARTITION_BY_NUM" in _plan(got) and "BroadcastHashJoin" not in _plan(got)
    tol = {"CID": 0.5, "HCD": 0.05}
    want = {(p.k, f.f) for p in peaks.collect() for f in frags.collect() if abs(p.mz - f.fmz) <= tol[p.activation]}
    assert {(r.k, r.f) for r in got.collect()} == want


def test_uneven_tolerances_are_whole_and_spread(spark):
    s = spark.createDataFrame([(i, 100 + i / 7, 1) for i in range(300)], "k long, mz double, z int")
    peps = spark.createDataFrame([(i, 99 + i / 3) for i in range(60)], "p long, pm double")
    got = search.match_candidates(s, peps, "mz", "z", "pm", (0.5, 2.0), isotopes=(0,), ppm=False)
    assert "REPARTITION_BY_NUM" in _plan(got) and "BroadcastHashJoin" not in _plan(got)
    from ionframe.functions.constants import PROTON
    want = {(a.k, b.p) for a in s.collect() for b in peps.collect() if abs(a.mz - PROTON - (b.pm + 0.75)) <= 1.25}
    assert {(r.k, r.p) for r in got.collect()} == want


def test_left_rows_beyond_all_intervals_go_before_the_shuffle(spark):
    left = spark.createDataFrame([(1, 5.0), (2, 100.0), (3, 1e6), (4, None)], "k long, x double")
    right = spark.createDataFrame([(1, 100.001), (2, None)], "r long, y double")
    for t in (Tol("x", "y", 0.01), Tol("x", "y", 20.0, ppm=True)):
        j = range_join(left, right, [t])
        below = _plan(j).split("REPARTITION_BY_NUM")[1]
        assert "scalar-subquery" in below or "Subquery" in below
        assert [(r.k, r.r) for r in j.collect()] == [(2, 1)]
        assert {(r.k, r.r) for r in range_join(left, right, [t], how="left").collect()} == {(1, None), (2, 1), (3, None), (4, None)}
        assert range_join(left, right.limit(0), [t]).count() == 0


def test_one_tag_a_mass_meets_the_masses(spark, monkeypatch):
    seen = []
    join = hits.range_join
    monkeypatch.setattr(hits, "range_join", lambda a, b, *x, **y: (seen.append(b.count()), join(a, b, *x, **y))[1])
    mods = spark.createDataFrame([(1, 10.01), (2, 10.05), (3, 99.0)], "m long, mass double")
    tags = spark.createDataFrame([(i, 10.0 + (i % 2) / 10) for i in range(50)], "tag long, tm double")
    got = hits.name_masses(mods, tags, ["m"], "mass", "tm", "tag", 0.06).orderBy("m").collect()
    assert seen == [2]
    assert [(r.m, r.tag, round(r.distance, 6)) for r in got] == [(1, 0, 0.01), (2, 1 if abs(10.05 - 10.1) < abs(10.05 - 10.0) else 0, 0.05)]


def _one_at_a_time(edges) -> dict:
    of: dict = {}
    for p, s in edges:
        of.setdefault(s, set()).add(p)
    total, owner = {s: len(x) for s, x in of.items()}, {}
    while any(of.values()):
        best = min((s for s in of if of[s]), key=lambda s: (-len(of[s]), -total[s], s))
        taken = set(of[best])
        owner |= {p: best for p in taken}
        for s in of:
            of[s] -= taken
    return owner


def _cover_tables(spark, at):
    """Supplier 2 holds as many uncovered parts as 1 and 3 after the first pick, but one more in all."""
    edges = [(p, 9) for p in range(6)] + [(p, 1) for p in (6, 7)] + [(p, 2) for p in (0, 7, 8)] + [(p, 3) for p in (8, 9)] + [(p, 4) for p in (6, 9, 10, 11)]
    edges += [(p, 5) for p in (12, 13, 14)] + [(p, 6) for p in (14, 15, 16)] + [(p, 7) for p in (13, 16, 17)]
    spark.createDataFrame(edges, "l_partkey long, l_suppkey long").write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame([(s, 0 if s == 9 else 5) for s in range(1, 10)], "s_suppkey long, s_nationkey int").write.parquet(f"{at}/supplier.parquet")
    return edges


def test_parsimony_is_the_greedy_cover(spark, tmpdir_path):
    from ionframe.plans.oracle import ORACLE
    from ionframe.plans.queries import q18_parsimony
    edges = _cover_tables(spark, tmpdir_path)
    assert {r[0]: r[1] for r in q18_parsimony(spark, tmpdir_path).collect()} == _one_at_a_time(edges)
    assert "rounds(" not in ORACLE["q18_parsimony"] and "LIMIT 1" in ORACLE["q18_parsimony"]


def test_sparse_prior_leaves_the_rest_to_the_greedy(spark, tmpdir_path):
    from ionframe.plans.coverage import ORACLE, q98_sparse_prior_cover
    edges = _cover_tables(spark, tmpdir_path)
    reached = {p for p, s in edges if s == 9}
    rest = _one_at_a_time([(p, s) for p, s in edges if p not in reached])
    got = q98_sparse_prior_cover(spark, tmpdir_path).collect()
    assert {r.l_partkey: r.l_suppkey for r in got if r.l_suppkey != 9} == rest
    assert {r.l_partkey for r in got if r.l_suppkey == 9} == reached
    assert "rounds(" not in ORACLE["q98_sparse_prior_cover"] and "LIMIT 1" in ORACLE["q98_sparse_prior_cover"]


def test_sets_of_one_peptide_need_no_pairs(spark, monkeypatch):
    from ionframe.operators import inference
    pairs, keep = [], inference.materialize
    monkeypatch.setattr(inference, "materialize", lambda df, name: (pairs.append(df.count()) if name == "group-candidates" else None, keep(df, name))[1])
    edges = [(0, 1)] + [(p, s) for s in range(2, 30) for p in (0, 100 + s, 200 + s)] + [(p, 40) for p in (0, 105, 205, 300)]
    got = inference.protein_groups(spark.createDataFrame(edges, "peptide long, protein long")).collect()
    assert {(r.protein, r.contained_in) for r in got if r.contained_in is not None} == {(1, 40), (5, 40)}
    assert pairs[0] < 10


def test_forms_of_few_bytes_of_names_are_spread(spark, tmpdir_path):
    from ionframe.plans.coverage import q100_modified_fragments_all
    spark.createDataFrame([(1, "ab"), (2, "ae")], "p_partkey long, p_name string").coalesce(1).write.parquet(f"{tmpdir_path}/part.parquet")
    got = q100_modified_fragments_all(spark, tmpdir_path)
    assert "REPARTITION_BY_NUM" in _plan(got)
    assert sorted((r.p_partkey, r.form, r.charge, r.n) for r in got.collect()) == sorted(
        (p, f, z, 1) for p, fs in ((1, ("", "1")), (2, ("", "1", "2", "1,2"))) for f in fs for z in (1, 2))


def test_runs_are_files_of_one_folder(spark, tmpdir_path, monkeypatch):
    from ionframe.plans import further
    spark.createDataFrame([(1, "a", 2), (4, "b", 0), (5, "c", 3)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{tmpdir_path}/supplier.parquet")
    monkeypatch.setattr(further, "_folder", lambda spark, name: f"{tmpdir_path}/{name}")
    got = further.q109_run_metadata(spark, tmpdir_path).collect()
    assert sorted((r.id, r.duration_s, r.n_files, r.status) for r in got) == [("a", 120.0, 1, "Succeeded"), ("b", 0.0, 1, None), ("c", 180.0, 1, "Succeeded")]
    import os
    assert not any(os.path.isdir(f"{tmpdir_path}/runs/{x}") for x in os.listdir(f"{tmpdir_path}/runs"))


def test_equal_prices_are_one_pair(spark, tmpdir_path, monkeypatch):
    from ionframe.plans import coverage

    lines = [(i, 1, 2.0, m and 2 * m) for i, m in enumerate([101.5] * 40 + [103.1] * 3 + [200.0, None])]
    parts = [(i % 25, 100.0) for i in range(30)] + [(40, 101.0), (41, 500.0), (42, None)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double").write.parquet(f"{tmpdir_path}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_retailprice double").write.parquet(f"{tmpdir_path}/part.parquet")
    pairs, match = [], search.match_candidates

    def counted(*args, **kw):
        pairs.append(match(*args, **kw))
        return pairs[-1]

    monkeypatch.setattr(search, "match_candidates", counted)
    got = {r.p_partkey: r.n for r in coverage.q92_uneven_tolerance(spark, tmpdir_path).collect()}
    assert got == {**{i: 40 * (1 + (i < 5)) for i in range(25)}, 40: 3}
    assert pairs[0].count() == 2


def test_rows_of_one_value_travel_as_lists(spark):
    left = spark.createDataFrame([(i, 100 + i / 10) for i in range(20)], "k long, x double")
    right = spark.createDataFrame([(i % 90, 101.0 if i % 2 else None if i % 3 else 100.5, None if i % 5 else "a") for i in range(100)], "r long, y double, z string")
    j = range_join(left, right, [Tol("x", "y", 0.1)])
    assert "explode(_rows" in _plan(j) and j.columns == ["k", "x", "r", "y", "z"]
    want = sorted(str((a.k, a.x, *b)) for a in left.collect() for b in right.collect() if b.y is not None and abs(a.x - b.y) <= 0.1)
    assert sorted(str(tuple(r)) for r in j.collect()) == want and len(want) > 100


def test_partitions_of_a_dense_range_grow_with_its_rows(spark, monkeypatch):
    from ionframe.operators import rangejoin

    monkeypatch.setattr(rangejoin, "_RIGHT_ROWS", 10)
    left = spark.range(100).select("id", (F.col("id") / 10).alias("x"))
    right = spark.range(50).select(F.col("id").alias("r"), (F.col("id") / 5).alias("y"))
    j = range_join(left, right, [Tol("x", "y", 0.15)])
    assert "_lb0#" in _plan(j) and ", 25), REPARTITION_BY_NUM" in _plan(j)
    assert j.count() == sum(abs(i / 10 - k / 5) <= 0.15 for i in range(100) for k in range(50))


def test_parent_ions_are_grouped_as_by_all_pairs(spark):
    import math
    import random

    rnd = random.Random(5)
    ions = [(i, rnd.choice("ab"), rnd.uniform(0, 60), rnd.uniform(0, 12), {b: rnd.choice([0.0, 1.0, 2.0, 5.0]) for b in rnd.sample(range(5), rnd.randint(1, 3))}) for i in range(400)]
    ions += [(1000 + i, *x[1:]) for i, x in enumerate(ions[:150])] + [(2000, "a", None, 1.0, {0: 1.0}), (2001, "a", float("nan"), 1.0, {0: 1.0})]
    p = spark.createDataFrame([(k, i, m, t) for i, k, m, t, _ in ions] + [("a", 3000, 1.0, 1.0), ("a", None, 1.0, 1.0)], "ds string, id long, mz double, rt double")
    b = spark.createDataFrame([(k, i, c, v) for i, k, _, _, s in ions for c, v in s.items()], "ds string, id long, bin long, total double")
    root = {(k, i): (k, i) for i, k, *_ in ions}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    norm = {i: math.sqrt(sum(v * v for v in s.values())) for i, _, _, _, s in ions}
    for n, x in enumerate(ions):
        for y in ions[:n]:
            if x[1] == y[1] and None not in (x[2], y[2]) and abs(x[2] - y[2]) <= 2 and abs(x[3] - y[3]) <= 1 and norm[x[0]] * norm[y[0]] > 0:
                if sum(v * y[4].get(c, 0.0) for c, v in x[4].items()) / (norm[x[0]] * norm[y[0]]) >= 0.9:
                    u, w = sorted((find((x[1], x[0])), find((y[1], y[0]))))
                    root[w] = u
    want = sorted([*(str((*x, find(x)[1])) for x in root), str(("a", 3000, 3000)), str(("a", None, None))])
    got = scans.group_parent_ions(p, b, "id", "mz", "rt", 2.0, 1.0, 0.9, keys=["ds"])
    assert sorted(str(tuple(r)) for r in got.collect()) == want and len({find(x) for x in root}) > 50


def test_equal_parent_ions_make_no_pairs(spark, monkeypatch):
    from ionframe.operators import components

    seen, star = [], components.star_components

    def counted(edges, a, b, rounds=None):
        seen.append(edges.count())
        return star(edges, a, b, rounds)

    monkeypatch.setattr(components, "star_components", counted)
    n = 300
    p = spark.createDataFrame([(i, 500.0 + i // 100 * 0.01, 1.0) for i in range(n)], "id long, mz double, rt double")
    b = spark.createDataFrame([(i, c, 1.0 + c) for i in range(n) for c in range(3)], "id long, bin long, total double")
    assert {r.group_id for r in scans.group_parent_ions(p, b, "id", "mz", "rt").collect()} == {0}
    assert sum(seen) < 20


def test_cosine_is_found_once_a_pair(spark, tmpdir_path):
    from ionframe.plans import queries

    rows = [(i, [((i * 7 + k) % 5 - 2) / 50 for k in range(4)] if i % 9 else None, i % 2) for i in range(60)] + [(70, [0.0, 0.0, 0.0, 0.0], 0)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmpdir_path}/embeddings.parquet")
    q = queries.q50_cosine(spark, tmpdir_path)
    assert _plan(q).count("zip_with") == 1 and "REPARTITION_BY_NUM" in _plan(q)
    v = {r.vec_id: (r.embedding, r.label) for r in spark.read.parquet(f"{tmpdir_path}/embeddings.parquet").collect()}
    want = {}
    for i, (x, k) in v.items():
        for j, (y, m) in v.items():
            if x and y and i < j and k == m and abs(x[0] - y[0]) <= 0.05 and abs(x[1] - y[1]) <= 0.05:
                n = sum(e * e for e in x) ** 0.5 * sum(e * e for e in y) ** 0.5
                c = sum(e * f for e, f in zip(x, y)) / n if n else -1
                if c >= 0:
                    want[i, j] = c
    got = {(r.vec_a, r.vec_b): r.cosine for r in q.collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_cover_one_at_a_time_takes_few_rounds(spark, monkeypatch):
    import random
    from ionframe.operators import inference
    rnd = random.Random(4)
    # two dense components and chains of small ones
    edges = [(c * 1000 + p, c * 100 + rnd.randrange(12)) for c in (0, 1) for p in range(60) for _ in range(3)]
    edges += [(5000 + i + j, 1000 + i) for i in range(0, 20, 4) for j in range(3)]
    edges = sorted(set(edges))
    df = spark.createDataFrame(edges, "peptide long, protein long")
    # components of a task each; components that no task takes whole
    for limit, most in ((200, 1), (130, 3)):
        monkeypatch.setattr(inference, "TASK_EDGES", limit)
        rounds: list = []
        got = {r[0]: r[1] for r in inference.greedy_cover(df, share=1, rounds=rounds).collect()}
        assert got == _one_at_a_time(edges)
        assert len(rounds) <= most, (limit, len(rounds))


CHAINS = {"a": 10.0, "b": 23.0, "c": 37.0, "d": 41.0}


def _chains(spark):
    import random
    rnd = random.Random(9)
    rows = [(i, "".join(rnd.sample("aabbccdd", 8))) for i in range(24)] + [(5, "ddccbbaa"), (None, "abcdabcd"), (None, "abcddcba"), (40, "aaabbccdd"), (41, "badcaabcd"), (42, "a"), (43, "abx")]
    return search.peptide_mass(spark.createDataFrame(rows, "pid long, peptide string"), "peptide", CHAINS)


def test_search_by_blocks_equals_all_pairs(spark, monkeypatch):
    """Repeated keys of spectra and peptides, null keys, heights and charges, several blocks a bin."""
    import math
    from collections import defaultdict

    from ionframe.functions.constants import ISOTOPE_SPACING, PROTON
    monkeypatch.setattr(search, "PEPTIDES", 8)
    monkeypatch.setattr(search, "SPECTRA", 4)
    pep = _chains(spark).cache()
    mass = {r.peptide: r.mass for r in pep.collect()}
    spectra = [(i, mass["ddccbbaa"] / 2 + PROTON, 2) for i in range(10)] + [(3, mass["aaabbccdd"] / 2 + PROTON, 2), (4, mass["ddccbbaa"] / 2 + PROTON, 2),
               (11, mass["aaabbccdd"] / 3 + PROTON, None), (None, mass["ddccbbaa"] / 2 + PROTON, 2), (12, None, 2)]
    frags = [(r.pid, r.mass, m) for r in search.theoretical_fragments(pep, "peptide", CHAINS, ["pid", "mass"]).collect() for m in (r.b_ion, r.y_ion)]
    some = sorted({m for _, _, m in frags})
    peaks = [(i, some[(7 * i + 3 * j) % len(some)] + 0.013 * (j % 3), [1.37, 2.91, None, 0.0, 7.77][(i + j) % 5] if i != 9 else None) for i in range(13) for j in range(14)] + [(1, None, 3.0), (2, float("nan"), 3.0)]
    got = search.search_spectra(spark.createDataFrame(spectra, "scan long, precursor_mz double, charge int"), spark.createDataFrame(peaks, "scan long, mz double, intensity double"),
                                pep, ["scan"], ["pid"], "peptide", CHAINS, n=2, isotopes=(0, 1), frag_tol=0.02)
    acc: dict = defaultdict(list)
    for scan, mz, z0 in spectra:
        for z in [z0] if z0 else (2, 3, 4, 5):
            for iso in (0, 1):
                for pid, m, f in frags if mz is not None and scan is not None else []:
                    if abs((mz - PROTON) * z - iso * ISOTOPE_SPACING - m) <= m * (20.0 / 1e6):
                        for s, x, h in peaks:
                            if s == scan and x is not None and abs(x - f) <= 0.02:
                                acc[scan, z, iso, pid].append(h)
    want = []
    for scan in {k[0] for k in acc}:
        found = []
        for (_, z, iso, pid), hs in ((k, v) for k, v in acc.items() if k[0] == scan):
            known = [h for h in hs if h is not None]
            total = sum(known) if known else None
            score = sum(math.log10(i) for i in range(1, len(hs) + 1)) + math.log10(total) if total else None
            found.append(((score is None, -(score or 0)), abs(iso), iso, z, (pid is not None, pid or 0), pid, len(hs), None if total is None else round(total, 6)))
        want += [(scan, r[3], r[2], *r[5:], i) for i, r in enumerate(sorted(found, key=lambda r: ((r[0][0], round(r[0][1], 9)), *r[1:5]))[:2], 1)]
    none = lambda rows: sorted(rows, key=lambda r: (r[0], r[-1]))
    assert {r[0] for r in want} >= {0, 3, 9, 11} and any(r[3] is None for r in want)
    assert none((r.scan, r.charge, r.isotope, r.pid, r.n_matched, None if r.matched_intensity is None else round(r.matched_intensity, 6), r.rn) for r in got.collect()) == none(want)
    pep.unpersist()


def test_pairs_of_equal_masses_stay_in_their_task(spark, monkeypatch):
    from ionframe.functions.constants import PROTON
    seen, top = [], search.top_n
    monkeypatch.setattr(search, "top_n", lambda g, *x, **y: (seen.append(g.count()), top(g, *x, **y))[1])
    pep = _chains(spark).where("pid < 24")
    spectra = pep.select(F.col("pid").alias("scan"), (F.col("mass") / 2 + PROTON).alias("precursor_mz"), F.lit(2).alias("charge")).dropDuplicates(["scan"])
    ions = search.theoretical_fragments(pep, "peptide", CHAINS, ["pid"])
    peaks = ions.select(F.col("pid").alias("scan"), F.col("b_ion").alias("mz"), (F.col("pos") * F.col("pos") * 1.03).alias("intensity"))
    got = search.search_spectra(spectra, peaks, pep, ["scan"], ["pid"], "peptide", CHAINS, n=1, frag_tol=0.02)
    assert got.count() == 24
    assert seen[0] <= 30  # of hundreds of pairs
