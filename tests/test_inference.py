"""Greedy cover equals the one-at-a-time greedy; components equal union-find."""

import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from ionframe.operators import inference


def sequential_greedy(edges):
    prot = {}
    for pep, pr in edges:
        prot.setdefault(pr, set()).add(pep)
    total = {p: len(s) for p, s in prot.items()}
    uncovered = {pep for pep, _ in edges}
    out = {}
    while uncovered:
        best = min(prot, key=lambda p: (-len(prot[p] & uncovered), -total[p], p))
        for pep in prot[best] & uncovered:
            out[pep] = best
        uncovered -= prot[best]
    return out


def test_greedy_cover_equals_sequential(spark):
    for seed in range(3):
        rnd = random.Random(seed)
        edges = sorted({(rnd.randint(0, 80), rnd.randint(0, 25)) for _ in range(220)})
        # identical peptide sets and a chain of overlaps
        edges += [(500, 90), (501, 90), (500, 91), (501, 91), (600, 92), (601, 92), (601, 93), (602, 93)]
        df = spark.createDataFrame(edges, "peptide long, protein long")
        got = {r[0]: r[1] for r in inference.greedy_cover(df, share=1).collect()}
        assert got == sequential_greedy(edges)


def test_unique_only_and_prior(spark):
    edges = [(1, "A"), (2, "A"), (2, "B"), (3, "B"), (4, "C")]
    df = spark.createDataFrame(edges, "peptide long, protein string")
    uo = sorted(tuple(r) for r in inference.unique_only(df).collect())
    assert uo == [(1, "A"), (3, "B"), (4, "C")]
    prior = spark.createDataFrame([("B",)], "accession string")
    res = sorted(tuple(r) for r in inference.infer_parsimony(df, prior=prior, prior_col="accession").collect())
    # B explains 2 and 3 first; 1 and 4 by the rest
    assert res == [(1, "A"), (2, "B"), (3, "B"), (4, "C")]


def test_connected_components(spark):
    rnd = random.Random(11)
    edges = [(rnd.randint(0, 60), rnd.randint(0, 60)) for _ in range(45)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in inference.connected_components(df, "a", "b").collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    comp = {}
    for n in nodes:
        comp.setdefault(find(n), []).append(n)
    exp = {n: min(ms) for ms in comp.values() for n in ms}
    assert got == exp


def test_filter_fdr_drops_decoys(spark):
    rows = [(10.0, False), (9.0, False), (8.0, True), (7.0, False), (6.0, True), (5.0, True)]
    df = spark.createDataFrame(rows, "score double, is_decoy boolean")
    kept = sorted(r["score"] for r in inference.filter_fdr(df, "score", "is_decoy", 0.0).collect())
    assert kept == [9.0, 10.0]


def parallel_greedy(edges, share=0.5):
    """Rounds of votes by plain loops; {peptide: protein}."""
    left, out = set(edges), {}
    while left:
        of = {}
        for pep, pr in left:
            of.setdefault(pr, set()).add(pep)

        def key(p):
            lead = bin(len(of[p]))[2:]
            return -len(lead), -int(lead[:4], 2), int(hashlib.md5(str(p).encode()).hexdigest()[:15], 16), p

        by_pep = {}
        for pep, pr in left:
            by_pep.setdefault(pep, []).append(pr)
        votes = Counter(min(ps, key=key) for ps in by_pep.values())
        taken = {p for p, v in votes.items() if v >= share * len(of[p])}
        for pep, ps in by_pep.items():
            mine = [p for p in ps if p in taken]
            if mine:
                out[pep] = min(mine, key=key)
        left = {(pep, p) for pep, p in left if pep not in out}
    return out


def test_dense_graphs_by_share(spark):
    # every protein overlaps every other
    for seed, n_prot, deg in ((21, 40, 6), (3, 12, 3)):
        rnd = random.Random(seed)
        edges = sorted({(pep, rnd.randint(0, n_prot - 1)) for pep in range(100) for _ in range(deg)})
        df = spark.createDataFrame(edges, "peptide long, protein long")
        assert {r[0]: r[1] for r in inference.greedy_cover(df, share=1).collect()} == sequential_greedy(edges)
        assert {r[0]: r[1] for r in inference.greedy_cover(df).collect()} == parallel_greedy(edges)


def test_greedy_takes_the_larger_rest_not_the_earlier_neighbour(spark):
    # after A the next pick is C (9 left) not B (7 left); C's peptides 11-13 are also B's
    edges = [(p, "A") for p in range(1, 11)] + [(p, "B") for p in [1, 2] + list(range(11, 18))] \
        + [(p, "C") for p in [11, 12, 13] + list(range(20, 26))]
    df = spark.createDataFrame(edges, "peptide long, protein string")
    assert {r[0]: r[1] for r in inference.greedy_cover(df, share=1).collect()} == sequential_greedy(edges)
    assert {r[0]: r[1] for r in inference.greedy_cover(df).collect()} == parallel_greedy(edges)


def test_hub_ends_in_few_rounds(spark):
    # one hub protein over 3,000 small ones: after the hub nothing is shared
    hub = [(i, 0) for i in range(3000)]
    small = [(i, i + 1) for i in range(3000)] + [(10_000 + i, i + 1) for i in range(3000)]
    df = spark.createDataFrame(hub + small, "peptide long, protein long")
    for share in (0.5, 1):
        rounds = []
        got = {r[0]: r[1] for r in inference.greedy_cover(df, share=share, rounds=rounds).collect()}
        assert len(rounds) <= 3
        assert got == {i: 0 for i in range(3000)} | {10_000 + i: i + 1 for i in range(3000)}


def test_one_component_of_a_million_edges(spark):
    e = spark.range(1_000_000).select((F.col("id") % 50_000).alias("peptide"), F.pmod(F.xxhash64("id"), F.lit(2000)).alias("protein"))
    rounds = []
    got = inference.greedy_cover(e, rounds=rounds)
    assert len(rounds) <= 25
    n = got.agg(F.count("*"), F.countDistinct("peptide"), F.countDistinct("protein")).first()
    # 500 peptides a protein, each with 20 proteins: a cover by chance alone takes over 450
    assert n[0] == n[1] == 50_000 and n[2] < 450
    assert got.join(e.distinct(), on=["peptide", "protein"], how="left_anti").isEmpty()


def test_protein_groups_equal_brute_force(spark):
    rnd = random.Random(5)
    sets = {f"p{i:03}": frozenset(rnd.sample(range(60), rnd.randint(1, 4))) for i in range(150)}
    sets |= {f"q{i}": frozenset(range(i, i + 12)) for i in range(0, 30, 3)} | {f"r{i}": frozenset(range(i + 2, i + 10)) for i in range(0, 30, 6)}
    sets |= {f"s{i}": frozenset(range(i, i + 12)) for i in range(0, 30, 9)} | {"hot": frozenset([1]), "hot2": frozenset([1])}
    df = spark.createDataFrame([(x, p) for p, s in sets.items() for x in s] * 2 + [(None, "z"), (7, None)], "peptide long, protein string")
    want = []
    for p, s in sets.items():
        above = sorted((-len(t), q) for q, t in sets.items() if s < t)
        want.append((p, min(q for q, t in sets.items() if t == s), len(s), above[0][1] if above else None))
    assert sorted(map(tuple, inference.protein_groups(df).collect())) == sorted(want)
    reps = {p for p, g, _, c in want if c is None and g == p}
    cover = parallel_greedy([(x, p) for p in reps for x in sets[p]])
    size = Counter(g for _, g, _, _ in want)
    assert {r[0]: (r[1], r[2]) for r in inference.collapsed_cover(df).collect()} == {x: (p, size[p]) for x, p in cover.items()}


def test_empty_and_null_edges(spark):
    df = spark.createDataFrame([(None, 1), (1, None)], "peptide long, protein long")
    assert inference.greedy_cover(df).count() == 0


def test_long_chain_ends_in_logarithmic_rounds(spark):
    from ionframe.operators.components import star_components
    rounds = []
    got = star_components(spark.createDataFrame([(i, i + 1) for i in range(10_000)], "a long, b long"), "a", "b", rounds).collect()
    assert len(rounds) <= 30 and len(got) == 10_001 and {r["component"] for r in got} == {0}
