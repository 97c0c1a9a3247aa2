"""Registered queries run on all rows and reach every part of their operator."""

import itertools

import __spark_entry__ as E
import pytest
from ionframe.functions.constants import PROTON, WATER
from ionframe.plans.tables import table
from tests.test_inference import parallel_greedy

SF = "/root/testdata/sf0.01"


def test_prior_leaves_parts_to_the_greedy(spark):
    edges = {tuple(r) for r in table(spark, SF, "lineitem").select("l_partkey", "l_suppkey").distinct().collect()}
    prior = {r[0] for r in table(spark, SF, "supplier").where("s_nationkey < 2").select("s_suppkey").collect()}
    kept = {(p, s) for p, s in edges if s in prior}
    reached = {p for p, _ in kept}
    rest = parallel_greedy(sorted((p, s) for p, s in edges if p not in reached))
    assert len(rest) > 200 and len(kept) > 200
    got = [(r.l_partkey, r.l_suppkey) for r in E.queries()["q98_sparse_prior_cover"](spark, SF).collect()]
    assert sorted(got) == sorted([*kept, *rest.items()])


def test_every_line_comes_back(spark):
    n = table(spark, SF, "lineitem").count()
    got = E.queries()["q99_psm_round_trip_all"](spark, SF)
    assert got.count() == 2 * n and got.where("is_decoy").count() == n and got.select("charge").distinct().count() > 1


def test_all_parts_and_forms_of_several_sites(spark):
    names = {r.p_partkey: r.p_name for r in table(spark, SF, "part").collect()}
    got = {(r.p_partkey, r.form, r.charge): r for r in E.queries()["q100_modified_fragments_all"](spark, SF).collect()}
    forms = {(k, c) for k, s in names.items() for m in range(4) for c in itertools.combinations([i + 1 for i, x in enumerate(s) if x in "ae"], m)}
    assert set(got) == {(k, ",".join(map(str, c)), z) for k, c in forms for z in (1, 2)} and max(len(c) for _, c in forms) == 3
    for k, c in sorted(forms)[::50]:
        masses = [ord(x) + ({"a": 16, "e": 1}[x] if i + 1 in c else 0) for i, x in enumerate(names[k])]
        for z in (1, 2):
            r = got[k, ",".join(map(str, c)), z]
            assert r.n == len(masses) - 1
            assert r.b == pytest.approx(sum(sum(masses[:i]) / z + PROTON for i in range(1, len(masses))), abs=2e-3)
            assert r.y == pytest.approx(sum((sum(masses[i:]) + WATER) / z + PROTON for i in range(1, len(masses))), abs=2e-3)
